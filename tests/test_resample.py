"""Resampling against the two-dimensional sums written out."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellweave.operators import resample


def weight(kernel, d):
    if kernel == "bilinear":
        return max(0.0, 1 - d)
    if kernel == "cubic":
        return 1.5 * d**3 - 2.5 * d**2 + 1 if d < 1 else -0.5 * d**3 + 2.5 * d**2 - 4 * d + 2 if d < 2 else 0.0
    return (3 * d**3 - 6 * d**2 + 4) / 6 if d < 1 else (2 - d) ** 3 / 6 if d < 2 else 0.0


def direct(image, height, width, kernel):
    out = np.full((height, width), np.nan)
    sy, sx = image.shape[0] / height, image.shape[1] / width
    for i in range(height):
        for j in range(width):
            total = parts = 0.0
            for r in range(image.shape[0]):
                for c in range(image.shape[1]):
                    if not np.isnan(image[r, c]):
                        w = weight(kernel, abs((i + 0.5) * sy - r - 0.5) / max(1, sy)) * weight(kernel, abs((j + 0.5) * sx - c - 0.5) / max(1, sx))
                        total, parts = total + w * image[r, c], parts + w
            if parts > 1e-6:
                out[i, j] = total / parts
    return out


def frame(spark, image, tile=1):
    rows = [(tile, r, c, None if np.isnan(v) else float(v), 9) for r, row in enumerate(image) for c, v in enumerate(row)]
    return spark.createDataFrame(rows, "tile int, r int, c int, z double, w int")


def picture(df, shape, tile=1):
    out = np.full(shape, np.nan)
    for x in df.where(F.col("tile") == tile).collect():
        out[x.r, x.c] = x.z
    return out


@pytest.mark.parametrize("kernel", ["bilinear", "cubic", "cubicspline"])
@pytest.mark.parametrize("size", [(18, 10), (27, 11), (3, 2), (4, 7)])
def test_any_size_and_missing_cells(spark, kernel, size):
    image = np.random.default_rng(1).normal(size=(9, 5)) * 100
    image[4, 2] = image[0, 0] = np.nan
    shape = spark.createDataFrame([(1, 9, 5, *size)], "tile int, height int, width int, new_height int, new_width int")
    got = picture(resample.resize(frame(spark, image), "z", shape, kernel), size)
    np.testing.assert_allclose(got, direct(image, *size, kernel), rtol=1e-9, atol=1e-9)


def test_kernels_keep_planes_and_constants(spark):
    plane = np.add.outer(np.arange(8) * 3.0, np.arange(8) * 2.0)
    for kernel in ("bilinear", "cubic", "cubicspline"):
        got = picture(resample.enlarge(frame(spark, plane), "z", 2, kernel), (16, 16))
        want = np.add.outer(((np.arange(16) + 0.5) / 2 - 0.5) * 3, ((np.arange(16) + 0.5) / 2 - 0.5) * 2)
        np.testing.assert_allclose(got[4:-4, 4:-4], want[4:-4, 4:-4], atol=1e-9)
        assert not np.isnan(got).any()


def test_coarse_smoothing(spark):
    image = np.random.default_rng(2).normal(size=(26, 37))
    got = picture(resample.coarse(frame(spark, image), "z", 12), image.shape)
    small = direct(image, 2, 3, "bilinear")
    want = np.array([[small[int((r + 0.5) * 2 / 26), int((c + 0.5) * 3 / 37)] for c in range(37)] for r in range(26)])
    np.testing.assert_allclose(got, want, rtol=1e-9)
    tiny = picture(resample.coarse(frame(spark, image[:3, :4]), "z", 12), (3, 4))
    assert len(np.unique(tiny.round(9))) == 1
    assert resample.coarse(frame(spark, image).where("false"), "z").collect() == []
