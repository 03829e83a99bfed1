"""Which mission a scene's folder belongs to, and which of its files and bands hold each layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: By mission, the pattern of each layer's file name and the number of its band there (-: the file alone).
LAYERS = r"""
SEN2COR green .*_B03_10m.jp2$ 1
SEN2COR red .*_B04_10m.jp2$ 1
SEN2COR swir .*_B11_20m.jp2$ 1
SEN2COR cloud .*_SCL_20m.jp2$ -
MAJA green .*FRE_R1.DBL.TIF$ 2
MAJA red .*FRE_R1.DBL.TIF$ 3
MAJA swir .*FRE_R2.DBL.TIF$ 5
MAJA cloud .*CLD_R2.DBL.TIF$ -
MAJA dem .*ALT_R2\.TIF$ -
S2 blue .*SRE_B2.*\.tif$ 1
S2 green .*FRE_B3.*\.tif$ 1
S2 red .*FRE_B4.*\.tif$ 1
S2 nir .*SRE_B8A.*\.tif$ 1
S2 swir .*FRE_B11.*\.tif$ 1
S2 cloud .*CLM_R2.*\.tif$ -
S2 div .*MG2_R2.*\.tif$ -
S2 dem .*ALT_R2\.TIF$ -
S2 metadata .*MTD_ALL.*\.xml$ -
Take5 green .*ORTHO_SURF_CORR_PENTE.*\.TIF$ 1
Take5 red .*ORTHO_SURF_CORR_PENTE.*\.TIF$ 2
Take5 swir .*ORTHO_SURF_CORR_PENTE.*\.TIF$ 4
Take5 cloud .*NUA.*\.TIF$ -
Take5 div .*DIV.*\.TIF$ -
Take5 dem .*\.tif -
LANDSAT8_new_format blue .*SRE_B2.*\.tif$ 1
LANDSAT8_new_format green .*FRE_B3.*\.tif$ 1
LANDSAT8_new_format red .*FRE_B4.*\.tif$ 1
LANDSAT8_new_format nir .*SRE_B5.*\.tif$ 1
LANDSAT8_new_format swir .*FRE_B6.*\.tif$ 1
LANDSAT8_new_format cloud .*CLM_XS.*\.tif$ -
LANDSAT8_new_format div .*MG2_XS.*\.tif$ -
LANDSAT8_new_format dem .*ALT_R2\.TIF$ -
LANDSAT8_new_format metadata .*MTD_ALL.*\.xml$ -
LANDSAT8 blue .*ORTHO_SURF_CORR_PENTE.*\.TIF$ 2
LANDSAT8 green .*ORTHO_SURF_CORR_PENTE.*\.TIF$ 3
LANDSAT8 red .*ORTHO_SURF_CORR_PENTE.*\.TIF$ 4
LANDSAT8 nir .*ORTHO_SURF_CORR_PENTE.*\.TIF$ 5
LANDSAT8 swir .*ORTHO_SURF_CORR_PENTE.*\.TIF$ 6
LANDSAT8 cloud .*NUA.*\.TIF$ -
LANDSAT8 div .*DIV.*\.TIF$ -
LANDSAT8 dem .*\.tif -
LANDSAT8 metadata .*MTD_ALL.*\.xml$ -
LANDSAT8_LASRC green .*_sr_band3.tif$ 1
LANDSAT8_LASRC red .*_sr_band4.tif$ 1
LANDSAT8_LASRC swir .*_sr_band6.tif$ 1
LANDSAT8_LASRC cloud .*_pixel_qa.tif$ -
LANDSAT8_LASRC dem .*\.tif -
"""


def layers() -> list[tuple[str, str, str, int | None]]:
    """Mission, layer, pattern, band."""
    return [(m, layer, p, None if n == "-" else int(n)) for m, layer, p, n in (x.split() for x in LAYERS.split("\n") if x)]


def mission(path: Column) -> Column:
    """The mission of a scene by what its path holds, the first that fits; null where none does."""
    sentinel = path.contains("S2") | path.contains("SENTINEL2")
    return (
        F.when(path.contains(".SAFE"), "SEN2COR").when(path.contains(".DBL.DIR"), F.when(sentinel, "MAJA")).when(sentinel, "S2").when(path.contains("Take5"), "Take5")
        .when(path.contains("LANDSAT8-OLITIRS-XS"), "LANDSAT8_new_format").when(path.contains("LANDSAT8"), "LANDSAT8").when(path.contains("LC08"), "LANDSAT8_LASRC")
    )


def tile_and_time(product: Column, of: Column) -> tuple[Column, Column]:
    """Tile and time of acquisition in a product's name, by its mission: parts 4 and 2 of Sentinel-2's, 6 and 4 of
    Landsat's; null for others and for shorter names."""
    p = F.split(product, "_")
    part = lambda k: F.get(p, F.lit(k))
    stamp = F.split(part(1), "-")
    two = of.isin("SEN2COR", "MAJA", "S2")
    time = F.concat(F.get(stamp, F.lit(0)), F.lit("T"), F.get(stamp, F.lit(1)))
    return F.when(two, part(3)).when(of.startswith("LANDSAT8"), part(5)), F.when(two, time).when(of.startswith("LANDSAT8"), part(3))


def layer_paths(files: DataFrame, scene: str = "scene", path: str = "path") -> DataFrame:
    """scene, mission, layer, path, band of the files of scenes: each layer's file is the first by path whose name matches.
    A file may serve several layers. Scenes of no known mission, and layers without a file, are left out; repeated rows
    count once. Each file is looked at once, against its own mission's patterns."""
    name = F.element_at(F.split(path, "/"), -1)
    of = mission(F.col(scene))
    hits = [F.when((F.col("mission") == m) & name.rlike(f"^{p}"), F.struct(F.lit(layer).alias("layer"), F.lit(n).cast("int").alias("band"))) for m, layer, p, n in layers()]
    found = files.select(scene, path, of.alias("mission")).where("mission is not null").select(scene, "mission", path, F.explode(F.array_compact(F.array(*hits))).alias("x"))
    return found.groupBy(scene, "mission", "x.layer").agg(F.min(path).alias("path"), F.any_value("x.band").alias("band")).select(scene, "mission", "layer", "path", "band")
