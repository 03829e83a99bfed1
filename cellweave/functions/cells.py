"""Column expressions over coded cells: codes, bits, map algebra and the decision rules of the snow, ice and water layers.

Codes stay ordinary integers: a no-data code is compared like any other, and rules that overwrite in order are CASE
cascades with the last rule first.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The codes shared by the layers.
CLOUD, WATER, NODATA, NODATA16 = 205, 210, 255, 65535
NO_BAND = -10000


def i(x: Column) -> Column:
    return x.cast("int")


def cascade(*rules: tuple[Column, object], otherwise: object) -> Column:
    """The value of the first rule that holds."""
    out = None
    for when, value in rules:
        out = F.when(when, value) if out is None else out.when(when, value)
    return out.otherwise(otherwise)


def overwrite(start: object, *rules: tuple[Column, object]) -> Column:
    """start, then each rule's value written over it in order: the last rule that holds wins."""
    return cascade(*reversed(rules), otherwise=start)


def bit(x: Column, k: int) -> Column:
    return F.shiftright(x, k).bitwiseAND(1) == 1


def set_bits(*conditions: tuple[int, Column]) -> Column:
    """An integer with bit k set where its condition holds; a null condition is none."""
    out = F.lit(0)
    for k, c in conditions:
        out = out.bitwiseOR(F.when(c, 1 << k).otherwise(0))
    return out


def put_bit(x: Column, k: int, value: int, where: Column) -> Column:
    return F.when(where, x.bitwiseOR(1 << k) if value else x.bitwiseAND(~(1 << k))).otherwise(x)


def unpack(x: Column, bits: int = 8) -> Column:
    """The bits of x, lowest first, as an array."""
    return F.array(*[i(bit(x, k)) for k in range(bits)])


def pack(bits: Column, n: int = 8) -> Column:
    out = F.lit(0)
    for k in range(n):
        out = out.bitwiseOR(F.shiftleft(F.get(bits, F.lit(k)), k))
    return out


def map_algebra(df: DataFrame, out: str, *steps: Callable[[Column], Column] | dict[int, Column], start: int = 0) -> DataFrame:
    """Steps over a running output: a function of it gives its next value; a dict sets bits by conditions."""
    b = F.lit(start)
    for step in steps:
        if isinstance(step, dict):
            b = b.bitwiseOR(set_bits(*step.items()))
        else:
            b = step(b)
    return df.withColumn(out, i(b))


def byte(x: Column) -> Column:
    """Cut to 0 to 255 and to whole numbers, as an eight-bit output keeps them."""
    return i(F.least(F.greatest(x, F.lit(0)), F.lit(255)))


def all_bits(x: Column, mask: int) -> Column:
    return i(x.bitwiseAND(mask) == mask)


def positive_bits(*xs: Column) -> Column:
    return set_bits(*[(k, x > 0) for k, x in enumerate(xs)])


def is_gap(x: Column, codes: tuple[int, ...] = (CLOUD, NODATA)) -> Column:
    return x.isin(*codes)


def is_value(x: Column) -> Column:
    return x.between(0, 100)


def index_mask(a: Column, b: Column, threshold: float) -> Column:
    """1 where (a - b) / (a + b) reaches the threshold, else 0; -9999 where a + b is 0."""
    return F.when(a + b == 0, -9999).otherwise(i(F.try_divide((a - b).cast("double"), a + b) >= threshold))


def clip(x: Column, low: int, high: int) -> Column:
    return F.greatest(F.lit(low), F.least(x, F.lit(high)))


def ndsi(green: Column, swir: Column) -> Column:
    return F.when(green + swir == 0, 0.0).otherwise(F.try_divide((green - swir).cast("double"), green + swir))


def burn(x: Column, mask: Column, codes: tuple[int, ...], value: int) -> Column:
    return F.when(mask.isin(*codes), value).otherwise(x)


def cloud_parts(bits: Column, red: Column) -> dict[str, Column]:
    """Any cloud, shadows, high cloud, and clouds bright enough in red to be looked at again."""
    cloud = bits > 0
    return {
        "all_clouds": i(cloud), "shadows": i((bits.bitwiseAND(32) > 0) | (bits.bitwiseAND(64) > 0)),
        "high_clouds": i(bits.bitwiseAND(128) > 0), "back_to_cloud": i(cloud & (red > 100)),
    }


def refined_cloud(cloud: Column, coarse_red: Column, shadow: Column, high: Column, first_pass: Column) -> Column:
    return i(((cloud == 1) & (coarse_red > 300)) | (shadow == 1) | (high == 1) | (cloud != first_pass))


def snow_first(cloud: Column, index: Column, red: Column) -> Column:
    return i((cloud == 0) & (index > 0.4) & (red > 200))


def snow_second(cloud: Column, z: Column, line: Column, index: Column, red: Column) -> Column:
    return i((cloud == 0) & (z > line) & (index > 0.15) & (red > 40))


def snow_shaded(cloud: Column, z: Column, line: Column, shade: Column, blue: Column, nir: Column) -> Column:
    return i((cloud == 0) & (z >= line) & (shade != 0) & (blue - nir > 160))


def snow_mask(snow: Column, cloud: Column, back: Column, nodata: Column, strict: bool = False) -> Column:
    hit = (snow == 1) & (back == 0) if strict else snow == 1
    return cascade((nodata == 1, NODATA), (hit, 100), ((cloud == 1) | (back == 1), CLOUD), otherwise=0)


def cover_percent(index: Column) -> Column:
    """Fractional cover seen from above, by the hyperbolic tangent model; percent."""
    return 100 * F.least(0.5 * F.tanh(2.65 * index - 1.42) + 0.5, F.lit(1.0))


def ground_cover(cover: Column, trees: Column) -> Column:
    """Cover on the ground under trees of a density in percent; densities over 100 and bare cells keep the cover. Full
    density hides all, which counts as full cover where any is seen."""
    share = F.try_divide(cover / 100.0, 1 - trees / 100.0)
    return F.when(trees > 100, cover).otherwise(100 * F.least(F.coalesce(share, i(cover > 0).cast("double")), F.lit(1.0)))


def product_value(value: Column, nodata: Column, water: Column, cloud: Column) -> Column:
    return cascade(((nodata == 1) | water.isin(253, 255), NODATA), (cloud > 0, CLOUD), (water.isin(1, 2) & (value < CLOUD), WATER), otherwise=value)


def cover_flags(bits: Column, water: Column, trees: Column, cloud: Column, cover: Column, hillshade: Column, shaded: Column, seen: Column) -> Column:
    """Quality flags of a cover cell. Bit 4 never holds, as in the layer's definition."""
    at = (water < 253) & seen
    return set_bits(
        (0, at & bit(bits, 6)), (1, at & bit(bits, 7)), (2, at & (trees > 90) & (trees < 101)),
        (3, at & (cloud > 0) & (cover > 0) & (cover < 101)), (5, at & (hillshade == 1)), (6, at & (shaded == 1)),
    )


def cover_quality(flags: Column, value: Column, seen: Column, trees: Column | None = None) -> Column:
    """0 best to 3 worst by flags, with codes passed through; trees, in percent, weigh 80 a unit."""
    on = lambda k: i(bit(flags, k))
    left = 100.0 - 30 * on(1) - 50 * on(0) - 25 * on(3) - 25 * on(2)
    left = left - 80 * trees if trees is not None else left
    score = i(F.least(F.lit(3.0), 4 - F.greatest(F.lit(0.0), left / 25.0)))
    return cascade((~seen, NODATA), (value.isin(CLOUD, WATER, NODATA), value), otherwise=score)


def cloud_class(bits: Column, nodata: Column) -> Column:
    """0 clear, 1 high cloud, 2 cloud, 3 shadow, 255 no data."""
    b1, b7, shadow = bit(bits, 1), bit(bits, 7), bit(bits, 5) | bit(bits, 6)
    return cascade((nodata == 1, NODATA), (b7, 1), (b1, 2), (shadow, 3), otherwise=0)


def cloud_flags(bits: Column, water: Column) -> Column:
    return set_bits(*[(k - 2, bit(bits, k)) for k in range(2, 7)], (5, water.isin(1, 2)))


def on_water(x: Column, water: Column, otherwise: int = NODATA) -> Column:
    """A layer on permanent and temporary water (1, 2); elsewhere no data, or the code given (0 for flags)."""
    return F.when(water.isin(1, 2), x).otherwise(otherwise)


def radar_ice(regression: Column, limit: Column, fallback: Column, known: Column, shadow: Column, nodata: Column, warm: Column, water: Column) -> Column:
    """Ice 100 where the regression (or, for tiles without coefficients, the dual threshold) stays under its limit, open
    water 1 elsewhere; then shadow 200, no data 255 and warm spells 1 overwrite in this order. Off water all is no data."""
    ice = F.when(known, regression < limit).otherwise(fallback)
    return on_water(overwrite(F.when(ice, 100).otherwise(1), (shadow, 200), (nodata, NODATA), (warm, 1)), water)


#: The sixth digit of a water body's category: lakes, and what is not categorised or only in an extended way.
STANDING = (1, 0, 3, 4)


def radar_flags(ice: Column, water: Column, category: Column, temperature: Column, sealed: Column, trees: Column, grass: Column, wind: Column) -> Column:
    """Nine flags of ice and open-water cells, 0 elsewhere; null or NaN weather is unknown."""
    known = lambda x: x.isNotNull() & ~F.isnan(x)
    kind = F.floor(category / 100000).cast("int") % 10
    flags = set_bits(
        (0, water == 2), (1, kind.isin(*STANDING)), (2, known(temperature)), (3, known(temperature) & (temperature >= 50)), (4, sealed.between(75, 100)),
        (5, trees.between(75, 100)), (6, grass == 1), (7, known(wind)), (8, known(wind) & (wind >= 5)),
    )
    return F.when(ice.isin(100, 1), flags).otherwise(0)


def radar_quality(flags: Column, ice: Column) -> Column:
    on = lambda k: i(bit(flags, k))
    some = on(1) + on(0) + on(6)
    some = some + F.when(some <= 3, on(5)).otherwise(0)
    return overwrite(some, (bit(flags, 4), 3), (bit(flags, 8), 3), (ice == 200, 200), (bit(flags, 3), 0), (ice == NODATA, NODATA))


def optical_ice(cls: Column, cloud: Column, nodata: Column, water: Column) -> Column:
    """Classes 0 to 3 of the classifier as layer codes, then masks in order."""
    code = cascade((cls == 0, 254), (cls == 1, 100), (cls == 2, 1), otherwise=NODATA)
    code = F.when(cloud > 0, CLOUD).otherwise(code)
    code = F.when(nodata == 1, NODATA).otherwise(code)
    code = F.when((code == 100) & (water == 0), 254).otherwise(code)
    return F.when(water.isin(253, 255), NODATA).otherwise(code)


def optical_quality(probability: Column, edge: Column, water: Column, ice: Column, ground: Column) -> Column:
    """0 to 3 by probability, one worse where the water map disagrees and for each ground flag (bits 4 to 7), 3 at most."""
    q = cascade((edge == 1, NODATA), (probability == NODATA, NODATA), (probability == CLOUD, CLOUD), (probability > 80, 0), (probability > 67, 1), (probability > 50, 2), otherwise=3)
    off = (ice.isin(1, 100) & ~water.isin(1, 2)) | ((ice == 254) & ~water.isin(0, 254))
    q = F.when(off & (q <= 2), q + 1).otherwise(q)
    more = sum([i(bit(ground, k)) for k in range(4, 8)], F.lit(0))
    q = F.when(q <= 2, q + more).otherwise(q)
    return F.when((q > 3) & (q <= 10), 3).otherwise(q)


#: Decibels by which the noise of the two polarisations lies below one.
VH_NOISE, VV_NOISE = 42, 40


def decibel(x: Column, noise: float | None = None) -> Column:
    """10 log10 of positive values, and of none at or under the noise floor, so many decibels down."""
    return F.when(x > (0.0 if noise is None else 10 ** (-noise / 10)), 10 * F.log10(x))


def wet_ratio(vh: Column, vv: Column, vh_reference: Column, vv_reference: Column, angle: Column) -> Column:
    """Backscatter against the reference in decibel, of both polarisations by the angle's weight. Null where either lies at
    or under its noise floor, a reference is not positive, or the angle is none (-180 to 180, ends excluded)."""
    w = angle_weight(angle)
    ratio = w * (decibel(vh, VH_NOISE) - decibel(vh_reference)) + (1 - w) * (decibel(vv, VV_NOISE) - decibel(vv_reference))
    known = decibel(vh, VH_NOISE).isNotNull() & decibel(vv, VV_NOISE).isNotNull() & decibel(vh_reference).isNotNull() & decibel(vv_reference).isNotNull()
    return F.when(known & (angle > -180) & (angle < 180), ratio)


def angle_weight(angle: Column, low: float = 20.0, high: float = 45.0, k: float = 0.5) -> Column:
    return cascade((angle > high, k), (angle >= low, k * (1 + (high - angle) / (high - low))), otherwise=1.0)


def wet_snow(ratio: Column) -> tuple[Column, Column]:
    """Code (110 wet, 125 not) and quality (250 where not wet) by the combined ratio in decibel; null gives no data."""
    code = cascade((ratio >= -2.5, 125), (ratio < -2.5, 110), otherwise=NODATA)
    quality = cascade((ratio >= -2.5, 250), (ratio >= -3.0, 3), (ratio >= -3.5, 2), (ratio >= -4.0, 1), (ratio < -4.0, 0), otherwise=NODATA)
    return code, quality


def wet_snow_masked(code: Column, mask: Column, lowland: Column, snow: Column, nodata: Column) -> Column:
    """Mask codes, then 240 off the mountains, then dry where little snow is seen, then no data."""
    code = F.when(mask != 0, mask).otherwise(code)
    code = F.when(lowland != 0, 240).otherwise(code)
    code = F.when((snow < 30) & (code == 110), 125).otherwise(code)
    return F.when(nodata, NODATA).otherwise(code)


def merge_ice(optical: Column, radar: Column) -> Column:
    """The optical code where it tells; radar water or ice under cloud, and all of radar where there is no data."""
    return cascade((optical.isin(1, 100, 254), optical), ((optical == CLOUD) & radar.isin(1, 100), radar), (optical == CLOUD, CLOUD), (optical == NODATA, radar), otherwise=optical)


def merge_quality(optical: Column, radar: Column, q_optical: Column, q_radar: Column) -> Column:
    """Quality of the merged layer: radar's wherever the optical code is cloud or no data, whatever radar has there; 0 for
    optical codes that the layer does not have."""
    return cascade((optical.isin(1, 100, 254), q_optical), (optical.isin(CLOUD, NODATA), q_radar), otherwise=0)


def merge_flags(optical: Column, radar: Column, f_optical: Column, f_radar: Column) -> Column:
    """Flags likewise. 256 is added to radar's under cloud, and without optical data where radar has any; the sum carries
    where radar's own ninth bit is set."""
    return cascade((optical.isin(1, 100, 254), f_optical), ((optical == CLOUD) | ((optical == NODATA) & (f_radar != 0)), f_radar + 256), otherwise=0)


def water_fill(x: Column, water: Column) -> Column:
    return F.when(water.isin(1, 2), WATER).otherwise(x)


def snow_binary(x: Column) -> Column:
    return i((x > 0) & (x <= 100))


def cloud_binary(x: Column) -> Column:
    return i(x.isin(CLOUD, NODATA, 254))


def ice_as_snow(x: Column) -> Column:
    """Ice codes as a snow series has them: ice 100, water 0, shadow and other as cloud."""
    return cascade((x == 100, 100), (x == 1, 0), (x.isin(200, 254, CLOUD), CLOUD), otherwise=NODATA)


def count_quality(n: Column) -> Column:
    return cascade((n < 40, 3), (n < 80, 2), (n < 120, 1), otherwise=0)


def season_masked(x: Column, water: Column) -> Column:
    return cascade((water.isin(253, 255), NODATA16), (water.isin(1, 2), 420), otherwise=x)


def season_flags(days: Column, trees: Column, land: Column, mask: Column, lowland: Column) -> Column:
    on = land.isin(0, 254)
    return set_bits((4, (days < 60) & on), (5, trees.between(91, 100) & on), (7, ~mask.isin(210, 220, 230) & (lowland == 0)))


def season_quality(days: Column, mean_quality: Column, n: Column) -> Column:
    """3 for short seasons, else the mean quality, worse for few observations; 420 and no data pass through."""
    few = cascade((n < 40, 2), (n < 80, 1), otherwise=0)
    q = F.when(days < 60, 3).otherwise(F.least(F.lit(3), i(F.floor(mean_quality)) + few))
    return F.when(days.isin(420, NODATA16), days).otherwise(q)


def compare_code(reference: Column, estimate: Column) -> Column:
    return F.when(reference == 2, 254).otherwise(2 * reference + estimate)
