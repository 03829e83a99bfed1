"""Registered queries of the map algebra over coded cells."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import cells as C
from ..registry import query

K = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
KS = ", ".join(K)
col = F.col


def on_bands(name: str, oracle: str, extra: str = "", before=None):
    """A query of bands with the given SQL columns; the function gives Spark's by name, from columns that before gives
    first."""

    def put(f):
        @query(name, f"SELECT {KS}, {oracle} FROM bands {extra}", "bands " + " ".join(w for w in ("water", "tcd", "dem") if w in extra))
        def run(t):
            b = t("bands")
            for w in ("water", "tcd", "dem"):
                if w in extra:
                    b = b.join(t(w), ["tile", "r", "c"])
            for n, x in (before() if before else {}).items():
                b = b.withColumn(n, x)
            return b.select(*K, *[x.alias(n) for n, x in f().items()])

        return f

    return put


def on_obs(name: str, oracle: str, extra: str = ""):
    def put(f):
        @query(name, f"SELECT tile, r, c, d, {oracle} FROM obs {extra}", "obs " + " ".join(w for w in ("water", "tcd", "dem") if w in extra))
        def run(t):
            b = t("obs")
            for w in ("water", "tcd", "dem"):
                if w in extra:
                    b = b.join(t(w), ["tile", "r", "c"])
            return b.select("tile", "r", "c", "d", *[x.alias(n) for n, x in f().items()])

        return f

    return put


W, T, D = (f"JOIN {x} USING (tile, r, c)" for x in ("water", "tcd", "dem"))


@query("p01_map_algebra", f"""SELECT {KS}, CAST(((green - red) % 7) * 2 | (CASE WHEN red > 400 THEN 1 ELSE 0 END) | (CASE WHEN nir > 300 THEN 16 ELSE 0 END) AS INT) AS b
    FROM bands WHERE green >= red""", "bands")  # fmt: skip
def _(t):
    b = t("bands").where("green >= red")
    return C.map_algebra(b, "b", lambda _: (col("green") - col("red")) % 7, lambda x: x * 2, {0: col("red") > 400, 4: col("nir") > 300}).select(*K, "b")


@on_bands("p02_byte_output", "CAST(trunc(least(greatest(green * 0.5 - red * 0.25, 0), 255)) AS INT) AS out")
def _():
    return {"out": C.byte(col("green") * 0.5 - col("red") * 0.25)}


@on_bands("p03_band_vector", "green * 100 AS a, (red * 2) // 100 AS b, (swir * 2) // 100 AS c2")
def _():
    return {"a": col("green") * 100, "b": F.expr("cast(red * 2 div 100 as int)"), "c2": F.expr("cast(swir * 2 div 100 as int)")}


@on_bands("p04_bits", "CAST((cloud_bits >> 3) & 1 AS INT) AS b3, CAST(CASE WHEN red > 300 THEN cloud_bits | 128 ELSE cloud_bits END AS INT) AS put, CAST(CASE WHEN red > 300 THEN cloud_bits & ~4 ELSE cloud_bits END AS INT) AS cleared, cloud_bits AS again")
def _():
    x = col("cloud_bits")
    return {"b3": C.i(C.bit(x, 3)), "put": C.put_bit(x, 7, 1, col("red") > 300), "cleared": C.put_bit(x, 2, 0, col("red") > 300), "again": C.pack(C.unpack(x))}


@on_bands("p05_all_bits", "CAST((cloud_bits & 192) = 192 AS INT) AS m")
def _():
    return {"m": C.all_bits(col("cloud_bits"), 192)}


@on_bands("p06_positive_bits", "CAST((red > 400)::INT | ((green > 500)::INT << 1) | ((nir > 300)::INT << 2) AS INT) AS m")
def _():
    return {"m": C.positive_bits(col("red") - 400, col("green") - 500, col("nir") - 300)}


@on_obs("p07_gap", "v IN (205, 255) AS gap, v IN (125, 200, 210, 220, 230, 240, 205, 255) AS wide_gap")
def _():
    return {"gap": C.is_gap(col("v")), "wide_gap": C.is_gap(col("v"), (125, 200, 210, 220, 230, 240, 205, 255))}


@on_bands("p08_index_masks", """CASE WHEN green + swir = 0 THEN -9999 ELSE ((green - swir)::DOUBLE / (green + swir) >= 0.4)::INT END AS snow, CASE WHEN nir + red = 0 THEN -9999 ELSE ((nir - red)::DOUBLE / (nir + red) >= 0.1)::INT END AS plants,
    CASE WHEN green + nir = 0 THEN -9999 ELSE ((green - nir)::DOUBLE / (green + nir) >= 0.3)::INT END AS wet""")
def _():
    return {"snow": C.index_mask(col("green"), col("swir"), 0.4), "plants": C.index_mask(col("nir"), col("red"), 0.1), "wet": C.index_mask(col("green"), col("nir"), 0.3)}


@on_bands("p09_clip", "greatest(200, least(swir, 600)) AS x")
def _():
    return {"x": C.clip(col("swir"), 200, 600)}


@on_bands("p10_zero_masks", "(green % 10 + red % 10 = 0) AS a, (green % 10 + red % 10 = 0 OR nir % 10 + red % 10 = 0 OR green % 10 + nir % 10 = 0) AS any_zero")
def _():
    z = lambda a, b: col(a) % 10 + col(b) % 10 == 0
    return {"a": z("green", "red"), "any_zero": z("green", "red") | z("nir", "red") | z("green", "nir")}


@on_bands("p11_no_data", "CAST((CASE WHEN red % 50 = 0 THEN -10000 ELSE red END) = -10000 AS INT) AS nodata")
def _():
    return {"nodata": C.i(F.when(col("red") % 50 == 0, C.NO_BAND).otherwise(col("red")) == C.NO_BAND)}


@on_bands("p12_slope_flag", "CAST(z % 90 >= 30 AS INT) AS steep", D)
def _():
    return {"steep": C.i(col("z") % 90 >= 30)}


@on_obs("p13_burn", "CASE WHEN wl IN (1, 2) THEN 0 ELSE v END AS v", W)
def _():
    return {"v": C.burn(col("v"), col("wl"), (1, 2), 0)}


@on_bands("p14_cloud_parts", "(cloud_bits > 0)::INT AS all_clouds, ((cloud_bits & 32) > 0 OR (cloud_bits & 64) > 0)::INT AS shadows, ((cloud_bits & 128) > 0)::INT AS high_clouds, (cloud_bits > 0 AND red > 100)::INT AS back_to_cloud")
def _():
    return C.cloud_parts(col("cloud_bits"), col("red"))


@on_bands("p15_refined_cloud", "((cloud_bits % 3 = 0 AND red > 300) OR (cloud_bits & 32) > 0 OR (cloud_bits & 128) > 0 OR (cloud_bits % 3 = 0) <> (cloud_bits % 6 = 0))::INT AS refined")
def _():
    x = col("cloud_bits")
    return {"refined": C.refined_cloud(C.i(x % 3 == 0), col("red"), C.i(x.bitwiseAND(32) > 0), C.i(x.bitwiseAND(128) > 0), C.i(x % 6 == 0))}


INDEX = "(CASE WHEN green + swir = 0 THEN 0 ELSE (green - swir)::DOUBLE / (green + swir) END)"


@on_bands("p16_p19_snow_passes", f"""(cloud_bits % 2 = 0 AND {INDEX} > 0.4 AND red > 200)::INT AS p1, (cloud_bits % 2 = 0 AND z > 1000 AND {INDEX} > 0.15 AND red > 40)::INT AS p2,
    (cloud_bits % 2 = 0 AND z >= 1000 AND cloud_bits % 5 <> 0 AND blue - nir > 160)::INT AS shaded,
    ((cloud_bits % 2 = 0 AND {INDEX} > 0.4 AND red > 200) OR (cloud_bits % 2 = 0 AND z > 1000 AND {INDEX} > 0.15 AND red > 40) OR (cloud_bits % 2 = 0 AND z >= 1000 AND cloud_bits % 5 <> 0 AND blue - nir > 160))::INT AS p3,
    ((cloud_bits % 2 = 0 AND z >= 1000 AND cloud_bits % 5 <> 0 AND blue - nir > 160) AND NOT (cloud_bits % 2 = 0 AND {INDEX} > 0.4 AND red > 200) AND NOT (cloud_bits % 2 = 0 AND z > 1000 AND {INDEX} > 0.15 AND red > 40))::INT AS uncalibrated""", D)
def _():
    cloud, index = col("cloud_bits") % 2, C.ndsi(col("green"), col("swir"))
    p1, p2 = C.snow_first(cloud, index, col("red")), C.snow_second(cloud, col("z"), F.lit(1000), index, col("red"))
    sh = C.snow_shaded(cloud, col("z"), F.lit(1000), col("cloud_bits") % 5, col("blue"), col("nir"))
    return {"p1": p1, "p2": p2, "shaded": sh, "p3": C.i((p1 == 1) | (p2 == 1) | (sh == 1)), "uncalibrated": C.i((sh == 1) & (p1 == 0) & (p2 == 0))}


@on_bands("p20_snow_mask", """CASE WHEN red % 11 = 0 THEN 255 WHEN green % 3 = 0 THEN 100 WHEN cloud_bits % 2 = 1 OR red % 4 = 0 THEN 205 ELSE 0 END AS m,
    CASE WHEN red % 11 = 0 THEN 255 WHEN green % 3 = 0 AND red % 4 <> 0 THEN 100 WHEN cloud_bits % 2 = 1 OR red % 4 = 0 THEN 205 ELSE 0 END AS strict_m""")
def _():
    args = C.i(col("green") % 3 == 0), col("cloud_bits") % 2, C.i(col("red") % 4 == 0), C.i(col("red") % 11 == 0)
    return {"m": C.snow_mask(*args), "strict_m": C.snow_mask(*args, strict=True)}


TOC = f"(100 * least(0.5 * tanh(2.65 * {INDEX} - 1.42) + 0.5, 1.0))"


@on_bands("p21_cover", f"""CAST(round(100 * {INDEX}, 6) AS DOUBLE) AS index_percent, CAST(round({TOC}, 6) AS DOUBLE) AS cover,
    CAST(round(CASE WHEN tcd > 100 THEN {TOC} WHEN tcd = 100 THEN CASE WHEN trunc({TOC}) >= 0 AND {TOC} > 0 THEN 100 ELSE 0 END ELSE 100 * least({TOC} / 100.0 / (1 - tcd / 100.0), 1.0) END, 6) AS DOUBLE) AS ground""", T)
def _():
    index = C.ndsi(col("green"), col("swir"))
    cover = C.cover_percent(index)
    return {"index_percent": F.round(100 * index, 6), "cover": F.round(cover, 6), "ground": F.round(C.ground_cover(cover, col("tcd")), 6)}


@on_obs("p22_product_value", "CASE WHEN v = 255 OR wl IN (253, 255) THEN 255 WHEN qf % 5 = 0 THEN 205 WHEN wl IN (1, 2) AND v < 205 THEN 210 ELSE v END AS v", W)
def _():
    return {"v": C.product_value(col("v"), C.i(col("v") == 255), col("wl"), C.i(col("qf") % 5 == 0))}


@on_obs("p23_cover_flags", """CAST(CASE WHEN wl < 253 AND v <> 255 THEN ((qf >> 6) & 1) | (((qf >> 7) & 1) << 1) | ((tcd > 90 AND tcd < 101)::INT << 2) | ((qf % 3 > 0 AND v > 0 AND v < 101)::INT << 3)
    | ((qf % 7 = 1)::INT << 5) | ((qf % 11 = 1)::INT << 6) ELSE 0 END AS INT) AS flags""", W + " " + T)
def _():
    q = col("qf")
    return {"flags": C.cover_flags(q, col("wl"), col("tcd"), q % 3, col("v"), C.i(q % 7 == 1), C.i(q % 11 == 1), col("v") != 255)}


@on_obs("p24_cover_quality", """CASE WHEN qc = 3 THEN 255 WHEN v IN (205, 210, 255) THEN v ELSE CAST(trunc(least(3.0, 4 - greatest(0.0, (100.0 - 30 * ((qf >> 1) & 1) - 50 * (qf & 1) - 25 * ((qf >> 3) & 1) - 25 * ((qf >> 2) & 1)) / 25.0))) AS INT) END AS q,
    CASE WHEN qc = 3 THEN 255 WHEN v IN (205, 210, 255) THEN v ELSE CAST(trunc(least(3.0, 4 - greatest(0.0, (100.0 - 30 * ((qf >> 1) & 1) - 50 * (qf & 1) - 25 * ((qf >> 3) & 1) - 25 * ((qf >> 2) & 1) - 80 * tcd) / 25.0))) AS INT) END AS q_ground""", T)
def _():
    args = col("qf"), col("v"), col("qc") != 3
    return {"q": C.cover_quality(*args), "q_ground": C.cover_quality(*args, col("tcd"))}


@on_bands("p25_cloud_class", """CASE WHEN red % 13 = 0 THEN 255 WHEN (cloud_bits & 128) > 0 THEN 1 WHEN (cloud_bits & 2) > 0 THEN 2 WHEN (cloud_bits & 96) > 0 THEN 3 ELSE 0 END AS cls""")
def _():
    return {"cls": C.cloud_class(col("cloud_bits"), C.i(col("red") % 13 == 0))}


@on_bands("p26_cloud_flags", "CAST(((cloud_bits >> 2) & 31) | ((wl IN (1, 2))::INT << 5) AS INT) AS flags, CAST((cloud_bits >> 2) & 1 AS INT) AS thin", W)
def _():
    return {"flags": C.cloud_flags(col("cloud_bits"), col("wl")), "thin": C.i(C.bit(col("cloud_bits"), 2))}


@on_bands("p27_radar_ice", """CASE WHEN wl NOT IN (1, 2) THEN 255 WHEN nir > 600 THEN 1 WHEN red % 17 = 0 THEN 255 WHEN blue % 9 = 0 THEN 200 WHEN (CASE WHEN tile < 3 THEN 10 + 2 * red + green < 900 ELSE red < 200 AND green < 300 END) THEN 100 ELSE 1 END AS ice""", W)
def _():
    return {"ice": C.radar_ice(10 + 2 * col("red") + col("green"), F.lit(900), (col("red") < 200) & (col("green") < 300), col("tile") < 3, col("blue") % 9 == 0, col("red") % 17 == 0, col("nir") > 600, col("wl"))}


ICE = "(CASE green % 5 WHEN 0 THEN 100 WHEN 1 THEN 1 WHEN 2 THEN 200 WHEN 3 THEN 1 ELSE 255 END)"
FLAGS = f"""(CASE WHEN {ICE} IN (100, 1) THEN (wl = 2)::INT | ((((red * 1000) // 100000) % 10 IN (0, 1, 3, 4))::INT << 1) | ((nir % 3 > 0)::INT << 2) | ((nir % 3 > 0 AND nir % 100 >= 50)::INT << 3) | ((blue % 120 BETWEEN 75 AND 100)::INT << 4)
    | ((tcd BETWEEN 75 AND 100)::INT << 5) | ((swir % 4 = 1)::INT << 6) | ((swir % 5 > 0)::INT << 7) | ((swir % 5 > 0 AND swir % 20 >= 5)::INT << 8) ELSE 0 END)"""


@on_bands("p28_radar_flags", f"CAST({FLAGS} AS INT) AS flags", W + " " + T)
def _():
    return {"flags": radar_inputs()[1]}


def radar_inputs():
    ice = F.expr("case green % 5 when 0 then 100 when 1 then 1 when 2 then 200 when 3 then 1 else 255 end")
    temperature, wind = F.expr("case when nir % 3 > 0 then double(nir % 100) else double('NaN') end"), F.expr("case when swir % 5 > 0 then double(swir % 20) end")
    return ice, C.radar_flags(ice, col("wl"), col("red") * 1000, temperature, col("blue") % 120, col("tcd"), C.i(col("swir") % 4 == 1), wind)


Q0 = f"((({FLAGS} >> 1) & 1) + ({FLAGS} & 1) + (({FLAGS} >> 6) & 1))"


@on_bands("p28_radar_quality", f"""CAST(CASE WHEN {ICE} = 255 THEN 255 WHEN (({FLAGS} >> 3) & 1) = 1 THEN 0 WHEN {ICE} = 200 THEN 200 WHEN (({FLAGS} >> 8) & 1) = 1 OR (({FLAGS} >> 4) & 1) = 1 THEN 3
    ELSE {Q0} + CASE WHEN {Q0} <= 3 THEN (({FLAGS} >> 5) & 1) ELSE 0 END END AS INT) AS q""", W + " " + T, before=lambda: dict(zip(("ice", "flags"), radar_inputs(), strict=True)))
def _():
    return {"q": C.radar_quality(col("flags"), col("ice"))}


CODE = "(CASE red % 4 WHEN 0 THEN 254 WHEN 1 THEN 100 WHEN 2 THEN 1 ELSE 255 END)"


@on_bands("p29_p30_optical_ice", f"CASE WHEN wl IN (253, 255) THEN 255 WHEN green % 13 = 0 THEN 255 WHEN cloud_bits % 4 = 0 THEN 205 WHEN {CODE} = 100 AND wl = 0 THEN 254 ELSE {CODE} END AS ice", W)
def _():
    return {"ice": C.optical_ice(col("red") % 4, C.i(col("cloud_bits") % 4 == 0), C.i(col("green") % 13 == 0), col("wl"))}


P1 = "(CASE WHEN green % 19 = 0 THEN 255 WHEN red % 23 = 0 THEN 255 WHEN red % 29 = 0 THEN 205 WHEN red % 101 > 80 THEN 0 WHEN red % 101 > 67 THEN 1 WHEN red % 101 > 50 THEN 2 ELSE 3 END)"
P2 = f"(CASE WHEN {P1} <= 2 AND (({ICE} IN (1, 100) AND wl NOT IN (1, 2)) OR ({ICE} = 254 AND wl NOT IN (0, 254))) THEN {P1} + 1 ELSE {P1} END)"
P3 = f"(CASE WHEN {P2} <= 2 THEN {P2} + bit_count((cloud_bits >> 4) & 15) ELSE {P2} END)"


@on_bands("p31_optical_quality", f"CAST(CASE WHEN {P3} > 3 AND {P3} <= 10 THEN 3 ELSE {P3} END AS INT) AS q", W)
def _():
    probability = F.expr("case when red % 23 = 0 then 255 when red % 29 = 0 then 205 else red % 101 end")
    return {"q": C.optical_quality(probability, C.i(col("green") % 19 == 0), col("wl"), radar_ice_code(), col("cloud_bits"))}


def radar_ice_code():
    return F.expr("case green % 5 when 0 then 100 when 1 then 1 when 2 then 200 when 3 then 1 else 255 end")


#: Backscatter from bands: a good part lies under the noise floors of 10 ** -4.2 and 10 ** -4, references of 0 and angles of -200
#: are none.
VH, VV, VH_REF, VV_REF, ANGLE = "(green % 200 / 1e6::DOUBLE)", "(red % 300 / 1e6::DOUBLE)", "(nir % 90 / 5e5::DOUBLE)", "(blue % 80 / 4e5::DOUBLE)", "(CASE WHEN swir % 11 = 0 THEN -200 ELSE swir % 70 END)"
WEIGHT = f"(CASE WHEN {ANGLE} > 45 THEN 0.5 WHEN {ANGLE} >= 20 THEN 0.5 * (1 + (45.0 - {ANGLE}) / 25.0) ELSE 1.0 END)::DOUBLE"
RC = f"""(CASE WHEN {VH} > 10 ** (-4.2::DOUBLE) AND {VV} > 10 ** (-4.0::DOUBLE) AND {VH_REF} > 0 AND {VV_REF} > 0 AND {ANGLE} > -180 THEN
    {WEIGHT} * (10 * log10({VH}) - 10 * log10({VH_REF})) + (1 - {WEIGHT}) * (10 * log10({VV}) - 10 * log10({VV_REF})) END)"""


@on_bands("p32_wet_snow", f"""CAST(round({WEIGHT}, 6) AS DOUBLE) AS w, CAST(round({RC}, 6) AS DOUBLE) AS rc, CASE WHEN {RC} >= -2.5 THEN 125 WHEN {RC} < -2.5 THEN 110 ELSE 255 END AS code,
    CASE WHEN {RC} >= -2.5 THEN 250 WHEN {RC} >= -3 THEN 3 WHEN {RC} >= -3.5 THEN 2 WHEN {RC} >= -4 THEN 1 WHEN {RC} < -4 THEN 0 ELSE 255 END AS q""")
def _():
    angle = F.when(col("swir") % 11 == 0, -200).otherwise(col("swir") % 70)
    rc = C.wet_ratio(col("green") % 200 / 1e6, col("red") % 300 / 1e6, col("nir") % 90 / 5e5, col("blue") % 80 / 4e5, angle)
    code, q = C.wet_snow(rc)
    return {"w": F.round(C.angle_weight(angle), 6), "rc": F.round(rc, 6), "code": code, "q": q}


WET = "(CASE WHEN red < 400 THEN 110 ELSE 125 END)"
WET1 = f"(CASE WHEN blue % 7 = 0 THEN 240 WHEN green % 6 = 0 THEN 210 ELSE {WET} END)"


@on_bands("p33_wet_snow_masked", f"CASE WHEN nir % 31 = 0 THEN 255 WHEN swir % 101 < 30 AND {WET1} = 110 THEN 125 ELSE {WET1} END AS code")
def _():
    return {"code": C.wet_snow_masked(F.when(col("red") < 400, 110).otherwise(125), F.when(col("green") % 6 == 0, 210).otherwise(0), C.i(col("blue") % 7 == 0), col("swir") % 101, col("nir") % 31 == 0)}


S2 = "(CASE red % 5 WHEN 0 THEN 1 WHEN 1 THEN 100 WHEN 2 THEN 254 WHEN 3 THEN 205 ELSE 255 END)"
S1 = "(CASE green % 4 WHEN 0 THEN 1 WHEN 1 THEN 100 WHEN 2 THEN 200 ELSE 255 END)"


def two_sensors():
    return F.expr(S2), F.expr(S1)


@on_bands("p35_merge_ice", f"CASE WHEN {S2} IN (1, 100, 254) THEN {S2} WHEN {S2} = 205 AND {S1} IN (1, 100) THEN {S1} WHEN {S2} = 205 THEN 205 ELSE {S1} END AS ice")
def _():
    return {"ice": C.merge_ice(*two_sensors())}


MERGED = {
    "q": f"CASE WHEN {S2} IN (1, 100, 254) THEN blue % 4 ELSE nir % 4 END",
    "flags": f"CASE WHEN {S2} IN (1, 100, 254) THEN cloud_bits WHEN {S2} = 255 AND swir % 512 = 0 THEN 0 ELSE swir % 512 + 256 END",
    "ice": f"CASE WHEN {S2} IN (1, 100, 254) THEN {S2} WHEN {S2} = 205 AND {S1} NOT IN (1, 100) THEN 205 ELSE {S1} END",
}


def merged():
    a, b = two_sensors()
    return {"q": C.merge_quality(a, b, col("blue") % 4, col("nir") % 4), "flags": C.merge_flags(a, b, col("cloud_bits"), col("swir") % 512), "ice": C.merge_ice(a, b)}


@on_bands("p36_merge_quality", ", ".join(f"CAST({MERGED[k]} AS INT) AS {k}" for k in ("q", "flags")))
def _():
    return {k: x for k, x in merged().items() if k != "ice"}


@on_bands("p36_water_masked", ", ".join(f"CAST(CASE WHEN wl IN (1, 2) THEN {x} ELSE {0 if k == 'flags' else 255} END AS INT) AS {k}" for k, x in MERGED.items()), W)
def _():
    return {k: C.on_water(x, col("wl"), 0 if k == "flags" else C.NODATA) for k, x in merged().items()}


@on_obs("p37_fill_from_wet_snow", """CASE WHEN v IN (205, 255) AND qf % 3 = 0 THEN 100 ELSE v END AS v, CASE WHEN v IN (205, 255) AND qf % 3 = 0 THEN qf % 4 ELSE qc END AS qc,
    CAST(CASE WHEN v IN (205, 255) AND qf % 3 = 0 THEN qf | 128 ELSE qf END AS INT) AS qf""")
def _():
    hit = C.is_gap(col("v")) & (F.when(col("qf") % 3 == 0, 110).otherwise(125) == 110)
    return {"v": F.when(hit, 100).otherwise(col("v")), "qc": F.when(hit, col("qf") % 4).otherwise(col("qc")), "qf": C.put_bit(col("qf"), 7, 1, hit)}


@on_obs("p38_water_fill", "CASE WHEN wl IN (1, 2) THEN 210 ELSE v END AS v, CASE WHEN wl IN (1, 2) THEN 210 ELSE qc END AS qc", W)
def _():
    return {"v": C.water_fill(col("v"), col("wl")), "qc": C.water_fill(col("qc"), col("wl"))}


@on_obs("p39_binary", "(v > 0 AND v <= 100)::INT AS snow, (v IN (205, 255, 254))::INT AS cloud")
def _():
    return {"snow": C.snow_binary(col("v")), "cloud": C.cloud_binary(col("v"))}


@on_bands("p40_ice_as_snow", f"CASE {ICE} WHEN 100 THEN 100 WHEN 1 THEN 0 WHEN 200 THEN 205 ELSE 255 END AS v, CASE WHEN red % 150 < 40 THEN 3 WHEN red % 150 < 80 THEN 2 WHEN red % 150 < 120 THEN 1 ELSE 0 END AS q")
def _():
    return {"v": C.ice_as_snow(radar_ice_code()), "q": C.count_quality(col("red") % 150)}


@on_obs("p41_season_masked", "CASE WHEN wl IN (253, 255) THEN 65535 WHEN wl IN (1, 2) THEN 420 ELSE v END AS v, CASE WHEN wl NOT IN (1, 2, 253, 255) AND v < 60 THEN 65535 WHEN wl IN (253, 255) THEN 65535 WHEN wl IN (1, 2) THEN 420 ELSE v END AS long_v", W)
def _():
    m = C.season_masked(col("v"), col("wl"))
    return {"v": m, "long_v": F.when(m < 60, C.NODATA16).otherwise(m)}


@on_obs("p42_season_flags", "CAST(((v < 60 AND wl IN (0, 254))::INT << 4) | ((tcd BETWEEN 91 AND 100 AND wl IN (0, 254))::INT << 5) | ((v NOT IN (210, 220, 230) AND qf % 2 = 0)::INT << 7) AS INT) AS flags", W + " " + T)
def _():
    return {"flags": C.season_flags(col("v"), col("tcd"), col("wl"), col("v"), col("qf") % 2)}


@on_obs("p43_season_quality", "CASE WHEN v IN (420, 65535) THEN v WHEN v < 60 THEN 3 ELSE least(3, CAST(floor(qf / 100.0) AS INT) + CASE WHEN n < 2 THEN 2 ELSE 1 END) END AS q")
def _():
    return {"q": C.season_quality(col("v"), col("qf") / 100.0, F.when(col("n") < 2, 10).otherwise(50))}


@query("p44_day_slice", "SELECT tile, r, c, d, CASE WHEN epoch(d) + qf * 900 BETWEEN epoch(d) AND epoch(d) + 86399 THEN v ELSE 255 END AS v FROM obs", "obs")
def _(t):
    day = F.unix_timestamp(col("d").cast("timestamp"))
    at = day + col("qf") * 900
    return t("obs").select("tile", "r", "c", "d", F.when(at.between(day, day + 86399), col("v")).otherwise(255).alias("v"))


@on_obs("p45_compare_code", "CASE WHEN qc % 3 = 2 THEN 254 ELSE 2 * (qc % 3) + qf % 2 END AS code")
def _():
    return {"code": C.compare_code(col("qc") % 3, col("qf") % 2)}


@query("p46_pair_filter", f"SELECT {KS}, CAST(round({INDEX}, 6) AS DOUBLE) AS index_value FROM bands WHERE green % 2 = 0 AND {INDEX} BETWEEN 0 AND 1", "bands")
def _(t):
    x = C.ndsi(col("green"), col("swir"))
    return t("bands").where((col("green") % 2 == 0) & x.between(0, 1)).select(*K, F.round(x, 6).alias("index_value"))


@on_obs("p47_half_cloud", "CASE WHEN c <= 4 THEN 205 ELSE v END AS v")
def _():
    return {"v": F.when(col("c") <= 4, 205).otherwise(col("v"))}


@query("p48_date_window", "SELECT tile, r, c, d, v FROM obs WHERE tile = 1 AND d BETWEEN DATE '1995-10-01' - INTERVAL 15 DAY AND DATE '1996-09-30' + INTERVAL 15 DAY", "obs")
def _(t):
    return t("obs").where("tile = 1 and d between date_sub(date'1995-10-01', 15) and date_add(date'1996-09-30', 15)").select("tile", "r", "c", "d", "v")
