"""Zonal, altitude and validation statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOWEST_LAND = -413  # metres
#: Codes of the ice layer.
ICE_LAYER = {"water": 1, "ice": 100, "cloud": 205, "other": 254}


def altitude_histogram(cells: DataFrame, dz: int, by: list[str]) -> DataFrame:
    """Counts of all, cloud, snow and bare cells by altitude bin of dz from the lowest cell on."""
    low = cells.groupBy(*by).agg(F.min("z").alias("low"))
    x = cells.join(F.broadcast(low), by)  # a row for each scene
    return x.groupBy(*by, "low", F.expr(f"cast((z - low) div {dz} as int)").alias("bin")).agg(
        F.count("*").alias("total"), F.count_if(F.expr("cloud = 1")).alias("clouds"), F.count_if(F.expr("cloud = 0 and snow = 1")).alias("snows"), F.count_if(F.expr("cloud = 0 and snow = 0")).alias("bare")
    )


def snow_line(histogram: DataFrame, dz: int, least_clear: float, least_snow: float, by: list[str], reverse: bool = False, offset: int = -2) -> DataFrame:
    """Altitude of the lowest (reverse: highest) bin with enough clear cells and snow among them, moved by offset bins and
    half a bin down; -1000 where there is none. Bins whose centre lies below all land do not count."""
    clear = F.col("total") - F.col("clouds")
    land = F.col("low") + F.col("bin") * dz + dz / 2.0 >= LOWEST_LAND
    good = land & (clear > least_clear * F.col("total")) & (F.col("snows") > least_snow * clear)
    at = F.max(F.when(good, F.col("bin"))) if reverse else F.min(F.when(good, F.col("bin")))
    g = histogram.groupBy(*by).agg(at.alias("bin"), F.min("low").alias("low"))
    center = F.col("low") + F.greatest(F.col("bin") + offset, F.lit(0)) * dz + dz / 2.0
    return g.select(*by, F.when(F.col("bin").isNull(), -1000).otherwise(F.floor(center - dz / 2.0)).cast("int").alias("line"))


def zonal(cells: DataFrame, members: DataFrame, by: list[str], classes: dict[str, int] = ICE_LAYER) -> DataFrame:
    """Per feature: percent of each class among all cells of the feature's mask, observed or not, each rounded half to
    even, what is left over, and the rounded mean quality: codes 0 to 3 of all its observed cells, whatever their class,
    with 205 as 0; 255 without any. Features with nothing but left-over are left out."""
    size = members.groupBy("fid").agg(F.count("*").alias("cells"))
    x = members.join(cells, ["tile", "r", "c"])
    v, qc = F.col("v"), F.col("qc")
    quality = F.avg(F.when(qc.between(0, 3), qc).when(qc == 205, 0))
    n = [F.count_if(v == code).alias(name) for name, code in classes.items()]
    g = x.groupBy("fid", *by).agg(*n, F.coalesce(F.bround(quality, 0), F.lit(255)).cast("int").alias("quality")).join(size, "fid")
    g = g.select("fid", *by, *[F.bround(100.0 * F.col(name) / F.col("cells"), 0).cast("int").alias(name) for name in classes], "quality")
    return g.withColumn("left_over", 100 - sum((F.col(name) for name in classes), F.lit(0))).where("left_over <> 100")


def percent(df: DataFrame, value: Column, valid: Column, by: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.round(100.0 * F.count_if(valid & value) / F.nullif(F.count_if(valid), F.lit(0)), 6).alias("percent"))


def confusion(df: DataFrame, reference: str, estimate: str, by: list[str]) -> DataFrame:
    """Counts of the four outcomes of two binary columns, overall agreement and kappa in percent."""
    a, b = F.col(reference), F.col(estimate)
    g = df.groupBy(*by).agg(
        F.count_if((a == 1) & (b == 1)).alias("tp"), F.count_if((a == 0) & (b == 0)).alias("tn"), F.count_if((a == 0) & (b == 1)).alias("fp"), F.count_if((a == 1) & (b == 0)).alias("fn")
    )
    n = (F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")).cast("double")
    po = (F.col("tp") + F.col("tn")) / n
    pe = ((F.col("tp") + F.col("fn")) * (F.col("tp") + F.col("fp")) + (F.col("tn") + F.col("fp")) * (F.col("tn") + F.col("fn"))) / (n * n)
    return g.withColumn("agreement", F.round(100 * po, 6)).withColumn("kappa", F.round(100 * F.when(pe == 1, 0.0).otherwise(F.try_divide(po - pe, 1 - pe)), 6))


def agreement(df: DataFrame, x: str, y: str, by: list[str]) -> DataFrame:
    """Number, root mean square error, mean error, correlation and the fitted line of y on x."""
    e = F.col(y) - F.col(x)
    return df.groupBy(*by).agg(
        F.count("*").alias("n"), F.round(F.sqrt(F.avg(e * e)), 6).alias("rmse"), F.round(F.avg(e), 6).alias("bias"), F.round(F.corr(x, y), 6).alias("r"),
        F.round(F.regr_slope(y, x), 6).alias("slope"), F.round(F.regr_intercept(y, x), 6).alias("intercept"), F.round(F.stddev(e), 6).alias("sd"),
    )


def nearest_in_time(left: DataFrame, right: DataFrame, by: list[str], days: int, left_id: list[str], best: str = "closest", where: str | None = None,
                    seen: tuple[list[str], list[str]] | None = None) -> DataFrame:
    """For each left row (d) the right row (rd, ratio) of the same by within days: the closest, or the cleanest (smallest
    ratio of no data, then the closest). where is a further condition on both rows, as that their footprints overlap, and
    seen are the left and the right columns that it looks at (without it all of them).

    Only the best right row of each day, by and seen counts, and left rows of one day, by and seen share their answer. So
    rows do not meet each other: days do, and their number follows the days and the values of seen, not the rows."""
    if not where:
        seen = [], []
    elif seen is None:
        seen = [c for c in left.columns if c not in (*by, "d")], [c for c in right.columns if c not in by]
    mine, theirs = seen
    asked = left.select(*by, "d", *mine).distinct()
    around = asked.withColumn("_day", F.explode(F.expr(f"sequence(date_sub(d, {days}), date_add(d, {days}))")))
    rest = F.struct("ratio", "rd", "rid").alias("_x")
    near = right.select(*by, F.to_date("rd").alias("_day"), *[F.col(c).alias(f"_r{k}") for k, c in enumerate(theirs)], rest)
    near = near.groupBy(*by, "_day", *[f"_r{k}" for k in range(len(theirs))]).agg(F.min("_x").alias("_x"))
    if where:
        shown = near.withColumnsRenamed({f"_r{k}": c for k, c in enumerate(theirs)})
        near = around.select(*by, "_day", *mine).distinct().join(shown, [*by, "_day"]).where(where).groupBy(*by, "_day", *mine).agg(F.min("_x").alias("_x"))
    lag = F.abs(F.datediff("_day", "d"))
    x = F.col("_x")
    key = F.struct(lag.alias("lag"), x["ratio"].alias("ratio"), x["rd"].alias("rd"), x["rid"].alias("rid")) if best == "closest" else F.struct(x["ratio"].alias("ratio"), lag.alias("lag"), x["rd"].alias("rd"), x["rid"].alias("rid"))
    found = around.join(near, [*by, "_day", *mine]).groupBy(*by, "d", *mine).agg(F.min(key).alias("_k"))
    return left.join(found, [*by, "d", *mine]).groupBy(*left_id).agg(F.min("_k").alias("_k")).select(*left_id, "_k.rid", "_k.rd")
