"""Per-cell time series: gap filling, interpolation, seasons. All work on (tile, r, c) keys, one shuffle each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CELL = ["tile", "r", "c"]
GAPS = (205, 255)


def fill_newest_first(obs: DataFrame, gaps: tuple[int, ...] = GAPS) -> DataFrame:
    """The newest observation of each cell, or where that is a gap the newest that is none; quality, flags and time move
    with the value."""
    row = F.struct("v", "qc", "qf", "d")
    good = F.max_by(F.when(~F.col("v").isin(*gaps), row), F.when(~F.col("v").isin(*gaps), F.col("d")))
    return obs.groupBy(*CELL).agg(F.coalesce(good, F.max_by(row, "d")).alias("x")).select(*CELL, "x.*")


def fill_window(obs: DataFrame, days: int, gaps: tuple[int, ...] = GAPS) -> DataFrame:
    """Of the last days before a tile's newest date: the newest value that is no gap, else the oldest cloud, else 255.
    The first day of the window counts only for the newest product."""
    tiles = obs.groupBy("tile").agg(F.max("d").alias("last"))
    inside = obs.join(F.broadcast(tiles), "tile").where(  # a row for each tile
        (F.col("d") > F.date_sub("last", days)) | ((F.col("d") == F.date_sub("last", days)) & (F.col("d") == F.col("last")))
    )
    row, v, d = F.struct("v", "qc", "qf", "d"), F.col("v"), F.col("d")
    good, cloud = ~v.isin(*gaps), v != 255
    agg = inside.groupBy(*CELL).agg(
        F.coalesce(F.max_by(F.when(good, row), F.when(good, d)), F.min_by(F.when(cloud, row), F.when(cloud, d))).alias("x")
    )
    return agg.select(*CELL, F.coalesce("x.v", F.lit(255)).alias("v"), F.coalesce("x.qc", F.lit(255)).alias("qc"), F.coalesce("x.qf", F.lit(0)).alias("qf"), F.col("x.d").alias("d"))


def merge_by_priority(obs: DataFrame, priority: Column, by: list[str]) -> DataFrame:
    """The first value up to 100 in order of priority, else the last value."""
    good = F.col("v") <= 100
    p = priority
    return obs.groupBy(*by).agg(F.coalesce(F.min_by(F.when(good, F.col("v")), F.when(good, p)), F.max_by("v", p)).alias("v"))


def snow_runs(obs: DataFrame, start: str, end: str, margin: int = 0) -> DataFrame:
    """Runs of equal days of each cell from start to end: snow, and the first and last day a and b, counted from 0.

    A day is snow where the value between its latest clear observation and the next one, linear in time, is at least half;
    beyond either end the nearest counts, and a cell without a clear observation has no snow. So a run ends half-way
    between two clear observations that differ, and no row a day is made. Clear days up to margin days before start and
    after end count too.
    """
    first, last = (F.unix_date(F.to_date(F.lit(x))) for x in (start, end))
    day = F.unix_date("d")
    clear = obs.where(F.col("v") <= 100).where(day.between(first - margin, last + margin)).select(*CELL, day.alias("d"), (F.col("v") > 0).cast("int").alias("snow"))
    w = Window.partitionBy(*CELL).orderBy("d")
    half = (F.col("d") + F.lead("d").over(w)) / 2
    owned = clear.withColumn("b", F.coalesce(F.when(F.col("snow") == 1, F.floor(half)).otherwise(F.ceil(half) - 1), last).cast("int"))
    owned = owned.withColumn("a", F.coalesce(F.lag("b").over(w) + 1, first))
    inside = owned.select(*CELL, "d", "snow", F.greatest("a", first).alias("a"), F.least("b", last).alias("b")).where("a <= b")
    run = F.sum(F.when(F.col("snow") == F.col("was"), 0).otherwise(1)).over(w)
    numbered = inside.withColumn("was", F.lag("snow").over(w)).withColumn("run", run)
    runs = numbered.groupBy(*CELL, "run", "snow").agg((F.min("a") - first).cast("int").alias("a"), (F.max("b") - first).cast("int").alias("b"))
    cells = obs.select(*CELL).distinct().join(runs, CELL, "left")
    return cells.select(*CELL, F.coalesce("snow", F.lit(0)).alias("snow"), F.coalesce("a", F.lit(0)).alias("a"), F.coalesce("b", last - first).alias("b"))


def daily(obs: DataFrame, start: str, end: str, margin: int = 0) -> DataFrame:
    """A row for each cell and day from start to end with snow as in snow_runs."""
    day = F.explode(F.sequence(F.date_add(F.lit(start).cast("date"), F.col("a")), F.date_add(F.lit(start).cast("date"), F.col("b"))))
    return snow_runs(obs, start, end, margin).select(*CELL, day.alias("d"), "snow")


def runs_of_days(days: DataFrame) -> DataFrame:
    """Runs of equal days as in snow_runs, of rows that give each day of a cell."""
    w = Window.partitionBy(*CELL).orderBy("d")
    x = days.withColumn("k", F.row_number().over(w) - 1).withColumn("was", F.lag("snow").over(w))
    x = x.withColumn("run", F.sum(F.when(F.col("snow") == F.col("was"), 0).otherwise(1)).over(w))
    return x.groupBy(*CELL, "run", "snow").agg(F.min("k").alias("a"), F.max("k").alias("b")).drop("run")


def season_of_runs(runs: DataFrame, least: int = 10) -> DataFrame:
    """Onset and end day index of the longest run of snow days (the first of equal ones) in cells of more than least snow
    days, else 0 with has_season false."""
    on, n = F.col("snow") == 1, F.col("b") - F.col("a") + 1
    best = F.max(F.when(on, F.struct(n.alias("n"), (-F.col("a")).alias("na"), "b")))
    g = runs.groupBy(*CELL).agg(F.coalesce(F.sum(F.when(on, n)), F.lit(0)).cast("bigint").alias("snow_days"), best.alias("x"))
    enough = F.col("snow_days") > least
    return g.select(*CELL, "snow_days", F.when(enough, -F.col("x.na")).otherwise(0).alias("onset"), F.when(enough, F.col("x.b")).otherwise(0).alias("melt"), enough.alias("has_season"))


def periods_of_runs(runs: DataFrame) -> DataFrame:
    """Numbers of rises from no snow to snow, and of rises and falls."""
    later = F.col("a") > 0
    return runs.groupBy(*CELL).agg(F.count_if(later & (F.col("snow") == 1)).alias("periods"), F.count_if(later).alias("both_ways"))


def season(days: DataFrame, least: int = 10) -> DataFrame:
    """season_of_runs for rows that give each day of a cell."""
    return season_of_runs(runs_of_days(days), least)


def periods(days: DataFrame, count_falling: bool = False) -> DataFrame:
    """Number of rises from no snow to snow; with count_falling the falls too."""
    return periods_of_runs(runs_of_days(days)).select(*CELL, F.col("both_ways" if count_falling else "periods").alias("periods"))


def temporal_cloud_filter(obs: DataFrame) -> DataFrame:
    """Cloudy observations take the value on which their neighbours in time agree: those one step away, then two before
    and one after, then one before and two after; each pass sees what the one before filled."""
    w = Window.partitionBy(*CELL).orderBy("d")
    out = obs
    for back, ahead in ((1, 1), (2, 1), (1, 2)):
        a, b = F.lag("v", back).over(w), F.lead("v", ahead).over(w)
        out = out.withColumn("v", F.when((F.col("v") == 205) & (a == b) & a.isin(0, 100), a).otherwise(F.col("v")))
    return out


def day_counts(obs: DataFrame) -> DataFrame:
    """Snow days, cloud days, observations, clear ones by sensor (bit 7 of the flags: radar) and in-range ones."""
    v, radar = F.col("v"), F.shiftright("qf", 7).bitwiseAND(1) == 1
    cloud, valid = v.isin(205, 255, 254), v.between(0, 100)
    return obs.groupBy(*CELL).agg(
        F.count_if((v > 0) & (v <= 100)).alias("snow_days"), F.count_if(cloud).alias("cloud_days"), (F.count("*") - F.count_if(cloud)).alias("observations"),
        F.count_if(valid & ~radar).alias("clear_sky"), F.count_if(valid & radar).alias("by_radar"), F.count_if(valid).alias("valid"),
    )


def season_of(day: str) -> Column:
    """The season that begins in September and is named by the year in which it ends."""
    return F.year(day) + F.when(F.month(day) >= 9, 1).otherwise(0)


def perennial(obs: DataFrame, month: int = 5, day: int = 1) -> DataFrame:
    """Per cell and season: whether all its dates from one of its tile's on are snow or cloud. That date is the tile's
    nearest, as numbers yyyymmdd, to the day given of the year of its last one in the season; the earlier of two. Cells
    without a row from that date on are left out, as nothing tells of them."""
    rows = obs.select(*CELL, season_of("d").alias("season"), "d", "v")
    number = F.date_format("d", "yyyyMMdd").cast("int")
    days = rows.select("tile", "season", "d").distinct()
    last = days.groupBy("tile", "season").agg(F.year(F.max("d")).alias("y"))
    gap = F.abs(number - (F.col("y") * 10000 + month * 100 + day))
    start = days.join(last, ["tile", "season"]).groupBy("tile", "season").agg(F.min(F.struct(gap.alias("gap"), "d"))["d"].alias("start"))  # a row a tile and season
    inside = rows.join(start, ["tile", "season"]).where("d >= start")
    return inside.groupBy(*CELL, "season").agg(F.bool_and((F.col("v").between(1, 100)) | F.col("v").isin(205, 254, 255)).alias("perennial"))


def quality_stats(obs: DataFrame) -> DataFrame:
    """Mean and lower median of the quality of observations with one, 0 to 3, whatever their value; codes over 3 are masks.
    Both are 255 where there are none."""
    ok = F.col("qc") <= 3
    at = lambda k: F.count_if(F.col("qc") <= k)
    n = F.count_if(ok)
    median = F.when(n == 0, 255).when(2 * at(0) >= n, 0).when(2 * at(1) >= n, 1).when(2 * at(2) >= n, 2).otherwise(3)
    return obs.groupBy(*CELL).agg(F.coalesce(F.round(F.avg(F.when(ok, F.col("qc"))), 6), F.lit(255.0)).alias("mean_qc"), median.alias("median_qc"))


def distance_to_observation(obs: DataFrame, marks: DataFrame, mark: str) -> DataFrame:
    """Days from a cell's mark to its nearest observed snow; 65535 without one or without a mark."""
    seen = obs.where(F.col("v").between(1, 100)).select(*CELL, "d")
    return marks.join(seen, CELL, "left").groupBy(*CELL).agg(F.coalesce(F.min(F.abs(F.datediff(mark, "d"))), F.lit(65535)).alias("days"))
