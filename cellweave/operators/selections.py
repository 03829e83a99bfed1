"""Choosing, ordering and pairing rows of observations, names, boxes and products."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import durable


def band_rows(cells: DataFrame, keys: list[str], bands: list[str], where: Column | str) -> DataFrame:
    """Cells as rows of a key and bands, of those that a condition keeps; a null condition keeps none."""
    return cells.where(where).select(*keys, *bands)


def date_series(obs: DataFrame, by: list[str], day: str = "d", value: str = "v") -> DataFrame:
    """by, n, and series: each place's values in order of day, joined by blanks. Rows of a null day come first, null values
    count and are not written; of two values of a day the smaller comes first."""
    ordered = F.array_sort(F.collect_list(F.struct(day, value)))  # as many as a place has days
    return obs.groupBy(*by).agg(F.count("*").alias("n"), F.array_join(F.transform(ordered, lambda x: x[value].cast("string")), " ").alias("series"))


def products_as_inputs(products: DataFrame, inputs: DataFrame, types: DataFrame, routines: DataFrame, condition: str, since: str) -> DataFrame:
    """What products may become inputs of a processing condition: those created since a day, whose type's data (types: id,
    data_type) some routine takes (routines: input_type), with the tile, day and mission of the input they were made from.
    Each product comes once, however many routines take it; products without a date or a known input are left out."""
    taken = types.join(routines.where("input_type is not null").select(F.col("input_type").alias("data_type")).distinct(), "data_type", "left_semi")
    some = products.where(F.col("creation_date") >= F.lit(since).cast("timestamp")).join(taken.select(F.col("id").alias("product_type_id")).distinct(), "product_type_id", "left_semi")
    source = inputs.select(F.col("id").alias("input_fk_id"), "tile", "measurement_day", "mission")
    return some.join(source, "input_fk_id").select(F.lit(condition).alias("processing_condition_name"), "creation_date", "tile", "measurement_day", F.col("product_path").alias("input_path"), "mission")


def day_index(days: DataFrame, day: str = "d") -> DataFrame:
    """Distinct days and day_index, their place in order from 0; null days are left out. There is a row a day, so one task
    may number them."""
    return days.where(F.col(day).isNotNull()).select(day).distinct().select(day, (F.row_number().over(Window.orderBy(day)) - 1).cast("bigint").alias("day_index"))


def date_pairs(names: DataFrame, days: DataFrame, name: str = "name", day: str = "d") -> DataFrame:
    """Names with the day and day_index of the date that they hold (eight digits and a T). Names without a date, or with one
    that is not among the days, are left out."""
    key = F.try_to_date(F.nullif(F.regexp_extract(name, "([0-9]{8})T", 1), F.lit("")), "yyyyMMdd")
    return names.withColumn(day, key).join(day_index(days, day), day)


def newest_first(obs: DataFrame, by: list[str], day: str = "d") -> DataFrame:
    """by, day and place: 1 for a place's newest row, null days last; rows of one day in either order."""
    return obs.select(*by, day, F.row_number().over(Window.partitionBy(*by).orderBy(F.desc(day))).alias("place"))


def places(df: DataFrame, group: Column, *order: str) -> DataFrame:
    """df with place: from 1 in each group, in order (nulls first).

    Rows are dealt by range of group and order, so that a large group is spread, and written; a row's place is its rank in
    its task's run and what earlier runs of its group hold. Only counts of runs are summed.
    """
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = df.withColumn("_group", group)
    dealt = keyed.repartitionByRange(width, "_group", *order).sortWithinPartitions("_group", *order)
    cut = durable(dealt.withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.spark_partition_id()))
    runs = cut.groupBy("_group", "_part").agg(F.count("*").alias("n"), F.min("_at").alias("_first"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row a task
    starts = runs.select(F.col("_group").alias("_g"), F.col("_part").alias("_p"), "_first", before.alias("_before"))
    found = cut.join(starts, F.col("_group").eqNullSafe(F.col("_g")) & (F.col("_part") == F.col("_p")))
    return found.withColumn("place", (F.col("_before") + F.col("_at") - F.col("_first") + 1).cast("int")).select(*df.columns, "place")


def nearest_to_day(obs: DataFrame, by: list[str], month: int, day: int) -> DataFrame:
    """by, year and d: of each year the day nearest to the one given, the earlier of two; null days are left out."""
    gap = F.abs(F.datediff("d", F.make_date(F.year("d"), F.lit(month), F.lit(day))))
    return obs.where("d is not null").groupBy(*by, F.year("d").alias("year")).agg(F.min_by("d", F.struct(gap, "d")).alias("d"))


def all_candidates(sources: dict[str, DataFrame], key: str = "id") -> DataFrame:
    """Keys of all sources, each with its source's name; a key of two sources comes twice."""
    out = None
    for name, df in sources.items():
        some = df.select(key, F.lit(name).alias("source"))
        out = some if out is None else out.unionByName(some)
    if out is None:
        raise ValueError("there is no source")
    return out


def take_boxes(slices: DataFrame, by: list[str], margin: float, axes: tuple[tuple[str, str], ...] = (("x0", "x1"),)) -> DataFrame:
    """The box of each take's slices, wider by a margin on every side: columns of both ends of each axis. Slices whose end
    is null count by their other one."""
    return slices.groupBy(*by).agg(*[x for low, high in axes for x in ((F.min(low) - margin).alias(low), (F.max(high) + margin).alias(high))])


def outside(grid: DataFrame, features: DataFrame, keys: tuple[str, ...] = ("tile", "r", "c")) -> DataFrame:
    """Cells of a grid that no feature holds; those with a null in their key are held by none."""
    return grid.join(features.select(*keys), list(keys), "left_anti").select(*keys)


def coloured(cells: DataFrame, palette: DataFrame, value: str = "v") -> DataFrame:
    """Cells with their value's colour; values that the palette lacks are left out. A palette has 256 rows at most."""
    return cells.join(F.broadcast(palette), value)


def overlapping_boxes(boxes: DataFrame, size: int, key: str = "fid", by: str = "tile") -> DataFrame:
    """Pairs a, b of boxes (key, by, r0, r1, c0, c1, ends included) of one tile that meet, and whether b lies inside a.
    Boxes are dealt to the squares of a size that they touch; a pair is taken in the square where its overlap begins, so
    none comes twice, and boxes that share no square are not compared. Boxes with a null are left out."""
    some = boxes.select(F.col(key).alias("k"), F.col(by).alias("t"), "r0", "r1", "c0", "c1").na.drop()
    dealt = some.withColumn("y", F.explode(F.expr(f"sequence(floor(r0 / {size}), floor(r1 / {size}))"))).withColumn("x", F.explode(F.expr(f"sequence(floor(c0 / {size}), floor(c1 / {size}))")))
    other = dealt.toDF("k2", "t", "p0", "p1", "q0", "q1", "y", "x")
    met = dealt.join(other, ["t", "y", "x"]).where("k <> k2 and r0 <= p1 and p0 <= r1 and c0 <= q1 and q0 <= c1")
    once = met.where(f"y = floor(greatest(r0, p0) / {size}) and x = floor(greatest(c0, q0) / {size})")
    return once.select(F.col("k").alias("a"), F.col("k2").alias("b"), F.expr("p0 >= r0 and p1 <= r1 and q0 >= c0 and q1 <= c1").alias("inside"))


def upsert_features(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Features of both by key, with the fields of either: a new feature's values take the place of the old one's, but for
    fields that are null in it or that it lacks. Null keys meet each other. Each key must come once in either table."""
    fields = [*old.columns, *[c for c in new.columns if c not in old.columns]]
    kinds = {f.name: f.dataType for f in [*old.schema, *new.schema]}
    a, b = (df.select(*[(F.col(c) if c in df.columns else F.lit(None).cast(kinds[c])).alias(f"{side}{k}") for k, c in enumerate(fields)]) for df, side in ((old, "a"), (new, "b")))
    same = [F.col(f"a{fields.index(k)}").eqNullSafe(F.col(f"b{fields.index(k)}")) for k in keys]
    condition = same[0]
    for x in same[1:]:
        condition = condition & x
    return a.join(b, condition, "full").select(*[F.coalesce(f"b{k}", f"a{k}").alias(c) for k, c in enumerate(fields)])
