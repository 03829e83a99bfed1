"""Reproducible shuffles and shards by a Feistel permutation of global row numbers."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable, shuffle_width

#: Odd multipliers of the round function.
MULTIPLIERS = (0x2C1B3C6D, 0x297A2D39, 0x1B56C4E9, 0x7F4A7C15)


def feistel(x: np.ndarray, size: int, key: int) -> np.ndarray:
    """A permutation of 0 .. size - 1, given by key. Values that leave the range are sent on (cycle walking) until they
    are back; the domain is less than four times as large, so this takes four steps on average at most."""
    half = max(1, ((max(size, 2) - 1).bit_length() + 1) // 2)
    mask = np.int64((1 << half) - 1)

    def once(v: np.ndarray) -> np.ndarray:
        left, right = v >> half, v & mask
        for k, m in enumerate(MULTIPLIERS):
            mixed = ((right ^ np.int64((key >> (8 * k)) & 0xFFFF)) * np.int64(m) + np.int64(key & 0x7FFFFFFF)) & np.int64(0x7FFFFFFF)
            left, right = right, left ^ ((mixed ^ mixed >> 15) & mask)
        return left << half | right

    y = once(x.astype(np.int64))
    while (out := y >= size).any():
        y[out] = once(y[out])
    return y


def number_rows(df: DataFrame, *order: str) -> DataFrame:
    """df with row_number from 0, gapless over the whole table in the order of the columns given (nulls first).

    Rows are dealt by range and sorted in their partitions; only the count of each partition goes to the driver. A last
    key that differs for each row splits rows equal in all columns, of which either order gives the same table.
    """
    dealt = df.withColumn("_tie", F.monotonically_increasing_id())
    dealt = dealt.repartitionByRange(shuffle_width(df.sparkSession), *order, "_tie").sortWithinPartitions(*order, "_tie").drop("_tie")
    cut = durable(dealt.withColumn("_at", F.monotonically_increasing_id()))
    cut = cut.withColumn("_part", F.shiftright("_at", 33)).withColumn("_at", F.col("_at").bitwiseAND((1 << 33) - 1))
    starts, total = [], 0
    for p, n in cut.groupBy("_part").count().orderBy("_part").collect():  # a row for each partition
        starts.append((p, total))
        total += n
    begin = df.sparkSession.createDataFrame(starts, "_part long, _start long")  # so it may be broadcast
    return cut.join(F.broadcast(begin), "_part").withColumn("row_number", F.col("_start") + F.col("_at")).drop("_part", "_start", "_at")


def shuffled_shards(df: DataFrame, shards: int, key: int, *order: str) -> tuple[DataFrame, int]:
    """df with place, shard and slot, and the number of rows.

    place permutes the row numbers; shard = place mod shards, slot = place div shards. So shards differ by one row at
    most, slots have no gaps, and both can be computed from a row number alone, as can the row at a shard and slot be
    found by running the permutation. Nulls in a column of the order are an ordinary value that comes first; repeated rows each get
    a place; an empty table gives no rows.
    """
    numbered = number_rows(df, *order)
    n = numbered.count()

    @F.pandas_udf("long")
    def place(x: pd.Series) -> pd.Series:
        return pd.Series(feistel(x.to_numpy(), n, key))

    placed = numbered.withColumn("place", place("row_number"))
    return placed.withColumn("shard", F.expr(f"cast(place % {shards} as int)")).withColumn("slot", F.expr(f"place div {shards}")), n


def size_of(text: Column) -> Column:
    """Bytes of the text in UTF-8 (null: none) and one."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint")


def text_crc(text: Column) -> Column:
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))
