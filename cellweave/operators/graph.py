"""Linked nodes: components, and the order of nodes along closed chains."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import exists, forget, shared_path, written


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of an edge (a, b): the smallest node that edges reach. Nodes are of any type that
    has an order.

    Nodes point to smaller ones. In turn all neighbours of a node, and then all that it points to, are pointed to the
    smallest of them, until each points to one alone; rounds grow with the logarithm of the longest way. Each round's cut
    is deleted when the next one stands.
    """
    spark = edges.sparkSession
    now, path = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct())
    before = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        upper = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        least = upper.groupBy("u").agg(F.min("v").alias("m"))
        linked = upper.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
        old = path
        now, path = written(linked.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        forget(spark, old)
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    tops = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(tops)


def ring_order(links: DataFrame, by: list[str]) -> DataFrame:
    """Closed chains of nodes: links (by, id, next) in which each node has one next and is that of one node. Gives by, id,
    ring (its smallest id) and place (steps from there to the node).

    Each node knows the smallest id of so many that follow it, and how far off it is; each round doubles how many. Where
    both halves of what a node sees have the same smallest id, the second is the first again, a ring's length further on. All
    nodes of a ring know its length in the round that joins halves of at least that length, and leave the rounds together,
    so rounds grow with the logarithm of the longest ring, and only rings that are not done yet are sent again.
    """
    spark = links.sparkSession
    top, columns = shared_path(spark, "rings"), [*by, "id", "jump", "ring", "off", "size"]
    now, before = written(links.select(*by, "id", F.col("next").alias("jump"), F.col("id").alias("ring"), F.lit(0).cast("bigint").alias("off"), F.lit(None).cast("bigint").alias("size")))
    schema, nodes, reach = now.schema, now.count(), 1
    while True:
        far = now.select(*by, F.col("id").alias("jump"), F.col("jump").alias("_jump"), F.col("ring").alias("_ring"), (F.col("off") + reach).alias("_off"))
        lower, again = F.col("_ring") < F.col("ring"), F.col("_ring") == F.col("ring")
        found = now.join(far, [*by, "jump"]).select(
            *by, "id", F.col("_jump").alias("jump"), F.when(lower, F.col("_ring")).otherwise(F.col("ring")).alias("ring"), F.when(lower, F.col("_off")).otherwise(F.col("off")).alias("off"),
            F.coalesce("size", F.when(again, F.col("_off") - F.col("off"))).alias("size"),
        )
        path = f"{top}/reach={reach}"
        found.select(*columns, F.coalesce(F.col("size") <= reach, F.lit(False)).alias("done")).write.partitionBy("done").parquet(path)
        forget(spark, before)
        before = f"{path}/done=false"
        if not exists(spark, before):
            break
        if reach > 2 * nodes:
            raise ValueError("links are not closed chains")
        now, reach = spark.read.schema(schema).parquet(before), 2 * reach
    return spark.read.schema(schema).parquet(top).select(*by, "id", "ring", F.expr("(size - off) % size").alias("place"))
