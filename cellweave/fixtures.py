"""Domain tables derived from the generic star-schema tables by integer arithmetic, one SQL text for Spark and DuckDB."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from .session import MANY, bounded_parts, spread

BASE = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

#: In order of dependence; {div} is integer division.
#: The image's width grows with the part table, so all tables of cells grow with the scale factor.
TABLES = {
    "side": "SELECT CAST(FLOOR(SQRT(COUNT(*))) AS INT) AS w FROM part",
    "tiles": "SELECT DISTINCT CAST(s_suppkey % 4 AS INT) AS tile FROM supplier",
    "obs_raw": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, CAST(l_suppkey % 4 AS INT) AS tile, CAST(l_partkey {div} (SELECT w FROM side ) AS INT) AS r,
        CAST(l_partkey % (SELECT w FROM side ) AS INT) AS c, CAST(l_shipdate AS DATE) AS d, CASE WHEN l_returnflag = 'A' THEN 'S1' ELSE 'S2' END AS mission,
        CAST(CASE WHEN (l_orderkey*31 + l_partkey*17 + l_linenumber*7) % 20 < 9 THEN (l_partkey*3 + l_orderkey) % 101
                  WHEN (l_orderkey*31 + l_partkey*17 + l_linenumber*7) % 20 < 11 THEN 0
                  WHEN (l_orderkey*31 + l_partkey*17 + l_linenumber*7) % 20 < 16 THEN 205
                  WHEN (l_orderkey*31 + l_partkey*17 + l_linenumber*7) % 20 < 18 THEN 255 ELSE 210 END AS INT) AS v,
        CAST((l_orderkey + l_partkey) % 4 AS INT) AS qc, CAST((l_orderkey*5 + l_partkey) % 256 AS INT) AS qf FROM lineitem""",
    "obs": "SELECT tile, r, c, d, MIN(v) AS v, MIN(qc) AS qc, MIN(qf) AS qf, CAST(COUNT(*) AS BIGINT) AS n FROM obs_raw x GROUP BY tile, r, c, d",
    "grid": """SELECT tile, CAST(p_partkey {div} (SELECT w FROM side ) AS INT) AS r, CAST(p_partkey % (SELECT w FROM side ) AS INT) AS c FROM part CROSS JOIN tiles""",
    "dem": """SELECT tile, CAST(p_partkey {div} (SELECT w FROM side ) AS INT) AS r, CAST(p_partkey % (SELECT w FROM side ) AS INT) AS c,
        CAST(p_size*50 + p_partkey % 97 + 13*tile AS INT) AS z FROM part CROSS JOIN tiles""",
    "water": "SELECT tile, r, c, CASE (tile*7 + r*3 + c*5) % 9 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 253 WHEN 3 THEN 255 ELSE 0 END AS wl FROM grid g",
    "tcd": "SELECT tile, r, c, (tile*31 + r*13 + c*7) % 105 AS tcd FROM grid g",
    "bands": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, CAST(l_suppkey % 4 AS INT) AS tile, CAST(l_partkey {div} (SELECT w FROM side ) AS INT) AS r,
        CAST(l_partkey % (SELECT w FROM side ) AS INT) AS c, CAST(l_shipdate AS DATE) AS d, CAST(100 + (l_orderkey*7) % 900 AS INT) AS green, CAST(50 + (l_partkey*11) % 800 AS INT) AS red,
        CAST(20 + (l_orderkey*3 + l_partkey) % 500 AS INT) AS swir, CAST(100 + (l_partkey*5) % 900 AS INT) AS blue,
        CAST(50 + (l_suppkey*13 + l_orderkey) % 700 AS INT) AS nir, CAST((l_orderkey + l_partkey*3) % 256 AS INT) AS cloud_bits FROM lineitem""",
    "feature_cells": """SELECT n_nationkey AS fid, g.tile, g.r, g.c FROM nation JOIN grid g ON g.tile = n_nationkey % 4 CROSS JOIN side
        WHERE g.r BETWEEN n_nationkey % 7 * w {div} 10 AND (n_nationkey % 7 + 3) * w {div} 10 AND g.c BETWEEN n_nationkey % 5 * w {div} 10 AND (n_nationkey % 5 + 4) * w {div} 10""",
    "input": """SELECT o_orderkey AS id, CONCAT('R', CAST(o_custkey % 25 AS STRING), '_PC') AS processing_condition_name, o_orderdate AS date,
        CONCAT('T', CAST(10 + o_custkey % 40 AS STRING)) AS tile, CAST(YEAR(o_orderdate)*10000 + MONTH(o_orderdate)*100 + DAY(o_orderdate) AS BIGINT) AS measurement_day,
        CONCAT('/in/', CAST(o_orderkey AS STRING)) AS input_path, CASE WHEN o_custkey % 3 = 0 THEN 'S1' ELSE 'S2' END AS mission FROM orders""",
    "processing_tasks": """SELECT l_orderkey*8 + l_linenumber AS id, l_orderkey AS input_fk_id, MIN(l_suppkey) AS virtual_machine_id, MIN(l_shipdate) AS creation_date,
        CASE WHEN l_linenumber > 1 THEN l_orderkey - 1 END AS preceding_input_id, MAX(l_linestatus) = 'O' AS has_ended FROM lineitem GROUP BY l_orderkey, l_linenumber""",
    "dispatch": """SELECT l_orderkey*8 + l_linenumber AS id, l_orderkey*8 + l_linenumber AS processing_task_fk_id, MAX(l_shipdate) AS dispatch_date
        FROM lineitem WHERE (l_orderkey + l_linenumber) % 4 <> 0 GROUP BY l_orderkey, l_linenumber""",
    "workflow": """SELECT e.event_id AS id, t.id AS dispatch_fk_id, e.ts AS date,
        CASE e.event_type WHEN 'purchase' THEN 2 WHEN 'error' THEN 3 WHEN 'view' THEN 4 ELSE 1 END AS processing_status_id
        FROM events e JOIN dispatch t ON t.id = (e.event_id {div} 2)*8 + 1 + e.user_id % 7""",
    "routine": """SELECT CONCAT('R', CAST(n_nationkey AS STRING)) AS name, CAST(1 + n_nationkey % 4 AS INT) AS cpu, CAST(1 + n_nationkey % 3 AS INT) AS ram,
        CAST(1 + n_nationkey % 2 AS INT) AS storage_space, CAST(1 + n_nationkey % 5 AS INT) AS duration, CASE WHEN n_nationkey % 2 = 0 THEN 'L1' ELSE 'L2' END AS input_type,
        CASE WHEN n_nationkey % 3 = 0 THEN 'L2' ELSE 'L3' END AS product_data_type FROM nation""",
    "condition": """SELECT CONCAT('R', CAST(n_nationkey AS STRING), '_PC') AS name, CONCAT('R', CAST(n_nationkey AS STRING)) AS processing_routine_name FROM nation""",
    "products": "SELECT o_orderkey AS id, o_orderkey AS input_fk_id, CONCAT('/out/', CAST(o_orderkey AS STRING)) AS product_path, o_custkey % 5 AS product_type_id FROM orders WHERE o_orderstatus = 'F'",
}


def needed(name: str) -> list[str]:
    """The derived tables that name's text mentions, itself last."""
    words = set(TABLES[name].replace(",", " ").replace("(", " ").split())
    out: list[str] = []
    for other in TABLES:
        if other != name and other in words:
            out += [t for t in needed(other) if t not in out]
    return [*out, name]


def with_tables(body: str, names: list[str], spark: bool = False) -> str:
    """body with the derived tables in front that it is said to use."""
    order: list[str] = []
    for n in names:
        order += [t for t in needed(n) if t not in order]
    if not order:
        return body
    ctes = ",\n".join(f"{n} AS ({TABLES[n]})" for n in order).replace("{div}", "div" if spark else "//")
    if body.lstrip()[:14].upper() == "WITH RECURSIVE":
        return f"WITH RECURSIVE {ctes},\n{body.lstrip()[14:]}"
    if body.lstrip()[:4].upper() == "WITH":
        return f"WITH {ctes},\n{body.lstrip()[4:]}"
    return f"WITH {ctes}\n{body}"


class Tables:
    """Tables of a folder by name: base tables as they are, derived ones through their SQL. No view is made; of the
    session's settings only the sizes of parts change, with the tables. Days and hours are those of a session in UTC."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.read: dict[str, DataFrame] = {}
        self.size = 0

    def __call__(self, name: str) -> DataFrame:
        if name in BASE:
            if name not in self.read:
                self.read[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
                before, many = self.size, name == "part"  # each part is a cell of all tiles, which queries make finer
                self.size = bounded_parts(self.spark, f"{self.sf_dir}/{name}.parquet", before, MANY if many else 1)
                if many:
                    self.read[name] = spread(self.read[name], self.size - before)
            return self.read[name]
        if name not in TABLES:
            raise KeyError(name)
        text = with_tables(f"SELECT * FROM {name}", [name], spark=True)
        used = [n for n in BASE if re.search(rf"\b(?:FROM|JOIN) {n}\b", text)]
        for n in used:
            text = re.sub(rf"\b(FROM|JOIN) {n}\b(?! AS \()", rf"\1 {{{n}}}", text)
        return self.spark.sql(text, **{n: self(n) for n in used})
