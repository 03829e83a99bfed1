"""Queries by name, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .fixtures import Tables, with_tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None, uses: str = ""):
    """Registers a function of Tables; uses names the derived tables of the oracle, which follows them as CTEs."""

    def put(f: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if oracle:
            ORACLES[name] = with_tables(oracle, uses.split())
        return f

    return put
