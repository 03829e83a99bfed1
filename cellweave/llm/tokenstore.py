"""Tokenised corpora in Simple-8b files, in ascending order of document id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import simple8b
from .common import shuffle_width


def in_order(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and text in ascending order of id over tasks and their rows, nulls first; rows of one id by a checksum of
    the text. Equal rows may stand in several tasks."""
    rows = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    keyed = rows.withColumn("_crc", F.xxhash64("text")).withColumn("_tie", F.monotonically_increasing_id())
    order = ["doc_id", "_crc", "_tie"]
    return keyed.repartitionByRange(shuffle_width(df.sparkSession), *order).sortWithinPartitions(*order).select("doc_id", "text")


def store(df: DataFrame, tokenizer: str, path: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the corpus to token files under path and gives what they hold: doc_id, start (ids of all documents before)
    and ids. Repeated rows and ids are documents of their own, null ids come first, null texts have the end id alone, other
    columns are left out, an empty table gives a store without files and no rows."""
    simple8b.write_texts(in_order(df, id_col, text_col), path, tokenizer, end_id)
    return simple8b.read_tokens(df.sparkSession, path)


def digest(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of what a store holds."""
    return tokens.select("doc_id", "start", F.expr("octet_length(ids) div 4").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
