"""The registered queries of the numbered operators: thin calls with production parameters."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, conversations, jaccard, licenses, merkle, packing, pii, quality, sharding, tokenstore, toxicity, vectors
from .common import shared_dir, table


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents", "doc_id", "text"))


#: A document's first line counts as its prompt, which bears no loss. On these documents each limit binds.
PACKING = packing.Limits(tokens=2048, segments=12, loss=1984)


def pack_documents(docs: DataFrame) -> DataFrame:
    answer = F.when(F.instr("text", "\n") > 0, 1 - F.instr("text", "\n") / F.length("text")).otherwise(1.0)
    return packing.pack(docs.withColumn("_answer", answer), tokenizer_path("word_bpe_49k.json"), limits=PACKING, loss_share_col="_answer")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents", "doc_id", "text"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    narrow = docs.select(F.col("doc_id"), sharding.size_of(F.col("text")).alias("size"), sharding.text_crc(F.col("text")).alias("text_crc32"))
    placed, _ = sharding.shuffled_shards(narrow, 8, 20240501, "doc_id", "text_crc32", "size")
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link_classes(table(spark, sf_dir, "documents", "doc_id", "text"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "quality"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "toxic"))


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans")


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.codec_digest(table(spark, sf_dir, "documents", "doc_id", "text"), tokenizer_path("byte_bpe_50k.json"))


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return vectors.nearest(rows, rows.where("vec_id % 20 = 0"), plan=vectors.Aq(queries=32_768, certain=True))


MANIFEST = ["doc_id", "source", "lang", "n_chars", "text"]


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", *MANIFEST)
    changed = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    shown = [changed if c == "n_chars" else F.col(c) for c in MANIFEST]
    return merkle.manifest(docs, MANIFEST, "lang", "doc_id", 2, shown).drop("steps")


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    return tokenstore.digest(tokenstore.store(table(spark, sf_dir, "documents", "doc_id", "text"), tokenizer_path("word_bpe_49k.json"), path))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(conversations.damaged(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k.startswith("op") and k[2].isdigit()}
