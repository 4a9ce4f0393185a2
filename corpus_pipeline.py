"""The corpus pipeline: quality rules, near-dedup, secrets, source mix, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
reread as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from joinscope.llm import minhash_dedup, packing, quality_rules, secret_scan, source_mix
from joinscope.llm.common import fresh, keep, table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the weighed votes reject go."""
    verdict = fresh(docs, "quality")
    return quality_rules.judge(docs, into=verdict).where(F.col(f"{verdict}.kept")).drop(verdict)


def _near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group stays; rows with one id and text are one."""
    gone, own = fresh(docs, "gone"), fresh(docs, "own")
    dropped = minhash_dedup.near_duplicates(docs).where("not kept").select(F.col("doc_id").alias(gone)).distinct()
    left = docs.join(dropped, F.col("doc_id") == F.col(gone), "left_anti")
    text = F.xxhash64(F.coalesce("text", F.lit("")))
    return left.withColumn(own, F.when(F.col("doc_id").isNotNull(), text).otherwise(F.monotonically_increasing_id())).dropDuplicates(["doc_id", own]).drop(own)


def _secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret is replaced in its text; n_chars follows."""
    clean = docs.withColumn("text", secret_scan.redact(F.col("text")))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return clean


def _mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source gets near its target; rows are repeated or left out for it."""
    return source_mix.mix(docs)


def _pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 ids in their sequences."""
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("quality_rules", _quality),
    ("minhash_dedup", _near_duplicates),
    ("secret_scan", _secrets),
    ("source_mix", _mix),
    ("packing", _pack),
]

#: Ids of tokenizers and decoded secrets can't be had in SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
