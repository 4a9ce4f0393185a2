"""The registered query of each operator: its operator over the whole table, with the digest columns.

``ORACLE`` is the check SQL of those that SQL can express.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from joinscope.llm import block_ann, embedding_whitening, lattice_lm, license_scan, merkle_manifest, minhash_dedup, packing, quality_fm, quality_rules, secret_scan, sentence_pieces, source_mix, toxicity_knn
from joinscope.llm.common import ascii_lower, table
from joinscope.llm.labelled import held_out
from joinscope.llm.oracle import ORACLE

#: A tokenizer file; each machine has it at this path.
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    s = quality_fm.classify(docs, table(spark, sf_dir, "labels"), metadata=("n_chars",))
    return s.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), TOKENIZER)


@query
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents")).drop("spans")


@query
def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    taken = F.col("size") * F.size("copies")
    shard = F.array_min(F.transform("copies", lambda c: c["shard"]))
    return source_mix.plan(docs, carry=("doc_id",)).select("row.doc_id", "size", "source_size", "target", taken.alias("taken"), shard.alias("first_shard"))


@query
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = secret_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"), into="s")
    counts = [f"s.{c}" for c in ("n_assign", "n_access", "n_hex")]
    return s.select("doc_id", *counts, F.sha2(F.col("s.base"), 256).alias("base_sha256"), "s.spans")


@query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    q = quality_rules.judge(docs, into="q")
    return q.select("doc_id", *[f"q.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")])


@query
def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op8_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_lm.score(table(spark, sf_dir, "documents"), VOCABULARY)


@query
def op9_block_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return block_ann.neighbours(vectors, vectors.where(F.col("vec_id") % 50 == 0), 5)


@query
def op10_toxicity_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    s = toxicity_knn.classify(docs, table(spark, sf_dir, "labels"), "toxic")
    score = F.col("toxicity.score")
    return s.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score, (score >= 0.3).cast("int").alias("predicted"), F.col("toxicity.examples").alias("evidence"))


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("doc_id", "source", "lang", "n_chars", "text")
    tampered = merkle_manifest.leaf([ascii_lower(F.col(c)) if c == "text" else F.col(c) for c in columns])
    changed = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, tampered)
    m = merkle_manifest.manifest(table(spark, sf_dir, "documents"), columns, "source", other=changed, witness=False)
    return m.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@query
def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_whitening.whiten(table(spark, sf_dir, "embeddings"))


@query
def op13_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", sentence_pieces.digests(F.col("text"), VOCABULARY).alias("d")).select("doc_id", "d.*")


__all__ = ["ORACLE", "QUERIES"]
