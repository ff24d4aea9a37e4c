"""Queries over this subpackage's operators, with production parameters and whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import chunk_dedup, hnsw, line_dedup, merkle, minhash, mpeg, negatives, packing, pieces, simhash, suffix_dedup, toxicity, warc
from tessera.llm.common import scratch, stored


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _alone(what: str, make: Callable[[], DataFrame]) -> DataFrame:
    """A result as a table in the shared folder, without the tables that led to it."""
    with scratch() as keep:
        return keep(stored(make(), what))


def op1_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    return hnsw.search(rows, rows.where(F.col("vec_id") % 100 == 0))


def op2_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _alone("near-duplicates", lambda: minhash.near_duplicates(_table(spark, sf_dir, "documents"), words=3, similar=85))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _alone("archived", lambda: warc.archive_round_trip(spark, _table(spark, sf_dir, "pages")))


def op5_mpeg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _alone("media-read", lambda: mpeg.media_columns(_table(spark, sf_dir, "documents")))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _alone("suffix-dedup", lambda: suffix_dedup.suffix_dedup(_table(spark, sf_dir, "documents")))


def op8_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup.chunk_dedup(_table(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _alone("line-dedup", lambda: line_dedup.line_dedup(_table(spark, sf_dir, "documents")).withColumn("kept_sha256", F.sha2("kept_text", 256)).drop("kept_text"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tamper_check(_table(spark, sf_dir, "documents"))


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.withColumn("label", label), F.col("vec_id") % 100 == 0)


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_hnsw, op2_pieces, op3_minhash, op4_warc, op5_mpeg, op6_suffix_dedup, op7_packing, op8_chunk_dedup, op9_line_dedup, op10_toxicity, op11_merkle, op12_negatives, op13_simhash)}

#: DuckDB SQL by query, where SQL can express it.
ORACLES: dict[str, str] = {
    "op9_line_dedup": line_dedup.ORACLE,
    "op11_merkle": merkle.ORACLE,
    "op12_negatives": negatives.ORACLE,
    "op4_warc": """
        WITH p AS (SELECT page_id, url, coalesce(html, '') AS h FROM pages),
        d AS (SELECT page_id, url, strlen(h) AS b, sha1(h) AS s FROM p),
        m AS (SELECT *, max(page_id) OVER (PARTITION BY s) AS top FROM d)
        SELECT page_id, url, CAST(b AS BIGINT) AS payload_bytes, s AS payload_digest,
               CASE WHEN b >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN b >= 1000 AND page_id <> top THEN top END AS refers_to
        FROM m""",
}
