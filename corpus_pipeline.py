"""A corpus pipeline of five stages, each over all that its predecessor kept.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame; all but the last give the
columns of documents.  ``run`` writes every stage's result as a table in the shared folder
and reads it again for the next one; the one before it is deleted then, with all tables that
led to the new one, so that the last result alone stays.

In every stage: null and empty texts stay as they are (toxicity scores them as texts without
words, near-dedup takes none for a copy, packing gives each one piece).  Ids must be integers;
rows without an id stay, untouched by what compares documents.  Repeated rows (same id and
text) are one document, whose rows go or stay together.  Columns beside doc_id and text go
along, whatever their names; n_chars, where there is one, follows the text.  Empty tables
give empty tables.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import release, scratch, stored
from tessera.llm.line_dedup import line_dedup
from tessera.llm.minhash import near_dedup
from tessera.llm.packing import pack
from tessera.llm.suffix_dedup import suffix_dedup
from tessera.llm.toxicity import fit, score


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model scores below 0.5; it is fitted on labelled documents of this stage's input."""
    labels, name = spark.read.parquet(f"{sf_dir}/labels.parquet"), f"_score_{uuid.uuid4().hex}"
    return score(docs, fit(docs, labels), keep=True, score_col=name).where(F.col(name) < 0.5).drop(name)


def _counted(docs: DataFrame) -> DataFrame:
    """docs with n_chars of the text as it is now, where there is such a column."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast(docs.schema["n_chars"].dataType)))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the runs of three lines or fifty words, or more, that an earlier text has."""
    return _counted(line_dedup(docs, keep=True))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: shingles of five words, similarity 0.8 or more."""
    return near_dedup(docs, words=5, similar=80)


def drop_repeated_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of strings of 100 bytes that also start earlier."""
    return _counted(suffix_dedup(docs, keep=True))


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents packed into windows of 2048 tokens."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("minhash", drop_near_copies),
    ("suffix_dedup", drop_repeated_bytes),
    ("packing", pack_windows),
]

#: SQL can't express the model, the sketches or the packing; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        with scratch() as keep:
            before, docs = docs, keep(stored(stage(spark, docs, sf_dir), f"stage-{name}", "zstd"))
        release(before)  # the table of the stage before; documents itself isn't one
    return docs
