"""Read quality over a landing folder, pair by pair, and running counts of what has landed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import barcodes, demux
from tessera.params import Params, ReadQC

PAIRS = "read_index long, read_id string, r1_seq string, r1_qual string, r2_seq string, r2_qual string"


def stream_pairs(spark: SparkSession, folder: str, schema: str = PAIRS) -> DataFrame:
    """Read pairs as they land, Parquet files of read_pairs' columns."""
    return spark.readStream.schema(schema).parquet(folder)


def checked_stream(pairs: DataFrame, p: ReadQC = ReadQC()) -> DataFrame:
    """The stream with qc_reason; stateless. Clustering and all that follows need the whole set."""
    return demux.with_qc(pairs, p)


def write_passed(pairs: DataFrame, folder: str, checkpoint: str, p: ReadQC = ReadQC()) -> None:
    """Write passing pairs of all files that are there, exactly once, and stop."""
    query = checked_stream(pairs, p).where("qc_reason is null").drop("qc_reason").writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(folder)
    query.awaitTermination()


#: What is counted: why pairs are filtered, where 16S primers begin, and reads of each barcode.
COUNTS = "kind string, key string, n long, first struct<class:int,index:long>"


def observed(pairs: DataFrame, panel: demux.Panel, params: Params = Params()) -> DataFrame:
    """(kind, key, first): a row for each pair's verdict, and for each passing pair's barcode and, where it is 16S, its primer's start."""
    _, _, fwd, rev, _ = panel[0]
    checked = demux.with_qc(pairs, params.read_qc)
    passed = F.col("qc_reason").isNull()
    own = demux.packets(demux.place_16s(checked, fwd, rev, params.matching), panel, params.matching, params.read_qc.barcode_length)
    seen = lambda kind, key, when: F.when(when, F.struct(F.lit(kind).alias("kind"), key.cast("string").alias("key"), barcodes.read_order().alias("first")))
    rows = F.array(
        seen("reason", F.coalesce("qc_reason", F.lit("passed")), F.lit(True)), seen("start", F.col("r1_primer_start"), passed & F.col("r1_primer_start").isNotNull()), seen("barcode", F.col("barcode"), passed))
    return own.select(F.explode(F.array_compact(rows)).alias("o")).select("o.kind", "o.key", "o.first")


def running_counts(pairs: DataFrame, panel: demux.Panel, folder: str, checkpoint: str, params: Params = Params()) -> None:
    """Count what has landed since the last call, and stop.

    The counts are state of the stream, by kind and key, which the checkpoint keeps: a call
    goes on where the last one ended, however it ended.  Each batch writes the counts that it
    changed to a folder of its own; one that is run again after a loss writes the same.
    """
    counted = observed(pairs, panel, params).groupBy("kind", "key").agg(F.count(F.lit(1)).alias("n"), F.min("first").alias("first"))

    def write(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{folder}/batch={batch}")

    query = counted.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def counts_now(spark: SparkSession, folder: str) -> DataFrame:
    """(kind, key, n, first) as of the last batch: of each key what was written last."""
    changes = spark.read.schema(COUNTS + ", batch long").parquet(folder)
    last = changes.groupBy("kind", "key").agg(F.max_by(F.struct("n", "first"), "batch").alias("last"))
    return last.select("kind", "key", "last.n", "last.first")
