"""From read pairs to packets: quality, 16S primer placement, gene assignment, barcode and taxonomy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import seq as S
from tessera.params import Matching, ReadQC

Panel = list[tuple[int, str, str, str, str]]


def panel_list(panel: DataFrame) -> Panel:
    """A panel's rows in order, for expressions; a panel is a few dozen rows."""
    return [(r["panel_index"], r["target"], r["fwd"], r["rev"], r["mode"]) for r in panel.orderBy("panel_index").collect()]


def with_qc(pairs: DataFrame, p: ReadQC = ReadQC()) -> DataFrame:
    """pairs with qc_reason, null where a pair passes."""
    return pairs.withColumn("qc_reason", S.qc_reason(F.col("r1_seq"), F.col("r1_qual"), F.col("r2_seq"), F.col("r2_qual"), p))


def qc_counts(checked: DataFrame) -> DataFrame:
    """One row of counters: total, passed and filtered pairs, and each reason's."""
    one = lambda c: F.count_if(c).alias
    reason = F.col("qc_reason")
    return checked.agg(
        F.count(F.lit(1)).alias("total_pairs"), one(reason.isNull())("passed_pairs"), one(reason.isNotNull())("filtered_pairs"),
        *[one(reason == r)(r) for r in ("read_length_or_quality_length", "mean_phred", "barcode_length", "barcode_q25")])


def place_16s(pairs: DataFrame, fwd: str, rev: str, p: Matching = Matching()) -> DataFrame:
    """pairs with r1_primer_start: where the 16S primer begins on R1, null unless R2's primer matches too."""
    return pairs.withColumn("r1_primer_start", S.place_16s(F.col("r1_seq"), F.col("r2_seq"), fwd, rev, p))


def gene_of(r1: Column, r2: Column, panel: Panel, p: Matching = Matching(), skip_16s: Column | None = None) -> Column:
    """panel_index of a read: an exact match on any primer goes before near matches; among either the panel's order decides. Null: none."""
    return S.gene_of(r1, r2, F.lit(False) if skip_16s is None else skip_16s, [(k, fwd, rev) for k, _, fwd, rev, _ in panel], p)


def packets(pairs: DataFrame, panel: Panel, p: Matching = Matching(), barcode_length: int = 20) -> DataFrame:
    """pairs with r1_primer_start as packets: barcode, panel_index and gene_class.

    A read with a start is 16S; others are held against the panel without its 16S row.
    """
    index = F.when(F.col("r1_primer_start").isNotNull(), F.lit(0)).otherwise(gene_of(F.col("r1_seq"), F.col("r2_seq"), panel, p, F.lit(True)))
    out = pairs.withColumn("panel_index", index).withColumn("barcode", S.barcode(F.col("r2_seq"), barcode_length))
    kind = F.when(F.col("panel_index") == 0, "16s").when(F.col("panel_index").isNotNull(), "target").otherwise("unclassified")
    return out.withColumn("gene_class", kind)


def trimmed(pairs: DataFrame, fwd: str, rev: str, p: Matching = Matching()) -> DataFrame:
    """16S reads without primers and barcode, for an external classifier."""
    keep = pairs.where("r1_primer_start is not null")
    start = F.col("r1_primer_start")
    cut = lambda c, s, n: F.substring(F.col(c), s + n + 1, F.length(F.col(c)))
    r2 = F.lit(p.r2_primer_start)
    return keep.select("read_index", "read_id", "r1_header", cut("r1_seq", start, len(fwd)).alias("r1_seq"), cut("r1_qual", start, len(fwd)).alias("r1_qual"), "r2_header", cut("r2_seq", r2, len(rev)).alias("r2_seq"), cut("r2_qual", r2, len(rev)).alias("r2_qual"))


def stagger_counts(pairs: DataFrame, starts: tuple[int, ...] = Matching().r1_starts) -> DataFrame:
    """(start, n) for each valid start, zeros included."""
    # no filter before the aggregate: pushed down, it would compute the start once more
    counted = pairs.groupBy(F.col("r1_primer_start").cast("int").alias("start")).agg(F.count(F.lit(1)).alias("n"))
    every = pairs.sparkSession.createDataFrame([(s,) for s in starts], "start int")
    return every.join(F.broadcast(counted), "start", "left").select("start", F.coalesce("n", F.lit(0)).alias("n"))


EMPTY_PATH = "struct<R1:string,P:string,C:string,O:string,F:string,G:string,S:string>"


def classify(reads: DataFrame, labels: DataFrame, taxa: DataFrame, require_all: bool = True) -> DataFrame:
    """reads with classifiable and path, from a classifier's labels (read_id, label).

    0 or unclassified: not classifiable.  1 or root: classifiable, all ranks null.  A label
    without "__" is a taxon id, others are rank__Name, d standing for R1; a taxon that the
    report doesn't have leaves all ranks null.  A 16S read without a label ends the query.
    """
    label = F.col("label")
    tagged = label.contains("__")
    rank = F.when(tagged, F.initcap(F.substring_index(label, "__", 1)))
    asked = labels.select("read_id", "label", F.when(rank == "D", "R1").otherwise(rank).alias("_rank"), F.when(tagged, F.split(label, "__", 2)[1]).alias("_name"))
    by_id = taxa.select(F.col("taxid").alias("label"), F.col("path").alias("_by_id"))
    by_name = taxa.groupBy(F.col("rank").alias("_rank"), F.col("name").alias("_name")).agg(F.min_by("path", "taxid").alias("_by_name"))
    # the report has a row for each taxon of the database; Spark broadcasts it while it is below its own size limit
    named = asked.join(by_id, "label", "left").join(by_name, ["_rank", "_name"], "left").select("read_id", "label", F.coalesce("_by_id", "_by_name").alias("_path"))
    out = reads.join(named, "read_id", "left")
    no = F.col("label").isin("0", "unclassified")
    root = F.col("label").isin("1", "root")
    fault = F.when((F.col("gene_class") == "16s") & F.col("label").isNull(), F.raise_error(F.concat(F.lit("no classification for read "), F.col("read_id"))).cast("boolean")) if require_all else F.lit(None).cast("boolean")
    is16 = F.col("gene_class") == "16s"
    return out.withColumn("classifiable", F.when(is16, F.coalesce(fault, ~no))).withColumn("path", F.when(is16 & ~no & ~root, F.col("_path"))).drop("label", "_path")
