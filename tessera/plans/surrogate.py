"""Reads made from the events table, by one SQL text that Spark and DuckDB run alike.

The tables that queries run over hold no sequences.  Barcodes, strains, reads, qualities and
ranks follow from an event's ids, with foreign reads, point errors and missing ranks at
fixed rates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.seq import RANKS
from tessera.operators import barcodes, cells, order, sequences, variants
from tessera.params import Cells, Params, Variants
from tessera.sources import fastq
from tessera.storage import forget_shuffles, fresh_path, scratch, stored, write_text

PANEL = [
    (0, "16s", "CCTACGGGAGGCAGCAGT", "GGACTACCAGGGTATCTAAT", ""),
    (1, "T1", "ACGTTGCAAGGCTTAACGTA", "TTGACCGATACCGGTTAACA", "ssr"),
    (2, "T2", "GGCATTACCGATTGACCTAA", "CCATGGTTAACGGATCGATA", ""),
]
TARGETS = [r[1] for r in PANEL[1:]]
LINKER = "GAGTCATTGCCAGTAGCATACG"

READS = f"""
SELECT read_index, read_id, barcode, gene_class, target, strain, q20, r1, r2, fq1, fq2,
  CASE WHEN read_index % 13 = 0 THEN substr(repeat(q20, 13), 1, 120) ELSE substr(repeat(q20, 13), 1, CAST(length(fq1) AS INT)) END AS q1,
  substr(concat(q20, repeat('IHGIFIIIHI', 30)), 1, CAST(length(fq2) AS INT)) AS q2,
  'Bacteria' AS R1k, concat('P', CAST(strain % 3 AS STRING)) AS P, concat('C', CAST(strain % 3 AS STRING)) AS C, concat('O', CAST(strain % 6 AS STRING)) AS O,
  concat('F', CAST(strain % 6 AS STRING)) AS F, concat('G', CAST(strain AS STRING)) AS G,
  CASE WHEN read_index % 5 = 0 THEN NULL ELSE concat('S', CAST(strain AS STRING)) END AS S
FROM (
 SELECT *,
  CASE gene_class
   WHEN '16s' THEN concat(substr('TGCAACGTAGATTACAG', 1, CAST(read_index % 10 AS INT)),
     CASE WHEN read_index % 7 = 3 THEN 'CCTATGGGAGGCAGCAGT' WHEN read_index % 17 = 2 THEN 'CCTACGGGGGCAGCAGT' WHEN read_index % 19 = 5 THEN 'AATTCGAGAAACTGCAGT' ELSE '{PANEL[0][2]}' END, r1)
   WHEN 'target' THEN concat(CASE WHEN target = 'T1' THEN CASE WHEN read_index % 5 = 1 THEN 'ACGATGCAAGCCTTAACGTA' ELSE '{PANEL[1][2]}' END
     ELSE CASE WHEN read_index % 9 = 4 THEN substr('{PANEL[2][2]}', 3) ELSE '{PANEL[2][2]}' END END, r1)
   ELSE r1 END AS fq1,
  concat(barcode, 'ACGTACGTACGTAC', '{LINKER}',
   CASE gene_class WHEN '16s' THEN '{PANEL[0][3]}' WHEN 'target' THEN CASE WHEN target = 'T1' THEN '{PANEL[1][3]}' ELSE '{PANEL[2][3]}' END ELSE substr(r2, 90, 20) END, r2) AS fq2
 FROM (
  SELECT read_index, concat('R', CAST(read_index AS STRING)) AS read_id, barcode, gene_class, target, strain, q20, s2 AS r2,
   CASE WHEN read_index % 7 = 0 THEN concat(substr(s, 1, CAST(p - 1 AS INT)), 'A', substr(s, CAST(p + 1 AS INT))) ELSE s END AS r1
  FROM (
   SELECT *, repeat(translate(md5(concat('strain', CAST(strain AS STRING))), '0123456789abcdef', 'ACGTACGTACGTACGT'), 5) AS s,
    repeat(translate(md5(concat('mate', CAST(strain AS STRING))), '0123456789abcdef', 'ACGTACGTACGTACGT'), 5) AS s2,
    31 + read_index % 80 AS p,
    translate(substr(concat(md5(concat('q', CAST(read_index AS STRING))), md5(concat('p', CAST(read_index AS STRING)))), 1, 20), '0123456789abcdef', '#,28;?BDFGHIIIII') AS q20
   FROM (
    SELECT event_id AS read_index, translate(substr(md5(CAST(user_id AS STRING)), 1, 6), '0123456789abcdef', 'ACGTACGTACGTACGT') AS barcode,
     CASE WHEN event_type IN ('view', 'click') THEN '16s' WHEN event_type IN ('purchase', 'signup') THEN 'target' ELSE 'unclassified' END AS gene_class,
     CASE event_type WHEN 'purchase' THEN 'T1' WHEN 'signup' THEN 'T2' END AS target,
     CASE WHEN event_id % 11 = 0 THEN (user_id + 1) % 12 ELSE user_id % 12 END AS strain
    FROM events) AS a) AS b) AS c) AS d"""

#: Thresholds that leave cells at the small sizes.
PARAMS = Params(cells=Cells(min_cells_per_taxon=2), variants=Variants(final_min_cells=2, conflict_cells=3))


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads_of(spark.read.parquet(f"{sf_dir}/events.parquet"))


def reads_of(events: DataFrame) -> DataFrame:
    """A read for each event, in the events' order."""
    return events.sparkSession.sql(READS.replace("FROM events", "FROM {events}"), events=events)


def panel(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PANEL, "panel_index int, target string, fwd string, rev string, mode string")


def packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads as packets, their classes and paths taken as given."""
    names = F.struct(*[F.col("R1k" if c == "R1" else c).alias(c) for c in RANKS])
    return reads(spark, sf_dir).select("read_index", "read_id", "barcode", "gene_class", "target", names.alias("path"), F.lit(0).alias("r1_primer_start"), F.col("r1").alias("r1_seq"), F.col("r2").alias("r2_seq"), "strain")


_kept: dict = {}


def kept(spark: SparkSession, sf_dir: str, what: str, make) -> DataFrame:
    """A table that several queries read, stored once a session and input."""
    key = (spark.sparkContext.applicationId, sf_dir, what)
    if key not in _kept:
        _kept[key] = stored(make(), what)
    return _kept[key]


class Steps:
    """The steps of a run over the surrogate, each a table or a plan."""

    def __init__(self, spark: SparkSession, sf_dir: str, params: Params = PARAMS):
        self.spark, self.sf_dir, self.p = spark, sf_dir, params

    def _kept(self, what: str, make) -> DataFrame:
        return kept(self.spark, self.sf_dir, f"{what}-{hash(self.p) & 0xFFFFFF:x}", make)

    def packets(self) -> DataFrame:
        return self._kept("clustered", lambda: barcodes.with_cells(packets(self.spark, self.sf_dir), self.p.cells.barcode_shift))

    def place(self) -> DataFrame:
        return self.packets().where("barcode = cell").groupBy("cell").agg(F.min("barcode_ord").alias("place"))

    def summary(self) -> DataFrame:
        return self._kept("summary", lambda: cells.consensus(cells.path_counts(self.packets()), self.p.consensus))

    def counts(self) -> DataFrame:
        return cells.target_counts(self.packets())

    def stage1(self) -> DataFrame:
        return cells.stage1(self.summary(), self.p.cells)

    def sized(self) -> DataFrame:
        return self._kept("sized", lambda: cells.taxon_size(self.stage1(), self.p.cells.min_cells_per_taxon))

    def cores(self) -> DataFrame:
        return variants.core_counts(self.packets().join(self.sized().select("cell"), "cell", "left_semi"), self.p.variants)

    def typed(self) -> DataFrame:
        return self._kept("typed", lambda: variants.with_unused(self.sized(), variants.summarise(self.cores(), self.p.variants)))

    def asvs(self) -> DataFrame:
        return variants.registry(self.typed(), self.place())

    def judged(self) -> DataFrame:
        return self._kept("judged", lambda: variants.filtered(variants.assign(self.typed(), self.asvs()), self.p.variants))

    def alive(self) -> DataFrame:
        return self.judged().where("stage is null")

    def tested(self) -> DataFrame:
        return self._kept("tested", lambda: cells.background(self.alive(), self.counts().join(self.alive().select("cell"), "cell", "left_semi"), 0.5))

    def target_cores(self) -> DataFrame:
        return sequences.target_cores(self.packets().join(self.alive().select("cell"), "cell", "left_semi"), self.p.targets)

    def clusters(self) -> DataFrame:
        return sequences.cluster_cores(self.target_cores(), self.p.targets)

    def calls(self) -> DataFrame:
        return self._kept("calls", lambda: sequences.call_sequences(self.target_cores(), self.clusters(), self.p.consensus))

    def names(self) -> DataFrame:
        return self._kept("names", lambda: sequences.denoise(sequences.name_sequences(self.calls(), self.place()), self.p.targets))

    def ranked_names(self) -> DataFrame:
        """names() of which each target's first two stay: a rule that SQL can state, where denoise()'s fit can't be."""
        return self.names().withColumn("retained", F.col("seq_no") <= 2)

    def assigned(self) -> DataFrame:
        return sequences.assignments(self.tested(), self.calls(), self.ranked_names(), ["T1"])


#: A classifier's label of a read: unclassified, root, a name that the report hasn't, a name, or a taxon's number.
LABEL = "CASE WHEN read_index % 23 = 0 THEN '0' WHEN read_index % 29 = 0 THEN '1' WHEN read_index % 31 = 0 THEN 'g__missing' WHEN read_index % 2 = 0 THEN concat('g__G', CAST(strain AS STRING)) ELSE CAST(10 + strain AS STRING) END"


def report() -> str:
    """A classifier's report of the strains' genera and all above them."""
    lines = [("R", "1", "root"), ("D", "2", "d__Bacteria")]
    for a in range(3):
        lines += [("P", f"10{a}", f"p__P{a}"), ("C", f"20{a}", f"c__C{a}")]
        for b in (a, a + 3):
            lines += [("O", f"30{b}", f"o__O{b}"), ("F", f"40{b}", f"f__F{b}")]
            lines += [("G", str(10 + g), f"g__G{g}") for g in (b, b + 6)]
    return "".join(f"1.0\t1\t1\t{code}\t{taxid}\t  {name}\n" for code, taxid, name in lines)


#: Records of a read file, at most; with fewer in all, there is a file for each core.
FILE_RECORDS = 500_000


def _in_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in order, a partition for each read file.

    What reads are made from is narrow, so events are sorted and reads made behind the sort.
    Places deal events out, so that both mates' files hold the same records.
    """
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "user_id", "event_type")
    count = events.count()
    n = max(spark.sparkContext.defaultParallelism, -(-count // FILE_RECORDS))
    # these three are all that reads follow from, so that ties are equal
    placed = order.numbered(events, events.columns, "place")
    return placed.repartitionById(n, F.expr(f"CAST((place - 1) DIV {max(1, -(-count // n))} AS INT)")).sortWithinPartitions("place")


def files(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """The surrogate as a run's input files: reads, the classifier's labels and its report; paths by what they are."""
    key = (spark.sparkContext.applicationId, sf_dir, "files")
    if key not in _kept:
        folder = fresh_path(spark, "surrogate")
        paths = {k: f"{folder}/{k}" for k in ("r1", "r2", "labels", "report")}
        with scratch():
            own = reads_of(_in_files(spark, sf_dir))
            for mate in "12":
                fastq.write_fastq(own, paths[f"r{mate}"], F.concat(F.lit("@"), "read_id", F.lit(f" {mate}")), F.col(f"fq{mate}"), F.col(f"q{mate}"), compression="gzip")
                forget_shuffles(spark)
            own.select(F.concat_ws("\t", F.lit("C"), "read_id", F.expr(LABEL), F.lit("0"), F.lit("A:0")).alias("value")).write.option("compression", "gzip").text(paths["labels"])
        write_text(spark, paths["report"], report())
        forget_shuffles(spark)
        _kept[key] = paths
    return _kept[key]
