"""Reads: qualities, primers, demultiplexing, FASTQ."""

import gzip
import random

import pytest
from pyspark.sql import functions as F

from tessera.functions import seq as S
from tessera.operators import demux
from tessera.params import ReadQC
from tessera.sources import fastq
from tessera.streaming import reads as stream


def edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def matches(seq, primer, shift, mm, centre):
    """The definition of a near match, plainly."""
    for s in range(-shift, shift + 1):
        rest, start = (primer, centre + s) if s >= 0 else (primer[-s:], centre)
        if not rest or start < 0 or start >= len(seq):
            continue
        for n in range(max(1, len(rest) - min(mm, 2)), len(rest) + min(mm, 2) + 1):
            w = seq[start : start + n]
            if len(w) == n and (sum(a != b for a, b in zip(rest, w)) if n == len(rest) else edit(rest, w)) <= mm:
                return True
    return False


def start_of(seq, primer, mm):
    best = None
    for s in range(10):
        d = min((edit(primer, seq[s : s + n]) for n in range(len(primer) - 2, len(primer) + 3) if s < len(seq) and len(seq[s : s + n]) == n), default=99)
        if d <= mm and (best is None or d < best[0]):
            best = (d, s)
    return best[1] if best else None


def mutate(r, s, n):
    s = list(s)
    for _ in range(n):
        k = r.randrange(len(s))
        kind = r.random()
        if kind < 0.5:
            s[k] = r.choice("ACGT")
        elif kind < 0.75:
            del s[k]
        else:
            s.insert(k, r.choice("ACGT"))
    return "".join(s)


def test_near_matches_follow_the_definition(spark):
    r = random.Random(5)
    primer = "TCGGGCTGTGTGAATCATTT"
    seqs = ["GTCGGGGTGTGAAATACATTTGCGG", "", "ACG", primer, "A" * 40]
    seqs += ["".join(r.choice("ACGT") for _ in range(r.randint(0, 6))) + mutate(r, primer, r.randint(0, 6)) + "".join(r.choice("ACGT") for _ in range(r.randint(0, 12))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(seqs)), "k int, s string").repartition(3)
    got = {x.k: (x.m, x.c, x.p) for x in df.select("k", S.primer_matches(F.col("s"), primer, 4, 4).alias("m"), S.primer_matches(F.col("s"), primer, 2, 3, 2).alias("c"), S.primer_start(F.col("s"), primer).alias("p")).collect()}
    for k, s in enumerate(seqs):
        assert got[k] == (matches(s, primer, 4, 4, 0), matches(s, primer, 2, 3, 2), start_of(s, primer, 4)), s


def test_a_tie_between_starts_goes_to_the_first(spark):
    assert spark.range(1).select(S.primer_start(F.lit("A" * 20), "AAAA").alias("s")).first().s == 0


def test_staggered_primers(spark):
    primer = "CCTACGGGAGGCAGCAGT"
    prefixes = {0: "", 4: "TGCA", 5: "AACGT", 8: "GATTACAG", 9: "ACGTACGTA"}
    df = spark.createDataFrame([(k, v + primer + "ACGT" * 30) for k, v in prefixes.items()], "k int, s string")
    assert {r.k: r.s for r in df.select("k", S.primer_start(F.col("s"), primer).alias("s")).collect()} == {k: k for k in prefixes}


def test_quality_rules_apply_in_order(spark):
    good, low = "I" * 140, "#" * 140
    rows = [
        ("A" * 129, "I" * 129, "A" * 140, good, "read_length_or_quality_length"), ("A" * 140, "I" * 139, "A" * 140, good, "read_length_or_quality_length"),
        ("A" * 140, low, "A" * 140, good, "mean_phred"), ("A" * 140, good, "A" * 140, "#" * 6 + "I" * 134, "barcode_q25"), ("A" * 140, good, "A" * 140, "#" * 5 + "I" * 135, None)]
    df = spark.createDataFrame([(k, *r[:4]) for k, r in enumerate(rows)], "k int, r1_seq string, r1_qual string, r2_seq string, r2_qual string")
    got = {r.k: r.qc_reason for r in demux.with_qc(df).collect()}
    assert got == {k: r[4] for k, r in enumerate(rows)}
    counts = demux.qc_counts(demux.with_qc(df)).first()
    assert (counts.total_pairs, counts.passed_pairs, counts.read_length_or_quality_length) == (5, 1, 2)
    short = demux.with_qc(df, ReadQC(min_length=1, barcode_length=141)).select("qc_reason").distinct().collect()
    assert {r.qc_reason for r in short} >= {"barcode_length"}
    assert spark.range(1).select(S.mean_phred(F.lit(""))).first()[0] == 0.0


def test_an_exact_match_goes_before_an_earlier_near_one(spark):
    panel = [(0, "16s", "AAAACCCC", "GGGGTTTT", ""), (1, "a", "ACGTACGT", "TGCATGCA", ""), (2, "b", "ACGTACGA", "TGCATGCC", "")]
    pad = "T" * 42
    rows = [("ACGTACGAGG", pad + "TGCATGCCAA", 2), ("ACGTACGTGG", pad + "TGCATGCAAA", 1), ("ACGTACGCGG", pad + "TGCATGCGAA", 1), ("AAAACCCCGG", pad + "GGGGTTTTAA", None), ("AC", pad, None)]
    df = spark.createDataFrame([(k, *r[:2]) for k, r in enumerate(rows)], "k int, a string, b string")
    from tessera.params import Matching

    got = {r.k: r.g for r in df.select("k", demux.gene_of(F.col("a"), F.col("b"), panel, Matching(max_edits=1, max_shift=1), F.lit(True)).alias("g")).collect()}
    assert got == {k: r[2] for k, r in enumerate(rows)}


def _write(path, records, opener=open):
    with opener(path, "wt") as f:
        for r in records:
            f.write("\n".join(r) + "\n")


def test_fastq_scan_pairs_by_position(spark, tmp_path):
    one = [(f"@R{k} 1", "ACGT" * (k % 5), "+", "IIII" * (k % 5)) for k in range(500)]
    two = [(f"@R{k} 2", "TTTT", "+", "@III") for k in range(500)]
    _write(tmp_path / "a.fastq", one)
    _write(tmp_path / "b.fastq.gz", two, gzip.open)
    got = fastq.read_pairs(spark, str(tmp_path / "a.fastq"), str(tmp_path / "b.fastq.gz")).orderBy("read_index").collect()
    assert [(r.read_index, r.read_id, r.r1_seq, r.r2_qual) for r in got] == [(k, f"R{k}", "ACGT" * (k % 5), "@III") for k in range(500)]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        again = fastq.read_fastq(spark, str(tmp_path / "a.fastq")).orderBy("read_index").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [(r.header, r.seq) for r in again] == [(r[0], r[1]) for r in one]
    spark.dataSource.register(fastq.FastqSource)
    split = spark.read.format("fastq").option("rangeBytes", "700").load(str(tmp_path / "a.fastq")).orderBy("offset").collect()
    assert [r.header for r in split] == [r[0] for r in one]


def test_folders_of_files_are_read_in_their_names_order(spark, tmp_path):
    for name, low, high in (("a.fastq", 0, 3), ("b.fastq", 3, 250), ("c.fastq", 250, 260)):
        for mate in "12":
            (tmp_path / mate).mkdir(exist_ok=True)
            _write(tmp_path / mate / name, [(f"@R{k} {mate}", "ACGT" * (1 + k % 7), "+", "IIII" * (1 + k % 7)) for k in range(low, high)])
    got = fastq.read_pairs(spark, str(tmp_path / "1"), str(tmp_path / "2")).orderBy("read_index").collect()
    assert [(r.read_index, r.read_id) for r in got] == [(k, f"R{k}") for k in range(260)]


def test_unequal_files_and_ids_end_the_query(spark, tmp_path):
    _write(tmp_path / "a", [("@A", "AC", "+", "II"), ("@B", "AC", "+", "II")])
    _write(tmp_path / "b", [("@A", "AC", "+", "II")])
    _write(tmp_path / "c", [("@A", "AC", "+", "II"), ("@C", "AC", "+", "II")])
    with pytest.raises(Exception, match="different numbers"):
        fastq.read_pairs(spark, str(tmp_path / "a"), str(tmp_path / "b")).collect()
    with pytest.raises(Exception, match="ids differ"):
        fastq.read_pairs(spark, str(tmp_path / "a"), str(tmp_path / "c")).collect()
    check = lambda x, y: fastq.check_paired(fastq.pair(fastq.read_fastq(spark, str(tmp_path / x)), fastq.read_fastq(spark, str(tmp_path / y)), check=False))
    assert check("a", "a") == "Valid" and "end at different records" in check("a", "b") and "the record at line 5 has another id" in check("a", "c")


def test_trimming_and_sinks(spark, tmp_path):
    df = spark.createDataFrame([(0, "r", "@r", "TT" + "ACGT" + "GGG", "123456789", "@r", "A" * 42 + "CC" + "TTT", "x" * 42 + "yyzzz", 2)], "read_index long, read_id string, r1_header string, r1_seq string, r1_qual string, r2_header string, r2_seq string, r2_qual string, r1_primer_start int")
    row = demux.trimmed(df, "ACGT", "CC").first()
    assert (row.r1_seq, row.r1_qual, row.r2_seq, row.r2_qual) == ("GGG", "789", "TTT", "zzz")
    fastq.write_fastq(df, str(tmp_path / "out"), F.col("r1_header"), F.col("r1_seq"), F.col("r1_qual"))
    assert fastq.read_fastq(spark, str(tmp_path / "out")).first().qual == "123456789"


def test_passing_pairs_of_a_landing_folder(spark, tmp_path):
    rows = [(0, "a", "A" * 140, "I" * 140, "A" * 140, "I" * 140), (1, "b", "A", "I", "A", "I")]
    spark.createDataFrame(rows, stream.PAIRS).write.parquet(str(tmp_path / "in"))
    stream.write_passed(stream.stream_pairs(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "check"))
    assert [r.read_id for r in spark.read.parquet(str(tmp_path / "out")).collect()] == ["a"]


def test_small_text_functions(spark):
    one = spark.range(1)
    value = lambda c: one.select(c).first()[0]
    assert value(S.reverse_complement(F.lit("AACGT"))) == "ACGTT"
    assert value(S.last_bases(F.lit("A" * 59 + "CG"), 60)) == "A" * 58 + "CG"
    assert value(S.tool_number(F.lit("x dG = -3.5 t"))) == -3.5
    assert value(S.percent(F.lit("100%"))) == 100.0
    assert value(S.display_label(F.lit("one two three four"), 9)) == "one two\nthree\nfour"
    assert value(S.semi_global(F.lit("AACGT"), F.lit("ACGTT"), 1)) == 0
    assert value(S.shift_match(F.lit("ACGTACGT"), F.lit("TACGTACG"))) is True and value(S.shift_match(F.lit("ACGT"), F.lit("GGGG"))) is False
    path = F.struct(*[F.lit(v).alias(c) for c, v in zip(S.RANKS, ("B", "P", "C", "O", "F", "Klebsiella x", "S1"))])
    assert value(S.species_complex(path)["G"]) == "Klebsiella pneumoniae complex" and value(S.species_complex(path)["S"]) is None
    assert value(S.most_specific(path)) == "S1"


def test_running_counts_survive_stops_and_losses(spark, tmp_path, monkeypatch):
    """Files land in portions; calls end well, die while a batch is counted, and die once it is written: the counts are those of all files in one go."""
    from pyspark.sql import DataFrameWriter

    from tessera.operators import barcodes
    from tessera.plans import surrogate
    from tessera.streaming import reads as streaming

    panel = surrogate.PANEL
    own = surrogate.reads(spark, "/root/testdata/sf0.001").select("read_index", "read_id", F.col("fq1").alias("r1_seq"), F.col("q1").alias("r1_qual"), F.col("fq2").alias("r2_seq"), F.col("q2").alias("r2_qual"))
    folder, checkpoint = f"{tmp_path}/counts", f"{tmp_path}/checkpoint"
    calls = []
    write = DataFrameWriter.parquet

    def dying(self, path, *a, **k):
        calls.append(path)
        if "batch=" in path and len(calls) == 2:
            raise RuntimeError("before it is written")
        write(self, path, *a, **k)
        if "batch=" in path and len(calls) == 4:
            raise RuntimeError("once it is written")

    def call():
        stream = spark.readStream.schema(streaming.PAIRS).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
        streaming.running_counts(stream, panel, folder, checkpoint)

    lost = 0
    for k in range(6):
        own.where(f"read_index % 6 = {k}").coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
        if k % 2:
            with monkeypatch.context() as m:
                m.setattr(DataFrameWriter, "parquet", dying)
                for _ in range(3):
                    try:
                        call()
                        break
                    except Exception as e:
                        assert "written" in str(e)
                        lost += 1
    assert lost == 2
    got = {(r.kind, r.key): (r.n, tuple(r.first)) for r in streaming.counts_now(spark, folder).collect()}
    checked = demux.with_qc(own)
    reasons = {("reason", r.qc_reason or "passed"): r["count"] for r in checked.groupBy("qc_reason").count().collect()}
    placed = demux.place_16s(checked.where("qc_reason is null"), panel[0][2], panel[0][3])
    starts = {("start", str(r.start)): r.n for r in demux.stagger_counts(placed).collect() if r.n}
    found = {("barcode", r.barcode): (r.n, tuple(r["first"])) for r in barcodes.barcode_counts(demux.packets(placed, panel)).collect()}
    assert {k: v[0] for k, v in got.items() if k[0] == "reason"} == reasons and {k: v[0] for k, v in got.items() if k[0] == "start"} == starts
    assert {k: v for k, v in got.items() if k[0] == "barcode"} == found and len(found) > 5
    call()  # nothing new
    assert {(r.kind, r.key): (r.n, tuple(r.first)) for r in streaming.counts_now(spark, folder).collect()} == got
