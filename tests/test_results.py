"""Tables, validators, reports, and a whole run over made reads."""

import functools
import json
import math
import pathlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions import duplex
from tessera.operators import primers
from tessera.params import Cells, Params, Variants
from tessera.plans import reports, results, run
from tessera.sources import commit, fastq, tables
from tessera.storage import write_text

PANEL = "Primer,F,R,Mode\n16s,CCTACGGGAGGCAGCAGT,GGACTACCAGGGTATCTAATCCTGTT,\ntarget,ACGTTGCAACGTTGCAACGT,TGCACGATTGCACGATTGCA,ssr\n"


def test_panel_dialects_and_faults(spark, tmp_path):
    def say(text):
        (tmp_path / "p.csv").write_text(text, encoding="utf-8")
        return tables.check_panel(spark, str(tmp_path / "p.csv"))

    assert say(PANEL) == "Valid"
    assert [r.target for r in tables.read_panel(spark, str(tmp_path / "p.csv")).orderBy("panel_index").collect()] == ["16s", "target"]
    assert say("﻿Primer,F,R,Sub-ARG\n16s,ACG,CCC,single\n\"a,b\",ACC,CCA,family\n") == "Valid"
    assert [(r.target, r["mode"]) for r in tables.read_panel(spark, str(tmp_path / "p.csv")).orderBy("panel_index").collect()] == [("16s", ""), ("a,b", "")]
    head = "Primer,F,R,Mode\n"
    for text, part in (("a,b\n", "four columns"), ("", "four columns"), ("X,F,R,Mode\n", "first column"), ("Primer,F,R,Kind\n", "fourth column"), ("Target,F,R,Sub-ARG\n", "fourth column"), ("Primer,A,R,Mode\n", "second and third"), (head + "16s,A\n", "line 2"), (head + "16s,A,C,\n16s,C,C,\n", "listed twice"), (head + "16s,A,C,\nb,A,C,\n", "primers of an earlier line"), (head + "16s,N,C,\n", "forward primer of 16s"), (head + "16s,A,n,\n", "reverse primer of 16s"), (head + "16s,A,C,x\n", "the mode x"), ("Primer,F,R,Sub-ARG\n16s,A,C,x\n", "neither single nor family"), (head + "b,A,C,\n", "stands first")):
        assert part in say(text), text


def test_reference_fasta(spark, tmp_path):
    def say(text):
        (tmp_path / "r.fa").write_text(text)
        return tables.check_fasta(spark, str(tmp_path / "r.fa"))

    assert say(">a x\nACGT\n\n>b\nAC\nGT\n") == "Valid"
    assert {r.name: (r.title, r.seq) for r in tables.read_fasta(spark, str(tmp_path / "r.fa"), ("b",)).collect()} == {"a": ("a x", "ACGT")}
    for text, part in ((">a\n>b\nA\n", "line 2: a record begins"), (">\nA\n", "line 1: a record has no name"), ("A\n", "line 1: there is a sequence before"), (">a\nA C\n", "line 2: there is white space"), (">a\nA\n\n>b\n\n>c\nA", "line 6: a record begins"), ("\n", "no records"), (">a\n", "the last record")):
        assert part in say(text), text


def test_report_tree_and_labels(spark, tmp_path):
    from tessera.operators import demux

    rows = [("U", "0", "unclassified"), ("R", "1", "root"), ("D", "2", "  d__Bacteria"), ("P", "3", "p__P"), ("K", "9", "k__skipped"), ("G", "4", "g__G"), ("S", "5", "s__S"), ("S1", "8", "s1__x"), ("P", "6", "p__Q")]
    (tmp_path / "report").write_text("".join(f"1\t1\t1\t{c}\t{i}\t{n}\n" for c, i, n in rows))
    taxa = tables.read_taxa(spark, str(tmp_path / "report"))
    assert {r.taxid: tuple(r.path) for r in taxa.collect()}["5"] == ("Bacteria", "P", None, None, None, "G", "S")
    assert {r.taxid: tuple(r.path) for r in taxa.collect()}["6"] == ("Bacteria", "Q") + (None,) * 5
    (tmp_path / "out").write_text("".join(f"C\tr{k}\t{label}\t0\tx\n" for k, label in enumerate(["0", "1", "5", "g__G (taxid 4)", "d__Bacteria", "g__other", "77"])))
    labels = tables.read_classified(spark, str(tmp_path / "out"))
    reads = spark.createDataFrame([(f"r{k}", "16s") for k in range(7)] + [("t", "target")], "read_id string, gene_class string")
    got = {r.read_id: (r.classifiable, r.path and (r.path.R1, r.path.G, r.path.S)) for r in demux.classify(reads, labels, taxa).collect()}
    assert got == {"r0": (False, None), "r1": (True, None), "r2": (True, ("Bacteria", "G", "S")), "r3": (True, ("Bacteria", "G", None)), "r4": (True, ("Bacteria", None, None)), "r5": (True, None), "r6": (True, None), "t": (None, None)}
    with pytest.raises(Exception, match="no classification"):
        demux.classify(reads.unionByName(spark.createDataFrame([("lost", "16s")], "read_id string, gene_class string")), labels, taxa).collect()


def _example(folder):
    """12 cells of 8 16S reads, 4 of them with 8 target reads too: 128 pairs of 150 bases."""
    r = random.Random(1)
    dna = lambda n: "".join(r.choice("ACGT") for _ in range(n))
    linker, core = dna(22), (dna(150), dna(150))
    target, out = (dna(150), dna(150)), []
    for c in range(12):
        code = dna(20)
        kinds = ["16s"] * 8 + ["t"] * 8 * (c < 4)
        for k, kind in enumerate(kinds):
            if kind == "16s":
                r1, r2 = "TGCAACGTA"[: k % 10] + "CCTACGGGAGGCAGCAGT" + core[0], code + linker + "GGACTACCAGGGTATCTAATCCTGTT" + core[1]
            else:
                r1, r2 = "ACGTTGCAACGTTGCAACGT" + target[0], code + linker + "TGCACGATTGCACGATTGCA" + target[1]
            out.append((r1[:150], r2[:150]))
    for name, m in (("1.fastq", 0), ("2.fastq", 1)):
        (folder / name).write_text("".join(f"@read{k} x\n{p[m]}\n+\n{'I' * 150}\n" for k, p in enumerate(out)))
    (folder / "panel.csv").write_text(PANEL)


def test_a_whole_run(spark, tmp_path):
    _example(tmp_path)
    pairs = fastq.read_pairs(spark, str(tmp_path / "1.fastq"), str(tmp_path / "2.fastq"))
    panel = tables.read_panel(spark, str(tmp_path / "panel.csv"))
    taxa = spark.createDataFrame([("7", "S", "S", ("B", "P", "C", "O", "F", "G", "S"))], tables.TAXA)
    labels = pairs.select("read_id", F.lit("7").alias("label"))
    seqs = {r.k: r for r in pairs.where("read_index in (0, 8)").select(F.col("read_index").alias("k"), "r1_seq", "r2_seq").collect()}
    params = Params(cells=Cells(min_cells_per_taxon=10), variants=Variants(final_min_cells=10))
    reference = spark.createDataFrame([("ref", "ref title", seqs[8].r1_seq + "ACGT" + seqs[8].r2_seq)], "name string, title string, seq string")
    # a rate far below the counts, so that positive cells stay positive
    done = run.run(pairs, panel, labels, taxa, params, reference=reference)
    s = done.summary
    assert s["read_qc"]["raw_read_pairs"] == s["read_qc"]["passed_read_pairs"] == 128
    assert s["read_classification"] == {"accepted_16s_reads": 96, "target_reads": 32, "unclassified_reads": 0}
    funnel = s["barcode_funnel"]
    assert (funnel["raw_unique_barcodes"], funnel["clustered_barcodes"], funnel["final_cells"]) == (12, 12, 12)
    assert s["asv_summary"]["final_asv_count"] == 1
    assert s["target_filtering_summary"][0]["original_positive_cells"] == s["target_filtering_summary"][0]["final_positive_cells"] == 4
    assert sum(s["16s_r1_primer_starts"].values()) == 96 and s["16s_r1_primer_starts"]["0"] == 12
    assert done.problems(spark, ["target"], params) == []
    seq = done.sequences.first()
    assert seq.sequence_cluster_id == "target_seq_1" and seq.final_surviving_cell_count == 4 and seq.reference_matches[0].subject == "ref title" and seq.phase_variation.call in ("ssr_detected", "no_ssr_detected")
    assert s["phase_variation_summary"]["cell_calls"] == 4

    folder = tmp_path / "out"
    results.write_results(str(folder), s, done.candidates, done.all_asvs, done.cells, done.asvs, done.sequences)
    again = tables.read_jsonl(spark, str(folder / "cells.jsonl"), results.CELL)
    assert sorted(map(str, again.collect())) == sorted(map(str, done.cells.collect()))
    assert json.loads((folder / "run_summary.json").read_text())["run_id"] == s["run_id"]
    row = json.loads(next((folder / "target_sequences.jsonl").glob("part*")).read_text().splitlines()[0])
    assert set(row) == {"schema_version", "record_type", "run_id", "sequence_cluster_id", "parent_target", "core_sequence", "final_surviving_cell_count", "phase_variation", "reference_matches"}
    assert "direct_similarity" in row["phase_variation"]  # nulls inside stay
    with pytest.raises(FileExistsError):
        results.write_results(str(folder), s, done.candidates, done.all_asvs, done.cells, done.asvs, None)

    matrix = results.cell_target_matrix(done.cells, ["target"]).collect()
    assert sorted(r["target"] for r in matrix) == ["0"] * 8 + ["target_seq_1"] * 4
    assert results.taxonomy_report(done.cells).first().Cell_Count == 12 and results.asv_report(done.asvs).first().cell_count == 12
    assert results.target_report(done.target_summary).first()["% Retention"] == 100.0
    assert results.phase_report(done.cells, done.sequences).count() == 4 and results.reference_report(done.sequences, ["target"]).first().read1_percent_identity == "100%"
    assert {(r.section, r.metric): r.value for r in results.overview(spark, s).collect()}["cells", "final_cells"] == 12
    assert results.asv_target_fractions(done.cells, done.asvs, ["target"], 10).first().target == pytest.approx(1 / 3)
    assert results.legacy_export(done.candidates).count() == 12

    # validators see what is wrong
    broken = done.cells.withColumn("asv", F.col("asv").withField("asv_id", F.lit("ASV_9")))
    rules = {r.rule for r in results.violations(s["run_id"], broken, done.asvs, done.sequences, ["target"]).collect()}
    assert rules == {"asv_cells"}
    assert {r.rule for r in results.violations(s["run_id"], done.cells, done.asvs, done.sequences, ["other"]).collect()} == {"target_known", "sequence_parent"}
    rules = {r.rule for r in results.provenance_violations(s["run_id"], done.candidates, done.all_asvs, done.cells.limit(11), done.asvs, params.variants).collect()}
    assert "passed_is_final" in rules
    assert results.summary_violations(s | {"status": "x"}, s["run_id"], 12, 1, 12, 1) == ["identity"]


def test_staging_keeps_failures_apart(spark, tmp_path):
    with pytest.raises(RuntimeError):
        with tables.Staged(spark, str(tmp_path / "run")) as work:
            tables.write_json(spark, {"x": 1}, f"{work}/x.json")
            raise RuntimeError
    assert not (tmp_path / "run").exists() and list(tmp_path.glob(".run.incomplete.*"))
    with tables.Staged(spark, f"file://{tmp_path}/run") as work:
        tables.write_json(spark, {"x": 1}, f"{work}/x.json")
    assert json.loads((tmp_path / "run" / "x.json").read_text()) == {"x": 1}
    with pytest.raises(FileExistsError):
        tables.Staged(spark, str(tmp_path / "run"))


@pytest.mark.parametrize("rename", [True, False])
def test_a_run_that_is_killed_at_any_write_leaves_nothing_readable(spark, tmp_path, monkeypatch, rename):
    cell = spark.createDataFrame([("a", "x"), ("b", "y")], "run_id string, v string").repartition(2)
    steps = [lambda w: tables.write_json(spark, {"run_id": "a"}, f"{w}/run_summary.json"), lambda w: tables.write_jsonl(cell, f"{w}/cells.jsonl"), lambda w: tables.write_jsonl(cell.limit(0), f"{w}/none.jsonl")]
    kills = 0

    def die(*_, **__):
        raise KeyboardInterrupt

    for k in range(len(steps) + 3):
        target = str(tmp_path / (f"run{k}" if rename else "run"))
        with pytest.raises(KeyboardInterrupt), monkeypatch.context() as m:
            if k == len(steps):
                m.setattr(commit, "move" if rename else "digests", die)
            if k == len(steps) + 1:
                m.setattr(commit, "write_text", die)
            if k == len(steps) + 2:
                # a manifest of which half is there
                half = lambda spark, path, text: (write_text(spark, path, text[: len(text) // 2]), die())
                m.setattr(commit, "write_text", half)
            with commit.Staged(spark, target, rename) as work:
                for j, step in enumerate(steps):
                    if j == k:
                        die()
                    step(work)
        kills += 1
        with pytest.raises(FileNotFoundError):
            commit.Published(spark, target)
        with pytest.raises(FileNotFoundError):
            reports.load(spark, target)
    assert kills == 6
    # in an object store another attempt follows into the same target, but for the half manifest
    target = tmp_path / ("whole" if rename else "run")
    if not rename:
        (target / commit.MANIFEST).unlink()
        (target / f".{commit.MANIFEST}.crc").unlink(missing_ok=True)
    with commit.Staged(spark, str(target), rename) as work:
        for step in steps:
            step(work)
    whole = commit.Published(spark, str(target))
    assert sorted(tuple(r) for r in whole.read_json("cells.jsonl", "run_id string, v string").collect()) == [("a", "x"), ("b", "y")] and whole.faults() == []
    assert whole.read_json("none.jsonl", "run_id string").count() == 0 and whole.read_json("other.jsonl", "a string") is None and len(whole.paths("run_summary.json")) == 1
    with pytest.raises(FileExistsError):
        commit.Staged(spark, str(target), rename)
    # a file that comes up later isn't read; one that changes is told
    folder = tmp_path / whole.folder
    (folder / "cells.jsonl" / "part-99.json").write_text('{"run_id": "z", "v": "z"}\n')
    part = next(p for p in (folder / "cells.jsonl").glob("part-0*.json") if p.stat().st_size)
    assert whole.read_json("cells.jsonl", "run_id string, v string").count() == 2
    text = part.read_text()
    (part.parent / f".{part.name}.crc").unlink(missing_ok=True)
    part.write_text(text.replace('"x"', '"q"').replace('"y"', '"q"'))
    assert whole.faults() == sorted(["cells.jsonl/part-99.json", f"cells.jsonl/{part.name}"])


def test_one_command_from_files_to_a_folder(spark, tmp_path, capsys):
    from tessera import cli

    _example(tmp_path)
    (tmp_path / "labels").write_text("".join(f"C\tread{k}\t5\t0\tx\n" for k in range(128)))
    ranks = [("R", "1", "root"), ("D", "2", "d__B"), ("P", "3", "p__P"), ("S", "5", "s__S")]
    (tmp_path / "report").write_text("".join(f"1\t1\t1\t{c}\t{i}\t{n}\n" for c, i, n in ranks))
    (tmp_path / "ref.fa").write_text(">r one\nACGT\n")
    args = ["-1", f"{tmp_path}/1.fastq", "-2", f"{tmp_path}/2.fastq", "-p", f"{tmp_path}/panel.csv", "--classified", f"{tmp_path}/labels", "--report", f"{tmp_path}/report", "-r", f"{tmp_path}/ref.fa", "-o", f"{tmp_path}/out"]

    def refused(change):
        with pytest.raises(SystemExit):
            cli.main(change, spark)
        return capsys.readouterr().err

    assert "no such file for R2" in refused([x.replace("2.fastq", "none") for x in args]) and "negative" in refused([*args, "--min-cells-per-taxon=-1"])
    several = refused([x.replace("2.fastq", "none").replace("ref.fa", "no.fa") for x in args] + ["--threads=-2"])
    assert "no such file for R2" in several and "no such file for reference" in several and "--threads can't be negative" in several
    shared = lambda: {p.name for p in pathlib.Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file://"), "tessera").glob("*")}
    before = shared()
    (tmp_path / "bad.csv").write_text(PANEL.replace("16s", "x"))
    assert "stands first" in refused([x.replace("panel.csv", "bad.csv") for x in args])
    (tmp_path / "bad.fa").write_text("ACGT\n")
    assert "before any record" in refused([x.replace("ref.fa", "bad.fa") for x in args])
    (tmp_path / "short.fastq").write_text("".join((tmp_path / "2.fastq").read_text().splitlines(True)[:-4]))
    assert "end at different records" in refused([x.replace("2.fastq", "short.fastq") for x in args])
    cli.main([*args, "--min-cells-per-taxon", "12"], spark)
    folder = tmp_path / "out"
    record = json.loads((folder / "run_summary.json").read_text())
    assert record["parameters"]["cells"]["min_cells_per_taxon"] == 12 and record["inputs"]["reference_fasta"] == f"{tmp_path}/ref.fa" and record["barcode_funnel"]["final_cells"] == 12
    assert "there already" in refused(args) and not list(tmp_path.glob(".out.incomplete*"))
    assert shared() == before and commit.Published(spark, str(folder)).faults() == []

    from tessera.plans import reports

    names = ["summary.tsv", "cell_target_matrix.tsv", "asv_summary.tsv", "taxonomy_summary.tsv", "target_summary.tsv", "cell_phase_variation.tsv", "reference_matches.tsv"]
    assert sorted(x.name for x in (folder / "reports").iterdir() if not x.name.startswith(".")) == sorted(names)
    assert reports.write_reports(spark, str(folder), str(tmp_path / "again")) == names
    read = lambda name: spark.read.option("sep", "\t").option("header", True).csv(str(tmp_path / "again" / name))
    matrix = read("cell_target_matrix.tsv").collect()
    assert len(matrix) == 12 and [r["Barcode"] for r in matrix] == sorted(r["Barcode"] for r in matrix) and {r["target"] for r in matrix} == {"0", "target_seq_1"}
    assert read("reference_matches.tsv").count() == 0 and "sub-ARG_name" in read("reference_matches.tsv").columns
    assert {(r["section"], r["metric"]): r["value"] for r in read("summary.tsv").collect()}["cells", "final_cells"] == "12"
    with pytest.raises(FileExistsError):
        reports.write_reports(spark, str(folder), str(tmp_path / "again"))
    record["run_id"] = "other"
    (folder / ".run_summary.json.crc").unlink()
    (folder / "run_summary.json").write_text(json.dumps(record))
    with pytest.raises(ValueError, match="another run"):
        reports.write_reports(spark, str(folder), str(tmp_path / "third"))


def test_words_for_true_and_false(spark):
    import argparse

    from tessera import cli
    from tessera.functions import seq as S

    words = {"true": True, " Yes ": True, "1": True, "Y": True, "false": False, "NO": False, "0": False, "n ": False}
    assert {w: cli.parse_bool(w) for w in words} == words
    df = spark.createDataFrame([(w,) for w in words], "w string")
    assert {r.w: r.f for r in df.select("w", S.flag(F.col("w")).alias("f")).collect()} == words
    with pytest.raises(argparse.ArgumentTypeError):
        cli.parse_bool("maybe")
    with pytest.raises(Exception, match="neither true nor false"):
        spark.createDataFrame([("maybe",)], "w string").select(S.flag(F.col("w"))).collect()


def test_empty_reports_have_headers(spark, tmp_path):
    tables.write_tsv(spark.createDataFrame([], "a string, b string"), str(tmp_path / "t"))
    assert next((tmp_path / "t").glob("*")).read_text() == "a\tb\n"


def test_chains_score_what_they_meet(spark):
    pool = spark.createDataFrame([(g, f"g{g}", f"g{g}_{k}", "ACGTACGTACGTACGTACG" + "ACGT"[k], "TTGGCCAATTGGCCAATT" + "ACGT"[g]) for g in range(3) for k in range(4)], primers.CANDIDATES)
    asked = {"fixed": 1, "chains": 3, "cycles": 300, "top": 3}
    got = primers.anneal_chains(pool, None, **asked).collect()
    assert len(got) == 3 and got == primers.anneal_chains(pool, primers.dimer_scores(pool), **asked).collect()


def test_energies_of_batches_equal_those_of_pairs():
    r = random.Random(3)
    xs = ["".join(r.choice("ACGT") for _ in range(r.choice([0, 1, 2, 19, 20, 70]))) for _ in range(300)]
    ys = ["".join(r.choice("ACGT") for _ in range(r.choice([0, 1, 2, 19, 20, 70]))) for _ in range(300)]
    assert primers.dimer_energies(xs, ys).tolist() == pytest.approx([primers.dimer_energy(x, y) for x, y in zip(xs, ys)])


def test_candidate_files_and_tool_answers(spark, tmp_path):
    plain = spark.createDataFrame([(0, "g", "g_0", "ACGT", "GGCC")], primers.CANDIDATES)
    designed = spark.createDataFrame([(0, "g", "g_0", "ACGT", "GGCC", 60.0, 59.5, 420)], primers.DESIGNED)
    primers.write_candidates(designed, str(tmp_path / "out"))
    parts = lambda name: "".join(x.read_text() for x in sorted((tmp_path / "out" / name).glob("part*")))
    assert parts("primers.fasta") == ">g_0-f\nACGT\n>g_0-r\nGGCC\n"
    assert parts("primers.tsv") == "primer_id\tgene\tforward\treverse\tforward_tm\treverse_tm\tamplicon_len\ng_0\tg\tACGT\tGGCC\t60.0\t59.5\t420\n"
    assert spark.read.parquet(str(tmp_path / "out" / "primers.parquet")).collect() == designed.collect()
    assert primers.candidate_table(plain).first().forward_tm is None and primers.with_fixed(designed, [("f", "AC", "GT")]).count() == 2
    assert primers.parse_energy(" ".join(["x"] * 13 + ["-4.25", "t"])) == -4.25 and primers.parse_energy("dG = -3.5 t") == -3.5
    with pytest.raises(ValueError):
        primers.parse_energy("none")
    tool = tmp_path / "tool"
    tool.write_text("#!/bin/sh\nfor a; do last=$a; done\nif [ $last = END1 ]; then echo dG = -1.5; else echo dG = -2.5; fi\n")
    tool.chmod(0o755)
    pool = spark.createDataFrame([(g, f"g{g}", f"g{g}_0", "ACGTACGTAC", "TTGGCCAATT") for g in range(2)], primers.CANDIDATES)
    assert [tuple(r) for r in primers.dimer_scores(pool, primers.tool_energy(str(tool))).collect()] == [("g0_0", "g1_0", -2.5)]


def test_pools_are_scored_apart(spark):
    rows = [(g, f"g{g}", f"{p}g{g}_{k}", "ACGTACGTAC" + "ACGT"[k], "TTGGCCAATT" + "ACGT"[g], p) for p in "ab" for g in range(2) for k in range(2)]
    pool = spark.createDataFrame(rows, primers.CANDIDATES + ", pool string")
    got = {(r.id_lo, r.id_hi): r.delta_g for r in primers.dimer_scores(pool, pool="pool").collect()}
    whole = {(r.id_lo, r.id_hi): r.delta_g for r in primers.dimer_scores(pool).collect()}
    assert got == {k: v for k, v in whole.items() if k[0][0] == k[1][0]} and len(got) == 8
    asked = {"fixed": 0, "chains": 60, "cycles": 50, "top": 2}
    best = primers.anneal_chains(pool, pool="pool", **asked).collect()
    assert sorted(r.pool for r in best) == ["a", "a", "b", "b"] and all(i.startswith(r.pool) for r in best for i in r.primers)
    # each pool's chains are those of the pool alone; scores of pairs that are no candidates change nothing
    more = primers.dimer_scores(pool.where("pool = 'a'")).union(spark.range(1000).select(F.concat(F.lit("x"), "id").alias("id_lo"), F.lit("y").alias("id_hi"), F.lit(-9.0).alias("delta_g")))
    alone = primers.anneal_chains(pool.where("pool = 'a'"), more, **asked).collect()
    assert [tuple(r) for r in alone] == sorted((tuple(r)[1:] for r in best if r.pool == "a"), key=lambda r: (-r[1], r[0]))


def plain_chain(genes, scores, fixed, cycles, temperature, beta, seed, chain):
    """One chain, with all scores of a set summed up anew in each step; also how often it took a set."""
    began, steps = primers.draws(seed, chain, len(genes), cycles)
    pairs = max(1, len(genes) * (len(genes) - 1) // 2)
    of = lambda s: [int(scores[s[i], s[j]]) for i in range(len(s)) for j in range(i)]
    rank = lambda s: sum(of(s)) / pairs + min(of(s), default=0)
    current = [int(g[int(u * len(g))]) for g, u in zip(genes, began)]
    best, taken = list(current), []
    open_ = range(fixed, len(genes))
    for turn in range(cycles if open_ and len(genes) > 1 else 0):
        any_, which, with_, stay = steps[turn]
        sums = [sum(int(scores[a, b]) for j, b in enumerate(current) if j != i) for i, a in enumerate(current)]
        k = min(open_, key=lambda i: sums[i]) if any_ >= 0.2 else open_[int(which * len(open_))]
        trial = list(current)
        trial[k] = int(genes[k][int(with_ * len(genes[k]))])
        rise = -(sum(of(trial)) - sum(of(current))) / pairs / primers.UNIT
        if rise < 0 or temperature > 0 and math.exp(-max(rise, 0) / temperature) > stay:
            current = trial
            taken.append(turn)
        if rank(trial) > rank(best):
            best = trial
        if (turn + 1) % 100 == 0:
            temperature *= beta
    return rank(best) / primers.UNIT, sum(of(best)) / pairs / primers.UNIT, min(of(best), default=0) / primers.UNIT, best


@pytest.mark.parametrize("genes, fixed, temperature", [(6, 1, 600.0), (5, 0, 0.5), (9, 2, 0.0), (1, 0, 1.0), (3, 3, 1.0), (2, 1, 0.05)])
def test_chains_in_step_are_the_plain_chains(genes, fixed, temperature):
    r = np.random.default_rng(genes)
    parts, n = [], 0
    for _ in range(genes):
        size = int(r.integers(1, 9))
        parts.append(np.arange(n, n + size))
        n += size
    scores = -r.integers(0, 4000, (n, n)) if genes != 5 else -1000 * r.integers(0, 3, (n, n))  # many ties
    scores = np.minimum(scores, scores.T).astype(np.int32)
    chains = [0, 3, 7, 11]
    got = primers.anneal(parts, scores, fixed, 350, temperature, 0.9, 5, chains)
    want = [plain_chain(parts, scores, fixed, 350, temperature, 0.9, 5, c) for c in chains]
    assert [(float(a), float(b), float(c), d.tolist()) for a, b, c, d in zip(*got)] == want


def plain_anchored(x, y, model):
    """The lowest energy of a duplex that pairs x's last base, by recursion over pairs of bases."""
    other, weak = {"A": "T", "C": "G", "G": "C", "T": "A"}, lambda c: model.weak if c in "AT" else 0
    back = y[::-1]

    @functools.cache
    def to(i, j):
        if other.get(x[i]) != back[j]:
            return None
        out = [model.begin + weak(x[i])]
        for a in range(i):
            for b in range(j):
                left, right, before = i - a - 1, j - b - 1, to(a, b)
                if before is None or left + right > duplex.LOOP:
                    continue
                stack = int(model.stack["ACGT".index(x[a]), "ACGT".index(x[i])])
                if left + right < 2 and left * right == 0:
                    gap = stack + model.bulge[left + right]
                elif left == 0 or right == 0:
                    gap = model.bulge[left + right] + weak(x[a]) + weak(x[i])
                else:
                    gap = model.internal[left + right] + model.uneven * abs(left - right)
                out.append(before + gap)
        return min(out)

    ends = [to(len(x) - 1, j) for j in range(len(y))] if x else []
    return min([0, *(e + weak(x[-1]) for e in ends if e is not None)])


def test_energies_of_duplexes_equal_the_recursion(monkeypatch):
    r = random.Random(1)
    oligo = lambda k: "".join(r.choice("ACGT" if k % 9 else "ACGTN") for _ in range(r.choice([0, 1, 2, 6, 12, 20])))
    xs, ys = [oligo(k) for k in range(400)], [oligo(k) for k in range(400)]
    model = duplex.Model()
    want = [min(plain_anchored(a, b, model), plain_anchored(b, a, model)) for a, b in zip(xs, ys)]
    assert duplex.energies(xs, ys).tolist() == want and duplex.energies(ys, xs).tolist() == want and sum(w < 0 for w in want) > 30
    monkeypatch.setattr(duplex, "TOGETHER", 3)
    monkeypatch.setattr(duplex, "LOOP", 3)
    assert duplex.energies(xs, ys).tolist() == [min(plain_anchored(a, b, model), plain_anchored(b, a, model)) for a, b in zip(xs, ys)]


def test_energies_follow_the_model():
    g = lambda a, b, **at: int(duplex.energies([a], [b], duplex.Model(**at))[0])
    rc = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))
    full = "GATTACAGGCATGCC"
    model = duplex.Model()
    stacks = sum(int(model.stack["ACGT".index(a), "ACGT".index(b)]) for a, b in zip(full, full[1:]))
    assert g(full, rc(full)) == model.begin + stacks  # ends of G and C cost nothing
    assert g(full, rc(full), celsius=60) > g(full, rc(full)) and g(full, rc(full), monovalent=50, divalent=0) > g(full, rc(full))
    # a bulge, a mismatch, a longer loop: ever weaker
    bulge, mismatch, loop = full[:7] + "T" + full[7:], full[:7] + "C" + full[8:], full[:6] + "CACTG" + full[9:]
    assert g(full, rc(full)) < g(bulge, rc(full)) < g(loop, rc(full)) and g(full, rc(full)) < g(mismatch, rc(full)) < 0
    # without a 3' end that binds there is none
    assert g("GGGGGGGGAAAA", "CCCCCCCCAAAA") == 0 and g("AAAAGGGGGGGG", "CCCCCCCCAAAA") < 0


def test_primer_pools(spark):
    rows = [(g, f"g{g}", f"g{g}_{k}", "ACGTACGTACGTACGTACG" + "ACGT"[k], "TTGGCCAATTGGCCAATT" + "ACGT"[g]) for g in range(3) for k in range(4)]
    pool = primers.with_fixed(spark.createDataFrame(rows, primers.CANDIDATES), [("ad", "ACGTTT", "GGGAAA")])
    assert pool.count() == 13 and {r.gene_idx for r in pool.collect()} == {0, 1, 2, 3}
    scores = primers.dimer_scores(pool)
    known = {(r.id_lo, r.id_hi): r.delta_g for r in scores.collect()}
    assert len(known) == 12 + 3 * 16
    of = {r.primer_id: (r.fwd, r.rev) for r in pool.collect()}
    for (a, b), g in list(known.items())[:10]:
        oligos = [*of[a], *of[b]]
        assert g == min(primers.dimer_energy(x, y) for x in oligos for y in oligos)
    best = primers.anneal_chains(pool, scores, fixed=1, chains=3, cycles=300, top=3).collect()
    again = primers.anneal_chains(pool, scores, fixed=1, chains=3, cycles=300, top=3).collect()
    assert best == again and best[0].primers[0] == "ad" and best[0].rank_score >= best[-1].rank_score
    chosen = spark.createDataFrame([(p,) for p in best[0].primers], "primer_id string")
    assert primers.pool_score(chosen, scores).first().rank_score == pytest.approx(best[0].rank_score)
    assert primers.parse_boulder("PRIMER_LEFT_0_SEQUENCE=AC\nPRIMER_RIGHT_0_SEQUENCE=GT\nPRIMER_LEFT_0_TM=60.5\nPRIMER_PAIR_0_PRODUCT_SIZE=420\n=\n") == [(0, "AC", "GT", 60.5, None, 420)]
    with pytest.raises(FileNotFoundError):
        primers.design(spark.createDataFrame([(0, "a", "ACGT")], "gene_idx int, name string, seq string"), "no-such-tool")


def test_bounded_energies_and_pools_in_step():
    rng = random.Random(8)
    dna = lambda n: "".join(rng.choice("ACGT" if n % 2 else "ACGTGC") for _ in range(n))
    for n, m in ((20, 20), (3, 18), (31, 12), (60, 60)):
        xs, ys = [dna(n) for _ in range(150)], [dna(m) for _ in range(150)]
        exact, below = duplex.energies(xs, ys), np.array([rng.choice((0, -1500, -3000, -5000)) for _ in xs])
        got, low = duplex.energies(xs, ys, below=below), exact < below
        assert (got[low] == exact[low]).all() and (got[~low] >= below[~low]).all() and low.any()

    some = np.random.default_rng(4)
    pools = []
    for _ in range(5):
        sizes = some.integers(1, 7, 4)
        scores = -some.integers(0, 6000, (sizes.sum(), sizes.sum())).astype(np.int32)
        pools.append((np.split(np.arange(sizes.sum()), np.cumsum(sizes)[:-1]), np.minimum(scores, scores.T)))
    for (genes, scores), got in zip(pools, primers.anneal_pools(pools, 1, 250, 2.0, 0.9, 3, [0, 2, 7])):
        assert all((a == b).all() for a, b in zip(got, primers.anneal(genes, scores, 1, 250, 2.0, 0.9, 3, [0, 2, 7])))


def test_oligos_are_scored_once_alone(spark, tmp_path):
    """A pair asks for its four energies across; those of a candidate alone aren't asked for again in each of its pairs."""
    pool = spark.range(60).selectExpr("CAST(id div 20 AS STRING) AS pool", "CAST(id % 4 AS INT) AS gene_idx", "concat('p', id) AS primer_id", *[f"substr(translate(md5(concat('{k}', id)), '0123456789abcdef', 'ACGTACGTACGTACGT'), 1, 20) AS {k}" for k in ("fwd", "rev")])
    folder = str(tmp_path)

    def energies(xs, ys):
        import tempfile

        with tempfile.NamedTemporaryFile("w", dir=folder, suffix=".asked", delete=False) as f:
            f.write(str(len(xs)))
        return primers.equal_places(xs, ys)

    pairs = primers.dimer_scores(pool, energies, "pool").collect()
    asked = sum(int(f.read_text()) for f in tmp_path.glob("*.asked"))
    assert len(pairs) == 3 * 150 and 4 * len(pairs) <= asked <= 4 * len(pairs) + 3 * 60
