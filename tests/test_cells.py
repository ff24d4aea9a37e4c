"""Cells: clustering, consensus, background, variants, sequences — each against its sequential definition."""

import math
import os
import random
import time

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tessera.functions import automaton
from tessera.functions.kernels import Texts
from tessera.operators import barcodes, cells, sequences, variants
from tessera.functions.seq import RANKS
from tessera.params import Cells, Consensus, Targets, Variants
from tessera.storage import Log

CODES = list(RANKS)


def greedy(order, k):
    """Each barcode joins the earliest dominant one that it matches shifted."""
    match = lambda a, b: a == b or any(s < len(a) and (a[s:] == b[: len(a) - s] or b[s:] == a[: len(b) - s]) for s in range(1, k + 1))
    heads, out = [], {}
    for b in order:
        out[b] = next((h for h in heads if match(h, b)), b)
        if out[b] == b:
            heads.append(b)
    return out


def test_clusters_equal_the_greedy_definition(spark):
    r = random.Random(20260904)
    for length, shift, n in ((4, 1, 60), (5, 2, 80), (6, 1, 200)):
        pool = list({"".join(r.choice("ACGT") for _ in range(length)) for _ in range(n)})
        rows = [(b, r.randint(1, 6), k) for k, b in enumerate(pool)]
        df = spark.createDataFrame(rows, "barcode string, n long, k long").select("barcode", "n", F.struct(F.lit(0).alias("class"), F.col("k").alias("index")).alias("first"))
        want = greedy([b for b, _, _ in sorted(rows, key=lambda x: (-x[1], x[2]))], shift)
        for parts in (1, 5):
            assert {x.barcode: x.cell for x in barcodes.cluster(df.repartition(parts), shift).collect()} == want


def test_long_chains_take_few_rounds(spark, monkeypatch):
    """4,000 barcodes, each a shifted base from the one before and less frequent: dominant and absorbed in turn; branches that join chains."""
    r = random.Random(2)
    text = "".join(r.choice("ACGT") for _ in range(4020))
    chain = [text[k : k + 20] for k in range(4000)]
    assert len(set(chain)) == 4000
    rows = [(b, 5000 - k, k) for k, b in enumerate(chain)]
    # barcodes beside the chain, which have two neighbours in it or one, earlier or later ones
    rows += [(c + b[:-1], 5500 - k, 5000 + 4 * k + j) for k, b in enumerate(chain[::37]) for j, c in enumerate("ACGT") if c + b[:-1] not in set(chain)]
    df = spark.createDataFrame(rows, "barcode string, n long, k long").select("barcode", "n", F.struct(F.lit(0).alias("class"), F.col("k").alias("index")).alias("first"))
    rounds = []
    append = Log.append
    monkeypatch.setattr(Log, "append", lambda self, df: rounds.append(1) or append(self, df))
    got = {x.barcode: x.cell for x in barcodes.cluster(df, 1).collect()}
    # neighbours in the order of the definition
    order_, heads, want = [b for b, _, _ in sorted(rows, key=lambda x: (-x[1], x[2]))], {}, {}
    for place, b in enumerate(order_):
        near = [heads[o] for c in "ACGT" for o in (c + b[:-1], b[1:] + c) if o in heads]
        want[b] = order_[min(near)] if near else b
        if not near:
            heads[b] = place
    assert got == want and len(rounds) <= 15
    folder = spark.conf.get("spark.checkpoint.dir").removeprefix("file://") + "/tessera"
    assert not [x for x in os.listdir(folder) if x.startswith(("settled", "verdicts", "links", "open", "edges"))]


def consensus(reads, p=Consensus()):
    """Read by read, rank by rank."""
    path, last, open_ = [], 1.0, True
    for k in range(7):
        own = [r for r in reads if k == 0 or r[k - 1] == path[k - 1]]
        names = {r[k] for r in own}
        if not open_ or not names - {None}:
            open_ = False
            path.append(None)
            continue
        score = {}
        for c in names:
            t = 0.0
            for r in reads:
                if any(r[j] is not None and r[j] != path[j] for j in range(k)):
                    t += math.log(p.p_error)
                elif c is None:
                    t += math.log(p.p_match if r[k] is None else p.p_error)
                else:
                    t += math.log(p.p_none if r[k] is None else p.p_match if r[k] == c else p.p_error)
            score[c] = t
        best = max(score, key=score.get)
        share = 1 / sum(math.exp(v - score[best]) for v in score.values())
        open_ = share >= p.min_confidence and best is not None
        path.append(best if open_ else None)
        last = share if open_ else last
    rank = max([k for k in range(7) if path[k] is not None], default=0)
    values = [r[rank] for r in reads if r[rank] is not None]
    match = values.count(path[rank]) if path[rank] is not None else 0
    noise = contam = 0
    for v in set(values) - {path[rank]}:
        n = values.count(v)
        if n < p.min_noise_reads or n / len(reads) < p.noise_ratio:
            noise += n
        else:
            contam += n
    return len(reads), noise, path, last, (1 + contam) / (10 + contam + match + noise)


def test_consensus_equals_the_read_by_read_definition(spark):
    r = random.Random(1)
    rows, want = [], {}
    for c in range(150):
        truth = [f"{k}{r.randint(0, 1)}" for k in CODES]
        reads = []
        for _ in range(r.randint(1, 40)):
            path = [v if r.random() < 0.93 else r.choice([None, v + "x"]) for v in truth]
            depth = r.choice([7, 7, 7, r.randint(0, 7)])
            reads.append(tuple(v if k < depth else None for k, v in enumerate(path)))
        want[f"c{c}"] = consensus(reads)
        rows += [(f"c{c}", "16s", x) for x in reads]
    schema = "cell string, gene_class string, path struct<" + ",".join(f"{c}:string" for c in CODES) + ">"
    got = cells.consensus(cells.path_counts(spark.createDataFrame(rows, schema).repartition(7))).collect()
    assert len(got) == len(want)
    for x in got:
        total, noise, path, conf, contam = want[x.cell]
        assert (x.total_16s, x.noise, [x.path[c] for c in CODES]) == (total, noise, path)
        assert abs(x.confidence - conf) < 1e-9 and abs(x.contamination - contam) < 1e-9


def test_stage1_is_strict(spark):
    path = lambda p: (("B", p, None, None, None, None, None))
    rows = [("a", 6, 0.05, path("P")), ("b", 5, 0.05, path("P")), ("c", 6, 0.1, path("P")), ("d", 6, 0.05, path(None))]
    df = spark.createDataFrame(rows, "cell string, total_16s long, contamination double, path struct<" + ",".join(f"{c}:string" for c in CODES) + ">")
    assert [x.cell for x in cells.stage1(df, Cells()).collect()] == ["a"]
    assert cells.taxon_size(df, 4).count() == 0 and cells.taxon_size(df, 3).count() == 3 and cells.taxon_size(df, 0).count() == 4


def test_poisson_tail(spark):
    from tessera.functions.stats import poisson_tail

    rows = [(1, 2.0), (4, 2.0), (3, 0.0), (5, 800.0)]
    df = spark.createDataFrame(rows, "k int, rate double")
    got = {(x.k, x.rate): x.p for x in df.select("k", "rate", poisson_tail(F.col("k"), F.col("rate")).alias("p")).collect()}
    assert abs(got[4, 2.0] - 0.14287653950145285) < 1e-15 and got[3, 0.0] == 0.0 and got[5, 800.0] == 1.0
    assert abs(got[1, 2.0] - (1 - math.exp(-2))) < 1e-15


def test_background_and_its_statistics(spark):
    own = spark.createDataFrame([("a", 10), ("b", 1000)], "cell string, total_16s long")
    counts = spark.createDataFrame([("a", "T", 9), ("b", "T", 1)], "cell string, target string, n long")
    got = {x.cell: x.filtered for x in cells.background(own, counts).collect()}
    assert got == {"a": 9, "b": 0}
    rows = {x.target: (x.original, x.filtered_out, x.remaining, x.retention) for x in cells.background_stats(cells.background(own, counts), ["T", "U"]).collect()}
    assert rows == {"T": (2, 1, 1, 50.0), "U": (0, 0, 0, 0.0)}


def fold(rows, p=Variants()):
    """The per-cell summary, core by core; rows: (core pair, n), most frequent first."""
    dist = lambda a, b: max(min(sum(x != y for x, y in zip(u[s:] if s >= 0 else u, v if s >= 0 else v[-s:])) for s in range(-p.max_shift, p.max_shift + 1)) for u, v in zip(a, b))
    total = sum(n for _, n in rows)
    gate, members = max(2, int(0.05 * total)), [rows[0][0]]
    final, coexisting, secondary, widest = rows[0][1], 0, 0, 0
    for c, n in rows[1:]:
        d = dist(c, members[0])
        if d <= p.max_distance:
            bad = [e for e in (dist(c, m) for m in members) if e > p.max_distance]
            if not bad:
                members.append(c)
                final, coexisting, widest = final + n, coexisting + n, max(widest, d)
                continue
            d = bad[0]
        if n >= gate:
            secondary, widest = secondary + n, max(widest, d)
    ratio = secondary / (final + secondary)
    status = "low_depth" if total < 5 else "single_ASV" if not secondary else "mixed_ASV" if ratio >= 0.1 else "corrupted_single_ASV"
    return total, len(rows), rows[0][1], coexisting, secondary, final, widest, status


def test_large_cells_are_folded_as_small_ones():
    """Cells of up to 500 cores, many near one another: all at once, against the plain fold, and much faster."""
    r = random.Random(9)
    cells_ = []
    for c, size in enumerate((1, 2, 3, 40, 120, 500)):
        base = ["".join(r.choice("ACGT") for _ in range(n)) for n in (90, 50)]
        cut = lambda s: "".join(r.choice("ACGT") if r.random() < 0.01 else x for x in (s[1:] + "A" if r.random() < 0.1 else s))  # noqa: E731, B023
        found = list({(cut(base[0]), cut(base[1])): None for _ in range(size)})
        cells_.append(sorted(((core, r.randint(1, 40)) for core in found), key=lambda x: -x[1]))
    flat_ = [x for cell in cells_ for x in cell]
    began = time.perf_counter()
    cores = Texts(pa.array([c[0] for c, _ in flat_]), pa.array([c[1] for c, _ in flat_]))
    got = variants.fold(np.array([n for _, n in flat_]), np.cumsum([0, *map(len, cells_)]), cores, Variants())
    took = time.perf_counter() - began
    began = time.perf_counter()
    want = [fold(cell) for cell in cells_]
    assert [tuple(x.item() if hasattr(x, "item") else x for x in row) for row in zip(*got.values())] == want
    assert any(w[3] > 50 for w in want) and any(w[4] for w in want) and took * 10 < time.perf_counter() - began


def test_cell_summaries_equal_the_fold(spark):
    r = random.Random(3)
    rows, want = [], {}
    for c in range(60):
        base = ["".join(r.choice("ACGT") for _ in range(30)) for _ in range(2)]
        cores = {}
        for _ in range(r.randint(1, 7)):
            cut = lambda s: "".join(x if r.random() > 0.06 else r.choice("ACGT") for x in s[k:] + s[:k])
            k = r.choice([0, 0, 1])
            cores[cut(base[0]), cut(base[1])] = r.randint(1, 30)
        ordered = sorted(((core, n, j) for j, (core, n) in enumerate(cores.items())), key=lambda x: (-x[1], x[2]))
        want[f"c{c}"] = fold([(core, n) for core, n, _ in ordered])
        rows += [(f"c{c}", core, n, (0, j)) for core, n, j in ordered]
    df = spark.createDataFrame(rows, "cell string, core struct<r1:string,r2:string>, n long, first struct<a:int,b:int>")
    got = {x.cell: (x.reads_used, x.raw_unique, x.dominant_reads, x.coexisting, x.secondary, x.final_reads, x.max_distance, x.status) for x in variants.summarise(df.repartition(3)).collect()}
    assert got == want


def test_abundance_thresholds(spark):
    groups = {"ASV_1": 20, "ASV_2": 19, "ASV_3": 10, "ASV_4": 3951}
    df = spark.createDataFrame([(f"{a}-{k}", a) for a, n in groups.items() for k in range(n)], "cell string, asv_id string")
    got = {x.asv_id: x.passed for x in variants.abundance(df).collect()}
    assert got == {"ASV_1": True, "ASV_2": False, "ASV_3": False, "ASV_4": True}


def test_conflicting_phyla_and_statuses(spark):
    schema = "cell string, asv_id string, status string, path struct<" + ",".join(f"{c}:string" for c in CODES) + ">"
    path = lambda p: ("B", p, None, None, None, None, None)
    rows = [(f"a{k}", "ASV_1", "single_ASV", path("P1")) for k in range(199)] + [("odd", "ASV_1", "single_ASV", path("P2")), ("none", "ASV_1", "single_ASV", path(None)), ("mix", "ASV_1", "mixed_ASV", path("P1")), ("empty", None, "no_usable_reads", path("P1")), ("few", "ASV_2", "single_ASV", path("P2"))]
    got = {x.cell: (x.stage, x.reason) for x in variants.filtered(spark.createDataFrame(rows, schema)).collect()}
    assert got["odd"] == ("asv_taxonomy_conflict", "asv_phylum_conflict") and got["mix"] == ("asv_status_quality", "mixed_ASV") and got["empty"] == ("asv_status_quality", "no_usable_reads")
    assert got["a0"] == got["none"] == got["few"] == (None, None)


def test_target_clusters_keep_the_strict_guard(spark):
    rows = [("T", "t", ("AAAACCCC", "GGGG"), 9, 0), ("T", "t", ("CAAAACCC", "GGGG"), 5, 1), ("T", "t", ("TTTTTTTT", "GGGG"), 4, 2), ("T", "t", ("AAACCCCC", "GGGG"), 3, 3)]
    df = spark.createDataFrame([(c, t, core, n, f) for t, c, core, n, f in rows], "cell string, target string, core struct<r1:string,r2:string>, n long, first long")
    strict = {x.core.r1: x.dominant.r1 for x in sequences.cluster_cores(df, Targets()).collect()}
    loose = {x.core.r1: x.dominant.r1 for x in sequences.cluster_cores(df, Targets(), guard="cluster").collect()}
    assert strict == {"AAAACCCC": "AAAACCCC", "CAAAACCC": "AAAACCCC", "TTTTTTTT": "TTTTTTTT", "AAACCCCC": "AAACCCCC"}
    assert loose["CAAAACCC"] == "AAAACCCC"


def test_sequence_calls_and_names(spark):
    a, b = ("AAAA", "CC"), ("GGGG", "CC")
    counts = spark.createDataFrame([("x", "T", a, 5), ("x", "T", b, 1), ("y", "T", a, 3), ("y", "T", b, 3), ("z", "T", b, 4)], "cell string, target string, core struct<r1:string,r2:string>, n long")
    clusters = counts.select("target", "core", F.col("core").alias("dominant")).distinct()
    calls = sequences.call_sequences(counts, clusters)
    got = {x.cell: (x.core and x.core.r1, x.total, x.noise) for x in calls.collect()}
    assert got == {"x": ("AAAA", 6, 1), "y": (None, 6, 0), "z": ("GGGG", 4, 0)}
    names = sequences.name_sequences(calls, spark.createDataFrame([("x", 1), ("y", 2), ("z", 0)], "cell string, place int"))
    assert {x.core.r1: x.sequence_id for x in names.collect()} == {"GGGG": "T_seq_1", "AAAA": "T_seq_2"}


def test_decay_fit_and_retention():
    x = np.arange(1, 12, dtype=float)
    for a, b, c in ((50, 0.5, 2), (200, 0.9, 5), (30, 0.2, 1)):
        got = sequences.fit_decay(x, a * np.exp(-b * x) + c)
        assert got is not None and np.allclose(got, (a, b, c), rtol=1e-4)
    assert sequences.retained([], 0, 0.05) == 0 and sequences.retained([7], 0, 0.05) == 1
    # a second peak far above a flat tail stays, the tail goes
    assert sequences.retained([1000, 900, 3, 3, 2, 2, 2, 2, 2], 0.0, 0.05) >= 1
    assert abs(sequences.poisson_sf(3, 2.0) - 0.14287653950145285) < 1e-12 and sequences.poisson_ppf(0.95, 2.0) == 5 and sequences.poisson_ppf(0.95, 0.0) == 0


def repeats(s):
    out, i = [], 0
    while i < len(s):
        best = None
        for m in range(1, (len(s) - i) // 2 + 1):
            k = 1
            while s[i + k * m : i + (k + 1) * m] == s[i : i + m]:
                k += 1
            if k > 1 and (best is None or k * m > best[3] - best[2]):
                best = (s[i : i + m], k, i, i + k * m)
        if best:
            out.append(best)
            i = best[3]
        else:
            i += 1
    return out


def test_tandem_repeats_and_calls(spark):
    r = random.Random(2)
    for _ in range(300):
        s = "".join(r.choice("AC") for _ in range(r.randint(0, 25)))
        assert sequences.tandem_repeats(s) == repeats(s)
    names = spark.createDataFrame([("T", "T_seq_1", ("AAAA", "TTT")), ("T", "T_seq_2", ("ACGT", "")), ("U", "U_seq_1", ("AA", "AA"))], "target string, sequence_id string, core struct<r1:string,r2:string>")
    modes = spark.createDataFrame([("T", "ssr"), ("U", "")], "target string, mode string")
    got = {x.sequence_id: (x.call, x.motif, x.repeat_count, x.start, x.end) for x in sequences.phase_calls(names, modes).collect()}
    assert got == {"T_seq_1": ("ssr_detected", "A", 7, 0, 7), "T_seq_2": ("no_ssr_detected", None, None, None, None)}


def test_reference_matches_on_either_strand(spark):
    r = random.Random(4)
    dna = lambda n: "".join(r.choice("ACGT") for _ in range(n))
    rc = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))
    one, two = dna(40), dna(30)
    names = spark.createDataFrame([("T_seq_1", (one, two))], "sequence_id string, core struct<r1:string,r2:string>")
    ref = spark.createDataFrame([("a", "a x", dna(7) + one + rc(two)), ("b", "b", rc(one) + "AC" + two), ("c", "c", one)], "name string, title string, seq string")
    got = {x.subject: (x.r1_start, x.r1_end, x.r2_start, x.r2_end) for x in sequences.reference_matches(names, ref).collect()}
    assert got == {"a x": (8, 47, 48, 77), "b": (1, 40, 43, 72)}


def test_short_mates_are_found(spark):
    names = spark.createDataFrame([("T_seq_1", ("ACGTA", "GGATCCAAT")), ("T_seq_2", ("C", "G")), ("T_seq_3", ("TTTTTTTTTTTTTTTTTT", "A")), ("T_seq_4", ("", "ACGT"))], "sequence_id string, core struct<r1:string,r2:string>")
    ref = spark.createDataFrame([("a", "a", "TTACGTATTTGGATCCAATTT"), ("b", "b", "ATTGGATCCAAAA" + "TACGT"), ("c", "c", "CCCCCC"), ("d", "d", "GG" + "A" * 19)], "name string, title string, seq string")
    got = {(x.sequence_id, x.subject): (x.r1_start, x.r1_end, x.r2_start, x.r2_end) for x in sequences.reference_matches(names, ref).collect()}
    def place(seq, q):
        rc = q[::-1].translate(str.maketrans("ACGT", "TGCA"))
        return seq.find(q) + 1 or seq.find(rc) + 1

    want = {}
    for n in names.collect():
        for r in ref.collect():
            a, b = place(r.seq, n.core.r1), place(r.seq, n.core.r2)
            if n.core.r1 and n.core.r2 and a and b:
                want[n.sequence_id, r.title] = (a, a + len(n.core.r1) - 1, b, b + len(n.core.r2) - 1)
    assert got == want and len(got) > 5 and sequences.reference_matches(names.limit(0), ref).count() == 0


def brute_places(patterns, texts):
    return sorted((k, j, t.find(p)) for k, t in enumerate(texts) for j, p in enumerate(patterns) if p in t)


def test_automaton_finds_first_places(monkeypatch):
    r = random.Random(6)
    dna = lambda n, letters: bytes(r.choice(letters) for _ in range(n))
    for trial in range(120):
        if trial == 60:
            monkeypatch.setattr(automaton, "LANES", 3)
            monkeypatch.setattr(automaton, "HELD", 10)
        letters = (b"AC", b"ACGTN", b"A", bytes(range(256)))[trial % 4]
        patterns = list({dna(r.randint(1, 7), letters) for _ in range(r.randint(1, 25))})
        texts = [dna(r.choice([0, 1, 5, 300, 3000]), letters if trial % 3 else b"ACGTN-") for _ in range(r.randint(1, 6))]
        found = automaton.Automaton(patterns).first_places(texts)
        assert sorted(zip(*(x.tolist() for x in found))) == brute_places(patterns, texts)
    assert [len(x) for x in automaton.Automaton([]).first_places([b"ACGT"])] == [0, 0, 0]


def test_places_whatever_the_cuts(spark):
    r = random.Random(8)
    dna = lambda n: "".join(r.choice("ACGT") for _ in range(n))
    rc = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))
    subjects = [(f"s{k}", f"s{k} of {k}", dna(n)) for k, n in enumerate((0, 1, 40, 900, 2500))]
    patterns = {s[j : j + n] for _, _, s in subjects for n in (1, 3, 20, 61) for j in range(0, max(0, len(s) - n), 173)} | {dna(12) for _ in range(40)}
    want = {(p, t, s.find(p) + 1) for p in patterns for _, t, s in subjects if p in s}
    ref = spark.createDataFrame([*subjects, ("empty", None, None)], "name string, title string, seq string")
    df = spark.createDataFrame([(p,) for p in patterns], "pattern string")
    for sizes in ({}, {"size": 50, "bases": 300, "together": 700}, {"size": 7, "together": 100}):
        assert {(x.pattern, x.title, x.place) for x in sequences.places(df, ref, **sizes).collect()} == want
    names = [(f"T_seq_{k}", (s[5:5 + n], rc(s[100 : 100 + m]) if k % 2 else s[100 : 100 + m])) for k, (_, _, s) in enumerate(subjects[3:] * 6) for n, m in [(40 + k, 30 + k)]]
    got = sequences.reference_matches(spark.createDataFrame(names, "sequence_id string, core struct<r1:string,r2:string>"), ref, size=64, together=1000).collect()
    assert {(x.sequence_id, x.subject, x.r1_start, x.r2_start) for x in got} == {(i, f"s{3 + k % 2} of {3 + k % 2}", 6, 101) for k, (i, _) in enumerate(names)}


def test_a_subject_of_fifty_million_bases(spark, tmp_path):
    """Mates across the ends of stretches of one long subject; no task holds more of it than the row itself and a group's stretches."""
    seq = np.frombuffer(b"ACGT", np.uint8)[np.random.default_rng(3).integers(0, 4, 50_000_000)].tobytes().decode()
    rc = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))
    pq.write_table(pa.table({"name": ["chr"], "title": ["chr 1"], "seq": [seq]}), tmp_path / "ref.parquet")
    at = [0, sequences.STRETCH - 60, 7 * sequences.STRETCH - 1, 20_000_000, 49_999_700]
    names = spark.createDataFrame([(f"T_seq_{k}", (seq[a : a + 120], rc(seq[a + 130 : a + 290]) if k % 2 else seq[a + 130 : a + 290])) for k, a in enumerate(at)] + [("none", ("ACGT" * 40, seq[:50]))], "sequence_id string, core struct<r1:string,r2:string>")
    got = {x.sequence_id: (x.r1_start, x.r1_end, x.r2_start, x.r2_end) for x in sequences.reference_matches(names, spark.read.parquet(str(tmp_path / "ref.parquet"))).collect()}
    assert got == {f"T_seq_{k}": (a + 1, a + 120, a + 131, a + 290) for k, a in enumerate(at)}


@pytest.mark.parametrize("shift,mismatches", [(2, 0), (1, 2), (2, 3)])
def test_target_clusters_equal_the_greedy_definition(spark, shift, mismatches):
    """Cores that are shifted, changed and unlike copies of a few; both guards against the sequential definition."""
    r = random.Random(shift * 10 + mismatches)
    dna = lambda n: "".join(r.choice("ACGT") for _ in range(n))
    near = lambda x, y: max(min(sum(a != b for a, b in zip(x[m][s:] if s >= 0 else x[m], y[m] if s >= 0 else y[m][-s:])) for s in range(-shift, shift + 1)) for m in (0, 1)) <= mismatches
    rows = []
    for t in "TU":
        base = [(dna(12), dna(9)) for _ in range(3)]
        cores = set(base)
        while len(cores) < 60:
            a, b = r.choice(base)
            kind = r.random()
            if kind < 0.4:
                k = r.randint(0, shift)
                a = dna(k) + a[: len(a) - k] if r.random() < 0.5 else a[k:] + dna(k)
            elif kind < 0.8:
                k = r.randrange(len(a))
                a = a[:k] + r.choice("ACGT") + a[k + 1 :]
            else:
                a, b = dna(12), dna(9)
            cores.add((a, b))
        rows += [("c", t, c, r.randint(1, 9) + 20 * (c in base), k) for k, c in enumerate(sorted(cores))]
    counts = spark.createDataFrame(rows, "cell string, target string, core struct<r1:string,r2:string>, n long, first long").repartition(3)
    params = Targets(max_shift=shift, max_mismatches=mismatches)
    for guard in ("all_dominants", "cluster"):
        want = {}
        for t in "TU":
            heads, members = [], {}
            for _, _, core, n, first in sorted((x for x in rows if x[1] == t), key=lambda x: (-x[3], x[4])):
                head = next((h for h in heads if near(core, h)), None)
                held = heads if guard == "all_dominants" else members.get(head, [])
                if head is None or not all(near(core, h) for h in held):
                    head = core
                    heads.append(core)
                members.setdefault(head, []).append(core)
                want[t, core] = head
        got = {(x.target, tuple(x.core)): tuple(x.dominant) for x in sequences.cluster_cores(counts, params, guard).collect()}
        assert got == want


def test_rows_are_numbered_in_order(spark):
    from tessera.operators import order

    r = random.Random(2)
    rows = [(r.choice("abc"), r.randint(0, 9), k) for k in range(500)]
    df = spark.createDataFrame(rows, "g string, v int, k int").repartition(7)
    want = sorted(rows, key=lambda x: (-x[1], x[2]))
    got = order.numbered(df, [F.desc("v"), "k"])
    assert [(x.g, x.v, x.k, x.no) for x in sorted(got.collect(), key=lambda x: x.no)] == [(*x, i) for i, x in enumerate(want, 1)]
    inside = order.numbered_in(df, "g", [F.desc("v"), "k"]).collect()
    for g in "abc":
        assert [(x.v, x.k, x.no) for x in sorted((x for x in inside if x.g == g), key=lambda x: x.no)] == [(*x[1:], i) for i, x in enumerate([x for x in want if x[0] == g], 1)]
    assert order.numbered(df.limit(0), ["k"]).count() == 0


def test_group_sizes_of_three_kinds(spark):
    df = spark.createDataFrame([("a", "16s"), ("a", "16s"), ("a", "target"), ("a", "unclassified"), ("b", "target"), ("c", "16s")], "cell string, gene_class string")
    sizes = {(x.series, x.cell): x.size for x in cells.group_sizes(df).collect()}
    assert sizes == {("16s", "a"): 2, ("classified", "a"): 3, ("all", "a"): 4, ("all", "b"): 1, ("16s", "c"): 1, ("classified", "c"): 1, ("all", "c"): 1}
    curves = {(x.series, x.size): (x.groups, x.share) for x in cells.group_curves(cells.group_sizes(df)).collect()}
    assert curves == {("16s", 1): (1, 1 / 3), ("16s", 2): (1, 1.0), ("classified", 1): (1, 0.25), ("classified", 3): (1, 1.0), ("all", 1): (2, 2 / 6), ("all", 4): (1, 1.0)}


def test_lorenz_and_histogram(spark):
    sizes = spark.createDataFrame([(1,), (1,), (2,), (4,)], "size long")
    assert [(x.size, x.groups, x.share) for x in cells.lorenz(sizes).orderBy("size").collect()] == [(1, 2, 0.25), (2, 1, 0.5), (4, 1, 1.0)]
    balance = spark.createDataFrame([("T", 0.05), ("T", 0.1), ("T", 1.0)], "target string, ratio double")
    assert {x.bin: x.n for x in cells.ratio_histogram(balance).collect()} == {1: 1, 100: 1}
