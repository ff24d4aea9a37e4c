"""The Merkle manifest, hard negatives and SimHash against plain versions."""

import hashlib
import math
import os
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tessera.llm import merkle, negatives, registry, simhash

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, leaf string, pos int, tree string, root string, id int, fp long, component string"


def shared(spark):
    """What stands in the folder that all share."""
    folder = spark.conf.get("spark.checkpoint.dir").removeprefix("file://") + "/tessera"
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def texts(n, seed=1):
    r = random.Random(seed)
    out = [" ".join(r.choice(["alpha", "Beta", "gaMMa", "d\ne", "é", "x\ty"]) for _ in range(r.randint(0, 40))) for _ in range(n)]
    return [None if k % 17 == 3 else "" if k % 19 == 5 else t for k, t in enumerate(out)]


def documents(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y", "z", 2, 3, "w") for r in rows], DOCS).repartition(3)


# ---- Merkle manifest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[0], row[3], row[2], row[4], text)])


def tree(nodes):
    """The root, and each leaf's (before, after) by level."""
    proofs, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, place in enumerate(at):
            low = place // 3 * 3
            proofs[k].append(("".join(nodes[low:place]), "".join(nodes[place + 1 : low + 3])))
            at[k] = place // 3
        nodes = [h(*nodes[k : k + 3]) for k in range(0, len(nodes), 3)]
    return nodes[0], proofs


def plain_manifest(rows):
    by = {}
    for r in rows:
        by.setdefault(r[3], []).append(r)
    groups = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for s in groups:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
    trees = {s: tree([leaf(r, r[1]) for r in by[s]]) for s in groups}
    if not groups:
        return []
    root, above = tree([trees[s][0] for s in groups])
    out = []
    for s, over in zip(groups, above):
        for r, own in zip(by[s], trees[s][1]):
            text = r[1]
            if text is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            at = leaf(r, text)
            for before, after in own + over:
                at = h(before, at, after)
            out.append((r[0], leaf(r, r[1]), trees[s][0], root, h(*[b + a for b, a in own + over]), at, at == root))
    return sorted(out, key=str)


def document_rows(n, sources, seed=2):
    r = random.Random(seed)
    rows = [(k - 5, t, r.choice(["en", None, "d:e"]), r.choice(sources), r.choice([None, len(t or "")])) for k, t in enumerate(texts(n, seed))]
    return rows + [rows[0], rows[0], (None, "no\nid", "en", sources[0], 3), (None, None, None, None, None), (7, "another text of 7", "en", sources[0], 1)]


@pytest.mark.parametrize("n, sources", [(1, ["a"]), (40, ["a", None, "", "Z", "é", "-", "2:ab"]), (1100, ["hot", "hot", "hot", "b"]), (500, [f"s{k}" for k in range(400)])])
def test_manifest(spark, n, sources):
    rows = document_rows(n, sources)
    before = shared(spark)
    got = merkle.tamper_check(documents(spark, rows))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    found = sorted(map(tuple, got.collect()), key=str)
    assert found == plain_manifest(rows)
    assert any(not r[-1] for r in found) or n == 1
    # the result alone stays in the shared folder
    assert len(shared(spark) - before) == 1


def test_manifest_of_one_row_and_of_nothing(spark):
    row = (3, "a\nb", "en", "s", 3)
    got = merkle.tamper_check(documents(spark, [row])).collect()
    assert [tuple(g) for g in got] == plain_manifest([row]) and got[0].leaf == got[0].subroot == got[0].root and got[0].proof_sha256 == h()
    assert merkle.tamper_check(documents(spark, []), "doc_id").count() == 0


def test_manifest_with_ids_and_columns_of_other_names(spark):
    df = spark.createDataFrame([(k, f"t{k}", k % 2) for k in range(10)], "`a.b` int, t string, g int")
    got = merkle.manifest(df, "a.b", "g", ("a.b", "t")).collect()
    want = {g: tree([h(f"1:{k}2:t{k}") for k in range(10) if k % 2 == g]) for g in (0, 1)}
    assert {r.subroot for r in got} == {want[0][0], want[1][0]} and {r.root for r in got} == {h(want[0][0], want[1][0])} and got[0].asDict().keys() >= {"a.b", "before", "after"}


def test_blocks_agree_with_whole_trees():
    for n in (1, 2, 3, 4, 9, 10, 100, 243):
        leaves = [h(str(k)) for k in range(n)]
        width = 1
        while width < n:
            width *= 3
        root, before, after = merkle.traverse(leaves, width)
        assert (root, [list(zip(b, a)) for b, a in zip(before, after)]) == tree(leaves)


# ---- hard negatives


def plain_negatives(rows, anchors, positives=5, count=10, low=30, high=90, scale=256):
    ok = [(i, lab, [math.floor(scale * float(c)) for c in v]) for i, lab, v in rows if i is not None and lab is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)]
    own = {}
    for r in sorted(ok):
        own.setdefault(r[0], r)
    out = []
    for i, lab, q in own.values():
        if not anchors(i):
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, v)), j, m) for j, m, v in own.values() if len(v) == len(q))
        for s, j, _ in [x for x in scored if x[2] == lab and x[1] != i][:positives]:
            taken = [(t, k) for t, k, m in scored if m != lab and -low * s <= -100 * t <= -high * s][:count]
            out += [(i, j, rank, k, -s, -t) for rank, (t, k) in enumerate(taken, 1)]
    return sorted(out)


VECTORS = "vec_id long, label int, embedding array<double>, rank int, x string, anchor_id int, d int"


def vector_frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "q", 2, 3) for r in rows], VECTORS).repartition(3)


@pytest.mark.parametrize("block", [1 << 14, 37])
def test_hard_negatives(spark, block):
    r = np.random.default_rng(5)
    centres = r.normal(size=(4, 12))
    rows = [(k - 50, int(k % 4) if k % 3 else 9, (centres[k % 4] + r.normal(size=12) * 0.4).round(1).tolist()) for k in range(400)]
    rows += [rows[60], rows[60], (10, 1, rows[0][2]), (1000, None, rows[1][2]), (None, 1, rows[1][2]), (1001, 1, None), (1010, 1, [float("nan")] * 12), (1020, 1, [None] * 12), (1030, 1, [float("inf")] * 12)]
    rows += [(1040, 2, [1.0, 2.0]), (1050, 2, [1.0, 1.5]), (1060, 3, [0.5, 0.5]), (1070, 3, []), (1080, 3, []), (1090, 77, rows[3][2])]
    before = shared(spark)
    got = negatives.hard_negatives(vector_frame(spark, rows), F.col("vec_id") % 10 == 0, block=block)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    found = sorted(map(tuple, got.collect()))
    assert found and found == plain_negatives(rows, lambda i: i % 10 == 0)
    assert len(shared(spark) - before) == 1


def test_negatives_of_equal_vectors_go_by_id(spark):
    rows = [(k, k % 2, [1.0, 0.25 if k % 2 else 1.0]) for k in range(60)]
    assert sorted(map(tuple, negatives.hard_negatives(vector_frame(spark, rows), F.col("vec_id") == 0, block=7).collect())) == plain_negatives(rows, lambda i: i == 0)


def test_negatives_of_nothing_and_of_ids_that_are_no_integers(spark):
    assert negatives.hard_negatives(vector_frame(spark, []), F.col("vec_id") % 10 == 0).count() == 0
    with pytest.raises(TypeError):
        negatives.hard_negatives(spark.createDataFrame([("a", 1, [1.0])], "vec_id string, label int, embedding array<double>"), F.lit(True))


def test_limits_are_whole_numbers_within():
    for score in range(-40, 200):
        least, most = negatives.limits(score, 30, 90)
        assert [s for s in range(-60, 260) if 30 * score <= 100 * s <= 90 * score] == list(range(least, most + 1))


def test_products_are_exact_or_refused(spark):
    a = np.array([[2.0**40, 3.0], [-(2.0**31), 1.0]])
    assert negatives.products(a[:1], np.array([[2.0**20, 1.0]])).tolist() == [[2**60 + 3]]
    assert negatives.products(a[1:], np.array([[-(2.0**31), 7.0]])).tolist() == [[2**62 + 7]]
    with pytest.raises(OverflowError):
        negatives.products(a[:1], a[:1])
    with pytest.raises(PySparkException):
        negatives.hard_negatives(vector_frame(spark, [(0, 1, [1e18]), (1, 1, [1e18])]), F.col("vec_id") == 0).collect()


# ---- SimHash


def plain_fingerprint(text, n=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    runs = [" ".join(words[k : k + n]) for k in range(len(words) - n + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64(r.encode(), seed=42).intdigest() for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in hashes) > len(hashes))


def plain_components(prints, differ=2):
    up = {i: i for i in prints}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(prints)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= differ:
                one, other = find(a), find(b)
                up[max(one, other)] = min(one, other)
    return {i: find(i) for i in ids}


def near_texts(n=300, seed=7):
    r = random.Random(seed)
    words = [f"w{k}" for k in range(500)]
    bases = [[r.choice(words) for _ in range(150)] for _ in range(12)]
    out = []
    for k in range(n):
        text = list(bases[k % 12])
        for _ in range(k % 5):
            text[r.randrange(150)] = r.choice(words)
        out.append(r.choice([" ", "\n", " \t "]).join(text))
    return out


def test_simhash(spark):
    rows = [(3 * k, t, "en", "s", 1) for k, t in enumerate(near_texts())] + [(2000 + k, t, "en", "s", 1) for k, t in enumerate(["", None, " \n", "a", "A", "a b", "É É É", "x" * 100])]
    prints = {i: plain_fingerprint(t) for i, t, *_ in rows}
    component = plain_components(prints)
    want = sorted((i, f"{prints[i]:016x}", component[i]) for i in prints)
    df = documents(spark, [*rows, rows[5], rows[5]])
    before = shared(spark)
    got = simhash.near_duplicates(df)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(tuple, got.distinct().collect())) == want and got.count() == len(rows) + 2
    assert 12 < len(set(component.values())) < 250 and len(shared(spark) - before) == 1


def test_simhash_without_ids_and_of_nothing(spark):
    got = simhash.near_duplicates(documents(spark, [(None, "a b c d", None, None, None), (4, "a b c d", None, None, None), (2, None, None, None, None)])).collect()
    assert sorted((g.doc_id or -1, g.component_id) for g in got) == [(-1, None), (2, 2), (4, 4)] and len({g.fingerprint for g in got}) == 2
    assert simhash.near_duplicates(documents(spark, [])).count() == 0
    with pytest.raises(TypeError):
        simhash.near_duplicates(spark.createDataFrame([("a", "b")], "doc_id string, text string"))


def test_long_texts_are_hashed_alike_in_stretches(monkeypatch):
    r = random.Random(3)
    long = [" ".join("".join(r.choice("aBc") for _ in range(r.randint(1, 30))) + r.choice(["", "\n", "\t "]) for _ in range(700)), "q" * 3000, "a b", "a " * 900, " " * 500 + "x y z"]
    want = [plain_fingerprint(t) for t in long]
    assert [simhash.fingerprint(t.encode()) % (1 << 64) for t in long] == want
    for piece, stretch in ((1, 1), (64, 10), (1000, 7)):
        monkeypatch.setattr(simhash, "PIECE", piece)
        monkeypatch.setattr(simhash, "STRETCH", stretch)
        assert [simhash.fingerprint(t.encode()) % (1 << 64) for t in long] == want


def crowded(n=2400, seed=11):
    """Fingerprints, many of them near a few, and near one another."""
    r = np.random.default_rng(seed)
    base = r.integers(-(1 << 63), 1 << 63, 40)
    out = [r.integers(-(1 << 63), 1 << 63, n // 4)]
    for flips in (1, 2, 3, 6):
        some = base[np.minimum(r.geometric(0.3, n // 4) - 1, 39)]
        for _ in range(flips):
            some = some ^ (np.int64(1) << r.integers(0, 63, len(some)))
        out.append(some)
    return np.unique(np.concatenate(out))


def all_pairs(prints, differ):
    out = set()
    for k in range(len(prints)):
        for j in np.flatnonzero(np.array([(int(x) % (1 << 64)).bit_count() for x in prints[k] ^ prints[k + 1 :]]) <= differ) + k + 1:
            out.add((min(int(prints[k]), int(prints[j])), max(int(prints[k]), int(prints[j]))))
    return out


@pytest.mark.parametrize("differ", [0, 2, 3])
def test_trees_lose_no_pair(differ):
    prints = crowded()
    found = {(min(a, b), max(a, b)) for x, y in simhash.close_pairs(prints, differ) for a, b in zip(x.tolist(), y.tolist())}
    assert found == all_pairs(prints, differ) and (differ == 0) == (not found)


def test_trees_leave_most_comparisons_out(monkeypatch):
    r = np.random.default_rng(1)
    looked = []
    kept = simhash.distances
    monkeypatch.setattr(simhash, "distances", lambda a, b: looked.append(np.broadcast(a, b).size) or kept(a, b))
    cost = []
    for n in (8000, 32000):
        looked.clear()
        list(simhash.close_pairs(np.unique(r.integers(-(1 << 63), 1 << 63, n)), 2))
        cost.append(sum(looked))
    # all pairs would be 16 times as many
    assert cost[0] < 8000 * 8000 / 8 and cost[1] < 7 * cost[0]


def test_shards_lose_no_pair_however_often_they_are_divided(spark):
    prints = crowded()
    df = spark.createDataFrame([(int(p), k) for k, p in enumerate(prints)], "fp long, id long").repartition(3)
    number = {int(p): k for k, p in enumerate(prints)}
    want = {tuple(sorted((number[a], number[b]))) for a, b in all_pairs(prints, 2)}
    for sizes in ({}, {"sample": 64, "shard": 50, "large": 300}, {"sample": 20, "shard": 10, "large": 100}):
        assert {tuple(r) for r in simhash.links(df, 2, **sizes).collect()} == want
    tables = simhash.dealt_out(df, 2, sample=20, shard=10, large=100)
    assert len(tables) > 1 and sum(t.count() for t in tables) >= len(prints)


# ---- registered queries


def plain(v):
    return "" if v is None else f"{float(v):.9g}" if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", ["op11_merkle", "op12_negatives"])
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for f in ("documents", "embeddings"):
        con.execute(f"create view {f} as select * from '{SF}/{f}.parquet'")
    df = registry.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    rows = con.execute(registry.ORACLES[name])
    names = [d[0] for d in rows.description]
    assert sorted(names) == columns
    want = sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in rows.fetchall())
    assert want and sorted(tuple(plain(r[c]) for c in columns) for r in df.collect()) == want


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_simhash_query(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    prints = {r.doc_id: plain_fingerprint(r.text) for r in rows}
    component = plain_components(prints)
    assert sorted(map(tuple, registry.op13_simhash(spark, SF).collect())) == sorted((i, f"{p:016x}", component[i]) for i, p in prints.items())
