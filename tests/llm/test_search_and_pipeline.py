"""Nearest neighbours, and the pipeline as a whole."""

import random

import numpy as np
import pytest

from tessera.llm import hnsw, registry

SF = "/root/testdata/sf0.001"


def exact(rows, queries, k):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float64)
    out = {}
    for i, q in queries:
        d = np.sqrt(((x - np.array(q, np.float64)) ** 2).sum(1))
        best = sorted((e, int(j)) for e, j in zip(d.tolist(), ids.tolist()) if j != i)
        out[i] = best[:k]
    return out


def test_recall_and_ties(spark):
    r = np.random.default_rng(2)
    x = r.normal(size=(3000, 16)).astype(np.float32)
    x[100:400] = x[100]  # one vector in very many rows
    rows = [(k, x[k].tolist()) for k in range(3000)]
    odd = [(9000, None), (9001, [0.0] * 16), (9002, [float("nan")] * 16), (9003, [None] * 16), (9004, [float("inf")] * 16), (None, x[0].tolist()), (9100, [])]
    df = spark.createDataFrame(rows + odd + rows[:3], "vec_id long, embedding array<float>").repartition(4)
    got = hnsw.search(df, df.where("vec_id % 100 = 0"), 10, shard=700).collect()
    want = exact(rows, [q for q in rows if q[0] % 100 == 0], 10)
    found: dict = {}
    for g in got:
        found.setdefault(g.query_id, {})[g.rank] = (g.score, g.vec_id)
    assert set(found) == set(want)
    hits = sum(len({v for _, v in f.values()} & {v for _, v in want[q]}) for q, f in found.items())
    assert hits / (10 * len(want)) >= 0.95
    # equal distances: the smallest ids of the very frequent vector
    assert [v for _, v in sorted(found[100].values())] == [v for _, v in want[100]]
    assert all(f[1] <= f[2] for f in found.values())
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert hnsw.search(none, none).count() == 0
    few = spark.createDataFrame([(0, [1.0]), (100, [2.0])], "vec_id long, embedding array<float>")
    assert sorted((g.query_id, g["rank"], g.vec_id, g.score) for g in hnsw.search(few, few).collect()) == [(0, 1, 100, 1.0), (100, 1, 0, 1.0)]


def test_scores_are_of_the_vectors_as_they_are(spark):
    """Vectors of doubles that single precision can't tell apart; queries in several blocks; clashing names; rows that repeat."""
    r = np.random.default_rng(3)
    x = np.repeat(r.normal(size=(300, 8)), 3, axis=0) + r.normal(size=(900, 8)) * 1e-9
    rows = [(k, x[k].tolist()) for k in range(900)]
    df = spark.createDataFrame([(i, v, "d", 1.5, 3, "q") for i, v in [*rows, *rows[:50]]], "vec_id long, embedding array<double>, d string, score double, rank int, q string").repartition(3)
    got: dict = {}
    for g in hnsw.search(df, df.where("vec_id % 2 = 0"), 4, shard=100).collect():
        got.setdefault(g.query_id, []).append((g["rank"], g.score, g.vec_id))
    want = exact(rows, rows[::2], 4)
    assert set(got) == set(want)
    for q, best in want.items():
        mine = sorted(got[q])
        assert [k for k, _, _ in mine] == [1, 2, 3, 4]
        assert np.allclose([e for _, e, _ in mine[:2]], [e for e, _ in best[:2]], rtol=1e-12, atol=0) and [v for _, _, v in mine[:2]] == [v for _, v in best[:2]]


def test_graphs_that_are_walked_while_they_are_built():
    r = np.random.default_rng(4)
    x = r.normal(size=(3000, 12)).astype(np.float32)
    for small in (0, 100, 1 << 20):
        g = hnsw.Graph(x, small=small)
        degree = (g.ground >= 0).sum(1)
        assert (g.ground < 3000).all() and degree.min() > 0 and all(len(set(row[row >= 0].tolist())) == (row >= 0).sum() for row in g.ground) and not (g.ground == np.arange(3000)[:, None]).any()
        found = g.nearest(x[:100], 10)
        near = np.argsort(((x[:100, None] - x[None]) ** 2).sum(2), axis=1)[:, :10]
        assert sum(len(set(a) & set(b)) for a, b in zip(found.tolist(), near.tolist())) >= 950
    assert hnsw.Graph(x[:1]).nearest(x[:2], 3).tolist() == [[0, -1, -1], [0, -1, -1]]


def test_each_graph_is_sent_once_however_many_queries(spark, monkeypatch):
    monkeypatch.setattr(hnsw, "PART", 5000)
    r = np.random.default_rng(8)
    x = r.normal(size=(1500, 8)).astype(np.float32)
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(3)
    graphs, shards = hnsw.build_index(df, 10, "vec_id", "embedding", 400)
    stored_parts = {(g.d, g.s, g.part) for g in graphs.collect()}
    assert shards == 4 and len(stored_parts) == graphs.count() > 3 * shards
    for n in (1, 40, 1500):
        asked = df.limit(n).select("vec_id", df.embedding.cast("array<double>").alias("q")).toDF("query_id", "q")
        sent = hnsw.sent(graphs, asked, shards)
        parts = sent.where("part is not null")
        assert {(g.d, g.s, g.part) for g in parts.collect()} == stored_parts and parts.count() == len(stored_parts) and sent.where("part is null").count() == n * shards
    # more queries than a block, by graphs in many rows, over several shards
    got = hnsw.search(df, df, 5, shard=400).collect()
    want = exact(list(enumerate(x.tolist())), list(enumerate(x.tolist())), 5)
    assert len(got) == 7500 and sum(g.vec_id in {v for _, v in want[g.query_id]} for g in got) >= 0.97 * 7500


def test_shards_are_bounded_by_bytes():
    assert hnsw.shards_for(1 << 20, 8192, 64) == 128 and hnsw.shards_for(1 << 20, 1 << 17, 4096) == 512 and hnsw.shards_for(100, 8192, 0) == 1


def test_walks_find_what_products_find():
    """Graphs that nodes enter by the walk, against those whose nodes all saw one another: over shards, for queries that are in none of them."""
    r = np.random.default_rng(12)
    x, q = r.normal(size=(6000, 24)).astype(np.float32), r.normal(size=(150, 24)).astype(np.float32)
    want = np.argsort(((q[:, None] - x[None]) ** 2).sum(2), axis=1)[:, :10]
    recall = {}
    for small in (hnsw.SMALL, 1 << 16):
        near = []
        for low in range(0, 6000, 2000):
            found = hnsw.Graph(x[low : low + 2000], small=small).nearest(q, 20)
            near.append(np.where(found >= 0, found + low, -1))
        near = np.hstack(near)
        d = np.where(near >= 0, ((q[:, None] - x[near]) ** 2).sum(2), np.inf)
        best = np.take_along_axis(near, np.argsort(d, axis=1)[:, :10], 1)
        recall[small] = np.mean([len(set(a) & set(b)) / 10 for a, b in zip(best.tolist(), want.tolist())])
    assert recall[hnsw.SMALL] >= 0.95 and recall[hnsw.SMALL] >= recall[1 << 16] - 0.02


def test_shards_grow_once_there_are_many():
    assert [hnsw.shards_for(n, hnsw.SHARD) for n in (0, 1, 8192, 8193, 1 << 21, 1 << 25, 1 << 30)] == [1, 1, 1, 2, 256, 256, 8192]


def test_the_pipeline_keeps_whole_results(spark):
    import os

    pipeline = pytest.importorskip("corpus_pipeline")
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "line_dedup", "minhash", "suffix_dedup", "packing"]
    for name, stage in pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF)
        assert after.columns == docs.columns
        path = f"{registry.warc.fresh_path(spark, name)}"
        after.write.parquet(path)
        docs = spark.read.parquet(path)
    packed = pipeline.pack_windows(spark, docs, SF)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == {r.doc_id for r in docs.select("doc_id").collect()}
    assert packed.groupBy("sequence_id").sum("length").where("`sum(length)` > 2048").count() == 0


def small_corpus():
    """Rows as documents has them: copies, near copies, repeated lines and passages, toxic texts, nulls and empty texts."""
    from tests.llm.test_text_ops import made

    r = random.Random(21)
    rows = [(i, t) for i, t in made(21, 160) if i is not None]
    rows = list(dict(rows).items())
    words = ["".join(r.choice("abcdefg") for _ in range(5)) for _ in range(300)]
    lines = ["\n".join(" ".join(r.choice(words) for _ in range(6)) for _ in range(5)) for _ in range(3)]
    labels = []
    for k in range(3000, 3500):
        w = [r.choice(words) for _ in range(r.randint(20, 60))]
        if k % 7 == 0:
            for _ in range(3):
                w.insert(r.randrange(len(w)), r.choice(["vilest", "rotten", "grimly"]))
        rows.append((k, " ".join(w) + (f"\n{r.choice(lines)}\n{k}" if k % 5 == 0 else "")))
        labels.append((k, None, int(k % 7 == 0)))
    base = " ".join(r.choice(words) for _ in range(150))
    for k in range(4000, 4040):
        w = base.split()
        w[r.randrange(150)] = "changed"
        rows.append((k, " ".join(w)))
    return rows, labels


def test_each_stage_does_what_it_says(spark, tmp_path):
    import public_tokenizers
    import zlib
    from tokenizers import Tokenizer

    from tests.llm.test_text_ops import brute_components, brute_cut, brute_lines
    from tessera.llm import toxicity

    pipeline = pytest.importorskip("corpus_pipeline")
    rows, labels = small_corpus()
    sf = str(tmp_path)
    docs = spark.createDataFrame([(i, t, "en", f"s{i % 3}", len(t) if t is not None else 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars int")
    docs.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    stages = dict(pipeline.STAGES)

    def step(name, docs):
        after = stages[name](spark, docs, sf)
        if name != "packing":
            assert after.schema == docs.schema
        path = f"{sf}/{name}"
        after.write.parquet(path)
        return spark.read.parquet(path)

    def texts(docs):
        found = docs.collect()
        assert all(d.n_chars == len(d.text or "") and d.source == f"s{d.doc_id % 3}" and d.lang == "en" for d in found)
        return {d.doc_id: d.text for d in found}

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before = texts(docs)
    docs = step("toxicity", docs)
    after = texts(docs)
    judged = {r.doc_id: r.predicted for r in toxicity.toxicity(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")).collect()}
    assert after == {i: t for i, t in before.items() if not judged[i]}
    toxic = {i for i, _, y in labels if y}
    assert len(toxic & set(after)) <= 2 and len(set(before) - toxic - set(after)) <= 2

    before, docs = after, step("line_dedup", docs)
    after = texts(docs)
    want = brute_lines(list(before.items()))
    assert after == {i: None if t is None else want[i, t][3] for i, t in before.items()} and after != before

    before, docs = after, step("minhash", docs)
    after = texts(docs)
    parts, _ = brute_components(list(before.items()), 5, 80)
    assert after == {i: t for i, t in before.items() if parts[i] == i}
    # equal long lines went before, and left empty texts; of the near copies one stays
    assert len([i for i, t in after.items() if 4000 <= i < 4040 and t]) == 1

    before, docs = after, step("suffix_dedup", docs)
    after = texts(docs)
    want = brute_cut(list(before.items()), 100)
    assert after == {i: None if t is None else want[i, t][1] for i, t in before.items()}

    packed = step("packing", docs).collect()
    reader = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    windows: dict = {}
    tokens = {i: np.array([*reader.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for i, t in after.items()}
    seen = dict.fromkeys(tokens, 0)
    for p in sorted(packed, key=lambda p: (p.doc_id, p.start)):
        assert p.start == seen[p.doc_id] and p.ids_crc32 == zlib.crc32(tokens[p.doc_id][p.start : p.start + p.length].tobytes())
        seen[p.doc_id] += p.length
        windows.setdefault(p.sequence_id, []).append((p.offset, p.length))
    assert seen == {i: len(t) for i, t in tokens.items()}
    for parts_ in windows.values():
        ends = np.cumsum([n for _, n in sorted(parts_)])
        assert [o for o, _ in sorted(parts_)] == [0, *ends[:-1].tolist()] and ends[-1] <= 2048
    # run() gives what the stages one after another give, up to the windows' numbers
    whole = pipeline.run(spark, sf).collect()
    assert sorted((p.doc_id, p.start, p.length, p.ids_crc32, p.doc_tokens) for p in whole) == sorted((p.doc_id, p.start, p.length, p.ids_crc32, p.doc_tokens) for p in packed)


def test_columns_that_clash_stay(spark, tmp_path):
    pipeline = pytest.importorskip("corpus_pipeline")
    rows, labels = small_corpus()
    names = ["_toxic_score", "score", "_id", "_dig", "_row", "_begin", "id", "n", "dig", "k"]
    docs = spark.createDataFrame([(i, t, *[f"{c}{i}" for c in names]) for i, t in rows[:120]], "doc_id long, text string, " + ", ".join(f"{c} string" for c in names)).repartition(2)
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for _, stage in pipeline.STAGES[:-1]:
        after = stage(spark, docs, str(tmp_path))
        assert after.columns == docs.columns
        assert all(r[c] == f"{c}{r.doc_id}" for r in after.collect() for c in names)


@pytest.mark.parametrize("name", [*registry.QUERIES, "pipeline"])
def test_a_result_alone_stays_in_the_shared_folder(spark, name):
    """After a query there is one table more at most, which is its result, and no archive or index."""
    import os

    import corpus_pipeline

    folder = spark.conf.get("spark.checkpoint.dir").removeprefix("file://") + "/tessera"
    seen = lambda: set(os.listdir(folder)) if os.path.isdir(folder) else set()
    before = seen()
    df = (corpus_pipeline.run if name == "pipeline" else registry.QUERIES[name])(spark, SF)
    rows = df.collect()
    left = seen() - before
    assert len(left) <= 1 and df.count() == len(rows) > 0
    assert all(f"/tessera/{x}/" in "".join(df.inputFiles()) for x in left)
