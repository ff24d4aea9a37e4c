"""Operators on whole texts against brute force, with nulls, empty tables, repeated rows and clashing names."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
import xxhash

from tessera.llm import chunk_dedup, line_dedup, minhash, mpeg, packing, pieces, suffix_dedup, toxicity, warc

TOKENIZER, MODEL = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")
#: Columns that the operators use themselves, as extra columns of a table.
CLASH = "id long, doc_id long, text string, n long, h string, c int, _doc string, _starts int, size int, key string"


def made(seed=0, n=120):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdeéß") for _ in range(r.randint(1, 6))) for _ in range(80)]
    say = lambda k: " ".join(r.choice(words) for _ in range(k))
    base = [say(r.randint(5, 90)) for _ in range(10)]
    lines = [say(r.randint(2, 8)) for _ in range(12)]
    out = []
    for k in range(n):
        kind = r.random()
        if kind < 0.2:
            t = r.choice(base)
        elif kind < 0.45:
            w = r.choice(base).split()
            for _ in range(r.randint(1, 6)):
                w[r.randrange(len(w))] = r.choice(words)
            t = " ".join(w)
        elif kind < 0.75:
            t = "\n".join(r.choice(lines + ["", "  "]) for _ in range(r.randint(1, 12)))
        else:
            t = say(r.randint(0, 60))
        out.append((k * 3, t))
    return [*out, (1000, None), (1001, ""), (1002, " \n "), (1003, "Aa " * 3000), (None, "no id here at all"), (None, None), out[5], out[5]]


def frame(spark, rows):
    return spark.createDataFrame([(k, i, t, 1, "x", 2, "y", 3, 4, "z") for k, (i, t) in enumerate(rows)], CLASH).repartition(3)


def empty(spark):
    return spark.createDataFrame([], CLASH)


def sets_of(text, words):
    w = [x.lower() if x.isascii() else "".join(c.lower() if c.isascii() else c for c in x) for x in __import__("re").findall(r"[^\x20\x09-\x0D]+", text or "")]
    return frozenset(tuple(w[k : k + words]) for k in range(max(1, len(w) - words + 1))) if w else frozenset()


def brute_components(rows, words, similar):
    sets = [(i, sets_of(t, words)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= similar * len(a | b):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i, _ in sets}, dict(sets)


@pytest.mark.parametrize("words,similar", [(3, 85), (5, 80)])
def test_near_duplicates(spark, words, similar):
    rows = made(1)
    want, sets = brute_components(rows, words, similar)
    got = minhash.near_duplicates(frame(spark, rows), words, similar).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), want[r.doc_id], want[r.doc_id] == r.doc_id)
    kept = minhash.near_dedup(frame(spark, rows), words, similar)
    assert kept.columns == [c.split()[0] for c in CLASH.split(", ")] and {r.doc_id for r in kept.collect()} == {i for i, c in want.items() if c == i} | {None}
    assert minhash.near_duplicates(empty(spark)).count() == 0


def loose_variants(n=600, length=200, edits=0.04, seed=3):
    """Variants of one text that isn't itself a row."""
    r = random.Random(seed)
    base = [f"w{k}" for k in range(length)]
    return [(k, " ".join(f"x{k}y{p}" if r.random() < edits else w for p, w in enumerate(base))) for k in range(n)]


def test_near_duplicates_of_loosely_similar_variants(spark):
    rows = loose_variants()
    want, _ = brute_components(rows, 3, 85)
    assert max(map(list(want.values()).count, set(want.values()))) > 50
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), 3, 85).collect()
    assert {r.doc_id: r.component_id for r in got} == want


def test_links_found_later_join_components(spark):
    r = random.Random(9)
    links = [(a, a + r.choice((1, 1, 2, 7))) for a in r.sample(range(400), 230)]
    links = [(min(x), max(x)) for x in links]
    label = minhash.components(spark.createDataFrame(links[:100], "a long, b long"))
    for more in (links[100:180], links[180:] + links[:5], []):
        label = minhash.joined(label, spark.createDataFrame(more, "a long, b long"))
    root = {x: x for link in links for x in link}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, y in links:
        x, y = top(x), top(y)
        root[max(x, y)] = min(x, y)
    got = [(x.node, x.component) for x in label.collect()]
    assert len(got) == len(root) and dict(got) == {x: top(x) for x in root}


def test_parities_bound_what_differs():
    r = np.random.default_rng(2)
    for size in (1, 40, 3000):
        a = np.unique(r.integers(0, 1 << 62, size, dtype=np.uint64))
        b = np.unique(np.r_[a[: size * 9 // 10], r.integers(0, 1 << 62, 1 + size // 10, dtype=np.uint64)])
        x, y = minhash.parities(np.r_[a, b], np.array([0, len(a), len(a) + len(b)]))
        assert 0 < np.bitwise_count((x ^ y).view(np.uint64)).sum() <= len(np.setxor1d(a, b))
    assert not minhash.parities(np.zeros(0, np.uint64), np.zeros(3, np.int64)).any()


def test_densified_sketches_estimate_similarity():
    r = np.random.default_rng(1)
    for size in (3, 40, 2000):
        a = np.sort(r.integers(0, 1 << 62, size, dtype=np.uint64))
        b = np.sort(np.r_[a[: max(1, int(size * 0.9))], r.integers(0, 1 << 62, size - max(1, int(size * 0.9)), dtype=np.uint64)])
        s = minhash.sketches(np.r_[a, b], np.array([0, len(a), 2 * len(a)]))
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs((s[0] == s[1]).mean() - true) < 0.25


def in_order(rows):
    """Documents, that is (id, text), in the order that earlier means: by id, then by a hash of the text where ids repeat."""
    docs = {(i, t or "") for i, t in rows if i is not None}
    told = len(docs) > len({i for i, _ in docs}) or len([i for i, _ in rows if i is not None]) > len(docs)
    return sorted(docs, key=lambda d: (d[0], np.uint64(xxhash.xxh64(d[1].encode(), seed=42).intdigest()).astype(np.int64) if told else 0))


def two_texts(rows):
    """rows, and other texts under ids that are there already: copies of other texts, shorter and longer ones."""
    own = [(i, t) for i, t in rows if i is not None and t]
    return [*rows, *((i, own[-k - 1][1] + own[k + 3][1]) for k, (i, _) in enumerate(own[:12])), (own[0][0], own[5][1][:150]), (own[1][0], None)]


def brute_cut(rows, length):
    seen, out = {}, {}
    for i, t in in_order(rows):
        b = t.encode()
        mask = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            w = b[p : p + length]
            if w in seen:
                mask[p : p + length] = True
            else:
                seen[w] = 1
        runs = int((np.diff(np.r_[0, mask.astype(int)]) == 1).sum())
        left = bytes(np.frombuffer(b, np.uint8)[~mask])
        out[i, t] = (len(b), int(mask.sum()), runs, hashlib.sha256(left).hexdigest()), left.decode("utf-8", "ignore") if mask.any() else t
    return out


def held(got, want, rows):
    """Digest rows against documents: ids with several texts have several rows."""
    mine = sorted((i, *want[i, t or ""][0]) for i, t in rows if i is not None)
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got if r.doc_id is not None) == mine
    assert len(got) == len(rows) and all(r.n_removed <= r.n_bytes for r in got) and all(not r.n_removed for r in got if r.doc_id is None)


def same_texts(spark, kept, want, rows):
    """Kept texts against documents, and all other columns as they were."""
    assert kept.columns == [c.split()[0] for c in CLASH.split(", ")]
    mine = [(k, i, t if i is None or t is None else want[i, t][1]) for k, (i, t) in enumerate(rows)]
    assert sorted(((r.id, r.doc_id, r.text) for r in kept.collect())) == sorted(mine)
    assert {(r.n, r.h, r.c, r._doc, r._starts, r.size, r.key) for r in kept.collect()} == {(1, "x", 2, "y", 3, 4, "z")}


@pytest.mark.parametrize("length", [100, 40])
@pytest.mark.parametrize("more", [list, two_texts])
def test_suffix_dedup(spark, length, more):
    rows = more(made(2) + [(2000, "ab" * 200), (2001, "b" + "ab" * 150), (2002, "q" * 350)])
    want = brute_cut(rows, length)
    held(suffix_dedup.suffix_dedup(frame(spark, rows), length).collect(), want, rows)
    same_texts(spark, suffix_dedup.suffix_dedup(frame(spark, rows), length, keep=True), want, rows)


def test_ids_must_be_integers(spark):
    docs = spark.createDataFrame([("a", "x"), ("b", "y")], "doc_id string, text string")
    for f in (suffix_dedup.suffix_dedup, chunk_dedup.chunk_dedup, line_dedup.line_dedup, minhash.near_duplicates, minhash.near_dedup):
        with pytest.raises(TypeError):
            f(docs)


def test_suffix_dedup_of_nothing(spark):
    assert suffix_dedup.suffix_dedup(empty(spark)).count() == 0 and suffix_dedup.suffix_dedup(empty(spark), keep=True).count() == 0
    nothing = spark.createDataFrame([(1, None), (2, ""), (None, None)], "doc_id long, text string")
    assert {(r.n_bytes, r.n_removed) for r in suffix_dedup.suffix_dedup(nothing).collect()} == {(0, 0)}
    with pytest.raises(ValueError):
        suffix_dedup.suffix_dedup(nothing, length=300)


@pytest.fixture(scope="module")
def long_texts():
    """Texts of more than two stretches, which share passages across a stretch's end, and what repeats."""
    r = random.Random(8)
    a = "".join(r.choices("abcdefgh  \n", k=2_600_000))
    passage = a[1_048_576 - 2000 : 1_048_576 + 3000]
    b = "".join(r.choices("ijklmnop  \n", k=2_300_000))
    return [(1, a), (2, b[:2_097_152 - 700] + passage + b[2_097_152 - 700 :]), (3, "zz" + passage + "yy")], len(passage)


def test_very_long_texts(spark, long_texts):
    rows, size = long_texts
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = {r.doc_id: r for r in suffix_dedup.suffix_dedup(docs).collect()}
    # what stands beside a passage may be alike by chance, in a letter or two
    assert got[1].n_removed == 0 and all(size <= got[i].n_removed <= size + 6 and got[i].n_spans == 1 for i in (2, 3))
    near = {r.doc_id: r for r in minhash.near_duplicates(docs, 3, 85).collect()}
    assert {i: near[i].n_shingles for i, _ in rows} == {i: len(sets_of(t, 3)) for i, t in rows}
    chunks = {r.doc_id: r for r in chunk_dedup.chunk_dedup(docs).collect()}
    want = brute_chunks(rows)
    assert {i: (chunks[i].n_bytes, chunks[i].n_removed, chunks[i].n_spans, chunks[i].kept_sha256) for i, _ in rows} == {d[0]: w[0] for d, w in want.items()}


def test_words_of_very_long_texts_are_hashed_alike():
    data = np.frombuffer(b"ab cd  " + b"x" * (5 << 20) + b" ef " + b"gh " * (1 << 20), np.uint8)
    whole, at = minhash._word_hashes(data, np.array([0, len(data)]))
    parts, cuts = minhash.word_hashes(data, np.array([0, len(data)]))
    assert (whole == parts).all() and (at == cuts).all()


def frequent(n=400):
    """One passage in every text, its surroundings different in each; one in half of them, in two variants."""
    r = random.Random(4)
    some = lambda k: "".join(r.choices("abcdefghijklmnopqrstuvwxyz ", k=k))
    everywhere, often = some(150), [some(130), some(130)]
    return [(k, some(r.randint(0, 90)) + everywhere + some(r.randint(0, 90)) + (often[k % 4 // 2] + some(40) if k % 2 else "")) for k in range(n)]


@pytest.mark.parametrize("hot_share,wide", [(0.0, 4000), (9.0, 3), (0.0, 3)])
def test_frequent_minimisers_give_the_same_result(spark, monkeypatch, hot_share, wide):
    monkeypatch.setattr(suffix_dedup, "HOT_SHARE", hot_share)
    monkeypatch.setattr(suffix_dedup, "WIDE", wide)
    for rows in (frequent(), made(3)):
        held(suffix_dedup.suffix_dedup(frame(spark, rows)).collect(), brute_cut(rows, 100), rows)


def test_mappers_and_streams_settle_alike():
    r = np.random.default_rng(5)
    from tessera.llm import spans

    n = 3000
    key, ctx, doc, at = r.integers(0, 60, n), r.integers(0, 3, n), r.integers(0, 40, n), r.integers(0, 50, n)
    dig, size = doc % 2, 5 + key % 7
    mapper = spans.Mapper()
    batches = []
    for i in range(0, n, 700):
        part = slice(i, i + 700)
        batches += [*mapper.add(key[part], ctx[part], doc[part], dig[part], at[part], at[part] + size[part], size[part]), *mapper.flush()]
    table = __import__("pyarrow").Table.from_batches(batches).sort_by([(k, "ascending") for k in ("key", "ctx", "doc", "dig", "place")])
    out = [b for b in spans.settled(iter(table.to_batches(max_chunksize=97)), lambda p: (p >> 20) + (p >> 2 & 0x3FFFF), True)]
    rows = [x for b in out for x in zip(*(c.to_pylist() for c in b.columns))]
    firsts: dict = {}
    for k, c, d, g, a in zip(key.tolist(), ctx.tolist(), doc.tolist(), dig.tolist(), at.tolist()):
        firsts[k, c] = min(firsts.get((k, c), (d, g, a)), (d, g, a))
    gone = {(d, g, a + x) for k, c, d, g, a, s in zip(*(y.tolist() for y in (key, ctx, doc, dig, at, size))) if (d, g, a) != firsts[k, c] for x in range(s)}
    assert {(d, g, x) for _, end, d, g, p in rows if p & 3 == spans.GONE for x in range(p >> 20, end)} == gone
    several = {k for k, _ in firsts if len([1 for j, _ in firsts if j == k]) > 1}
    assert {(k, c, d, g, p >> 20) for k, c, d, g, p in rows if p & 3 == spans.OPEN} == {(k, c, *v) for (k, c), v in firsts.items() if k in several}


def test_every_difference_has_a_shift_into_the_cover():
    for v in (8, 32, 64):
        d = set(suffix_dedup.difference_cover(v).tolist())
        assert all(any((i + s) % v in d and (j + s) % v in d for s in range(v)) for i in range(v) for j in range(v))


def brute_chunks(rows):
    seen, out = {}, {}
    for i, t in in_order(rows):
        b = t.encode()
        h, last, cuts = 0, 0, []
        for k, x in enumerate(b):
            h = (h * 2 + int(chunk_dedup.GEAR[x])) & 0xFFFFFFFF
            n = k + 1 - last
            if n >= chunk_dedup.LEAST and h >> (32 - chunk_dedup.BITS) == 0 or n == chunk_dedup.MOST:
                cuts.append((last, k + 1))
                last = k + 1
        cuts += [(last, len(b))] if last < len(b) else []
        kept, runs, before = b"", [], False
        for x, y in cuts:
            again = (y - x >= chunk_dedup.LEAST or y - x == len(b)) and b[x:y] in seen
            if again:
                runs = [*runs[:-1], (runs[-1][0], y)] if before else [*runs, (x, y)]
            else:
                kept += b[x:y]
            before = again
            if y - x >= chunk_dedup.LEAST or y - x == len(b):
                seen.setdefault(b[x:y], 1)
        out[i, t] = (len(b), sum(y - x for x, y in runs), len(runs), hashlib.sha256(kept).hexdigest()), kept.decode("utf-8", "ignore") if runs else t
    return out


@pytest.mark.parametrize("more", [list, two_texts])
def test_chunk_dedup(spark, more):
    rows = more(made(4) + [(3000, "w" * 5000)])
    want = brute_chunks(rows)
    held(chunk_dedup.chunk_dedup(frame(spark, rows)).collect(), want, rows)
    same_texts(spark, chunk_dedup.chunk_dedup(frame(spark, rows), keep=True), want, rows)
    assert chunk_dedup.chunk_dedup(empty(spark)).count() == 0


def test_insertions_move_few_chunks():
    r = random.Random(1)
    text = "".join(r.choice("abcdefgh ") for _ in range(20000)).encode()
    cut = lambda b: {b[x:y] for x, y in zip(*chunk_dedup.chunk_ends(np.frombuffer(b, np.uint8), np.array([0, len(b)]), 48, 384, 5)[1:])}
    a, b = cut(text), cut(text[:700] + b"inserted" + text[700:])
    assert len(a - b) <= 4


def brute_lines(rows):
    seen, out = set(), {}
    for i, t in in_order(rows):
        lines = t.split("\n")
        solid = [k for k, x in enumerate(lines) if x.strip(" ")]
        gone, ends = set(), []
        for j in range(len(solid)):
            size = next((n for n in (1, 2, 3) if j + n <= len(solid) and (n == 3 or sum(lines[solid[j + k]].count(" ") + 1 for k in range(n)) >= 50)), None)
            if size is None:
                continue
            w = tuple(lines[solid[j + k]] for k in range(size))
            if w in seen:
                gone.update(range(solid[j], solid[j + size - 1] + 1))
                ends.append((j, j + size - 1))
            seen.add(w)
        runs = sum(1 for k, (j, _) in enumerate(ends) if not k or j > ends[k - 1][1])
        out[i, t] = len(solid), sum(1 for k in solid if k in gone), runs, "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return out


@pytest.mark.parametrize("more", [list, two_texts])
def test_line_dedup(spark, more):
    long = " ".join(f"w{k}" for k in range(50))
    rows = more(made(5) + [(5000, long), (5001, f"a\n{long}\n\nb"), (5002, f"{long[:150]}\n{long[150:]}"), (5003, f"x\n{long[:150]}\n{long[150:]}\ny"), (5004, long[:-4])])
    want = brute_lines(rows)
    assert more is two_texts or want[5000, long][1] == 0 and want[5001, f"a\n{long}\n\nb"][1:3] == (1, 1)
    got = line_dedup.line_dedup(frame(spark, rows)).collect()
    mine = [(i, *(want[i, t] if t is not None else (0, 0, 0, None))) for i, t in rows if i is not None]
    order = lambda x: tuple((v is None, v) for v in x)
    assert len(got) == len(rows) and sorted(((r.doc_id, r.n_lines, r.n_removed, r.n_runs, r.kept_text) for r in got if r.doc_id is not None), key=order) == sorted(mine, key=order)
    assert all(not r.n_removed for r in got if r.doc_id is None)
    kept = line_dedup.line_dedup(frame(spark, rows), keep=True)
    same_texts(spark, kept, {d: (None, w[3]) for d, w in want.items()}, rows)
    plan = line_dedup.line_dedup(frame(spark, rows))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert line_dedup.line_dedup(empty(spark)).count() == 0


def test_near_dedup_tells_texts_of_one_id_apart(spark):
    texts = {k: " ".join(f"{k}{j}" for j in range(60)) for k in "abc"}
    rows = [(1, texts["a"]), (2, texts["b"]), (5, texts["b"]), (5, texts["c"]), (5, texts["c"]), (7, texts["c"] + " more"), (8, None), (9, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = minhash.near_duplicates(docs)
    assert sorted((r.doc_id, r.component_id, r.kept) for r in got.collect()) == [(1, 1, True), (2, 2, True), (5, 2, False), (5, 5, True), (5, 5, True), (7, 5, False), (8, 8, True), (9, 9, True)]
    assert sorted((r.doc_id, r.text or "") for r in minhash.near_dedup(docs).collect()) == [(1, texts["a"]), (2, texts["b"]), (5, texts["c"]), (5, texts["c"]), (8, ""), (9, "")]


def test_packing(spark):
    from tokenizers import Tokenizer

    rows = made(6) + [(4000, "Hello, WORLD's 12 <|endoftext|> x\x1cy İstanbul é"), (4001, "word " * 5000)]
    reader = Tokenizer.from_file(TOKENIZER)
    ids = {i: np.array([*reader.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for i, t in rows}
    got = packing.pack(frame(spark, rows), TOKENIZER).collect()
    pieces_of, windows = {}, {}
    for r in got:
        if r.doc_id is not None:
            assert zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes()) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id])
            pieces_of.setdefault(r.doc_id, set()).add((r.start, r.length))
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for i, parts in pieces_of.items():
        at = 0
        for start, length in sorted(parts):
            assert start == at
            at += length
        assert at == len(ids[i])
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.pack(empty(spark), TOKENIZER).count() == 0


def test_words_and_marks_have_the_tokenizers_ids(spark, monkeypatch):
    import pyarrow as pa
    from tokenizers import Tokenizer

    r, reader = random.Random(3), Tokenizer.from_file(TOKENIZER)
    own = lambda t: reader.encode(t or "", add_special_tokens=False).ids
    # letters that normalise to a letter and a mark, which what follows joins
    rows = [(1, "AL\u0130. ok"), (2, "\u0958, (\u0958) x"), (3, "***Word*** \"It's,\" don't! a.b <b> </b>")]
    for x in packing.pack(frame(spark, rows), TOKENIZER).collect():
        assert x.ids_crc32 == zlib.crc32(np.array([*own(dict(rows)[x.doc_id]), 1], "<u4").tobytes())
    parts = ["a", "B", "z", "\u00c9", "\u0130", "\u0958", "\u03a3", "\u03c2", "e\u0301", "\u0338", "'", "'s", "'S", ".", "!", "<", "|", "***", "$$", "12", "\u4e2d", "\ud55c", "\u1100", "\u1161", "\u200b", "\x85", "\x1c", "\xa0", "\u3000", " ", " ", "\t", "\n", "\U0001d49c", "\u1c89", "\U0001f9ff", "-", "_"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 14))) for _ in range(4000)] + [None, "", "  a  "]
    for most in (packing.KNOWN_WORDS, 50):
        monkeypatch.setattr(packing, "KNOWN_WORDS", most)
        read = packing.word_reader(TOKENIZER)
        for low in range(0, len(texts), 900):
            ids, n = read(pa.array(texts[low : low + 900], pa.string()))
            assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == [own(t) for t in texts[low : low + 900]] and len(ids) == n.sum()


def test_level_array_takes_the_smallest_sum_of_squares():
    r = random.Random(1)
    levels, counts = packing.LevelArray(50), [0] * 51
    for _ in range(400):
        size = r.randint(1, 49)
        best = None
        for level in [x for x in range(1, 51) if counts[x]] + [0]:
            if level + size <= 50:
                c = list(counts)
                c[level] -= level > 0
                if level + size < 50:
                    c[level + size] += 1
                total = sum(x * x for x in c)
                if best is None or total < best[0]:
                    best = (total, c)
        levels.place(size)
        counts = levels.counts.tolist()
        assert sum(x * x for x in counts) == best[0]


def test_ids_are_the_models_own():
    import sentencepiece

    r, model, own = random.Random(5), pieces.Pieces.load(MODEL), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    known = [own.id_to_piece(i).replace(pieces.SPACE, " ") for i in range(259, own.get_piece_size())]
    texts = [" ".join(r.choice(known) for _ in range(8)) for _ in range(500)] + ["".join(r.choice(known) for _ in range(8)) for _ in range(1500)]
    texts += ["".join(r.choice("  aetnihs\n.0é🧿") for _ in range(r.randint(0, 60))) for _ in range(1500)] + ["a" + " " * k + "b" for k in range(40)] + ["unbelievably internationalisation", "▁x"]
    texts += ["".join(r.choice("etaoinshrdlucmfw") for _ in range(r.randint(1, 30))) for _ in range(1500)]
    assert [t for t in texts if model.encode(t).tolist() != own.encode(t)] == []


def test_ids_of_a_unigram_model_are_the_librarys(tmp_path):
    """A model put together by hand: pieces over a few letters with scores drawn at random, with and without byte pieces."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as proto

    for fallback in (True, False):
        for lead in (True, False):
            r, spec = random.Random(11), proto.ModelProto()
            add = lambda p, s, kind: spec.pieces.add(piece=p, score=s, type=kind)
            kinds = proto.ModelProto.SentencePiece
            add("<unk>", 0, kinds.UNKNOWN)
            add("<s>", 0, kinds.CONTROL)
            if fallback:
                for b in range(256):
                    add(f"<0x{b:02X}>", 0, kinds.BYTE)
            seen = {*"abcd▁"}
            while len(seen) < 120:
                seen.add(("▁" if r.random() < 0.4 else "") + "".join(r.choice("abcdé") for _ in range(r.randint(1, 5))))
            for p in sorted(seen):
                add(p, -r.uniform(2, 12), kinds.NORMAL)
            spec.trainer_spec.model_type, spec.trainer_spec.byte_fallback = spec.trainer_spec.UNIGRAM, fallback
            spec.trainer_spec.vocab_size = len(spec.pieces)
            spec.normalizer_spec.name, spec.normalizer_spec.add_dummy_prefix = "identity", lead
            spec.normalizer_spec.remove_extra_whitespaces, spec.normalizer_spec.escape_whitespaces = False, True
            path = str(tmp_path / f"{fallback}{lead}.model")
            with open(path, "wb") as f:
                f.write(spec.SerializeToString())
            own, model = sentencepiece.SentencePieceProcessor(model_file=path), pieces.Pieces.load(path)
            texts = ["".join(r.choice("aabbccddé  x漢") for _ in range(r.randint(0, 40))) for _ in range(800)] + ["abcd" * 400]
            total = lambda ids: sum(model.scores[i] for i in ids)
            other = [t for t in texts if model.encode(t).tolist() != own.encode(t)]
            # the same pieces in another order have one sum, but for rounding
            assert len(other) < 4 and all(abs(total(model.encode(t).tolist()) - total(own.encode(t))) < 1e-6 for t in other)


def test_models_that_normalise_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as proto

    spec = proto.ModelProto.FromString(open(MODEL, "rb").read())
    spec.normalizer_spec.remove_extra_whitespaces = True
    (tmp_path / "x.model").write_bytes(spec.SerializeToString())
    with pytest.raises(ValueError):
        pieces.Pieces.load(str(tmp_path / "x.model"))


def test_round_trips_against_the_library(spark):
    import sentencepiece

    own, rows = sentencepiece.SentencePieceProcessor(model_file=MODEL), made(12)
    got = sorted((r.doc_id is None, r.doc_id, r.n_ids, r.ids_crc32, r.n_byte_ids, r.text_bytes, r.lossless) for r in pieces.round_trip(frame(spark, rows), MODEL).collect() if r.doc_id is not None)
    want = []
    for i, t in rows:
        if i is not None:
            ids = own.encode(t or "")
            want.append((False, i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), sum(map(own.is_byte, ids)), len((t or "").encode()), True))
    assert got == sorted(want)
    assert pieces.round_trip(empty(spark), MODEL).count() == 0


def test_pieces(spark):
    model = pieces.Pieces.load(MODEL)
    for text in ("", " ", "Hello  World\n\té 😀 x", "the theatre", "a" * 50):
        assert model.decode(model.encode(text)) == text
    small = pieces.Pieces(["a", "b", "ab", "ba", "aba", "▁", "▁a"], [-1.0, -1.5, -1.8, -2.0, -2.9, -1.0, -1.4], [True] * 7, [], 0)

    def best(s):
        if not s:
            return 0.0, []
        return max(((score + best(s[len(p) :])[0], [i, *best(s[len(p) :])[1]]) for i, (p, score) in enumerate(zip(small.pieces, small.scores)) if s.startswith(p)), default=(-1e9, []))

    r = random.Random(3)
    for _ in range(200):
        s = "".join(r.choice("ab▁") for _ in range(r.randint(1, 9)))
        ids = small.viterbi(s)
        assert abs(sum(small.scores[i] for i in ids) - best(s)[0]) < 1e-9 and "".join(small.pieces[i] for i in ids) == s
    rows = made(7)
    got = pieces.round_trip(frame(spark, rows), MODEL).collect()
    assert len(got) == len(rows) and all(r.lossless for r in got)
    encoded = pieces.encode(frame(spark, rows), MODEL)
    back = {r.doc_id: r.text for r in pieces.decode(encoded, MODEL).collect() if r.doc_id is not None}
    assert back == {i: t or "" for i, t in rows if i is not None}
    assert pieces.encode(empty(spark), MODEL).count() == 0


def crc16(bits):
    """Bit by bit, by the polynomial's definition."""
    r = 0xFFFF
    for b in bits:
        r ^= b << 15
        r = (r << 1 ^ 0x8005 if r & 0x8000 else r << 1) & 0xFFFF
    return r


def bits_of(data):
    return [x >> 7 - k & 1 for x in data for k in range(8)]


def media_by_hand(raw):
    """The stored form, byte by byte: a tag, a frame with the table, frames of 576 bytes of payload."""
    n = max(1, -(-len(raw) // 576))
    head, quiet = bytes([0xFF, 0xF2, 0xD8, 0xC0]), bytes(9)
    lead = head + crc16(bits_of(head[2:] + quiet)).to_bytes(2, "big") + quiet
    text = b"\0payload_bytes\0%d" % len(raw)
    said = b"TXXX" + bytes([0, 0, 0, len(text), 0, 0]) + text
    seek = bytes(min(255, 256 * (648 + n * 648 * k // 100) // ((n + 1) * 648)) for k in range(100))
    info = b"Info\0\0\0\7" + n.to_bytes(4, "big") + ((n + 1) * 648).to_bytes(4, "big") + seek
    out = b"ID3\3\0\0\0\0\0" + bytes([len(said)]) + said + (lead + info).ljust(648, b"\0")
    for k in range(n):
        out += (lead + raw[576 * k : 576 * k + 576].ljust(576, b"\xff")).ljust(648, b"\0")
    return out


def test_media(spark):
    rows = made(8)
    got = mpeg.media_columns(frame(spark, rows)).collect()
    want = {i: (t or "").encode() for i, t in rows}
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is not None:
            raw = want[r.doc_id]
            full = raw + b"\xff" * (max(1, -(-len(raw) // 576)) * 576 - len(raw))
            media = mpeg.carry(raw)
            assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(full), hashlib.sha256(full).hexdigest(), zlib.crc32(full[-32:]))
            assert (r.media_bytes, r.media_sha256) == (len(media), hashlib.sha256(media).hexdigest()) and r.n_samples == len(full) and r.crc_bad == 0
            assert media_by_hand(raw) == media
            # the first frames are the tag's end and the table's frame
            tag = 10 + 10 + len(f"payload_bytes {len(raw)}") + 1
            assert r.seek_offsets == [tag + 648 * (1 + k) for k in range(len(full) // 576)] and r.duration_s == len(full) / 16000
            values = [b - 128 for b in raw]
            signs = [v < 0 for v in values]
            crossings = sum(a != b for a, b in zip(signs, signs[1:]))
            assert r.feature == f"frames={len(full) // 576};duration={len(full)}/16000;energy={sum(v * v for v in values)};crossings={crossings};mean={sum(values) / max(1, len(values)):.6f}"
    assert mpeg.media_columns(empty(spark)).count() == 0


def test_streams_with_rubbish_tags_and_damage():
    raw = bytes(range(256)) * 5
    clean = mpeg.carry(raw)
    p = mpeg.parse(clean)
    assert bytes(mpeg.payload(clean, p))[: len(raw)] == raw and p["table"]["frames"] == len(p["offsets"]) == 3 and p["tags"] == {"payload_bytes": "1280"} and p["duration"] == Fraction(p["samples"], 16000)
    tagged = clean + b"TAG" + b"name".ljust(125, b"\0")
    assert mpeg.parse(tagged)["tags"]["title"] == "name" and mpeg.parse(tagged)["offsets"] == p["offsets"]
    first = p["offsets"][1]
    dirty = clean[:first] + b"\xff\xfb\x00junk" + clean[first:]
    q = mpeg.parse(dirty)
    assert len(q["offsets"]) == 3 and q["skipped"] == 7
    hurt = bytearray(clean)
    hurt[first + 8] ^= 1
    assert mpeg.parse(bytes(hurt))["crc_bad"] == 1
    assert mpeg.parse(b"")["offsets"] == [] and mpeg.parse(b"\xff" * 50)["offsets"] == []
    h = mpeg.head(bytes((0xFF, 0xFB, 0x90, 0x00)))
    assert (h["version"], h["layer"], h["bitrate"], h["hertz"], h["size"], h["samples"]) == ("1", 3, 128000, 44100, 417, 1152)


def layered(layer, version_bits, rate, hz, mode, extension, allocation, selection):
    """A frame of Layer I or II with a checksum: its allocation bits, then its selection bits."""
    header = bytes([0xFF, 0xE0 | version_bits << 3 | 4 - layer << 1, rate << 4 | hz << 2, mode << 6 | extension << 4])
    bits = allocation + selection
    crc = crc16(bits_of(header[2:]) + bits)
    body = int("".join(map(str, bits + [0] * (-len(bits) % 8))), 2).to_bytes((len(bits) + 7) // 8, "big")
    return (header + crc.to_bytes(2, "big") + body).ljust(mpeg.head(header)["size"], b"\x55")


def test_checksums_of_the_other_layers():
    r = random.Random(6)
    coin = lambda n: [r.randint(0, 1) for _ in range(n)]
    # Layer I: 32 subbands of 4 bits, for each channel below the bound of joint stereo
    one = [layered(1, 3, 9, 0, mode, ext, coin(4 * n), []) for mode, ext, n in ((3, 0, 32), (0, 0, 64), (1, 0, 2 * 4 + 28), (1, 2, 2 * 12 + 20)) for _ in range(3)]
    # Layer II: widths by table, two selection bits for each subband and channel that has any bits
    two = []
    wide = {"a": [4] * 11 + [3] * 12 + [2] * 4, "b": [4] * 11 + [3] * 12 + [2] * 7, "c": [4] * 2 + [3] * 6, "d": [4] * 2 + [3] * 10, "low": [4] * 4 + [3] * 7 + [2] * 19}
    for version, rate, hz, table, mode, ext in ((3, 4, 0, "a", 3, 0), (3, 10, 0, "b", 3, 0), (3, 14, 1, "a", 0, 0), (3, 2, 0, "c", 3, 0), (3, 2, 2, "d", 3, 0), (2, 8, 0, "low", 3, 0), (3, 14, 0, "b", 1, 1)):
        for _ in range(3):
            bits, chosen = [], []
            for band, width in enumerate(wide[table]):
                shared = mode == 1 and band >= 4 * ext + 4
                for _ in range(1 if mode == 3 or shared else 2):
                    some = coin(width) if r.random() < 0.6 else [0] * width
                    bits += some
                    chosen += coin(4 if shared else 2) if any(some) else []
            two.append(layered(2, version, rate, hz, mode, ext, bits, chosen))
    for frame_ in one + two:
        p = mpeg.parse(frame_ * 3)
        assert len(p["offsets"]) == 3 and (p["crc_seen"], p["crc_bad"]) == (3, 0)
        hurt = bytearray(frame_ * 3)
        hurt[len(frame_) + 6] ^= 0x80
        assert mpeg.parse(bytes(hurt))["crc_bad"] == 1


def test_archives(spark):
    big = "é" * 600
    rows = [(1, "http://a/ b", big), (5, None, big), (3, "http://c\n", big), (2, "u", "small"), (4, "u", "small"), (6, "u", None), (7, "u", ""), (None, "u", "x"), (9, "u", "y" * 999), (10, "u", "y" * 999), (11, "u", "z" * 1000), (12, "u", "z" * 1000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {r.page_id: r for r in warc.archive_round_trip(spark, pages).collect()}
    assert len(got) == len(rows)
    for i, url, html in rows:
        raw = (html or "").encode()
        to = {1: 5, 3: 5, 11: 12}.get(i)
        assert (got[i].payload_bytes, got[i].payload_digest, got[i].record_type, got[i].refers_to) == (len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if to else "response", to)
    assert warc.archive_round_trip(spark, spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_archives_with_repeated_rows_and_clashing_columns(spark):
    rows = [(4, "u", "z" * 1200), (4, "u", "z" * 1200), (4, "v", "z" * 1200), (3, "w", "z" * 1200), (None, "n", "z" * 1200), (2, "u", "ab"), (2, "u", "ab")]
    pages = spark.createDataFrame([(i, u, h, "d", 1, "f", 2, 3, 4) for i, u, h in rows], "page_id long, url string, html string, digest string, n long, file string, offset long, last long, refers_to long").repartition(3)
    got = sorted(((r.page_id, r.url, r.payload_bytes, r.record_type, r.refers_to) for r in warc.archive_round_trip(spark, pages).collect()), key=str)
    assert got == sorted([(4, "u", 1200, "response", None)] * 2 + [(4, "v", 1200, "response", None), (3, "w", 1200, "revisit", 4), (2, "u", 2, "response", None), (2, "u", 2, "response", None), (None, "n", 1200, "response", None)], key=str)


def test_tasks_that_run_twice_leave_the_index_right(spark):
    from tessera.llm.common import fresh_path

    pages = spark.createDataFrame([(k, f"u{k}", f"page {k} " * (1 + k % 90)) for k in range(300)], "page_id long, url string, html string").repartition(4)
    folder = fresh_path(spark, "warc")
    first = warc.write_archives(warc.with_revisits(pages), folder, file_bytes=4000)
    # another attempt of every task, with its rows in another order, into the same folder
    second = warc.write_archives(warc.with_revisits(pages).repartition(3).sortWithinPartitions("url"), folder, file_bytes=4000)
    for index in (first, second):
        back = warc.read_archives(index, folder)
        assert {r.page_id: bytes(r.payload).decode() for r in back.collect()} == {k: f"page {k} " * (1 + k % 90) for k in range(300)}
    assert not {r.file for r in first.collect()} & {r.file for r in second.collect()}


def test_reading_back_has_tasks_by_the_archives_bytes(spark):
    from tessera.llm.common import fresh_path

    r = random.Random(2)
    pages = spark.createDataFrame([(k, "u", "".join(r.choices("abcdefghijklmnop", k=60_000))) for k in range(120)], "page_id long, url string, html string")
    folder = fresh_path(spark, "warc")
    index = warc.write_archives(warc.with_revisits(pages), folder, file_bytes=1 << 20)
    assert warc.read_archives(index, folder).rdd.getNumPartitions() >= 3


def test_selected_records_are_read_by_their_ranges(spark):
    from tessera.llm.common import fresh_path

    pages = spark.createDataFrame([(k, f"u{k}", f"page {k} " * 50) for k in range(200)], "page_id long, url string, html string")
    folder = fresh_path(spark, "warc")
    index = warc.write_archives(warc.with_revisits(pages), folder, file_bytes=4000)
    assert index.select("file").distinct().count() > 3
    some = warc.read_archives(index.where("page_id % 7 = 0"), folder, gap=10).collect()
    assert {r.page_id: bytes(r.payload).decode() for r in some} == {k: f"page {k} " * 50 for k in range(0, 200, 7)}


def simulated_votes(seed=1, n=6000):
    """Labels, and voters of known accuracy that abstain now and then; the last one repeats the first nine times in ten."""
    r = np.random.default_rng(seed)
    y = (r.random(n) < 0.3).astype(int)
    accuracy = np.array([0.9, 0.85, 0.8, 0.75, 0.7])
    right = r.random((n, 5)) < accuracy
    votes = np.where(right, 2 * y[:, None] - 1, 1 - 2 * y[:, None])
    votes[r.random((n, 5)) < 0.2] = 0
    again = np.where(r.random(n) < 0.9, votes[:, 4], np.where(r.random(n) < 0.5, 1, -1))
    return y, np.hstack([votes, again[:, None]]), accuracy


def test_label_model_finds_accuracies_and_correlations():
    y, votes, accuracy = simulated_votes()
    posterior, found, correlations = toxicity.label_model(votes, 0.3)
    assert np.abs(found[:5] - accuracy).max() < 0.05
    pairs = {(i, j): correlations[i, j] for i in range(6) for j in range(i)}
    assert max(pairs, key=pairs.get) == (5, 4) and pairs[5, 4] > 0.5 and all(v < 0.3 for k, v in pairs.items() if k != (5, 4))
    # as good as the posterior of the true accuracies, the copy left out, and better than a plain majority
    odds = np.log(0.3 / 0.7) + votes[:, :5] @ np.log(accuracy / (1 - accuracy))
    best, got, majority = ((odds > 0) == y).mean(), ((posterior > 0.5) == y).mean(), ((votes.sum(1) > 0) == y).mean()
    assert got > best - 0.01 and got > majority
    # labels of a development set make it no worse
    assert ((toxicity.label_model(votes, 0.3, y.astype(float))[0] > 0.5) == y).mean() > best - 0.01


def test_linear_classifier_is_the_minimum_of_its_loss():
    r = np.random.default_rng(2)
    x = (r.random((400, 6)) < 0.3).astype(float)
    target = 1 / (1 + np.exp(-(x @ r.normal(size=6) * 2 - 0.5)))
    w, b = toxicity.linear(x, target, ridge=0.05)
    p = 1 / (1 + np.exp(-(x @ w + b)))
    assert np.abs(x.T @ (p - target) + 0.05 * w).max() < 1e-4 and abs((p - target).sum() + 1e-3 * b) < 1e-4

    def loss(v):
        z = x @ v[:-1] + v[-1]
        return (np.logaddexp(0, z) - target * z).sum() + 0.025 * (v[:-1] ** 2).sum() + 0.0005 * v[-1] ** 2

    own = np.r_[w, b]
    assert all(loss(own) < loss(own + r.normal(size=7) * 0.05) for _ in range(50))


def test_scores_keep_all_columns(spark):
    rows = made(9)
    model = toxicity.Model({"aa": ((0, 1),)}, np.array([9.0, 0.0, 0.0, 0.0, 0.0, 0.0]), -3.0, np.zeros(0), np.zeros((0, 0)))
    kept = toxicity.score(frame(spark, rows), model, keep=True, score_col="points")
    assert kept.columns == [*(c.split()[0] for c in CLASH.split(", ")), "points"]
    assert sorted((r.id, r.points > 0.5) for r in kept.collect()) == [(k, "aa" in (t or "").lower().split()) for k, (_, t) in enumerate(rows)]
    with pytest.raises(ValueError):
        toxicity.score(frame(spark, rows), model, keep=True, score_col="size")


def test_toxicity(spark):
    r = random.Random(9)
    words = ["".join(r.choice("abcdefg") for _ in range(5)) for _ in range(300)]
    bad = ["vilest", "rotten", "zzstem"]
    rows, labels = [], []
    for k in range(900):
        toxic = k % 8 == 0
        w = [r.choice(words) for _ in range(r.randint(20, 60))]
        if toxic:
            for _ in range(3):
                w.insert(r.randrange(len(w)), r.choice([bad[0], bad[1], bad[2] + r.choice(words)]))
        rows.append((k, " ".join(w)))
        labels.append((k, int(toxic)))
    rows += [(5000, None), (5001, ""), (None, "x")]
    named = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity.toxicity(frame(spark, rows), named).collect()
    truth = dict(labels)
    held = [g for g in got if g.doc_id in truth and g.held_out]
    assert len(held) > 100 and sum(g.predicted != truth[g.doc_id] for g in held) <= 3
    assert all(g.held_out == (zlib.crc32(str(g.doc_id).encode()) % 5 == 0) for g in got if g.doc_id is not None)
    assert all(0 <= g.score <= 1 and g.predicted == (g.score >= 0.5) for g in got) and len(got) == len(rows)
    assert toxicity.toxicity(empty(spark), named.limit(0)).count() == 0
    assert {g.predicted for g in toxicity.toxicity(frame(spark, rows[:50]), named.limit(0)).collect()} == {0}
