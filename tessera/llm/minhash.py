"""Near-dedup by one-permutation MinHash with optimal densification.

1. Each text's set of word shingles gives one sketch: the smallest hash of each of BINS
   bins; empty bins borrow from a bin chosen by their own hash sequence.
2. Texts with equal sets are one class from here on.  A class's sketch gives BANDS bucket
   keys of ROWS bins.
3. In a bucket, classes aren't paired with one another: each is paired with the bucket's
   centre, the class that shares most buckets with others (the base of a group of near
   copies).  Pairs are verified on full sets.
4. Buckets whose members are still in several components get more centres, chosen by hash,
   MORE_CENTRES times as many a round, until each member outside the component of the first
   centre has been one.  So each pair of a bucket is verified or in one component, or can't
   be similar: by its sizes, or by how many bits differ between its sets' parities.
5. Connected components of the verified links.

Candidates grow with the classes where centres settle a bucket, and with the pairs of classes
that are in different components where they don't.  Two classes at the threshold share no
bucket with a chance of (1 - 0.85**4)**24, about 1e-8 (at 0.8, 3e-6).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import blocks, forget_shuffles, integer_id, mix, prefix_hash, release, span_hash, stored, text_batches

BANDS, ROWS = 24, 4
BINS = BANDS * ROWS
MORE_CENTRES = 4
#: 64-bit words of a set's parities.
PARITY = 16
PROBES = 128
#: Parts that a component's nodes are dealt out in where they get another name.
SALTS = 32

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_STEP = np.uint64(0x9FB21C651E98DF25)


#: Bytes of a very long text that are hashed at a time.
STRETCH = 1 << 21


def _word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a block's texts, end to end, and their n + 1 offsets."""
    data = _LOWER[data]
    space = _SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    solid = ~space
    first = solid & (edge[:-1] | np.r_[True, space[:-1]])
    last = solid & (edge[1:] | np.r_[space[1:], True])
    begins, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return span_hash(prefix_hash(data), begins, ends), np.searchsorted(begins, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """_word_hashes(), one very long text in stretches that end at white space, so that their arrays stay small."""
    if len(offsets) != 2 or len(data) <= 2 * STRETCH:
        return _word_hashes(data, offsets)
    out, begin = [], 0
    while begin < len(data):
        end = begin + STRETCH
        while end < len(data) and not _SPACE[data[end]]:
            # the next white space, looked for a stretch at a time
            found = np.flatnonzero(_SPACE[data[end : end + STRETCH]])
            end += int(found[0]) if len(found) else STRETCH
        end = min(end, len(data))
        out.append(_word_hashes(data[begin:end], np.array([0, end - begin]))[0])
        begin = end
    h = np.concatenate(out)
    return h, np.array([0, len(h)])


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of a block's texts, end to end, and their n + 1 offsets.

    Words are runs of other bytes than white space, A-Z in lower case; a text of fewer
    words than a shingle has is one shingle.
    """
    n = len(offsets) - 1
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(n + 1, np.int64)
    h, cuts = word_hashes(data, offsets)
    count = np.diff(cuts)
    row = np.repeat(np.arange(n), count)
    left = np.repeat(cuts[1:], count) - np.arange(len(h))  # words from here to the text's end
    out = h.copy()
    for k in range(1, words):
        more = np.flatnonzero(left > k)
        out[more] = mix(out[more] * _STEP + h[more + k] + np.uint64(k))
    whole = (left >= words) | ((count[row] < words) & (left == count[row]))
    out, row = out[whole], row[whole]
    order = np.lexsort((out, row))
    out, row = out[order], row[order]
    new = np.r_[True, (out[1:] != out[:-1]) | (row[1:] != row[:-1])] if len(out) else np.zeros(0, bool)
    out, row = out[new], row[new]
    return out, np.searchsorted(row, np.arange(n + 1))


def sketches(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Texts by BINS smallest values, densified; undefined for empty sets."""
    n = len(offsets) - 1
    mixed = mix(hashes ^ np.uint64(0x5851F42D4C957F2D))
    bins = ((mixed >> np.uint64(32)) * np.uint64(BINS)) >> np.uint64(32)
    value = (mixed & np.uint64(0xFFFFFFFF)).astype(np.int64)
    none = np.int64(1) << 33
    out = np.full(n * BINS, none, np.int64)
    np.minimum.at(out, np.repeat(np.arange(n), np.diff(offsets)) * BINS + bins.astype(np.int64), value)
    out = out.reshape(n, BINS)
    full = out < none
    rows, empty = np.nonzero(~full & (np.diff(offsets) > 0)[:, None])
    dense = out.copy()
    for k in range(PROBES):
        if not len(rows):
            break
        probe = (mix(empty.astype(np.uint64) * np.uint64(1009) + np.uint64(k)) % np.uint64(BINS)).astype(np.int64)
        hit = full[rows, probe]
        dense[rows[hit], empty[hit]] = out[rows[hit], probe[hit]]
        rows, empty = rows[~hit], empty[~hit]
    for r, e in zip(rows.tolist(), empty.tolist()):
        filled = np.flatnonzero(full[r])
        dense[r, e] = out[r, filled[np.searchsorted(filled, e) % len(filled)]]
    return dense


def parities(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Texts by PARITY words: whether an odd number of hashes falls to each bit. As many bits as differ between two texts, so many hashes at least aren't in both."""
    n, bits = len(offsets) - 1, 64 * PARITY
    bit = (mix(hashes ^ np.uint64(0x2545F4914F6CDD1D)) % np.uint64(bits)).astype(np.int64)
    odd = np.bincount(np.repeat(np.arange(n), np.diff(offsets)) * bits + bit, minlength=n * bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).reshape(n, PARITY)


SEEDS = (0x1F83D9AB, 0x5BE0CD19137E2179)


def digest(hashes: np.ndarray, offsets: np.ndarray, seed: int) -> np.ndarray:
    """A hash of each set, whatever its order."""
    sums = np.r_[np.zeros(1, np.uint64), np.cumsum(mix(hashes ^ np.uint64(seed)), dtype=np.uint64)]
    return (sums[offsets[1:]] - sums[offsets[:-1]]).view(np.int64)


def _signatures(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in blocks(batch.column(1)):
                hashes, at = shingle_sets(data, offsets, words)
                n = np.diff(at)
                sketch = sketches(hashes, at).astype(np.uint64).reshape(j - i, BANDS, ROWS)
                keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (j - i, BANDS)).copy()
                for r in range(ROWS):
                    keys = mix(keys * _STEP + sketch[:, :, r])
                d0, d1 = (digest(hashes, at, s) for s in SEEDS)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(j - i + 1, dtype=np.int32) * BANDS), pa.array(keys.reshape(-1).view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), batch.column(2).slice(i, j - i), pa.array(n), pa.array(d0), pa.array(d1), lists], names=["id", "dig", "n", "d0", "d1", "bands"])

    return run


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in blocks(batch.column(1)):
                hashes, at = shingle_sets(data, offsets, words)
                lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(hashes.view(np.int64)))
                bits = pa.ListArray.from_arrays(pa.array(np.arange(j - i + 1, dtype=np.int32) * PARITY), pa.array(parities(hashes, at).reshape(-1)))
                # an id may have another text as well; the set that is asked for has this hash
                own = pa.array(digest(hashes, at, SEEDS[0]) == batch.column(2).slice(i, j - i).to_numpy())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), batch.column(2).slice(i, j - i), lists, bits], names=["id", "k", "hashes", "bits"]).filter(own)

    return run


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that links (a, b) reach, for every node in a link.

    Labels go down along links and then jump to their label's label; a component's rounds
    grow with the logarithm of its width.  Each round is a stored table.
    """
    both = stored(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    label = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component")), "labels")
    while True:
        near = both.join(label, F.col("b") == F.col("node")).groupBy("a").agg(F.min("component").alias("least"))
        lower = label.join(near, F.col("node") == F.col("a"), "left").select("node", "component", F.least("component", "least").alias("to"))
        target = label.select(F.col("node").alias("to"), F.col("component").alias("further"))
        after = stored(lower.join(target, "to", "left").select("node", F.least("to", "further").alias("component"), (F.least("to", "further") != F.col("component")).alias("moved")), "labels")
        done = after.where("moved").isEmpty()
        release(label)
        label, before = after.select("node", "component"), after
        label._stored_at = before._stored_at
        if done:
            release(both)
            return label


def joined(label: DataFrame, links: DataFrame) -> DataFrame:
    """components() of the links behind label and of these, from label, which is released.

    What is linked now are whole components, by their smallest nodes, so that the rounds go
    over the new links alone.
    """
    named = label.withColumnRenamed("node", "of")
    end = lambda rows, side: rows.join(named.hint("merge"), F.col(side) == F.col("of"), "left").withColumn(side, F.coalesce("component", side)).drop("of", "component")
    between = end(end(links.select("a", "b"), "a"), "b").where("a != b").distinct()
    wider = components(between)
    # a component may hold a third of all nodes: its rows are dealt out by node, too
    to = wider.select(F.col("node").alias("of"), F.col("component").alias("to"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = label.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int"))
    moved = salted.join(to.hint("merge"), (F.col("component") == F.col("of")) & (salted["salt"] == to["salt"]), "left").select("node", F.coalesce("to", "component").alias("component"))
    # a node that had no link before
    fresh = wider.select("node", "component").join(label.select("node").hint("merge"), "node", "left_anti")
    out = stored(moved.union(fresh), "joined")
    release(label, wider)
    return out


def near_duplicates(docs: DataFrame, words: int = 5, similar: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept): texts linked where 100 * intersection >= similar * union of their shingle sets.

    component_id: the smallest id reachable, itself included; kept: whether that is its
    own.  Texts without words, null or empty ones too: in a component of their own.  Null
    id: kept, without a component.  Ids that aren't integers: a TypeError.  Different texts
    of one id are linked by the id; each row gets the component of its own text.  Empty
    table: no rows.
    """
    out = _judged(docs, words, similar, id_col, text_col)
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), "kept")


def _judged(docs: DataFrame, words: int, similar: int, id_col: str, text_col: str) -> DataFrame:
    """(id, dig, n, component, kept): a row of near_duplicates() for each row, and its text's hash."""
    integer_id(docs, id_col)
    text_batches(docs.sparkSession)
    own = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"), F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("dig"))
    signed = stored(own.mapInArrow(_signatures(words), "id long, dig long, n long, d0 long, d1 long, bands array<long>"), "minhash")
    classes = stored(signed.where("n > 0 and id is not null").groupBy("d0", "d1", "n").agg(F.min("id").alias("id"), F.first("bands").alias("bands")), "classes")
    # a class is its first id and d0, as one id may be the first of several; links are between ids
    placed = classes.select("id", F.col("d0").alias("k"), "n", F.explode("bands").alias("h"))
    twice = stored(placed.groupBy("h").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "buckets")
    met = stored(placed.join(twice, "h"), "shared")
    weight = met.groupBy("id", "k").agg(F.sum("size").alias("weight"))
    shared = stored(met.join(weight, ["id", "k"]).select("h", "id", "k", "n", "weight"), "weighed")
    release(twice, met)
    wanted = shared.select("id", "k").distinct()
    # a merge join at every size: the ids wanted grow with the input and are never broadcast
    sets = stored(own.join(wanted.hint("merge"), "id").select("id", "text", "k").mapInArrow(_sets(words), "id long, k long, hashes array<long>, bits array<long>").dropDuplicates(["id", "k"]), "shingles")
    forget_shuffles(docs.sparkSession)
    scratch = [shared, sets]

    def pairs(rows: DataFrame, chosen: DataFrame, able=F.lit(True)) -> DataFrame:
        """Each row's pairs with its bucket's centres, where their sizes and components (and what else is asked) allow a new link."""
        apart = rows.join(chosen, "h").where((F.col("c") != F.col("to.c")) & (100 * F.least("n", "to.n") >= similar * F.greatest("n", "to.n")) & able)
        first = F.col("id") < F.col("to.id")
        low, high = (lambda c: F.when(first, F.col(c)).otherwise(F.col(f"to.{c}"))), (lambda c: F.when(first, F.col(f"to.{c}")).otherwise(F.col(c)))
        return apart.select(low("id").alias("a"), low("k").alias("ka"), high("id").alias("b"), high("k").alias("kb")).distinct()

    def verified(asked: DataFrame) -> DataFrame:
        left, right = sets.select(F.col("id").alias("a"), F.col("k").alias("ka"), F.col("hashes").alias("left")), sets.select(F.col("id").alias("b"), F.col("k").alias("kb"), F.col("hashes").alias("right"))
        met = asked.join(right.hint("merge"), ["b", "kb"]).join(left.hint("merge"), ["a", "ka"]).withColumn("i", F.size(F.array_intersect("left", "right")))
        return met.where(F.lit(100) * F.col("i") >= F.lit(similar) * (F.size("left") + F.size("right") - F.col("i"))).select("a", "b")

    heavy = F.struct("weight", -F.col("id"), "k")
    alone = shared.withColumn("c", F.col("id"))
    first = stored(alone.groupBy("h").agg(F.max_by(F.struct("id", "k", "n", "c"), heavy).alias("to")), "centres")
    asked = stored(pairs(alone, first), "asked")
    links = stored(verified(asked), "links")
    scratch += [first, asked, links]
    label = components(links)
    # of a pair, as many hashes at least are in one set only as parities differ
    differ = sum((F.bit_count(F.col("bits")[k].bitwiseXOR(F.col("to.bits")[k])) for k in range(PARITY)), F.lit(0))
    able = differ * (100 + similar) <= (100 - similar) * (F.col("n") + F.col("to.n"))
    centres, whole, open_ = 1, False, shared
    while not whole:
        centres *= MORE_CENTRES
        # buckets whose members are still in several components; a bucket in one component stays in one
        named = open_.join(label.withColumnRenamed("node", "id"), "id", "left").select("h", "id", "k", "n", "weight", F.coalesce("component", "id").alias("c"))
        named = stored(named, "named")
        mixed = named.groupBy("h").agg(F.min("c").alias("c0"), F.max("c").alias("c1"), F.max_by("c", heavy).alias("home"), F.count(F.lit(1)).alias("size")).where("c0 != c1")
        mixed = stored(mixed.select("h", "home", "size"), "mixed")
        largest = mixed.agg(F.max("size")).first()[0]
        if largest is None:
            release(named, mixed)
            break
        # of two members of different components, one at least isn't at home, and the last round has all of those as centres
        whole = centres >= largest
        rows = stored(named.join(mixed, "h").join(sets.select("id", "k", "bits").hint("merge"), ["id", "k"]), "apart")
        at = F.pmod(F.xxhash64("h", "id", "k"), F.col("size"))
        chosen = rows.where((F.col("c") != F.col("home")) & (at < centres)).select("h", F.struct("id", "k", "n", "c", "bits").alias("to"))
        more = stored(pairs(rows, chosen.hint("merge"), able).join(asked, ["a", "ka", "b", "kb"], "left_anti"), "asked")
        release(named, mixed)
        open_ = rows.select("h", "id", "k", "n", "weight")
        scratch += [more, rows]
        if more.isEmpty():
            continue
        asked = asked.union(more)
        found = stored(verified(more), "links")
        scratch.append(found)
        if not found.isEmpty():
            label = joined(label, found)
    known = classes.select("d0", "d1", F.col("n").alias("n_class"), F.col("id").alias("first")).join(label.withColumnRenamed("node", "first"), "first", "left")
    known = stored(known.select("d0", "d1", "n_class", F.coalesce("component", "first").alias("c")), "known")
    release(classes, label, *scratch)
    out = signed.select("id", "dig", "n", "d0", "d1").join(known.withColumnRenamed("n_class", "n"), ["d0", "d1", "n"], "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("c", "id"))
    return out.select("id", "dig", "n", component.alias("component"), F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))


def near_dedup(docs: DataFrame, words: int = 5, similar: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the near duplicates: of each component the documents with its smallest id stay.

    Rows with a null id stay, as do repeated rows (same id and text) of a document that
    stays.  Texts without words are no copies of one another and stay.  Empty table: no
    rows.  All columns go along, whatever their names.
    """
    name = uuid.uuid4().hex
    gone = _judged(docs, words, similar, id_col, text_col).where(~F.col("kept")).select(F.col("id").alias(f"_id_{name}"), F.col("dig").alias(f"_dig_{name}")).distinct()
    same = F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))) == F.col(f"_dig_{name}")
    return docs.join(gone.hint("merge"), (F.col(f"`{id_col}`").cast("long") == F.col(f"_id_{name}")) & same, "left_anti")
