"""Suffix-array dedup: blockwise suffix sorting with a difference cover.

A byte goes if a string of `length` bytes that covers it also starts earlier.  Each window
of that length falls into one bucket: that of its minimiser, the smallest hash of its
32-byte strings (leftmost on ties).  Equal windows have equal minimisers at equal places, so
buckets are independent, and a minimiser that occurs once in the corpus settles its windows
without any text.  Windows that follow one another with the same minimiser form a run, and
travel as one row.

1. Runs that are equal as a whole, bytes and all, are settled by their hashes: the earliest
   stays.  Mappers settle what they meet before the shuffle; what arrives is streamed.
2. Runs that share a minimiser but differ go on as text, bucket by bucket, and their
   suffixes are sorted one bucket block at a time: first by `PERIOD` bytes, then, where that
   ties, by the precomputed rank of the next cover sample.

No bucket is larger than a worker can sort.  Minimisers in very many documents (found in a
bounded sample; a matter of speed alone) have their runs dealt out window by window, by each
window's own hash and the minimiser's, before step 1; those that still have more than `WIDE`
different runs after it, before step 2.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import bytes_of, forget_shuffles, prefix_hash, release, span_hash, stored, stretches
from tessera.llm.spans import OPEN, RUNS, Mapper, cut, dealt, documents, earlier, gone_batch, settled, spans_of, whole_keys

LENGTH = 100
GRAM = 32
PERIOD = 32
#: Text of a block whose suffixes are sorted at a time; its arrays take about 150 times as much.
BLOCK_BYTES = 1 << 19
#: Documents of the sample that shows hot minimisers, and the share of them that makes one hot.
SAMPLE_DOCS, HOT_SHARE = 4000, 0.01

#: Contexts of a minimiser beyond which its windows are dealt out one by one: what one worker sorts at a time stays below that many.
WIDE = 4000


def difference_cover(v: int) -> np.ndarray:
    """Residues such that any two positions have a common shift below v into them: 0 to r - 1 and the multiples of r, r about the root of v."""
    r = max(1, int(np.ceil(np.sqrt(v))))
    return np.unique(np.r_[np.arange(r), np.arange(0, v, r)] % v)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each width values in a row."""
    done, out = 1, values
    while done * 2 <= width:
        out = np.minimum(out[:-done], out[done:])
        done *= 2
    return np.minimum(out[: len(out) - (width - done)], out[width - done :]) if width > done else out


def runs_of(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...] | None:
    """Runs of windows of a block: first window, number of windows, place of the minimiser; then hashes of grams and prefix sums."""
    n = len(data)
    if n < length:
        return None
    sums = prefix_hash(data)
    at = np.arange(n - gram + 1)
    grams = span_hash(sums, at, at + gram)
    bits = np.uint64(max(22, int(n).bit_length()))
    low = (np.uint64(1) << bits) - np.uint64(1)
    least = sliding_min((grams & ~low) | at.astype(np.uint64), length - gram + 1)
    ends = np.repeat(offsets[1:], np.diff(offsets))[: n - length + 1]
    valid = np.flatnonzero(np.arange(n - length + 1) + length <= ends)
    if not len(valid):
        return None
    places = (least[valid] & low).astype(np.int64)
    new = np.flatnonzero(np.r_[True, (np.diff(places) != 0) | (np.diff(valid) != 1)])
    first = valid[new]
    return first, np.diff(np.r_[new, len(valid)]), places[new], grams, sums


def hot_grams(own: DataFrame, length: int, gram: int) -> np.ndarray:
    """Minimisers in at least HOT_SHARE of a sample's documents, at most (runs of a document) / HOT_SHARE of them."""
    rows = own.count()
    if not rows:
        return np.zeros(0, np.int64)
    sample = own.select("_id", "_text").where(F.pmod(F.xxhash64("_id"), F.lit(1_000_000)) < int(min(1.0, SAMPLE_DOCS / rows) * 1_000_000))

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets, _ in stretches(batch.column(1), length - 1):
                if found := runs_of(data, offsets, length, gram):
                    first, _, places, hashes, _ = found
                    each = np.unique(np.stack([np.searchsorted(offsets, first, "right"), hashes[places].view(np.int64)]), axis=1)
                    yield pa.RecordBatch.from_arrays([pa.array(each[1])], names=["gram"])

    least = max(40, int(min(rows, SAMPLE_DOCS) * HOT_SHARE))
    counted = sample.mapInArrow(grams, "gram long").groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    return np.sort(np.array([r["gram"] for r in counted.select("gram").collect()], np.int64))


def each_window(count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of count windows window by window: each one's run, and its place in the run."""
    run = np.repeat(np.arange(len(count)), count)
    return run, np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count)


def repeated_spans(own: DataFrame, length: int = LENGTH) -> DataFrame:
    """Spans (_doc, _dig, _begin, _end) whose union is every byte covered by a string of length bytes that also starts earlier; own: from documents()."""
    if not 24 <= length <= 256:
        raise ValueError("strings of 24 to 256 bytes can be compared")
    spark = own.sparkSession
    gram = min(GRAM, max(8, length // 3))
    hot = spark.sparkContext.broadcast(hot_grams(own, length, gram))
    said = lambda count, lead: count << 8 | lead
    count_of, lead_of = (lambda place: place >> 10 & 1023), (lambda place: place >> 2 & 255)
    end_of = lambda place: (place >> 20) + count_of(place) + (length - 1)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mapper = Mapper()
        for batch in batches:
            ids, digs = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for i, j, data, offsets, base in stretches(batch.column(2), length - 1):
                found = runs_of(data, offsets, length, gram)
                if not found:
                    continue
                first, count, places, grams, sums = found
                row = np.searchsorted(offsets, first, "right") - 1
                key, ctx, lead = grams[places], span_hash(sums, first, first + count + length - 1), places - first
                doc, dig, at = ids[i:j][row], digs[i:j][row], first - offsets[row] + base
                if len(hot.value):
                    where = np.minimum(np.searchsorted(hot.value, key.view(np.int64)), len(hot.value) - 1)
                    wide = np.flatnonzero(hot.value[where] == key.view(np.int64))
                    if len(wide):
                        order, new, later = earlier((key[wide], ctx[wide]), doc[wide], dig[wide], at[wide])
                        gone, stay = wide[order[later]], wide[order[new]]
                        yield gone_batch(doc[gone], dig[gone], at[gone], at[gone] + count[gone] + (length - 1))
                        run, step = each_window(count[stay])
                        run = stay[run]
                        window = span_hash(sums, first[run] + step, first[run] + step + length)
                        yield from mapper.add(window, key[run], doc[run], dig[run], at[run] + step, at[run] + step + length, said(np.ones(len(run), np.int64), 0))
                        rest = np.ones(len(key), bool)
                        rest[wide] = False
                        key, ctx, doc, dig, at, count, lead = (x[rest] for x in (key, ctx, doc, dig, at, count, lead))
                yield from mapper.add(key, ctx, doc, dig, at, at + count + (length - 1), said(count, lead))
        yield from mapper.flush()

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return settled(batches, end_of, True)

    def settle_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return settled(batches, end_of, False)

    first_pass = stored(dealt(own.mapInArrow(split, RUNS)).mapInArrow(settle, RUNS), "suffix-runs")
    forget_shuffles(spark)
    open_ = first_pass.where(F.col("place").bitwiseAND(3) == OPEN)
    counts = stored(open_.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > WIDE).select(F.col("key").alias("wide")), "suffix-wide")
    parts = [spans_of(first_pass)]

    def asked(runs: DataFrame) -> DataFrame:
        """Documents and what of them is open; a document's runs are bounded by its length."""
        listed = runs.groupBy("doc", "dig").agg(F.collect_list("key").alias("keys"), F.collect_list("place").alias("places"))
        return own.join(listed.hint("merge"), (F.col("_id") == F.col("doc")) & (F.col("_dig") == F.col("dig"))).select("_id", "_dig", "_text", "keys", "places")

    def runs_in(batch: pa.RecordBatch, most: int = 20_000) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
        """For each document of asked() and each most of its runs: its id and hash, its bytes, keys and places."""
        data, offsets = bytes_of(batch.column(2))
        for k, (doc, dig) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
            keys, places = batch.column(3)[k].values.to_numpy(), batch.column(4)[k].values.to_numpy()
            for i in range(0, len(keys), most):
                yield doc, dig, data[offsets[k] : offsets[k + 1]], keys[i : i + most], places[i : i + most]

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, dig, data, keys, places in runs_in(batch):
                raw, begin = data.tobytes(), places >> 20
                cuts = [raw[b:e] for b, e in zip(begin.tolist(), end_of(places).tolist())]
                same = np.ones(len(keys), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(doc * same), pa.array(dig * same), pa.array(places), pa.array(cuts, pa.binary())], names=["key", "doc", "dig", "place", "bytes"])

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Open runs of wide keys as windows, by their own hashes."""
        mapper = Mapper()
        for batch in batches:
            for doc, dig, data, keys, places in runs_in(batch):
                order = np.argsort(places, kind="stable")
                for low in range(0, len(order), 4096):
                    mine = order[low : low + 4096]
                    begin, end = places[mine] >> 20, end_of(places[mine])
                    base = int(begin[0])
                    sums = prefix_hash(data[base : int(end.max())])
                    run, step = each_window(count_of(places[mine]))
                    at = begin[run] + step
                    key, same = span_hash(sums, at - base, at - base + length), np.ones(len(at), np.int64)
                    yield from mapper.add(key, keys[mine][run].view(np.uint64), doc * same, dig * same, at, at + length, said(same, 0))
        yield from mapper.flush()

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_keys(batches, "key", lambda b: b.nbytes, BLOCK_BYTES):
            yield _repeated_in_block(table, length, count_of, lead_of)

    if not counts.isEmpty():
        # merge joins, which split a skewed key, and a key in very many rows is what this is for
        wide = open_.join(counts.hint("merge"), F.col("key") == F.col("wide"), "left_semi")
        parts.append(spans_of(dealt(asked(wide).mapInArrow(windows, RUNS)).mapInArrow(settle_windows, RUNS)))
        open_ = open_.join(counts.hint("merge"), F.col("key") == F.col("wide"), "left_anti")
    deep = asked(open_).mapInArrow(texts, "key long, doc long, dig long, place long, bytes binary")
    parts.append(deep.repartition("key").sortWithinPartitions("key").mapInArrow(sort, "_doc long, _dig long, _begin long, _end long"))
    spans = stored(reduce(DataFrame.unionByName, parts), "suffix-spans")
    release(first_pass, counts)
    del deep, open_, parts
    forget_shuffles(spark)
    return spans


def words_of(text: np.ndarray) -> np.ndarray:
    """Each 8 bytes in a row as a big-endian number; text has 8 bytes to spare."""
    out = np.zeros(len(text) - 8, np.uint64)
    for k in range(8):
        out |= text[k : k + len(out)].astype(np.uint64) << np.uint64(56 - 8 * k)
    return out


def refine(group: np.ndarray, words: np.ndarray, at: np.ndarray, steps: range) -> tuple[np.ndarray, np.ndarray]:
    """Sort positions by group, then by the words at the steps: order and the dense rank of each position.

    Only positions whose rank another one shares are looked at again.
    """
    n = len(at)
    order = np.argsort(group, kind="stable")
    rank = np.zeros(n, np.int64)
    if n:
        rank[order] = np.cumsum(np.r_[0, np.diff(group[order]) != 0])
    for step in steps:
        size = np.bincount(rank, minlength=n)
        tied = np.flatnonzero(size[rank] > 1)
        if not len(tied):
            break
        w = words[at[tied] + step]
        inner = np.lexsort((w, rank[tied]))
        r, w = rank[tied][inner], w[inner]
        fresh = np.r_[False, (np.diff(r) == 0) & (np.diff(w.view(np.int64)) != 0)]
        # ranks become sparse: a group's first rank plus the place of the subgroup in it
        head = np.flatnonzero(np.r_[True, np.diff(r) != 0])
        inside = np.cumsum(fresh) - np.repeat(np.cumsum(fresh)[head], np.diff(np.r_[head, len(r)]))
        scaled = np.zeros(n, np.int64)
        scaled[tied[inner]] = inside
        order = np.lexsort((scaled, rank))
        both = np.stack([rank[order], scaled[order]])
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.r_[0, (np.diff(both, axis=1) != 0).any(0)])
    return np.argsort(rank, kind="stable"), rank


def cover_ranks(words: np.ndarray, text: np.ndarray, at: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted cover-sample suffixes and the length of each one's common beginning with the one before (up to depth)."""
    order, _ = refine(np.zeros(len(at), np.int64), words, at, range(0, depth, 8))
    common = np.zeros(len(at), np.int64)
    if len(at) > 1:
        a, b = at[order[1:]], at[order[:-1]]
        alive = np.arange(len(a))
        for step in range(0, depth, 8):
            x = words[a[alive] + step] ^ words[b[alive] + step]
            same = x == 0
            left = x[~same]
            lead = np.zeros(len(left), np.int64)
            for s in range(7):
                lead += left >> np.uint64(56 - 8 * s) == 0
            common[1 + alive[~same]] = step + lead
            alive = alive[same]
        common[1 + alive] = depth
    return order, common


def _repeated_in_block(table: pa.Table, length: int, count_of: Callable[[np.ndarray], np.ndarray], lead_of: Callable[[np.ndarray], np.ndarray]) -> pa.RecordBatch:
    """Spans of a block of whole buckets that a window earlier in (doc, place) repeats."""
    key, doc, dig, place = (table.column(k).to_numpy() for k in ("key", "doc", "dig", "place"))
    data, offsets = bytes_of(table.column("bytes").combine_chunks() if isinstance(table.column("bytes"), pa.ChunkedArray) else table.column("bytes"))
    at, count, lead = place >> 20, count_of(place), lead_of(place)
    sizes = np.diff(offsets)
    # each context is laid out so that its minimiser stands at a multiple of the period
    shift = -lead % PERIOD
    room = (shift + sizes + PERIOD - 1) // PERIOD * PERIOD
    base = np.cumsum(np.r_[0, room[:-1]]) + shift
    text = np.zeros(int(room.sum()) + length + 24, np.uint8)
    text[np.repeat(base - np.r_[0, np.cumsum(sizes)[:-1]], sizes) + np.arange(int(sizes.sum()))] = data[offsets[0] : offsets[-1]]
    words = words_of(text)
    cover = difference_cover(PERIOD)
    jump = np.array([min((c - r) % PERIOD for c in cover) for r in range(PERIOD)])
    run, step = each_window(count)
    suffix = base[run] + step
    # a bucket: windows of one minimiser that have it at the same place
    offset_in = lead[run] - step
    _, key_rank = np.unique(key, return_inverse=True)
    bucket = key_rank[run].astype(np.int64) * (length + 1) + offset_in
    delta = jump[suffix % PERIOD]
    # shallow: the first PERIOD bytes; deep: the rank of the next cover sample
    _, rank = refine(bucket, words, suffix, range(0, PERIOD, 8))
    tied = np.flatnonzero(np.bincount(rank, minlength=len(rank))[rank] > 1)
    samples, of = np.unique(suffix[tied] + delta[tied], return_inverse=True)
    order, common = cover_ranks(words, text, samples, length + 4)
    where = np.empty(len(samples), np.int64)
    where[order] = np.arange(len(samples))
    deep = np.zeros(len(tied), np.int64)
    for d in np.unique(delta[tied]):
        mine = delta[tied] == d
        # ranks that agree on length - d bytes are one
        deep[mine] = np.cumsum(common < length - d)[where[of[mine]]]
    sorted_, _, later = earlier((rank[tied], deep), doc[run[tied]], dig[run[tied]], at[run[tied]] + step[tied])
    gone = tied[sorted_[later]]
    begin = at[run[gone]] + step[gone]
    out = gone_batch(doc[run[gone]], dig[run[gone]], begin, begin + length)
    return pa.RecordBatch.from_arrays([out.column(2), out.column(3), pa.array(out.column(4).to_numpy() >> 20), out.column(1)], names=["_doc", "_dig", "_begin", "_end"])


def suffix_dedup(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", keep: bool = False) -> DataFrame:
    """Remove each byte covered by a length-byte string that also starts earlier (smaller document, or same document, earlier start).

    Strings never cross documents and are judged on the input.  With keep: docs with their
    texts cut; else (id, n_bytes, n_removed, n_spans, kept_sha256).  Null or empty text:
    nothing to remove.  Null id: untouched.  Ids that aren't integers: a TypeError.
    Repeated rows (same id and text) count as one document, each with its spans; different
    texts of one id are documents one after another, by a hash of the text.  Empty table:
    no rows.  Other columns go along with keep, whatever their names.
    """
    own, dig = documents(docs, id_col, text_col)
    return cut(docs, repeated_spans(own, length), dig, id_col, text_col, keep)
