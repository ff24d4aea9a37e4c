"""Byte spans of texts: settling equal strings by their first place, and cutting spans out."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import BASE, integer_id, mix, portions, text_batches

#: A string of a document by two hashes.  doc and dig name the document; place has where the string begins, what
#: else an operator says of it (18 bits), and a kind.  A string that is settled has its end as ctx.
RUNS = "key long, ctx long, doc long, dig long, place long"
RUN, GONE, OPEN = 0, 1, 2
#: Strings among which a mapper settles repeats before the shuffle: so many times fewer rows of a frequent one travel.
SETTLE = 1 << 17


def documents(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, Column]:
    """(_id, _dig, _text) of rows with an id, and the expression of _dig over a column _text.

    A document is an id and a text: rows that share both are one.  Where ids repeat, texts
    of one id are told apart, and ordered, by a hash; else there is nothing to tell apart
    and _dig is 0.
    """
    integer_id(docs, id_col)
    text_batches(docs.sparkSession)
    own = docs.select(F.col(f"`{id_col}`").cast("long").alias("_id"), F.col(f"`{text_col}`").alias("_text")).where("_id is not null")
    unique = own.groupBy("_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()
    dig = F.lit(0).cast("long") if unique else F.xxhash64(F.coalesce("_text", F.lit("")))
    return own.select("_id", dig.alias("_dig"), "_text"), dig


def run_batch(key: np.ndarray, ctx: np.ndarray, doc: np.ndarray, dig: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(ctx.view(np.int64)), pa.array(doc), pa.array(dig), pa.array(place)], names=["key", "ctx", "doc", "dig", "place"])


def gone_batch(doc: np.ndarray, dig: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
    """Spans that are settled, those that touch put together.  They need no key; their own place deals them out evenly."""
    order = np.lexsort((begin, dig, doc))
    doc, dig, begin, end = doc[order], dig[order], begin[order], end[order]
    if len(doc):
        same = (doc[1:] == doc[:-1]) & (dig[1:] == dig[:-1])
        group = np.cumsum(np.r_[0, ~same])
        # ends grow with begins inside a document once the largest so far counts; documents are kept apart by a large step
        reach = np.maximum.accumulate(end + group * (np.int64(1) << 40)) - group * (np.int64(1) << 40)
        new = np.flatnonzero(np.r_[True, ~same | (begin[1:] > reach[:-1])])
        doc, dig, begin, end = doc[new], dig[new], begin[new], reach[np.r_[new[1:] - 1, len(reach) - 1]]
    return run_batch(mix(doc.view(np.uint64) * np.uint64(BASE) + begin.astype(np.uint64)), end, doc, dig, begin << 20 | GONE)


def earlier(order_keys: tuple[np.ndarray, ...], doc: np.ndarray, dig: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sort by keys, then document and place: the order, where groups begin, and whether a row comes after its group's first (not only beside it)."""
    order = np.lexsort((at, dig, doc, *order_keys[::-1]))
    new = np.zeros(len(order), bool)
    if len(order):
        new[0] = True
        for k in order_keys:
            sorted_ = k[order]
            new[1:] |= sorted_[1:] != sorted_[:-1]
    group = np.cumsum(new) - 1
    head = np.flatnonzero(new)[group] if len(order) else group
    doc, dig, at = doc[order], dig[order], at[order]
    later = (doc != doc[head]) | (dig != dig[head]) | (at != at[head])
    return order, new, later


class Mapper:
    """A mapper's strings, collected until there are SETTLE of them; then repeats are settled and one of each goes on."""

    def __init__(self):
        self.held: list[tuple[np.ndarray, ...]] = []
        self.count = 0

    def add(self, key: np.ndarray, ctx: np.ndarray, doc: np.ndarray, dig: np.ndarray, at: np.ndarray, end: np.ndarray, said: np.ndarray) -> Iterator[pa.RecordBatch]:
        """said: up to 18 bits each."""
        self.held.append((key, ctx, doc, dig, at, end, said))
        self.count += len(key)
        if self.count >= SETTLE:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.held:
            return
        key, ctx, doc, dig, at, end, said = (np.concatenate(c) for c in zip(*self.held))
        self.held, self.count = [], 0
        order, new, later = earlier((key, ctx), doc, dig, at)
        gone, stay = order[later], order[new]
        yield gone_batch(doc[gone], dig[gone], at[gone], end[gone])
        yield run_batch(key[stay], ctx[stay], doc[stay], dig[stay], at[stay] << 20 | said[stay] << 2)


def dealt(runs: DataFrame) -> DataFrame:
    """runs by key, in order.  A string in very many documents is at most one row for each SETTLE strings of the input here."""
    return runs.repartition("key").sortWithinPartitions("key", "ctx", "doc", "dig", "place")


def settled(batches: Iterator[pa.RecordBatch], end_of: Callable[[np.ndarray], np.ndarray], several: bool) -> Iterator[pa.RecordBatch]:
    """dealt() rows settled as they stream by, whatever a key's number of rows: GONE rows for all that come after a string's first.

    With several, also the firsts of keys that have several strings, as OPEN rows. end_of:
    ends, from places.
    """
    names = ("key", "ctx", "doc", "dig", "place")
    last: list[np.ndarray] | None = None
    last_open = False
    for batch in batches:
        columns = [batch.column(k).to_numpy() for k in range(5)]
        done = columns[4] & 3 == GONE
        if done.any():
            yield pa.RecordBatch.from_arrays([pa.array(c[done]) for c in columns], names=names)
            columns = [c[~done] for c in columns]
        if not len(columns[0]):
            continue
        if last is not None:
            columns = [np.concatenate(two) for two in zip(last, columns)]
        key, ctx, doc, dig, place = columns
        new = np.r_[True, (key[1:] != key[:-1]) | (ctx[1:] != ctx[:-1])]
        heads = np.flatnonzero(new)
        head, at = heads[np.cumsum(new) - 1], place >> 20
        later = (doc != doc[head]) | (dig != dig[head]) | (at != at[head])
        if later.any():
            yield gone_batch(doc[later], dig[later], at[later], end_of(place[later]))
        many = np.zeros(len(heads), bool)
        same = key[heads[1:]] == key[heads[:-1]]
        many[1:] |= same
        many[:-1] |= same
        many[0] |= last_open
        if several:
            first = heads[:-1][many[:-1]]
            yield run_batch(key[first], ctx[first], doc[first], dig[first], place[first] | OPEN)
        # the last string may go on in the next batch
        last, last_open = [c[heads[-1:]] for c in columns], bool(many[-1])
    if several and last_open:
        yield run_batch(*last[:4], last[4] | OPEN)


def spans_of(runs: DataFrame) -> DataFrame:
    """(_doc, _dig, _begin, _end) of GONE rows."""
    return runs.where(F.col("place").bitwiseAND(3) == GONE).select(F.col("doc").alias("_doc"), F.col("dig").alias("_dig"), F.shiftright("place", 20).alias("_begin"), F.col("ctx").alias("_end"))


def union_of(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of half-open spans as sorted, disjoint spans that don't touch."""
    if not len(begin):
        return begin, end
    order = np.argsort(begin, kind="stable")
    begin, end = begin[order], np.maximum.accumulate(end[order])
    new = np.flatnonzero(np.r_[True, begin[1:] > end[:-1]])
    return begin[new], end[np.r_[new[1:] - 1, len(end) - 1]]


def cut(docs: DataFrame, spans: DataFrame, dig: Column, id_col: str, text_col: str, keep: bool) -> DataFrame:
    """Cut spans (_doc, _dig, _begin, _end; bytes) out of the texts; dig: from documents().

    With keep: all columns of docs, their text cut.  Else (id, n_bytes, n_removed, n_spans,
    kept_sha256).  A document's spans are together in one row: their number is bounded by
    the document's own length.  A character that is cut in part goes from a kept text.
    """
    listed = spans.groupBy("_doc", F.col("_dig").alias("_of")).agg(F.collect_list("_begin").alias("_begin"), F.collect_list("_end").alias("_end"))
    wanted = docs if keep else docs.select(id_col, text_col)
    own = wanted.schema
    # a row goes as one struct, so that no name of its columns meets those here
    rows = wanted.select(F.struct(*[F.col(f"`{c}`") for c in own.fieldNames()]).alias("_row"), F.col(f"`{id_col}`").cast("long").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    rows = rows.select("_row", "_id", dig.alias("_dig"))
    # a merge join at every size: both sides grow with the input
    joined = rows.join(listed.hint("merge"), (F.col("_id") == F.col("_doc")) & (F.col("_dig") == F.col("_of")), "left").select("_row", "_begin", "_end")
    place = own.fieldNames().index(text_col)
    extra = [] if keep else [T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()), T.StructField("kept_sha256", T.StringType())]
    schema = own if keep else T.StructType([own[id_col], *extra])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, lambda b: b.column(0).field(place)):
            own_columns, begins, ends = [batch.column(0).field(i) for i in range(len(own))], batch.column(1), batch.column(2)
            rows, texts = [], []
            for k, text in enumerate(own_columns[place].to_pylist()):
                raw = (text or "").encode("utf-8", "surrogatepass")
                b, e = begins[k].as_py(), ends[k].as_py()
                if not b:
                    texts.append(text)
                    rows.append((len(raw), 0, 0, None if keep else hashlib.sha256(raw).hexdigest()))
                    continue
                b, e = union_of(np.array(b, np.int64), np.array(e, np.int64))
                cuts = np.r_[0, np.stack([b, e], 1).reshape(-1), len(raw)].tolist()
                kept = b"".join(raw[i:j] for i, j in zip(cuts[::2], cuts[1::2]))
                if keep:
                    texts.append(kept.decode("utf-8", "ignore"))
                else:
                    rows.append((len(raw), int((e - b).sum()), len(b), hashlib.sha256(kept).hexdigest()))
            if keep:
                columns = [pa.array(texts, pa.string()) if i == place else own_columns[i] for i in range(len(own))]
                yield pa.RecordBatch.from_arrays(columns, names=own.fieldNames())
            elif rows:
                yield pa.RecordBatch.from_arrays([own_columns[own.fieldNames().index(id_col)], *(pa.array(list(c)) for c in zip(*rows))], names=schema.names)

    return joined.mapInArrow(run, schema)


def whole_keys(batches: Iterator[pa.RecordBatch], key: str, weight: Callable[[pa.Table], int], limit: int) -> Iterator[pa.Table]:
    """Rows that come sorted by key, in tables of whole keys that weigh about limit."""
    held: list[pa.RecordBatch] = []
    total = 0
    for batch in (b.slice(i, 1000) for b in batches for i in range(0, b.num_rows, 1000)):
        held.append(batch)
        total += weight(batch)
        if total < limit:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        keys = table.column(key).to_numpy()
        at = int(np.searchsorted(keys, keys[-1], "left"))
        if at:
            yield table.slice(0, at)
            held = table.slice(at).combine_chunks().to_batches()
            total = sum(map(weight, held))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()
