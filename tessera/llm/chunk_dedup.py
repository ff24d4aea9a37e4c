"""Substring dedup by content-defined chunks: a gear rolling hash cuts, digests deduplicate."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tessera.llm.common import blocks, mix
from tessera.llm.spans import RUNS, Mapper, cut, dealt, documents, settled, spans_of

#: Bytes of a chunk: never below the least but at a text's end, never above the most; about LEAST + 2**BITS on average.
LEAST, MOST, BITS = 48, 384, 5
#: The hash has 32 bits, so that a byte leaves it 32 bytes on: less than LEAST.
GEAR = (mix(np.arange(1001, 1257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)


#: Bytes that are hashed at a time.
STRETCH = 1 << 20


def gear_hash(data: np.ndarray) -> np.ndarray:
    """The gear hash at each byte: h = 2 h + gear(byte) modulo 2**32, that is, the last 32 bytes'."""
    h = GEAR[data]
    for s in (1, 2, 4, 8, 16):
        longer = h.copy()
        longer[s:] += h[:-s] << np.uint32(s)
        h = longer
    return h


def chunk_ends(data: np.ndarray, offsets: np.ndarray, least: int, most: int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, begins and ends of the chunks of a block's texts."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    # in stretches, each behind the 31 bytes that its first hash depends on: a very long text takes no more memory
    found = []
    for begin in range(0, len(data), STRETCH):
        lead = min(begin, 31)
        found.append(np.flatnonzero(gear_hash(data[begin - lead : begin + STRETCH])[lead:] >> np.uint32(32 - bits) == 0) + (begin + 1))
    places = np.concatenate(found)
    cuts = np.searchsorted(places, offsets)
    places = places.tolist()
    rows, begins, ends = [], [], []
    for k in range(len(offsets) - 1):
        last, end = int(offsets[k]), int(offsets[k + 1])
        first = len(ends)
        for p in places[cuts[k] : cuts[k + 1]]:
            if p - last < least:
                continue
            while p - last > most:
                begins.append(last)
                last += most
                ends.append(last)
            if p - last >= least:
                begins.append(last)
                ends.append(p)
                last = p
        while end - last > most:
            begins.append(last)
            last += most
            ends.append(last)
        if last < end:
            begins.append(last)
            ends.append(end)
        rows.extend([k] * (len(ends) - first))
    return np.array(rows, np.int64), np.array(begins, np.int64), np.array(ends, np.int64)


def repeated_chunks(own: DataFrame, least: int = LEAST, most: int = MOST, bits: int = BITS) -> DataFrame:
    """Spans (_doc, _dig, _begin, _end) of chunks whose digest an earlier chunk has (smaller document, or same document, earlier place).

    own: from documents().  Chunks below least bytes, texts' ends, stay, but where they are
    a whole text.  Mappers settle repeats among very many chunks and send one of a digest;
    what arrives is streamed in order, so that a digest in very many documents needs no
    memory.
    """

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mapper = Mapper()
        for batch in batches:
            ids, digs = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for i, j, data, offsets in blocks(batch.column(2)):
                rows, begins, ends = chunk_ends(data, offsets, least, most, bits)
                whole = (begins == offsets[rows]) & (ends == offsets[rows + 1])
                long = (ends - begins >= least) | whole
                rows, begins, ends = rows[long], begins[long], ends[long]
                raw = data.tobytes()
                digests = b"".join([hashlib.blake2b(raw[b:e], digest_size=16).digest() for b, e in zip(begins.tolist(), ends.tolist())])
                d = np.frombuffer(digests, np.int64).reshape(-1, 2)
                at, size = begins - offsets[rows], ends - begins
                yield from mapper.add(d[:, 0], d[:, 1], ids[i:j][rows], digs[i:j][rows], at, at + size, size)
        yield from mapper.flush()

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return settled(batches, lambda place: (place >> 20) + (place >> 2 & 0x3FFFF), False)

    return spans_of(dealt(own.mapInArrow(split, RUNS)).mapInArrow(settle, RUNS))


def chunk_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: bool = False) -> DataFrame:
    """Remove chunks whose bytes an earlier chunk has: with keep docs with texts cut, else (id, n_bytes, n_removed, n_spans, kept_sha256).

    Null or empty text: nothing to remove.  Null id: untouched.  Ids that aren't integers:
    a TypeError.  Repeated rows (same id and text) count as one document, each with its
    spans; different texts of one id are documents one after another, by a hash of the
    text.  Empty table: no rows.  Other columns go along with keep, whatever their names.
    """
    own, dig = documents(docs, id_col, text_col)
    return cut(docs, repeated_chunks(own), dig, id_col, text_col, keep)
