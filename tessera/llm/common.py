"""What the operators of this subpackage share: shared-folder tables and byte views of Arrow text."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tessera.storage import delete, forget_shuffles, fresh_path, release, scratch, shared_folder, stored

__all__ = ["blocks", "bytes_of", "delete", "forget_shuffles", "fresh_path", "integer_id", "mix", "portions", "powers", "prefix_hash", "release", "scratch", "shared_folder", "span_hash", "stored", "stretches", "text_batches"]

#: Bytes of text that a worker has at a time; one longer text counts as a portion of its own.
PORTION = 8 << 20


def text_batches(spark: SparkSession) -> None:
    """Let Spark hand over whole texts in Arrow batches of up to PORTION bytes.

    Its own bound, 64 MB, takes several hundred MB of an executor outside the heap.  This is
    a setting of the session, as Spark reads it when a plan runs; it is lowered, never
    raised, and changes no result.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key, "64m"))
    if not 0 < now <= PORTION:
        spark.conf.set(key, str(PORTION))


def integer_id(df: DataFrame, id_col: str) -> None:
    """Refuse ids that aren't integers before any work is done: earlier and smaller are defined on integers."""
    kind = df.schema[id_col].dataType
    if not isinstance(kind, T.IntegralType):
        raise TypeError(f"{id_col} must hold integers, not {kind.simpleString()}")


def portions(batches: Iterator[pa.RecordBatch], text: Callable[[pa.RecordBatch], pa.Array] = lambda b: b.column(1), limit: int = PORTION) -> Iterator[pa.RecordBatch]:
    """Batches in slices of about limit bytes of their text column, as a batch has other columns too."""
    for batch in batches:
        _, offsets = bytes_of(text(batch))
        i, n = 0, batch.num_rows
        while i < n:
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
            yield batch.slice(i, j - i)
            i = j


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A text or binary column as one byte array and its n + 1 offsets, without copies; null counts as empty."""
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n, (_, places, data) = len(column), column.buffers()
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), offsets


def blocks(column: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole rows of about limit bytes: (first row, row after the last, bytes, offsets from 0)."""
    data, offsets = bytes_of(column)
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def stretches(column: pa.Array, overlap: int, limit: int = 1 << 19) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, int]]:
    """blocks(), but a row of more than two limits comes in stretches, each with overlap bytes of the next one.

    So (first row, row after the last, bytes, offsets from 0, where in the row's text they
    begin): every string of overlap + 1 bytes begins in one stretch, and ends there.
    """
    for i, j, data, offsets in blocks(column, limit):
        if j - i > 1 or len(data) <= 2 * limit:
            yield i, j, data, offsets, 0
            continue
        for base in range(0, max(1, len(data) - overlap), limit):
            part = data[base : base + limit + overlap]
            yield i, j, part, np.array([0, len(part)], np.int64), base


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift and multiply)."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


#: Odd, so that it has an inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}
_byte_values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n."""
    if len(_powers["up"]) < n:
        n2 = max(n, 1 << 16)
        for k, b in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            p = np.full(n2, b, np.uint64)
            p[0] = 1
            _powers[k] = np.cumprod(p, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Prefix sums of value(byte i) * BASE**i modulo 2**64, with a leading 0."""
    up, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_byte_values[data] * up[: len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each data[start:end], the same wherever the bytes stand."""
    _, down = powers(len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
