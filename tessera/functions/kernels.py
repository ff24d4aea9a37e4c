"""Qualities and primers over whole Arrow batches of reads: plain byte arrays, no row at a time.

A batch's reads are one byte array and its offsets.  Exact copies of a primer are compared
byte by byte; edit distances are worked out only for reads that have none, all of them at
once, in a band as wide as the edits that are allowed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: A distance beyond any limit.
FAR = 99


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Texts as one byte array and n + 1 offsets, a byte for each character (255 for those beyond it); null counts as empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type)
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    raw, offsets = raw[offsets[0] : offsets[-1]], offsets - offsets[0]
    if len(raw) and raw.max() > 127:
        texts = [bytes(min(ord(c), 255) for c in t) for t in column.to_pylist()]
        return np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    return raw, offsets


def letters(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """flat() of reads without blanks around them, in upper case."""
    return flat(pc.utf8_upper(pc.utf8_trim(column, " ")))


def part(raw: np.ndarray, offsets: np.ndarray, start: int, width: int, rows: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Bytes start to start + width of each read (or of rows), 0 beyond its end, and how many of them there are."""
    begin, end = (offsets[:-1], offsets[1:]) if rows is None else (offsets[rows], offsets[rows + 1])
    have = np.clip(end - begin - start, 0, width)
    at = (begin + start)[:, None] + np.arange(width)
    inside = np.arange(width) < have[:, None]
    out = np.zeros((len(begin), width), np.uint8)
    if len(raw):
        out = np.where(inside, raw[np.where(inside, at, 0)], np.uint8(0))
    return out, have


def total(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of scores (Phred+33)."""
    sums = np.r_[0, np.cumsum(raw, dtype=np.int64)]
    return sums[offsets[1:]] - sums[offsets[:-1]] - 33 * np.diff(offsets)


REASONS = ("read_length_or_quality_length", "mean_phred", "barcode_length", "barcode_q25")


def qc_reason(r1: pa.Array, q1: pa.Array, r2: pa.Array, q2: pa.Array, min_length: int, min_mean: int, barcode: int, min_bases: int) -> pa.Array:
    """The first rule that a pair breaks, or null."""
    (_, a), (qa, b), (_, c), (qb, d) = flat(r1), flat(q1), flat(r2), flat(q2)
    n1, m1, n2, m2 = (np.diff(x) for x in (a, b, c, d))
    mean1, mean2 = total(qa, b) / np.maximum(m1, 1), total(qb, d) / np.maximum(m2, 1)
    front, have = part(qb, d, 0, barcode)
    good = ((front >= 33 + min_mean) & (np.arange(barcode) < have[:, None])).sum(1)
    broken = np.select([(n1 < min_length) | (n2 < min_length) | (n1 != m1) | (n2 != m2), (mean1 < min_mean) | (mean2 < min_mean), n2 < barcode, good < min_bases], [0, 1, 2, 3], -1)
    return pa.array(np.array([*REASONS, None], object)[broken], pa.string())


def distances(window: np.ndarray, have: np.ndarray, primer: bytes, lengths: list[int], most: int) -> np.ndarray:
    """Edit distances between the primer and each window's first bytes, for each of lengths: FAR beyond most, or where the window is shorter.

    Row by row of the usual table, but all windows at a time, and only its cells within
    most of the diagonal.
    """
    m, n = len(primer), len(window)
    out = np.full((n, len(lengths)), FAR, np.uint8)
    before = [np.full(n, j if j <= most else FAR, np.uint8) for j in range(m + 1)]
    far = np.full(n, FAR, np.uint8)
    for i in range(1, max(lengths) + 1):
        here = [far] * (m + 1)
        if i <= most:
            here[0] = np.full(n, i, np.uint8)
        letter = window[:, i - 1]
        for j in range(max(1, i - most), min(m, i + most) + 1):
            cell = before[j - 1] + (letter != primer[j - 1])
            np.minimum(cell, before[j] + np.uint8(1), out=cell)
            np.minimum(cell, here[j - 1] + np.uint8(1), out=cell)
            here[j] = np.minimum(cell, FAR)
        before = here
        if i in lengths:
            out[:, lengths.index(i)] = np.where((have >= i) & (here[m] <= most), here[m], FAR)
    return out


def tried(primer: str, most: int) -> list[int]:
    """Lengths of the windows that a primer is held against."""
    indel = min(most, 2)
    return list(range(max(1, len(primer) - indel), len(primer) + indel + 1))


def primer_start(reads: pa.Array, primer: str, starts: list[int], most: int) -> np.ndarray:
    """The start with the least distance, the first of equal ones; -1 where none is within most. starts: in their order."""
    primer = primer.strip().upper()
    raw, offsets = letters(reads)
    n = len(offsets) - 1
    code, size = primer.encode(), len(primer)
    out = np.full(n, -1, np.int64)
    for s in starts[::-1]:
        window, have = part(raw, offsets, s, size)
        out[(have == size) & (window == np.frombuffer(code, np.uint8)).all(1)] = s
    rest = np.flatnonzero((out < 0) & (np.diff(offsets) > 0))
    if len(rest) and starts:
        lengths = tried(primer, most)
        # all starts of all reads in one table
        windows = [part(raw, offsets, s, max(lengths), rest) for s in starts]
        found = distances(np.vstack([w for w, _ in windows]), np.concatenate([h for _, h in windows]), code, lengths, most).min(1).reshape(len(starts), -1)
        best = found.argmin(0)
        hit = found[best, np.arange(len(rest))] <= most
        out[rest[hit]] = np.array(starts)[best[hit]]
    return out


def near(raw: np.ndarray, offsets: np.ndarray, rows: np.ndarray, primer: str, max_shift: int, most: int, centre: int) -> np.ndarray:
    """Whether the primer stands near centre, with at most most edits, in each of rows.

    A shift to the left of centre drops the primer's first bases and stays at centre.
    Windows of the primer's own length are compared place by place, others by edit distance.
    """
    primer = primer.strip().upper()
    out = np.zeros(len(rows), bool)
    if not primer:
        return out
    window, have = part(raw, offsets, centre, len(primer), rows)
    out[(have == len(primer)) & (window == np.frombuffer(primer.encode(), np.uint8)).all(1)] = True
    # the place itself first, then those further away: most reads need no more than one
    for shift in sorted(range(-max_shift, max_shift + 1), key=abs):
        rest, start = (primer, centre + shift) if shift >= 0 else (primer[-shift:], centre)
        left = np.flatnonzero(~out)
        if start < 0 or not rest or not len(left):
            continue
        lengths = tried(rest, most)
        window, have = part(raw, offsets, start, max(lengths), rows[left])
        own = np.frombuffer(rest.encode(), np.uint8)
        hit = (have >= len(own)) & ((window[:, : len(own)] != own).sum(1) <= most)
        open_ = np.flatnonzero(~hit)
        others = [k for k in lengths if k != len(rest)]
        if len(open_) and others:
            hit[open_] = (distances(window[open_], have[open_], rest.encode(), others, most) <= most).any(1)
        out[left[hit]] = True
    return out


def primer_matches(reads: pa.Array, primer: str, max_shift: int, most: int, centre: int) -> np.ndarray:
    """near() for every read."""
    raw, offsets = letters(reads)
    return near(raw, offsets, np.arange(len(offsets) - 1), primer, max_shift, most, centre)


def place_16s(r1: pa.Array, r2: pa.Array, fwd: str, rev: str, starts: list[int], most: int, max_shift: int, centre: int) -> np.ndarray:
    """Where the forward primer begins on R1, -1 unless R2's primer matches too; R2 is looked at only where R1 has a start."""
    out = primer_start(r1, fwd, starts, most)
    rows = np.flatnonzero(out >= 0)
    raw, offsets = letters(r2)
    out[rows[~near(raw, offsets, rows, rev, max_shift, most, centre)]] = -1
    return out


def gene_of(r1: pa.Array, r2: pa.Array, skip: np.ndarray, panel: list[tuple[int, str, str]], max_shift: int, most: int, centre: int) -> np.ndarray:
    """The panel's number of each read pair, -1 for none: exact pairs of primers first, in the panel's order, then near ones in that order. skip: reads that its row 0 isn't held against."""
    (plain1, at1), (plain2, at2) = flat(r1), flat(r2)
    n = len(at1) - 1
    out = np.full(n, -1, np.int64)

    def exact(raw: np.ndarray, offsets: np.ndarray, rows: np.ndarray, primer: str, start: int) -> np.ndarray:
        window, have = part(raw, offsets, start, len(primer), rows)
        return (have == len(primer)) & (window == np.frombuffer(primer.encode(), np.uint8)).all(1)

    def open_rows(k: int) -> np.ndarray:
        return np.flatnonzero((out < 0) & ~skip if k == 0 else out < 0)

    for k, fwd, rev in panel:
        rows = open_rows(k)
        rows = rows[exact(plain2, at2, rows, rev, centre)]
        out[rows[exact(plain1, at1, rows, fwd, 0)]] = k
    (raw1, at1), (raw2, at2) = letters(r1), letters(r2)
    for k, fwd, rev in panel:
        rows = open_rows(k)
        rows = rows[near(raw2, at2, rows, rev, max_shift, most, centre)]
        out[rows[near(raw1, at1, rows, fwd, max_shift, most, 0)]] = k
    return out


def shifted(a: pa.Array, b: pa.Array, max_shift: int) -> np.ndarray:
    """Fewest mismatches of each two texts' overlap over shifts up to max_shift either way; a shift costs nothing."""
    (raw_a, at_a), (raw_b, at_b) = flat(a), flat(b)
    size_a, size_b = np.diff(at_a), np.diff(at_b)
    width = int(max(size_a.max(initial=0), size_b.max(initial=0)))
    x, _ = part(raw_a, at_a, 0, width)
    y, _ = part(raw_b, at_b, 0, width)
    return shifted_rows(x, size_a, y, size_b, max_shift)


def shifted_rows(x: np.ndarray, size_x: np.ndarray, y: np.ndarray, size_y: np.ndarray, max_shift: int) -> np.ndarray:
    """shifted() of the rows of two matrices of bytes, whose texts have the given sizes."""
    width = x.shape[1]
    best = np.full(len(size_x), width + 1, np.int64)
    alike = bool((size_x == width).all() and (size_y == width).all())
    for s in range(-max_shift, max_shift + 1):
        left, right = (x[:, s:], y[:, : max(0, width - s)]) if s >= 0 else (x[:, : max(0, width + s)], y[:, -s:])
        differ = left != right
        if not alike:
            overlap = np.maximum(np.minimum(size_x - max(s, 0), size_y - max(-s, 0)), 0)
            differ &= np.arange(left.shape[1]) < overlap[:, None]
        best = np.minimum(best, np.count_nonzero(differ, axis=1))
    return best


class Texts:
    """Pairs of texts as matrices, to compare rows with rows."""

    #: Rows that are compared at a time.
    TOGETHER = 1 << 15

    def __init__(self, *columns: pa.Array):
        self.mates = []
        for column in columns:
            raw, offsets = flat(column)
            size = np.diff(offsets)
            self.mates.append((part(raw, offsets, 0, int(size.max(initial=0)))[0], size))

    def apart(self, i: np.ndarray, j: np.ndarray, max_shift: int) -> np.ndarray:
        """The larger one of the mates' shifted distances between rows i and j."""
        out = np.zeros(len(i), np.int64)
        for low in range(0, len(i), self.TOGETHER):
            a, b = i[low : low + self.TOGETHER], j[low : low + self.TOGETHER]
            out[low : low + self.TOGETHER] = np.max([shifted_rows(x[a], n[a], x[b], n[b], max_shift) for x, n in self.mates], axis=0)
        return out
