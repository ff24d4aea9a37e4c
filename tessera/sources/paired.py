"""Paired FASTQ in splits: byte ranges of both mates that hold the same records, read side by side.

1. Files are cut into byte ranges, and each is gone through once: how many lines end in it,
   and where some of its lines begin (marks).  A range of a BGZF file begins at the first
   block in it; other gzip can't be entered in the middle, so that a file is one range,
   which is written anew as BGZF on the way.  Where files of both mates are no longer than
   a range and pairwise hold the same records, splits are whole files, and none is written.
2. The ranges' counts, summed up, number the lines, and so the records.
3. A split is the records between two marks of the first mate; the second is entered at its
   last mark before them.  Each task reads its two ranges together: no record is shuffled,
   and none is held beyond a batch.

Stores are those that pyarrow opens (local and shared folders, S3, GCS, HDFS with libhdfs).
"""

from __future__ import annotations

import bisect
import json
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tessera.storage import fresh_path, listed

#: Bytes of a range, more where that makes over RANGES of them; lines between marks.
RANGE, RANGES, MARK = 64 << 20, 20_000, 1 << 16
#: Bytes that are read at a time, records of a batch, and text bytes of a BGZF block that is written.
STEP, BATCH, BLOCK = 1 << 20, 4096, 65_280
GZIPPED = (".gz", ".bgz", ".bgzf")
#: The empty block that ends a BGZF file.
END = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")

MATE = ("header", "seq", "sep", "qual")
SCHEMA = "read_index long, " + ", ".join(f"r{m}_{c} string" for m in (1, 2) for c in MATE)
FOUND = "mate int, file int, begin long, path string, lines long, last int, marks array<struct<line:long,offset:long,within:int>>"


def opened(path: str) -> pa.NativeFile:
    store, inner = fs.FileSystem.from_uri(path)
    return store.open_input_file(inner)


def block_size(head: bytes) -> int:
    """The bytes of the BGZF block that begins with head, or 0 if none does."""
    if len(head) < 18 or head[:4] != b"\x1f\x8b\x08\x04":
        return 0
    at, end = 12, 12 + struct.unpack_from("<H", head, 10)[0]
    while at + 4 <= min(end, len(head)):
        size = struct.unpack_from("<H", head, at + 2)[0]
        if head[at : at + 2] == b"BC" and size == 2 and at + 6 <= len(head):
            return struct.unpack_from("<H", head, at + 4)[0] + 1
        at += 4 + size
    return 0


def packed_block(text: bytes) -> bytes:
    """A BGZF block of up to BLOCK bytes of text."""
    squeeze = zlib.compressobj(1, zlib.DEFLATED, -15)
    body = squeeze.compress(text) + squeeze.flush()
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff\x06\0BC\x02\0" + struct.pack("<H", len(body) + 25) + body + struct.pack("<II", zlib.crc32(text), len(text))


def blocks(f: pa.NativeFile, offset: int) -> Iterator[tuple[int, bytes]]:
    """(offset, text) of the BGZF blocks from one on."""
    f.seek(offset)
    held = b""
    while True:
        size = block_size(held)
        if not size or len(held) < size:
            more = f.read(STEP)
            if not more:
                if held:
                    raise ValueError(f"a BGZF block is cut off or damaged at byte {offset}")
                return
            held += more
            continue
        at = 0
        while (size := block_size(held[at : at + 256])) and at + size <= len(held):
            raw = held[at : at + size]
            head = 12 + struct.unpack_from("<H", raw, 10)[0]
            text = zlib.decompress(raw[head:-8], -15)
            if struct.unpack("<II", raw[-8:]) != (zlib.crc32(text), len(text)):
                raise ValueError(f"a BGZF block has another checksum than it says, at byte {offset}")
            yield offset, text
            at, offset = at + size, offset + size
        held = held[at:]


def first_block(f: pa.NativeFile, begin: int, size: int) -> int:
    """Where the first BGZF block begins at or after a byte: a header whose block ends where another begins, or the file ends."""
    if begin == 0:
        return 0
    f.seek(begin)
    data = f.read(3 << 16)
    at = data.find(b"\x1f\x8b\x08\x04")
    while at >= 0:
        long = block_size(data[at : at + 256])
        after = at + long
        if long and (begin + after == size or block_size(data[after : after + 256])):
            return begin + at
        at = data.find(b"\x1f\x8b\x08\x04", at + 1)
    return size


def plain(f: pa.NativeFile, offset: int) -> Iterator[tuple[int, bytes]]:
    """(offset, text) of pieces of a plain file from one byte on."""
    f.seek(offset)
    while text := f.read(STEP):
        yield offset, text
        offset += len(text)


def unzipped(f: pa.NativeFile) -> Iterator[bytes]:
    """A gzip file's text, member after member; zeros between them are padding."""
    member, begun = zlib.decompressobj(31), False
    while data := f.read(STEP):
        while data := data if begun else data.lstrip(b"\0"):
            begun = True
            yield member.decompress(data, 4 * STEP)
            while member.unconsumed_tail:
                yield member.decompress(member.unconsumed_tail, 4 * STEP)
            data = member.unused_data
            if member.eof:
                member, begun = zlib.decompressobj(31), False
    if begun:
        yield member.flush()
        if not member.eof:
            raise ValueError("a gzip file is cut off")


@dataclass
class Marks:
    """Lines that end in a range so far, its last byte, and marks: (lines before, offset, bytes of the block before)."""

    each: int
    lines: int = 0
    last: int | None = None
    marks: list[tuple[int, int, int]] = field(default_factory=list)

    def add(self, text: bytes, offset: int, block: bool) -> None:
        if not text:
            return
        ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 10)
        wanted = np.arange(-self.lines % self.each, len(ends), self.each)
        # the first line end of all, and each each-th from there on
        for k in wanted.tolist():
            after = int(ends[k]) + 1
            self.marks.append((self.lines + k + 1, offset if block else offset + after, after if block else 0))
        self.lines, self.last = self.lines + len(ends), text[-1]


def _rewritten(path: str, folder: str, marks: Marks) -> str:
    """Write a gzip file anew as BGZF, under a name of this attempt's own."""
    store, base = fs.FileSystem.from_uri(folder)
    store.create_dir(base, recursive=True)
    name, at, held = f"{uuid.uuid4().hex}.gz", 0, bytearray()
    with opened(path) as f, store.open_output_stream(f"{base}/{name}", compression=None) as out:

        def put(text: bytes) -> None:
            nonlocal at
            marks.add(text, at, True)
            block = packed_block(text)
            out.write(block)
            at += len(block)

        for text in unzipped(f):
            held += text
            while len(held) >= BLOCK:
                put(bytes(held[:BLOCK]))
                del held[:BLOCK]
        if held:
            put(bytes(held))
        out.write(END)
    return f"{folder}/{name}"


def _gone_through(path: str, begin: int, end: int, size: int, folder: str | None, each: int) -> tuple[str, Marks]:
    """A range's marks, and the file that they are in.

    A range that isn't the first of a plain gzip file has none.  Without a folder such a file
    stays as it is, and its lines are counted alone.
    """
    marks = Marks(each)
    zipped = path.endswith(GZIPPED)
    with opened(path) as f:
        blocked = zipped and block_size(f.read(256)) > 0
        if zipped and not blocked and folder is None:
            f.seek(0)
            for text in unzipped(f) if begin == 0 else ():
                marks.add(text, 0, True)
            marks.marks.clear()
            return path, marks
        if zipped and not blocked:
            return (_rewritten(path, folder, marks) if begin == 0 and size else path), marks
        start = first_block(f, begin, size) if blocked else begin
        for at, text in blocks(f, start) if blocked else plain(f, start):
            if at >= end:
                break
            marks.add(text if blocked else text[: end - at], at, blocked)
    return path, marks


def _ranges(folder: str | None, each: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                path, m = _gone_through(r["path"], r["begin"], r["end"], r["size"], folder, each)
                yield pa.RecordBatch.from_pylist([{
                    "mate": r["mate"], "file": r["file"], "begin": r["begin"], "path": path, "lines": m.lines, "last": m.last,
                    "marks": [dict(zip(("line", "offset", "within"), x)) for x in m.marks]}], schema=FOUND_ARROW)

    return run


FOUND_ARROW = pa.schema([
    ("mate", pa.int32()), ("file", pa.int32()), ("begin", pa.int64()), ("path", pa.string()), ("lines", pa.int64()), ("last", pa.int32()),
    ("marks", pa.list_(pa.struct([("line", pa.int64()), ("offset", pa.int64()), ("within", pa.int32())])))])


def index(spark: SparkSession, files: list[list[tuple[str, int]]], folder: str | None, range_bytes: int, each: int) -> list[list[dict]]:
    """Each mate's files in order, with their numbers of lines and marks: (line, offset, within), lines counted over all files of the mate."""
    total = sum(size for mate in files for _, size in mate)
    step = max(range_bytes, -(-total // RANGES))
    cut = [(m, k, path, begin, min(size, begin + step), size) for m, mate in enumerate(files) for k, (path, size) in enumerate(mate) for begin in range(0, size, step)]
    if not cut:
        return [[], []]
    asked = spark.createDataFrame(cut, "mate int, file int, path string, begin long, end long, size long").repartition(len(cut))
    out: list[list[dict]] = [[], []]
    before = [0, 0]
    for r in sorted(asked.mapInArrow(_ranges(folder, each), FOUND).collect(), key=lambda r: (r["mate"], r["file"], r["begin"])):
        m, own = r["mate"], out[r["mate"]]
        if not own or own[-1]["file"] != r["file"]:
            if own and own[-1].pop("last") not in (10, None):
                before[m] += 1  # a last line without its end
            own.append({"file": r["file"], "path": r["path"], "line": before[m], "marks": [(before[m], 0, 0)], "last": None})
        own[-1]["marks"] += [(before[m] + x["line"], x["offset"], x["within"]) for x in r["marks"]]
        before[m] += r["lines"]
        own[-1]["last"] = own[-1]["last"] if r["last"] is None else r["last"]
    for m, own in enumerate(out):
        if own and own[-1].pop("last") not in (10, None):
            before[m] += 1
        for f, end in zip(own, [f["line"] for f in own[1:]] + [before[m]]):
            f["end"] = end
    return out


def pieces(f: pa.NativeFile, offset: int, zipped: bool) -> Iterator[tuple[int, bytes]]:
    """(offset, text) of a file from a place on; gzip that isn't BGZF has no places but its beginning."""
    if not zipped:
        return plain(f, offset)
    if block_size(f.read(256)):
        return blocks(f, offset)
    f.seek(0)
    return ((0, text) for text in unzipped(f))


def _entered(files: list[dict], low: int, high: int) -> list[tuple[str, int, int, int]]:
    """(path, offset, within, lines to skip) of the files that hold lines low to high - 1."""
    out = []
    for f in files:
        if f["end"] <= low or f["line"] >= high:
            continue
        k = bisect.bisect_right(f["marks"], max(low, f["line"]), key=lambda m: m[0]) - 1
        line, offset, within = f["marks"][k]
        out.append((f["path"], offset, within, max(0, low - line)))
    return out


def splits(mates: list[list[dict]], range_bytes: int) -> list[dict]:
    """Splits of whole records, of about range_bytes of the first mate's files."""
    ends = [own[-1]["end"] if own else 0 for own in mates]
    records = -(-max(ends) // 4)
    cuts, taken = {0}, 0
    for f in mates[0]:
        taken = -range_bytes if f["line"] else 0  # the next file begins a split
        for line, offset, _ in f["marks"]:
            if offset - taken >= range_bytes:
                cuts.add(-(-line // 4))
                taken = offset
    cuts = sorted(c for c in cuts if c < records) + [records]
    return [{"first": a, "records": b - a, "mates": [_entered(own, 4 * a, 4 * b) for own in mates]} for a, b in zip(cuts, cuts[1:])]


class Lines:
    """The lines of files from their places on, some at a time."""

    def __init__(self, places: Iterable[tuple[str, int, int, int]]):
        self.places, self.held, self.at, self.text = iter(places), [], 0, self._texts()

    def _texts(self) -> Iterator[list[bytes]]:
        for path, offset, within, skip in self.places:
            with opened(path) as f:
                rest = b""
                for _, text in pieces(f, offset, path.endswith(GZIPPED)):
                    lines = (rest + text[within:]).split(b"\n")
                    rest, within = lines.pop(), 0
                    if skip:
                        lines, skip = lines[skip:], max(0, skip - len(lines))
                    yield lines
                if rest and not skip:
                    yield [rest]

    def take(self, n: int) -> list[bytes]:
        """The next n lines; fewer only at the end."""
        parts, have = [self.held[self.at :]], len(self.held) - self.at
        while have < n and (more := next(self.text, None)) is not None:
            parts.append(more)
            have += len(more)
        if len(parts) > 1:
            self.held, self.at = [line for p in parts for line in p], 0
        out = self.held[self.at : self.at + n]
        self.at += len(out)
        return out


def _column(lines: list[bytes | None], n: int) -> pa.Array:
    """Lines as strings without the blanks and the carriage return at their ends; nulls up to n."""
    raw = pa.array(lines + [None] * (n - len(lines)), pa.binary())
    try:
        text = raw.cast(pa.string())
    except pa.ArrowInvalid:
        text = pa.array([None if v is None else v.decode("utf-8", "replace") for v in raw.to_pylist()], pa.string())
    text = pc.utf8_rtrim(text, " ")
    return pc.replace_substring_regex(text, "\r$", "") if pc.any(pc.ends_with(text, "\r")).as_py() else text


class PairedReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.plan = json.loads(options["splits"])

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(s) for s in self.plan] or [InputPartition({"first": 0, "records": 0, "mates": [[], []]})]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        split = partition.value
        mates = [Lines(places) for places in split["mates"]]
        names = ["read_index", *[f"r{m}_{c}" for m in (1, 2) for c in MATE]]
        for begin in range(0, split["records"], BATCH):
            n = min(BATCH, split["records"] - begin)
            columns = [pa.array(np.arange(split["first"] + begin, split["first"] + begin + n))]
            there = np.zeros(n, bool)
            for mate in mates:
                lines = mate.take(4 * n)
                if len(lines) % 4 == 1 and not lines[-1].strip():
                    lines.pop()  # a blank line at the end is no record
                columns += [_column(lines[k::4], n) for k in range(4)]
                there[: -(-len(lines) // 4)] = True
            batch = pa.RecordBatch.from_arrays(columns, names=names)
            yield batch if there.all() else batch.filter(pa.array(there))


class PairedFastq(DataSource):
    """Splits (an option, from splits()) as (read_index, r1_header ... r2_qual); a mate that ends before the other has nulls."""

    @classmethod
    def name(cls) -> str:
        return "paired_fastq"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return PairedReader(self.options)


def reachable(files: list[tuple[str, int]]) -> bool:
    """Whether pyarrow opens what Spark has listed."""
    try:
        for path, _ in files[:1]:
            opened(path).close()
    except (OSError, ValueError, ImportError, pa.ArrowException):
        return False
    return True


def paired(spark: SparkSession, r1_path: str, r2_path: str, range_bytes: int = RANGE, each: int = MARK) -> DataFrame | None:
    """(read_index, r1_*, r2_*) of the records of two FASTQ files, or folders of files by name, by their places; None where pyarrow doesn't reach them.

    The index of ranges, which goes to the driver, has a row a range and a mark for each
    `each` lines.  Files of plain gzip are written anew as BGZF in the shared folder, where
    they stay as long as the rows are read: release() the result when it isn't needed any more.
    Pairs of gzip files of up to range_bytes each that hold as many lines are read as they are.
    """
    files = [listed(spark, p) for p in (r1_path, r2_path)]
    if not all(map(reachable, files)):
        return None
    folder = fresh_path(spark, "bgzf")
    short = len(files[0]) == len(files[1]) and all(path.endswith(GZIPPED) and size <= range_bytes for mate in files for path, size in mate)
    mates = index(spark, files, None if short else folder, range_bytes, each)
    if short and [(f["file"], f["end"]) for f in mates[0]] != [(f["file"], f["end"]) for f in mates[1]]:
        # a split would go through what is before it in the other mate's file
        mates = index(spark, files, folder, range_bytes, each)
    spark.dataSource.register(PairedFastq)
    rows = spark.read.format("paired_fastq").option("splits", json.dumps(splits(mates, range_bytes))).load()
    rows._stored_at = folder
    return rows
