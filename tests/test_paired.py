"""Paired FASTQ in splits: every cut, every container, against the files' own text."""

import gzip
import os
import random
import struct
import zlib

import pyarrow as pa
import pytest

from tessera.operators import demux
from tessera.sources import fastq, paired
from tessera.storage import listed


def records(n, mate, seed=1):
    r = random.Random(seed * 10 + mate)
    out = []
    for k in range(n):
        bases = "".join(r.choice("ACGT") for _ in range(r.randint(1, 60)))
        # quality lines that look like headers or separators
        out.append((f"@R{k} {mate}", bases, "+", "".join(r.choice("@+I#") for _ in bases)))
    return out


def text_of(rows, end="\n"):
    return end.join(line for r in rows for line in r) + end


def bgzf(text, sizes, seed=3):
    """Text in blocks of odd sizes, made by hand."""
    r, out, at = random.Random(seed), b"", 0
    while at < len(text):
        part = text[at : at + r.choice(sizes)]
        squeeze = zlib.compressobj(6, zlib.DEFLATED, -15)
        body = squeeze.compress(part) + squeeze.flush()
        # another subfield stands before the block's size
        extra = b"XY\x03\0abc" + b"BC\x02\0" + struct.pack("<H", 12 + 13 + len(body) + 8 - 1)
        out += b"\x1f\x8b\x08\x04" + bytes(6) + struct.pack("<H", len(extra)) + extra + body + struct.pack("<II", zlib.crc32(part), len(part))
        at += len(part)
    return out + paired.END


def members(text, count):
    """A gzip file of several members."""
    step = -(-len(text) // count)
    return b"".join(gzip.compress(text[k : k + step]) for k in range(0, len(text), step))


def put(path, rows, how):
    text = text_of(rows).encode()
    data = {"plain": lambda: text, "gz": lambda: gzip.compress(text), "members": lambda: members(text, 5), "bgzf": lambda: bgzf(text, (1, 7, 300, 2000))}[how]()
    name = f"{path}.fastq" + (".gz" if how != "plain" else "")
    with open(name, "wb") as f:
        f.write(data)
    return name


def rows_of(df):
    return sorted((r.read_index, r.r1_header, r.r1_seq, r.r1_sep, r.r1_qual, r.r2_header, r.r2_seq, r.r2_sep, r.r2_qual) for r in df.collect())


@pytest.mark.parametrize("one, two", [("plain", "plain"), ("plain", "gz"), ("bgzf", "plain"), ("bgzf", "bgzf"), ("members", "bgzf"), ("gz", "gz")])
def test_pairs_in_splits(spark, tmp_path, one, two):
    a, b = records(400, 1), records(400, 2)
    paths = put(tmp_path / "a", a, one), put(tmp_path / "b", b, two)
    want = [(k, *x, *y) for k, (x, y) in enumerate(zip(a, b))]
    for size, each in ((500, 1), (3000, 30), (1 << 20, 1 << 16)):
        df = fastq.read_pairs(spark, *paths, range_bytes=size, each=each)
        assert rows_of(df) == want
        # plain gzip of so few records is one block once it is written anew
        assert size > 3000 or one in ("gz", "members") or df.rdd.getNumPartitions() > 3
    assert [r.read_id for r in df.orderBy("read_index").limit(3).collect()] == ["R0", "R1", "R2"]


def test_every_cut_in_a_record_and_in_a_block(spark, tmp_path):
    rows = records(12, 1)
    text = text_of(rows).encode()
    for name, data in (("a.fastq", text), ("b.fastq.gz", bgzf(text, (5, 40, 90)))):
        path = str(tmp_path / name)
        with open(path, "wb") as f:
            f.write(data)
        ends = [k + 1 for k, c in enumerate(text) if c == 10]
        for cut in range(1, len(data)):
            marks, before = [], 0
            for low, high in ((0, cut), (cut, len(data))):
                _, m = paired._gone_through(path, low, high, len(data), "", 3)
                marks += [(before + line, offset, within) for line, offset, within in m.marks]
                before += m.lines
            assert before == len(ends)
            # from each mark on there are the lines that are left
            for line, offset, within in marks:
                assert paired.Lines([(path, offset, within, 0)]).take(9) == text.splitlines()[line:][:9]


def test_files_of_folders_line_ends_and_blank_lines(spark, tmp_path):
    a, b = records(90, 1), records(90, 2)
    for m, rows in ((1, a), (2, b)):
        (tmp_path / str(m)).mkdir()
        cuts = (0, 3, 50, 90) if m == 1 else (0, 41, 90)
        for k, (low, high) in enumerate(zip(cuts, cuts[1:])):
            put(tmp_path / str(m) / f"part{k}", rows[low:high], "plain" if (k + m) % 2 else "gz")
        (tmp_path / str(m) / "_SUCCESS").write_text("")
    want = [(k, *x, *y) for k, (x, y) in enumerate(zip(a, b))]
    for size in (700, 1 << 20):
        assert rows_of(fastq.read_pairs(spark, str(tmp_path / "1"), str(tmp_path / "2"), range_bytes=size, each=5)) == want
    assert rows_of(fastq.read_pairs(spark, str(tmp_path / "1" / "part*"), str(tmp_path / "2"))) == want
    # carriage returns, blanks at line ends, no end of the last line, a blank line too many
    (tmp_path / "x.fastq").write_bytes(text_of(a, "\r\n").encode()[:-2])
    (tmp_path / "y.fastq").write_bytes(text_of([(h, s + "  ", p, q) for h, s, p, q in b]).encode() + b"\n")
    assert rows_of(fastq.read_pairs(spark, str(tmp_path / "x.fastq"), str(tmp_path / "y.fastq"), range_bytes=900, each=7)) == want
    scanned = fastq.pair(fastq.read_fastq(spark, str(tmp_path / "x.fastq")), fastq.read_fastq(spark, str(tmp_path / "y.fastq")))
    assert rows_of(scanned) == want


def test_mates_of_unequal_length(spark, tmp_path):
    one, two = put(tmp_path / "a", records(100, 1), "bgzf"), put(tmp_path / "b", records(60, 2), "plain")
    for x, y, longer in ((one, two, "r2"), (two, one, "r1")):
        df = fastq.read_pairs(spark, x, y, check=False, range_bytes=400, each=4)
        assert df.count() == 100 and df.where(f"{longer}_header is null").count() == 40
        assert fastq.check_paired(df) == "reads, " + fastq.RULES["length"].format(line=241)
        with pytest.raises(Exception, match="different numbers"):
            fastq.read_pairs(spark, x, y, range_bytes=400, each=4).collect()
    for name in ("e.fastq", "f.fastq.gz"):
        (tmp_path / name).write_bytes(b"")
    assert fastq.read_pairs(spark, str(tmp_path / "e.fastq"), str(tmp_path / "f.fastq.gz")).count() == 0
    assert fastq.read_pairs(spark, two, str(tmp_path / "e.fastq"), check=False).where("r2_header is null").count() == 60
    with pytest.raises(FileNotFoundError):
        fastq.read_pairs(spark, two, str(tmp_path / "none"))


def test_damaged_files_end_the_query(spark, tmp_path):
    good, bad = put(tmp_path / "a", records(300, 1), "bgzf"), tmp_path / "b.fastq.gz"
    data = bytearray(open(good, "rb").read())
    data[len(data) // 2] ^= 0x55
    bad.write_bytes(bytes(data))
    cut = tmp_path / "c.fastq.gz"
    cut.write_bytes(gzip.compress(text_of(records(300, 1)).encode())[:-500])
    for path in (bad, cut):
        with pytest.raises(Exception, match="checksum|cut off|damaged|decompress"):
            fastq.read_pairs(spark, good, str(path)).collect()


def test_no_record_is_shuffled_before_it_is_judged(spark, tmp_path):
    paths = put(tmp_path / "a", records(50, 1), "plain"), put(tmp_path / "b", records(50, 2), "gz")
    df = demux.with_qc(fastq.read_pairs(spark, *paths)).where("qc_reason is null")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and df.count() <= 50


def test_stores_that_only_spark_opens_are_scanned(spark, tmp_path, monkeypatch):
    paths = put(tmp_path / "a", records(50, 1), "plain"), put(tmp_path / "b", records(50, 2), "gz")
    want = rows_of(fastq.read_pairs(spark, *paths))
    assert paired.reachable(listed(spark, paths[0])) and not paired.reachable([("viewfs://store/in/a", 3)])
    monkeypatch.setattr(paired, "reachable", lambda files: False)
    assert paired.paired(spark, *paths) is None and rows_of(fastq.read_pairs(spark, *paths)) == want


def test_blocks_that_are_written_are_read_by_gzip(tmp_path):
    text = text_of(records(3000, 1)).encode()
    (tmp_path / "a.gz").write_bytes(gzip.compress(text))
    path, marks = paired._gone_through(str(tmp_path / "a.gz"), 0, 1 << 40, 1 << 40, str(tmp_path / "out"), 100)
    assert gzip.open(path).read() == text and marks.lines == 12000 and len(marks.marks) == 120
    line, offset, within = marks.marks[77]
    assert paired.Lines([(path, offset, within, 2)]).take(1) == text.split(b"\n")[line + 2 : line + 3]
    assert pa.array(["x"]).type == pa.string()


def test_short_gzip_files_that_line_up_are_not_written_anew(spark, tmp_path):
    a, b = records(90, 1), records(90, 2)
    want = [(k, *x, *y) for k, (x, y) in enumerate(zip(a, b))]
    for name, rows, cuts in (("1", a, (0, 30, 31, 90)), ("2", b, (0, 30, 31, 90)), ("3", b, (0, 29, 31, 90))):
        (tmp_path / name).mkdir()
        for k, (low, high) in enumerate(zip(cuts, cuts[1:])):
            put(tmp_path / name / f"part{k}", rows[low:high], ("gz", "members", "bgzf")[k] if name == "1" else "gz")
    for two, size, anew in (("2", 1 << 20, False), ("3", 1 << 20, True), ("2", 400, True)):
        df = fastq.read_pairs(spark, str(tmp_path / "1"), str(tmp_path / two), range_bytes=size, each=5)
        assert rows_of(df) == want and os.path.isdir(df._stored_at.removeprefix("file://")) == anew
    assert fastq.read_pairs(spark, str(tmp_path / "1"), str(tmp_path / "2")).rdd.getNumPartitions() == 3
    cut = tmp_path / "c.fastq.gz"
    cut.write_bytes(gzip.compress(text_of(a).encode())[:-500])
    with pytest.raises(Exception, match="cut off"):
        fastq.read_pairs(spark, put(tmp_path / "d", b, "gz"), str(cut)).collect()
