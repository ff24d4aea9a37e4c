"""Media columns: MPEG audio streams, parsed and written without a codec.

``parse`` resynchronises frame headers, reads ID3v2, ID3v1 and APEv2 tags and Xing, Info
and VBRI tables, verifies frames' checksums, and gives exact durations and each frame's
offset.  ``carry`` stores bytes losslessly as ancillary data of MPEG-2 Layer
III frames (576 bytes a frame of 576 samples), ``payload`` reads them back.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tessera.llm.common import portions, stored, text_batches

# Fixed values of ISO/IEC 11172-3 and 13818-3: kbit/s by index 1 to 14, Hz by index 0 to 2.
KBITS = {
    ("1", 1): (32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448),
    ("1", 2): (32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384),
    ("1", 3): (32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320),
    ("2", 1): (32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256),
    ("2", 2): (8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
    ("2", 3): (8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
}
HERTZ = {"1": (44100, 48000, 32000), "2": (22050, 24000, 16000), "2.5": (11025, 12000, 8000)}
VERSIONS = {0: "2.5", 2: "2", 3: "1"}
# Layer II allocation: (bits, subbands) in a row, by table. "low" is for the lower sampling rates.
ALLOCATION = {
    "a": ((4, 11), (3, 12), (2, 4)),
    "b": ((4, 11), (3, 12), (2, 7)),
    "c": ((4, 2), (3, 6)),
    "d": ((4, 2), (3, 10)),
    "low": ((4, 4), (3, 7), (2, 19)),
}
# End of the fixed values.

UNIT = 576
#: MPEG-2 Layer III with checksum, 144 kbit/s, 16 kHz, mono: 648 bytes a frame.
HEADER = bytes((0xFF, 0xF2, 0xD8, 0xC0))
FRAME, SIDE = 648, 9
BODY = 4 + 2 + SIDE


def _crc_table() -> list[int]:
    out = []
    for i in range(256):
        r = i << 8
        for _ in range(8):
            r = (r << 1 ^ (0x8005 if r & 0x8000 else 0)) & 0xFFFF
        out.append(r)
    return out


CRC = _crc_table()


def frame_crc(data: bytes, bits: int | None = None) -> int:
    """The CRC-16 of MPEG audio over the first bits of data (all of them by default): polynomial 0x8005, start 0xFFFF."""
    r, bits = 0xFFFF, 8 * len(data) if bits is None else bits
    for b in data[: bits // 8]:
        r = (r << 8 & 0xFF00) ^ CRC[r >> 8 ^ b]
    for k in range(bits % 8):
        high = r >> 15 ^ data[bits // 8] >> 7 - k & 1
        r = (r << 1 & 0xFFFF) ^ (0x8005 if high else 0)
    return r


def _allocation(h: dict) -> tuple[tuple[int, int], ...]:
    """The allocation table of a Layer II frame, by its rate for each channel."""
    each = h["bitrate"] // 1000 // (1 if h["mono"] else 2)
    if h["version"] != "1":
        return ALLOCATION["low"]
    if each <= 48:
        return ALLOCATION["d" if h["hertz"] == 32000 else "c"]
    return ALLOCATION["a" if h["hertz"] == 48000 or each <= 80 else "b"]


def guarded(data: bytes, at: int, h: dict) -> tuple[bytes, int]:
    """What a frame's checksum covers, as bytes and a number of bits: the header's last 16 bits, then allocation (Layer I), allocation and scale factor selection (Layer II) or side information (Layer III)."""
    front, body, channels = data[at + 2 : at + 4], at + 6, 1 if h["mono"] else 2
    if h["layer"] == 3:
        bits = 8 * h["side"]
    elif h["layer"] == 1:
        bits = 4 * (channels * h["bound"] + 32 - h["bound"])
    else:
        whole, bits, used = int.from_bytes(data[body : body + 64].ljust(64, b"\0"), "big"), 0, 0
        widths = [w for w, n in _allocation(h) for _ in range(n)]
        for band, width in enumerate(widths):
            shared = channels == 2 and band >= h["bound"]
            for _ in range(1 if shared else channels):
                # a subband that both channels share selects scale factors for each
                if whole >> 512 - bits - width & (1 << width) - 1:
                    used += 2 if shared else 1
                bits += width
        bits += 2 * used
    return front + data[body : body + (bits + 7) // 8], 16 + bits


_heads: dict[bytes, dict | None] = {}


def head(four: bytes) -> dict | None:
    """A frame header's fields, or None where these four bytes can't be one."""
    if four in _heads:
        return _heads[four]
    out = None
    if len(four) == 4 and four[0] == 0xFF and four[1] >= 0xE0:
        version, layer = VERSIONS.get(four[1] >> 3 & 3), 4 - (four[1] >> 1 & 3)
        rate, hz = four[2] >> 4, four[2] >> 2 & 3
        if version and layer < 4 and 0 < rate < 15 and hz < 3 and four[3] & 3 != 2:
            hertz, bits = HERTZ[version][hz], 1000 * KBITS[version[0], layer][rate - 1]
            samples = 384 if layer == 1 else 576 if layer == 3 and version != "1" else 1152
            pad, mono = four[2] >> 1 & 1, four[3] >> 6 == 3
            size = (12 * bits // hertz + pad) * 4 if layer == 1 else samples // 8 * bits // hertz + pad
            side = 0 if layer < 3 else (17 if mono else 32) if version == "1" else (9 if mono else 17)
            out = {"version": version, "layer": layer, "bitrate": bits, "hertz": hertz, "samples": samples, "size": size, "side": side, "mono": mono, "bound": 4 * (four[3] >> 4 & 3) + 4 if four[3] >> 6 == 1 else 32, "crc": not four[1] & 1}
    if len(_heads) > 4096:
        _heads.clear()
    _heads[four] = out
    return out


def _tags(data: bytes) -> tuple[int, int, dict[str, str]]:
    """Where the frames may begin and must end, and the text of the tags around them."""
    begin, end, said = 0, len(data), {}
    while data[begin : begin + 3] == b"ID3" and begin + 10 <= end and max(data[begin + 6 : begin + 10]) < 128:
        size = 0
        for b in data[begin + 6 : begin + 10]:
            size = size << 7 | b
        at, stop, major = begin + 10, min(begin + 10 + size, end), data[begin + 3]
        while at + 10 <= stop and data[at]:
            name, raw = data[at : at + 4], data[at + 4 : at + 8]
            n = sum(b << s for b, s in zip(raw, (21, 14, 7, 0))) if major >= 4 else int.from_bytes(raw, "big")
            body, at = data[at + 10 : min(at + 10 + n, stop)], at + 10 + n
            if name[:1] == b"T" and body:
                text = body[1:].decode(("latin-1", "utf-16", "utf-16-be", "utf-8")[min(body[0], 3)], "replace").rstrip("\0")
                key, _, value = text.partition("\0") if name == b"TXXX" else (name.decode("latin-1"), "", text)
                said[key] = value
        begin = stop + (10 if data[begin + 5] & 0x10 else 0)
    if end - begin >= 128 and data[end - 128 : end - 125] == b"TAG":
        end -= 128
        for key, i, j in (("title", 3, 33), ("artist", 33, 63), ("album", 63, 93), ("year", 93, 97)):
            if value := data[end + i : end + j].rstrip(b"\0 ").decode("latin-1"):
                said.setdefault(key, value)
    if end - begin >= 32 and data[end - 32 : end - 24] == b"APETAGEX":
        size, flags = int.from_bytes(data[end - 20 : end - 16], "little"), int.from_bytes(data[end - 12 : end - 8], "little")
        end = max(begin, end - size - (32 if flags >> 31 else 0))
    return begin, end, said


def parse(data: bytes) -> dict:
    """Frames, tags, tables and times of an MPEG audio stream.

    offsets: of each audio frame.  duration: exact seconds, a Fraction (the sum of samples
    over Hz).  table: a Xing, Info or VBRI frame's fields, or None.  crc_seen, crc_bad:
    frames that have a checksum, and those whose checksum is wrong.  skipped: bytes between
    frames that belong to none.  Where nothing can be read: no frames.
    """
    begin, end, said = _tags(data)
    at, out, table, skipped, crc_seen, crc_bad = begin, [], None, 0, 0, 0
    duration, samples, kind, first, good, lost = Fraction(0), 0, None, None, set(), True
    while at + 4 <= end:
        h = head(data[at : at + 4])
        same = h and (kind is None or (h["version"], h["layer"], h["hertz"]) == kind)
        if same and at + h["size"] <= end:
            follows = at + h["size"]
            # out of step, or at the start: the next header must be there too
            if kind is not None and not lost or follows + 4 > end or head(data[follows : follows + 4]):
                lost = False
                kind = kind or (h["version"], h["layer"], h["hertz"])
                if h["crc"]:
                    crc_seen += 1
                    checked = *guarded(data, at, h), data[at + 4 : at + 6]
                    if checked not in good:
                        if frame_crc(*checked[:2]) == int.from_bytes(checked[2], "big"):
                            if len(good) < 64:
                                good.add(checked)
                        else:
                            crc_bad += 1
                found = None
                if first is None:
                    first = h
                    found = _table(data, at, h)
                if found:
                    table = found
                else:
                    out.append(at)
                    samples += h["samples"]
                at = follows
                continue
        lost = True
        following = data.find(b"\xff", at + 1, end)
        following = end if following < 0 else following
        skipped += following - at
        at = following
    skipped += max(0, end - at) if at < end else 0
    if kind:
        duration = Fraction(samples, kind[2])
    return {"offsets": out, "samples": samples, "duration": duration, "table": table, "tags": said, "crc_seen": crc_seen, "crc_bad": crc_bad, "skipped": skipped, "first": first, "kind": kind}


def _table(data: bytes, at: int, h: dict) -> dict | None:
    """The table in a first frame: Xing or Info after the side information, VBRI 32 bytes after the header."""
    i = at + 4 + (2 if h["crc"] else 0) + h["side"]
    if data[i : i + 4] in (b"Xing", b"Info"):
        flags, j = int.from_bytes(data[i + 4 : i + 8], "big"), i + 8
        out = {"kind": data[i : i + 4].decode()}
        for bit, key in ((1, "frames"), (2, "bytes")):
            if flags & bit:
                out[key], j = int.from_bytes(data[j : j + 4], "big"), j + 4
        if flags & 4:
            out["seek"] = list(data[j : j + 100])
        return out
    i = at + 36
    if data[i : i + 4] == b"VBRI":
        n, scale, width = (int.from_bytes(data[i + k : i + k + 2], "big") for k in (18, 20, 22))
        steps = [scale * int.from_bytes(data[i + 26 + k * width : i + 26 + (k + 1) * width], "big") for k in range(n)]
        return {"kind": "VBRI", "bytes": int.from_bytes(data[i + 10 : i + 14], "big"), "frames": int.from_bytes(data[i + 14 : i + 18], "big"), "seek": steps}
    return None


_CRC_BYTES = frame_crc(HEADER[2:4] + bytes(SIDE)).to_bytes(2, "big")
_LEAD = np.frombuffer(HEADER + _CRC_BYTES + bytes(SIDE), np.uint8)


def carry(raw: bytes) -> bytes:
    """Bytes as an MPEG audio stream: an ID3v2 tag with their number, an Info frame, then a frame for each 576 bytes, the last filled up with 255."""
    n = max(1, -(-len(raw) // UNIT))
    frames = np.zeros((n, FRAME), np.uint8)
    frames[:, :BODY] = _LEAD
    padded = np.full(n * UNIT, 255, np.uint8)
    padded[: len(raw)] = np.frombuffer(raw, np.uint8)
    frames[:, BODY : BODY + UNIT] = padded.reshape(n, UNIT)
    info = bytearray(FRAME)
    info[:BODY] = _LEAD.tobytes()
    seek = bytes(min(255, 256 * (FRAME + n * FRAME * k // 100) // ((n + 1) * FRAME)) for k in range(100))
    table = b"Info" + (7).to_bytes(4, "big") + n.to_bytes(4, "big") + ((n + 1) * FRAME).to_bytes(4, "big") + seek
    info[BODY : BODY + len(table)] = table
    text = b"\0payload_bytes\0" + str(len(raw)).encode()
    tag = b"TXXX" + len(text).to_bytes(4, "big") + b"\0\0" + text
    size = bytes(len(tag) >> s & 127 for s in (21, 14, 7, 0))
    return b"ID3\3\0\0" + size + tag + bytes(info) + frames.tobytes()


def payload(data: bytes, parsed: dict) -> np.ndarray:
    """What carry() stored, with what it filled up, from the frames that parse() found."""
    body = np.frombuffer(data, np.uint8)
    offsets = np.array(parsed["offsets"], np.int64)
    if len(offsets) and (np.diff(offsets) == FRAME).all():
        return body[offsets[0] : offsets[0] + len(offsets) * FRAME].reshape(-1, FRAME)[:, BODY : BODY + UNIT].reshape(-1)
    return body[(offsets[:, None] + np.arange(BODY, BODY + UNIT)).reshape(-1)]


def media_table(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text's bytes as a media column: (id, media), unshuffled. Null or empty text: a frame of 255s. Null id: kept. Repeated rows: as often. Empty table: no rows."""
    text_batches(df.sparkSession)
    schema = T.StructType([T.StructField(id_col, df.schema[id_col].dataType), T.StructField("media", T.BinaryType())])

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            media = [carry((x or "").encode("utf-8", "surrogatepass")) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(media, pa.binary())], names=schema.names)

    return df.select(id_col, text_col).mapInArrow(store, schema)


READ = "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, n_frames long, n_samples long, sample_rate int, duration_s double, crc_bad long, seek_offsets array<int>"


def read_media(media: DataFrame, id_col: str = "doc_id", every: int = 1) -> DataFrame:
    """Parse a media column that carry() wrote and read its payload back: a row for each stream.

    seek_offsets has the place of each frame (of each every-th one, where asked); duration_s is the nearest double to
    the exact duration, which feature states as samples/Hz.  Null or empty text: one frame
    of 255s.  Null id: kept.  Repeated rows: as often.  Empty table: no rows.
    """
    schema = T.StructType([T.StructField(id_col, media.schema[id_col].dataType), *T.StructType.fromDDL(READ).fields])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            rows = []
            for data in batch.column(1).to_pylist():
                p = parse(data)
                body = payload(data, p)
                n = int(p["tags"]["payload_bytes"])
                if p["crc_bad"] or p["skipped"] or p["table"]["frames"] != len(p["offsets"]):
                    raise ValueError("a stored stream is damaged")
                centred = body[:n].astype(np.int64) - 128
                energy, crossings = int((centred * centred).sum()), int(np.count_nonzero(np.diff(centred < 0)))
                feature = f"frames={len(p['offsets'])};duration={p['samples']}/{p['kind'][2]};energy={energy};crossings={crossings};mean={centred.sum() / max(1, n):.6f}"
                raw = body.tobytes()
                rows.append((n, len(raw), hashlib.sha256(raw).hexdigest(), zlib.crc32(raw[-32:]), len(data), hashlib.sha256(data).hexdigest(), feature, len(p["offsets"]), p["samples"], p["kind"][2], float(p["duration"]), p["crc_bad"], p["offsets"][::every]))
            if rows:
                arrays = [pa.array(list(c)) for c in zip(*rows)]
                arrays[9], arrays[12] = arrays[9].cast(pa.int32()), pa.array([r[12] for r in rows], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=schema.names)

    return media.select(id_col, "media").mapInArrow(read, schema)


def media_columns(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Store every text as a media column in the shared folder, then parse and read the stored bytes back: read_media()'s rows."""
    return read_media(stored(media_table(df, id_col, text_col), "media", "zstd"), id_col)
