"""SentencePiece encoding and decoding: an Aho-Corasick automaton over the pieces drives a single pass.

For a unigram model that is a Viterbi over the sums of scores.  A BPE model's scores are ranks
of merges: of the pieces that end at a place, that is the last one of the text up to there
which merges leave apart from the last one before it.
"""

from __future__ import annotations

import re
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tessera.llm.common import portions, text_batches

SPACE = "▁"
#: A unit: spaces in a row and what follows up to the next. No piece goes on behind a space, so units are independent.
UNIT = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
KNOWN_UNITS = 400_000
#: What an unknown character costs below the worst piece.
UNKNOWN_COST = 10.0


class Pieces:
    """A vocabulary's automaton: goto edges, failure links, and output links to the next shorter piece that ends at the same place."""

    def __init__(self, pieces: list[str], scores: list[float], usable: list[bool], byte_ids: list[int], unknown_id: int, bpe: bool = False, lead: bool = True):
        self.lead = lead
        self.pieces, self.scores, self.byte_ids, self.unknown_id = pieces, scores, byte_ids, unknown_id
        self.floor = min([s for s, u in zip(scores, usable) if u], default=0.0) - UNKNOWN_COST
        self.edges: list[dict[str, int]] = [{}]
        self.piece: list[int] = [-1]
        for i, (p, u) in enumerate(zip(pieces, usable)):
            if not u or not p:
                continue
            state = 0
            for c in p:
                to = self.edges[state].get(c)
                if to is None:
                    to = self.edges[state][c] = len(self.edges)
                    self.edges.append({})
                    self.piece.append(-1)
                state = to
            self.piece[state] = i
        self.fail = [0] * len(self.edges)
        #: The longest piece that ends in a state, its own or its output link's: (length, score, id, the next shorter one), or None.
        self.outputs: list[tuple | None] = [None] * len(self.edges)
        queue, order = deque([0]), []
        while queue:
            state = queue.popleft()
            for c, to in self.edges[state].items():
                if state:
                    back = self.fail[state]
                    while back and c not in self.edges[back]:
                        back = self.fail[back]
                    self.fail[to] = self.edges[back].get(c, 0)
                queue.append(to)
                order.append(to)
        self.raw = [b""] * len(pieces)
        for i, p in enumerate(pieces):
            self.raw[i] = p.replace(SPACE, " ").encode()
        for value, i in enumerate(byte_ids):
            self.raw[i] = bytes([value])
        # where SPACE is a piece as well, no unknown run goes across units
        self.plain = all(SPACE not in p.lstrip(SPACE) for p, u in zip(pieces, usable) if u) and any(p == SPACE for p, u in zip(pieces, usable) if u)
        self.known: dict[str, bytes] = {}
        self.bpe, self.apart = bpe, {}
        if bpe:
            self.rank = {p: (-s, i) for i, (p, s, u) in enumerate(zip(pieces, scores, usable)) if u and p}
            # pieces that merges don't reach never come up
            reached = {i for p, (_, i) in self.rank.items() if len(self.merged(p)) == 1}
        # in breadth first order a state's failure link, which is shorter, has its output already
        for state in order:
            i, link = self.piece[state], self.outputs[self.fail[state]]
            self.outputs[state] = (len(pieces[i]), scores[i], i, link) if i >= 0 and (not bpe or i in reached) else link

    @classmethod
    def load(cls, path: str) -> Pieces:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        spec = sentencepiece_model_pb2.ModelProto.FromString(model.serialized_model_proto())
        n = model.get_piece_size()
        pieces = [model.id_to_piece(i) for i in range(n)]
        byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)] if any(map(model.is_byte, range(n))) else []
        usable = [not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)) for i in range(n)]
        rules = spec.normalizer_spec
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces:
            raise ValueError("models whose texts are normalised first can't be used: encoding must be lossless")
        if any(p.type == p.USER_DEFINED for p in spec.pieces):
            raise ValueError("models with pieces that go before all others can't be used")
        bpe = spec.trainer_spec.model_type == spec.trainer_spec.BPE
        if not bpe and spec.trainer_spec.model_type != spec.trainer_spec.UNIGRAM:
            raise ValueError("the model is neither a unigram nor a BPE model")
        return cls(pieces, [model.get_score(i) for i in range(n)], usable, byte_ids, model.unk_id(), bpe, rules.add_dummy_prefix)

    def viterbi(self, text: str) -> list[int]:
        """Ids of the segmentation with the largest sum of scores, in one pass; of equal ones, that with the longer last piece. text has SPACE for blanks."""
        n = len(text)
        best, back = [0.0] * (n + 1), [(-1, 0)] * (n + 1)
        edges, fail, outputs, state = self.edges, self.fail, self.outputs, 0
        for end, c in enumerate(text, 1):
            while state and c not in edges[state]:
                state = fail[state]
            state = edges[state].get(c, 0)
            top, via = best[end - 1] + self.floor, (-1, end - 1)
            out = outputs[state]
            while out:
                length, score, i, out = out
                s = best[end - length] + score
                if s > top:
                    top, via = s, (i, end - length)
            best[end], back[end] = top, via
        out: list[int] = []
        while n:
            i, begin = back[n]
            if i >= 0:
                out.append(i)
            elif self.byte_ids:
                out.extend(self.byte_ids[b] for b in reversed(text[begin:n].encode("utf-8", "surrogatepass")))
            elif not out or out[-1] != self.unknown_id:
                out.append(self.unknown_id)  # unknown characters in a row are one
            n = begin
        return out[::-1]

    def merged(self, text: str) -> list[str]:
        """Characters merged by rank, the leftmost of equal ones first; for texts of a piece or two."""
        parts, rank = list(text), self.rank
        while True:
            found = [(rank[x + y][0], k) for k, (x, y) in enumerate(zip(parts, parts[1:])) if x + y in rank]
            if not found:
                return parts
            k = min(found)[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]

    def merges(self, text: str) -> list[int]:
        """Ids of a BPE model's encoding, in one pass. text has SPACE for blanks."""
        n = len(text)
        back = [(-1, 0)] * (n + 1)
        edges, fail, outputs, apart, state = self.edges, self.fail, self.outputs, self.apart, 0
        for end, c in enumerate(text, 1):
            while state and c not in edges[state]:
                state = fail[state]
            state = edges[state].get(c, 0)
            back[end] = (-1, end - 1)
            out = outputs[state]
            while out:
                length, _, i, out = out
                before = back[end - length][0]
                if before >= 0:
                    whole = apart.get((before, i))
                    if whole is None:
                        if len(apart) > KNOWN_UNITS:
                            apart.clear()
                        two = [self.pieces[before], self.pieces[i]]
                        whole = apart[before, i] = self.merged(two[0] + two[1]) == two
                    if not whole:
                        continue
                back[end] = (i, end - length)
                break
        out: list[int] = []
        while n:
            i, begin = back[n]
            if i >= 0:
                out.append(i)
            elif self.byte_ids:
                out.extend(self.byte_ids[b] for b in reversed(text[begin:n].encode("utf-8", "surrogatepass")))
            elif not out or out[-1] != self.unknown_id:
                out.append(self.unknown_id)
            n = begin
        return out[::-1]

    def segmented(self, text: str) -> list[int]:
        return self.merges(text) if self.bpe else self.viterbi(text)

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text: where the model says so, a space goes before it; blanks count as SPACE."""
        if not text:
            return np.zeros(0, np.int32)
        text = (SPACE if self.lead else "") + text.replace(" ", SPACE)
        if not self.plain:
            return np.array(self.segmented(text), np.int32)
        known, units = self.known, UNIT.findall(text)
        new = set(units).difference(known)
        if new:
            if len(known) > KNOWN_UNITS:
                known.clear()
                new = set(units)
            for u in new:
                known[u] = np.array(self.segmented(u), np.int32).tobytes()
        return np.frombuffer(b"".join(map(known.__getitem__, units)), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: bytes put together, SPACE as a blank, without the one that encode() puts first."""
        raw = b"".join(map(self.raw.__getitem__, ids.tolist()))
        return (raw.removeprefix(b" ") if self.lead else raw).decode("utf-8", "replace")


_loaded: dict[str, Pieces] = {}


def loaded(path: str) -> Pieces:
    """A worker's automaton for that model."""
    if path not in _loaded:
        _loaded[path] = Pieces.load(path)
    return _loaded[path]


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids): every whole text encoded. Null or empty text: no ids. Null id: kept. Repeated rows: as often. Empty table: no rows. No shuffle."""
    text_batches(docs.sparkSession)
    schema = T.StructType([docs.select(id_col).schema[0], T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = loaded(model_path)
        for batch in portions(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([model.encode(x or "") for x in batch.column(1).to_pylist()], pa.list_(pa.int32()))], names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def decode(encoded: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text): ids decoded; null ids give a null text, no ids an empty one. Repeated rows: as often. Empty table: no rows."""
    schema = T.StructType([encoded.select(id_col).schema[0], T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = loaded(model_path)
        for batch in batches:
            texts = [None if x is None else model.decode(np.array(x, np.int32)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=schema.names)

    return encoded.select(id_col, ids_col).mapInArrow(run, schema)


def round_trip(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_ids, ids_crc32, n_byte_ids, text_bytes, lossless): each text encoded and decoded again, in one pass.

    lossless: whether decoding gives the text back (but for SPACE itself, which a decoder can't tell from a blank).
    Null or empty text: no ids, lossless.  Null id: kept.  Repeated rows: as often.  Empty table: no rows.
    """
    text_batches(docs.sparkSession)
    own = docs.select(id_col).schema[0]
    schema = T.StructType([own, T.StructField("n_ids", T.LongType()), T.StructField("ids_crc32", T.LongType()), T.StructField("n_byte_ids", T.LongType()), T.StructField("text_bytes", T.LongType()), T.StructField("lossless", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = loaded(model_path)
        fallback = np.zeros(len(model.pieces), bool)
        fallback[model.byte_ids] = True
        for batch in portions(batches):
            rows = []
            for x in batch.column(1).to_pylist():
                x = x or ""
                ids = model.encode(x)
                rows.append((len(ids), zlib.crc32(ids.astype("<u4").tobytes()), int(fallback[ids].sum()), len(x.encode("utf-8", "surrogatepass")), model.decode(ids) == x.replace(SPACE, " ")))
            if rows:
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(list(c)) for c in zip(*rows))], names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(run, schema)
