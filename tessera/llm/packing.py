"""Packing: sum-of-squares online packing of documents into fixed windows of tokens."""

from __future__ import annotations

import functools
import os
import string
import unicodedata
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tessera.llm.common import portions, text_batches

WINDOW = 2048
END_ID = 1
#: Entries of a worker's table of known words; it starts anew beyond that, which bounds its memory.
KNOWN_WORDS = 500_000

PIECES = T.StructType([
    T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
    T.StructField("doc_tokens", T.LongType()), T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()),
])


class LevelArray:
    """Open windows by fill level, for one window length.

    counts[l] is the number of windows filled to level l, 0 < l < window.  A piece goes to
    the level that makes the sum of the squared counts smallest; moving a window from l to
    l + size changes it by 2 * (counts[l + size] - counts[l]) + 2, opening a window
    (level 0) by 2 * counts[size] + 1, and filling one up leaves only the loss at l.  Ties
    go to the fuller window.
    """

    def __init__(self, window: int):
        self.window = window
        self.counts = np.zeros(window + 1, np.int64)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]
        self.next_id = 0

    def place(self, size: int) -> tuple[int, int]:
        """Put a piece of size tokens; give its window's number and the offset there."""
        if size >= self.window:
            self.next_id += 1
            return self.next_id - 1, 0
        counts, top = self.counts, self.window - size
        change = 2 * (counts[1 + size : top + size + 1] - counts[1 : top + 1]) + 2
        change[-1] = 1 - 2 * counts[top]  # a window filled up leaves the array
        change = np.where(counts[1 : top + 1] > 0, change, np.iinfo(np.int64).max)
        best = top - int(np.argmin(change[::-1])) if len(change) else 0
        if not best or change[best - 1] > 2 * counts[size] + 1:
            window_id, level, self.next_id = self.next_id, 0, self.next_id + 1
        else:
            window_id, level = self.open[best].pop(), best
            counts[best] -= 1
        if level + size < self.window:
            counts[level + size] += 1
            self.open[level + size].append(window_id)
        return window_id, level


#: Ids of texts, one after another, and each text's length in ids.
Reader = Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]

_readers: dict[str, Reader] = {}


def word_ids(tokenizer_path: str) -> Reader:
    """word_reader(), one for each worker: later tasks find the words that earlier ones met."""
    if tokenizer_path not in _readers:
        _readers[tokenizer_path] = word_reader(tokenizer_path)
    return _readers[tokenizer_path]


#: Strings of special tokens and separators that Python alone, or the tokenizer alone, takes for white space.
ODD = "<\\||[\\x1c-\\x1f\\x{85}\\x{200b}\\x{feff}\\x{180e}]"
#: ASCII punctuation that the splitter keeps together; an apostrophe may begin a contraction.
MARKS = "".join(c for c in string.punctuation if c != "'")
#: Words that are sent to the tokenizer as one text.
TOGETHER = 1000


@functools.lru_cache(1 << 16)
def _ends_letters(c: str) -> bool:
    """Whether a letter stays one when the tokenizer normalises it, so that marks beside it are on their own."""
    return c.isascii() or len(unicodedata.normalize("NFC", c).lower()) == 1 and unicodedata.ucd_3_2_0.category(c)[0] == "L"


def word_reader(tokenizer_path: str) -> Reader:
    """Ids of texts by the tokenizer at that path, without special tokens added.

    The vocabulary's splitter never joins across white space, so that a word between white
    space always has the same ids, nor letters with the marks around them.  The distinct
    words of the texts are looked up, once each, in a table of known words.  Texts where that
    might not hold (ODD) go to the tokenizer whole.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path)
    assert tokenizer.get_vocab_size() <= 1 << 16
    ends_word = np.zeros(1 << 16, bool)
    ends_word[[i for w, i in tokenizer.get_vocab().items() if w.endswith("</w>")]] = True
    known: dict[str, bytes] = {}

    def packed(texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, np.uint16).tobytes() for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def learn_letters(words: list[str]) -> None:
        """Words of letters alone go in together: each ends at the next id of an end-of-word entry."""
        for k in range(0, len(words), TOGETHER):
            some = words[k : k + TOGETHER]
            got = np.array(tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, np.uint16)
            stops = np.flatnonzero(ends_word[got]) + 1
            if len(stops) == len(some) and stops[-1] == len(got):
                whole, cuts = got.tobytes(), [0, *(2 * stops).tolist()]
                known.update((w, whole[i:j]) for w, i, j in zip(some, cuts, cuts[1:]))
            else:
                known.update(zip(some, packed(some)))

    def learn(words: list[str]) -> None:
        """Letters with marks around them are three words; ASCII letters are learnt in lower case, as the tokenizer has them."""
        letters: set[str] = set()
        rest: set[str] = set()
        made: list[tuple[str, str, str, str]] = []
        for w in words:
            if w.isalpha():
                low = w.lower() if w.isascii() else w
                letters.add(low)
                if low != w:
                    made.append((w, "", low, ""))
                continue
            core = w.strip(MARKS)
            if len(core) == len(w) or not core.isalpha() or not (plain := core.isascii()) and not (_ends_letters(core[0]) and _ends_letters(core[-1])):
                rest.add(w)
                continue
            low = core.lower() if plain else core
            lead, _, trail = w.partition(core)
            letters.add(low)
            rest.add(lead)
            rest.add(trail)
            made.append((w, lead, low, trail))
        learn_letters([w for w in letters if w not in known])
        others = [w for w in rest if w not in known]
        known.update(zip(others, packed(others)))
        known[""] = b""
        for w, lead, low, trail in made:
            known[w] = known[lead] + known[low] + known[trail]

    def of_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        nonlocal known
        split = pc.utf8_split_whitespace(texts)
        words = split.flatten().dictionary_encode()
        distinct = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        new = [w for w in distinct if w not in known]
        if new and len(known) > KNOWN_WORDS:
            known = {w: known[w] for w in distinct if w in known}
        learn(new)
        each = [known[w] for w in distinct]
        table, sizes = np.frombuffer(b"".join(each), np.uint16), np.fromiter(map(len, each), np.int64, len(each)) // 2
        at = np.asarray(words.indices)
        size = sizes[at]
        ends = np.cumsum(size)
        # where each word's ids begin in the table, less where they go
        shift = (np.cumsum(sizes) - sizes)[at] - (ends - size)
        ids = table[np.repeat(shift, size) + np.arange(ends[-1] if len(ends) else 0)]
        ends = np.concatenate([[0], ends])
        last = np.cumsum(np.asarray(pc.list_value_length(split)).astype(np.int64))
        return ids, np.diff(ends[last], prepend=0)

    def read(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if texts.null_count:
            texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, ODD)
        if not pc.any(odd).as_py():
            return of_words(texts)
        ids, n = of_words(pc.if_else(odd, pa.scalar("", texts.type), texts))
        whole = [np.frombuffer(b, np.uint16) for b in packed(texts.filter(odd).to_pylist())]
        parts, at = np.split(ids, np.cumsum(n)[:-1]), np.flatnonzero(np.asarray(odd))
        for k, w in zip(at.tolist(), whole):
            parts[k] = w
        return np.concatenate(parts), np.array(list(map(len, parts)), np.int64)

    return read


def pack(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """Pack all documents into windows of tokens: a row for each piece.

    A document longer than a window gives full windows first; what remains goes through
    the level array of its input partition, in the partition's order.  There is no
    shuffle, the state is one level array, and a lost task packs the same rows again.
    sequence_id is the partition's number times 2**33 plus the window's number there.

    Null or empty text: one piece that holds end_id alone.  Null id: kept, as null.
    Repeated rows: each is packed.  Empty table: no rows.  Other columns are not read.
    """
    text_batches(df.sparkSession)
    schema = T.StructType([T.StructField(id_col, df.schema[id_col].dataType), *PIECES.fields])

    def partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, levels = word_ids(tokenizer_path), LevelArray(window)
        first = TaskContext.get().partitionId() << 33
        for batch in portions(batches):
            rows: list[tuple[int, ...]] = []
            flat, sizes = ids_of(batch.column(1))
            ends = np.cumsum(sizes)
            for k, (low, high) in enumerate(zip((ends - sizes).tolist(), ends.tolist())):
                ids = np.append(flat[low:high], end_id).astype("<u4")
                for start in range(0, len(ids), window):
                    piece = ids[start : start + window]
                    number, offset = levels.place(len(piece))
                    rows.append((k, start, len(piece), zlib.crc32(piece.tobytes()), len(ids), first + number, offset))
            if rows:
                of, *columns = np.array(rows, np.int64).T
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(of)), *map(pa.array, columns)], names=schema.names)

    return df.select(id_col, text_col).mapInArrow(partition, schema)
