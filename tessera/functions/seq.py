"""Column expressions over reads, qualities and primers.

What looks at every base of every read runs over Arrow batches (``kernels``); all else runs
inside the JVM.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions import kernels
from tessera.params import Matching, ReadQC


def phred(quality: Column) -> Column:
    """Phred+33 text as an array of scores; empty for an empty text."""
    return F.when(F.length(quality) == 0, F.array().cast("array<int>")).otherwise(F.transform(F.split(quality, ""), lambda c: F.ascii(c) - 33))


def mean_phred(quality: Column) -> Column:
    """Mean score, 0.0 if empty."""
    return F.when(F.length(quality) == 0, F.lit(0.0)).otherwise(F.aggregate(phred(quality), F.lit(0).cast("long"), lambda t, x: t + x) / F.length(quality))


def bases_at_least(quality: Column, score: int) -> Column:
    """How many scores are at least score."""
    return F.size(F.filter(phred(quality), lambda x: x >= score))


def _numbers(found: np.ndarray) -> pa.Array:
    """Numbers, null where they are negative."""
    return pa.array(found.astype(np.int32), pa.int32(), mask=found < 0)


def qc_reason(r1: Column, q1: Column, r2: Column, q2: Column, p: ReadQC = ReadQC()) -> Column:
    """Why a pair fails, or null; the rules apply in order. The barcode's bases are held against the mean's threshold. Null counts as empty."""

    @F.arrow_udf("string")
    def reason(a: pa.Array, b: pa.Array, c: pa.Array, d: pa.Array) -> pa.Array:
        return kernels.qc_reason(a, b, c, d, p.min_length, p.min_mean_phred, p.barcode_length, p.min_barcode_bases)

    return reason(r1, q1, r2, q2)


def hamming(a: Column, b: Column) -> Column:
    """Differing places of two texts of the same length; bytes are compared as one long expression over arrays."""
    return F.aggregate(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: F.when(x == y, 0).otherwise(1)), F.lit(0), lambda t, x: t + x)


def edit_distance(a: Column, b: Column, most: int) -> Column:
    """Levenshtein distance, or most + 1 beyond most."""
    d = F.levenshtein(a, b, most)
    return F.when(d < 0, most + 1).otherwise(d)


def windows(primer: str, max_shift: int, max_edits: int, centre: int = 0) -> list[tuple[str, int, int]]:
    """Where a primer may stand: (what is left of the primer, start, length).

    A shift to the left of centre drops the primer's first bases and stays at centre.
    """
    primer, indel, out = primer.strip().upper(), min(max_edits, 2), []
    for shift in range(-max_shift, max_shift + 1):
        rest, start = (primer, centre + shift) if shift >= 0 else (primer[-shift:], centre)
        if start >= 0 and rest:
            out += [(rest, start, n) for n in range(max(1, len(rest) - indel), len(rest) + indel + 1)]
    return out


def primer_matches(seq: Column, primer: str, max_shift: int, max_edits: int, centre: int = 0) -> Column:
    """Whether a primer stands near centre with at most max_edits edits.

    Windows of the primer's own length are compared place by place, others by edit distance.
    """

    @F.arrow_udf("boolean")
    def matches(reads: pa.Array) -> pa.Array:
        return pa.array(kernels.primer_matches(reads, primer, max_shift, max_edits, centre))

    return matches(seq)


#: What stands for a distance beyond the limit: levenshtein's -1 modulo 100.
_FAR = 99


def _distance_or_far(seq: Column, primer: str, start: int, max_edits: int) -> Column:
    """The least edit distance at one start over all window lengths, _FAR if none is accepted; seq is upper case."""
    indel = min(max_edits, 2)
    tries = []
    for n in range(max(1, len(primer) - indel), len(primer) + indel + 1):
        window = F.substring(seq, start + 1, n)
        tries.append(F.when(F.length(window) == n, F.pmod(F.levenshtein(F.lit(primer), window, max_edits), F.lit(100))).otherwise(_FAR))
    return F.least(*tries) if len(tries) > 1 else tries[0]


def primer_distance_at(seq: Column, primer: str, start: int, max_edits: int) -> Column:
    """The least accepted edit distance of a primer at one start, or null."""
    return F.nullif(_distance_or_far(F.upper(F.trim(seq)), primer.strip().upper(), start, max_edits), F.lit(_FAR))


def primer_start(seq: Column, primer: str, p: Matching = Matching()) -> Column:
    """The start with the least distance among the valid ones, the first on ties; null if none fits."""

    @F.arrow_udf("int")
    def start(reads: pa.Array) -> pa.Array:
        return _numbers(kernels.primer_start(reads, primer, list(p.r1_starts), p.max_edits))

    return start(seq)


def place_16s(r1: Column, r2: Column, fwd: str, rev: str, p: Matching = Matching()) -> Column:
    """primer_start() on R1, null unless R2's primer matches too; R2 is looked at only where R1 has a start."""

    @F.arrow_udf("int")
    def place(a: pa.Array, b: pa.Array) -> pa.Array:
        return _numbers(kernels.place_16s(a, b, fwd, rev, list(p.r1_starts), p.max_edits, p.max_shift, p.r2_primer_start))

    return place(r1, r2)


def gene_of(r1: Column, r2: Column, skip: Column, panel: list[tuple[int, str, str]], p: Matching = Matching()) -> Column:
    """The number of the first row (number, fwd, rev) of a panel whose primers both match: exact ones before near ones. skip: reads that row 0 isn't held against."""

    @F.arrow_udf("int")
    def gene(a: pa.Array, b: pa.Array, c: pa.Array) -> pa.Array:
        return _numbers(kernels.gene_of(a, b, np.array(c.fill_null(False)), panel, p.max_shift, p.max_edits, p.r2_primer_start))

    return gene(r1, r2, skip)


def pair_distance(a: Column, b: Column, max_shift: int) -> Column:
    """paired_semi_global() of two cores over Arrow batches, for very many pairs."""

    @F.arrow_udf("int")
    def distance(a1: pa.Array, a2: pa.Array, b1: pa.Array, b2: pa.Array) -> pa.Array:
        return pa.array(np.maximum(kernels.shifted(a1, b1, max_shift), kernels.shifted(a2, b2, max_shift)).astype(np.int32))

    return distance(a["r1"], a["r2"], b["r1"], b["r2"])


def after(seq: Column, start: Column | int, primer: str) -> Column:
    """What follows a primer that stands at start."""
    start = start if isinstance(start, Column) else F.lit(start)
    return F.substring(seq, start + len(primer) + 1, F.length(seq))


def barcode(r2: Column, length: int = 20) -> Column:
    return F.substring(r2, 1, length)


def core(r1: Column, r2: Column, r1_span: tuple[int, int] = (30, 120), r2_span: tuple[int, int] = (70, 120), start: Column | None = None) -> Column:
    """The core sequence (r1, r2), null where a mate is too short; start shifts R1's span."""
    shift = F.lit(0) if start is None else start
    (a, b), (c, d) = r1_span, r2_span
    return F.when((F.length(r1) >= shift + b) & (F.length(r2) >= d), F.struct(F.substring(r1, shift + a + 1, F.lit(b - a)).alias("r1"), F.substring(r2, F.lit(c + 1), F.lit(d - c)).alias("r2")))


def semi_global(a: Column, b: Column, max_shift: int) -> Column:
    """Fewest mismatches of the overlap over shifts up to max_shift either way; a shift costs nothing."""

    def at(s: int) -> Column:
        x = a if s <= 0 else F.substring(a, F.lit(s + 1), F.length(a))
        y = b if s >= 0 else F.substring(b, F.lit(1 - s), F.length(b))
        n = F.least(F.length(x), F.length(y))
        return hamming(F.substring(x, F.lit(1), n), F.substring(y, F.lit(1), n))

    tries = [at(s) for s in range(-max_shift, max_shift + 1)]
    return F.least(*tries) if len(tries) > 1 else tries[0]


def paired_semi_global(a: Column, b: Column, max_shift: int) -> Column:
    """The larger distance of the two mates, each at its own best shift; a and b are cores."""
    return F.greatest(semi_global(a["r1"], b["r1"], max_shift), semi_global(a["r2"], b["r2"], max_shift))


def shift_match(a: Column, b: Column, max_shift: int = 1) -> Column:
    """Whether two barcodes are equal, or equal once one of them is shifted by up to max_shift."""
    out = a == b
    for s in range(1, max_shift + 1):
        # the shorter side's overlap must stand at the other's shifted beginning
        out = out | ((F.length(a) > s) & (F.length(b) > s) & (
            (F.substring(a, F.lit(s + 1), F.length(a)) == F.substring(b, F.lit(1), F.length(a) - s))
            | (F.substring(b, F.lit(s + 1), F.length(b)) == F.substring(a, F.lit(1), F.length(b) - s))))
    return out


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGTacgt", "TGCAtgca"))


def last_bases(seq: Column, n: int = 60) -> Column:
    return F.when(F.length(seq) > n, F.substring(seq, -n, n)).otherwise(seq)


def tool_number(line: Column) -> Column:
    """The 14th token of a tool's output line as a number, else the first number in it."""
    token = F.try_element_at(F.split(F.trim(line), r"\s+"), F.lit(14))
    first = F.regexp_extract(line, r"[-+]?\d+(?:\.\d+)?(?:[eE][-+]?\d+)?", 0)
    return F.coalesce(token.try_cast("double"), F.nullif(first, F.lit("")).try_cast("double"))


def percent(text: Column) -> Column:
    """"100%" as 100.0."""
    return F.rtrim(F.trim(text.cast("string")), F.lit("%")).try_cast("double")


# Fixed values of the result format: rank codes and their names, and how a lineage reads.
RANKS = {"R1": "domain", "P": "phylum", "C": "class", "O": "order", "F": "family", "G": "genus", "S": "species"}


def lineage(path: Column) -> Column:
    """A path of seven ranks as "R1 - x | P - y | ..."; null ranks read None."""
    return F.concat_ws(" | ", *[F.concat(F.lit(f"{code} - "), F.coalesce(path[code], F.lit("None"))) for code in RANKS])


def parse_lineage(text: Column) -> Column:
    """The path of a lineage text."""
    parts = F.str_to_map(text, F.lit(r" \| "), F.lit(" - "))
    return F.struct(*[F.nullif(parts[code], F.lit("None")).alias(code) for code in RANKS])


def ranks_struct(path: Column) -> Column:
    """A path under the ranks' names."""
    return F.struct(*[path[code].alias(name) for code, name in RANKS.items()])


def most_specific(path: Column) -> Column:
    """The last rank that isn't null."""
    return F.coalesce(*[path[code] for code in reversed(RANKS)])


def species_complex(path: Column, genus: str = "Klebsiella") -> Column:
    """Species of a genus that can't be told apart become one complex."""
    hit = F.coalesce(path["G"].startswith(genus), F.lit(False))
    return F.struct(*[(F.when(hit, F.lit(f"{genus} pneumoniae complex")).otherwise(path["G"]) if c == "G" else F.when(~hit, path["S"]) if c == "S" else path[c]).alias(c) for c in RANKS])


def display_label(text: Column, width: int = 18) -> Column:
    """Words wrapped into lines of at most width characters."""
    words = F.split(F.trim(text), r"\s+")
    step = lambda t, w: F.when(t == "", w).when(F.length(F.substring_index(t, "\n", -1)) + 1 + F.length(w) <= width, F.concat(t, F.lit(" "), w)).otherwise(F.concat(t, F.lit("\n"), w))
    return F.aggregate(words, F.lit(""), step)


# The words that options and tables take for true and false.
FLAGS = {"true": True, "1": True, "yes": True, "y": True, "false": False, "0": False, "no": False, "n": False}


def flag(text: Column) -> Column:
    """What FLAGS says of a word, in any case and with blanks around; any other word ends the query."""
    word = F.lower(F.trim(text))
    known = F.element_at(F.create_map(*[F.lit(x) for item in FLAGS.items() for x in item]), word)
    return F.when(text.isNotNull(), F.coalesce(known, F.raise_error(F.concat(F.lit("neither true nor false: "), text)).cast("boolean")))
