"""Near-dedup by SimHash, with vantage-point trees over the fingerprints.

1. A text's fingerprint: 64 bits, each set if it is set in over half of the XXH64 hashes of
   the text's word shingles, repeats included.  Texts of one fingerprint are one class.
2. A vantage-point tree is fitted on a bounded sample: a node has a vantage point and a
   radius; fingerprints nearer to the point than the radius go inside, others outside.  By
   the triangle inequality two fingerprints that differ in at most `differ` bits have
   distances from the point that differ by as much at most, so that a pair on both sides has
   its inner member within `differ` of the radius.  These go to both sides, and so each pair
   that links meets in a shard.  Every fingerprint is routed, sampled or not.
3. Shards that hold more than expected get a tree of their own, on a sample of theirs.
4. In a shard the same tree goes on down to small buckets, whose members are compared.
5. Connected components of the pairs.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.common import integer_id, portions, scratch, stored, text_batches
from tessera.llm.minhash import components

SEED = 42
#: Fingerprints that a tree is fitted on, at most.
SAMPLE = 1 << 15
#: Fingerprints that a shard is meant to have, and those beyond which it gets a tree of its own; each such shard's sample, at least.
SHARD, LARGE, MORE = 1024, 1 << 18, 512
#: Members of a bucket in a shard that are compared with one another without a further node.
BUCKET = 96
#: Shingles whose bits are counted at a time, and bytes of texts that are cut into words at a time.
STRETCH, PIECE = 1 << 16, 1 << 21
#: Sampled fingerprints below which no further node is fitted; vantage points that are tried for a node.
FEW, TRIES = 16, 6


_GAP = re.compile(rb"[\x20\x09-\x0d]")


def word_runs(text: bytes, overlap: int) -> Iterator[list[bytes]]:
    """Words of a text (runs of other bytes than white space, A-Z in lower case): a stretch of it at a time, each led by the last words before it."""
    begin, before = 0, []
    while begin < len(text):
        gap = _GAP.search(text, begin + PIECE)
        end = gap.start() if gap else len(text)
        words = before + text[begin:end].lower().split()
        yield words
        begin, before = end, words[max(0, len(words) - overlap) :]


def shingle_hashes(text: bytes, n: int) -> Iterator[np.ndarray]:
    """XXH64 of each run of n words, joined by spaces, a stretch at a time; fewer words are one run, no words none."""
    some = False
    for words in word_runs(text, n - 1):
        for low in range(0, len(words) - n + 1, STRETCH):
            part = words[low : low + STRETCH + n - 1]
            yield _hashes(map(b" ".join, zip(*[part[k:] for k in range(n)])))
            some = True
    if not some and len(text) and words:
        yield _hashes([b" ".join(words)])


def _hashes(runs: Iterable[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join([xxhash.xxh64_digest(r, SEED) for r in runs]), ">u8")


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many hashes have each of the 64 bits, the highest first."""
    return np.unpackbits(hashes.astype(">u8", copy=False).view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)


def fingerprint(text: bytes, n: int = 3) -> int:
    """The SimHash of a text as a signed 64-bit number; 0 without words."""
    counts, total = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(text, n):
        counts += bit_counts(hashes)
        total += len(hashes)
    return int(np.packbits(2 * counts > total).view(">i8")[0])


def _fingerprints(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, limit=PIECE):
            texts = batch.column(1).cast(pa.binary() if pa.types.is_string(batch.column(1).type) else pa.large_binary())
            found = [fingerprint(t, n) if t else 0 for t in texts.to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], names=["id", "fp"])

    return run


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bits in which fingerprints differ; of signed numbers NumPy would count those of the magnitude."""
    return np.bitwise_count((a ^ b).view(np.uint64)).astype(np.int64)


class Tree:
    """Nodes as arrays: vantage point, radius, inner and outer child; a leaf has -1 as children and a shard's number."""

    def __init__(self) -> None:
        self.point: list[int] = []
        self.radius: list[int] = []
        self.inner: list[int] = []
        self.outer: list[int] = []
        self.shard: list[int] = []
        self.shards = 0

    def leaf(self) -> int:
        self.point.append(0)
        self.radius.append(0)
        self.inner.append(-1)
        self.outer.append(-1)
        self.shard.append(self.shards)
        self.shards += 1
        return len(self.point) - 1

    def grow(self, node: int, sample: np.ndarray, enough: float, differ: int) -> None:
        """Split a leaf by its sample until a leaf's part of it has `enough` members, or no vantage point tells them apart."""
        waiting = [(node, sample)]
        while waiting:
            at, own = waiting.pop()
            cut = vantage(own, differ) if len(own) > max(enough, FEW) else None
            if cut is None:
                continue
            self.point[at], self.radius[at] = int(cut[0]), cut[1]
            self.inner[at], self.outer[at] = self.leaf(), self.leaf()
            d = distances(own, cut[0])
            waiting += [(self.inner[at], own[d < cut[1]]), (self.outer[at], own[d >= cut[1] - differ])]

    def arrays(self) -> tuple[np.ndarray, ...]:
        return np.array(self.point, np.int64), np.array(self.radius), np.array(self.inner), np.array(self.outer), np.array(self.shard)


def vantage(own: np.ndarray, differ: int) -> tuple[np.int64, int] | None:
    """A vantage point and a radius that leave the larger side smallest, those in both counted; None where no side would lose a tenth."""
    best = None
    for k in range(TRIES):
        point = own[(k * len(own)) // TRIES]
        count = np.bincount(distances(own, point), minlength=66)
        upto = np.r_[0, np.cumsum(count)]  # members nearer than a radius
        radius = np.arange(1, 65)
        larger = np.maximum(upto[radius], len(own) - upto[np.maximum(radius - differ, 0)])
        # both sides together, and the larger one alone, ought to be small
        cost = np.where((upto[radius] > 0) & (larger <= 0.9 * len(own)), larger + upto[radius] - upto[np.maximum(radius - differ, 0)], 1 << 60)
        r = int(radius[np.argmin(cost)])
        if cost.min() < (1 << 60) and (best is None or cost.min() < best[0]):
            best = int(cost.min()), point, r
    return None if best is None else (best[1], best[2])


def route(tree: tuple[np.ndarray, ...], differ: int, prints: np.ndarray, node: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row, shard): all shards that each fingerprint belongs to."""
    point, radius, inner, outer, shard = tree
    row = np.arange(len(prints))
    node = np.zeros(len(prints), np.int64) if node is None else node
    rows, shards = [], []
    while len(row):
        done = inner[node] < 0
        rows.append(row[done])
        shards.append(shard[node[done]])
        row, node = row[~done], node[~done]
        d = distances(prints[row], point[node])
        far, near = d >= radius[node] - differ, d < radius[node]
        row, node = np.r_[row[near], row[far]], np.r_[inner[node[near]], outer[node[far]]]
    return np.concatenate(rows or [row]), np.concatenate(shards or [row])


def close_pairs(prints: np.ndarray, differ: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of distinct fingerprints that differ in at most `differ` bits, by a vantage-point tree; a pair may come more than once."""
    waiting = [prints]
    while waiting:
        own = waiting.pop()
        cut = vantage(own, differ) if len(own) > BUCKET else None
        if cut is not None:
            d = distances(own, cut[0])
            waiting += [own[d < cut[1]], own[d >= cut[1] - differ]]
            continue
        for low in range(0, len(own), 256):
            some = own[low : low + 256]
            a, b = np.nonzero(distances(some[:, None], own[None, low + 1 :]) <= differ)
            once = b + 1 > a  # each pair from its first member
            yield some[a[once]], own[low + 1 + b[once]]


def _routed(tree: Tree, roots: dict[int, int] | None, base: int, differ: int):
    """Deal fingerprints out: from the tree's first node, or each from its shard's; shards are numbered from base."""
    arrays = tree.arrays()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column(1).to_numpy()
            node = None if roots is None else np.array([roots[k] for k in batch.column(0).to_pylist()], np.int64)
            row, shard = route(arrays, differ, prints, node)
            yield pa.RecordBatch.from_arrays([pa.array(shard + base), pa.array(prints[row]), batch.column(2).take(pa.array(row))], names=["shard", "fp", "id"])

    return run


def dealt_out(prints: DataFrame, differ: int, sample: int = SAMPLE, shard: int = SHARD, large: int = LARGE) -> list[DataFrame]:
    """Tables (shard, fp, id) of all distinct fingerprints (fp, id): any two that differ in at most `differ` bits share a shard.

    The first tree takes a sample of all; each round after it a sample of every shard that
    is still large, until none is, or none of them can be divided.  Samples are those of
    the smallest hashes; they go to the driver, and nothing else does.
    """
    mixed = F.xxhash64("fp")
    schema = "shard long, fp long, id long"
    n = prints.count()
    own = np.array([r.fp for r in prints.select("fp").orderBy(mixed, "fp").limit(sample).collect()], np.int64)
    tree, base = Tree(), 0
    tree.grow(tree.leaf(), own, shard * len(own) / max(1, n), differ)
    left = stored(prints.select(F.lit(0).cast("long").alias("shard"), "fp", "id").mapInArrow(_routed(tree, None, base, differ), schema), "routed")
    done = []
    while True:
        base += tree.shards
        sizes = {r["shard"]: r["size"] for r in left.groupBy("shard").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > large).collect()}
        each = max(MORE, sample // max(1, len(sizes)))
        of_large = F.col("shard").isin(list(sizes)) if sizes else F.lit(False)
        # no more than `each` rows a shard leave a partition
        some = left.where(of_large).withColumn("place", F.row_number().over(W.partitionBy("shard").orderBy(mixed, "fp"))).where(F.col("place") <= each).select("shard", "fp")
        samples = some.toPandas().groupby("shard")["fp"] if sizes else []
        tree, roots = Tree(), {}
        for k, part in samples:
            root = tree.leaf()
            tree.grow(root, part.to_numpy(), shard * len(part) / sizes[k], differ)
            if tree.inner[root] >= 0:
                roots[int(k)] = root
        again = F.col("shard").isin(list(roots)) if roots else F.lit(False)
        done.append(left.where(~again))
        if not roots:
            return done
        left = stored(left.where(again).select("shard", "fp", "id").mapInArrow(_routed(tree, roots, base, differ), schema), "routed")


def links(prints: DataFrame, differ: int = 2, **sizes: int) -> DataFrame:
    """(a, b): ids of all pairs of distinct fingerprints (fp, id) that differ in at most `differ` bits."""

    def pairs(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("fp")
        found = list(close_pairs(pdf["fp"].to_numpy(), differ))
        ends = [pdf["id"].to_numpy()[np.searchsorted(pdf["fp"].to_numpy(), np.concatenate([f[k] for f in found] or [np.zeros(0, np.int64)]))] for k in (0, 1)]
        return pd.DataFrame({"a": np.minimum(*ends), "b": np.maximum(*ends)}).drop_duplicates()

    tables = dealt_out(prints, differ, **sizes)
    met = tables[0]
    for t in tables[1:]:
        met = met.union(t)
    return met.groupBy("shard").applyInPandas(pairs, "a long, b long").where("a != b").distinct()


def near_duplicates(docs: DataFrame, words: int = 3, differ: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint, component_id): texts linked where their fingerprints differ in at most `differ` bits.

    fingerprint: 16 hexadecimal digits; zero for texts without words, null and empty ones
    too, which are linked like any other.  component_id: the smallest id reachable, itself
    included.  Null id: a row without a component.  Ids that aren't integers: a TypeError.
    Repeated rows get the same result each; different texts of one id have a fingerprint
    each.  Empty table: no rows.  Other columns aren't read.  The result is a table in the
    shared folder; what led to it is deleted.
    """
    integer_id(docs, id_col)
    text_batches(docs.sparkSession)
    own = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    with scratch() as keep:
        prints = stored(own.mapInArrow(_fingerprints(words), "id long, fp long"), "fingerprints")
        classes = stored(prints.where("id is not null").groupBy("fp").agg(F.min("id").alias("id")), "classes")
        label = components(stored(links(classes, differ), "links"))
        named = classes.join(label.withColumnRenamed("node", "id"), "id", "left").select("fp", F.coalesce("component", "id").alias("component"))
        out = prints.join(named, "fp", "left").select(
            F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.when(F.col("id").isNotNull(), F.col("component")).alias("component_id"))
        return keep(stored(out, "simhash"))
