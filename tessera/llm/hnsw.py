"""Approximate nearest neighbours: a hierarchical navigable small-world graph for each shard.

Graphs are stored as flat arrays: level 0 has 2 * LINKS neighbour slots a node, each node
of a higher level LINKS more, -1 where empty.  Equal vectors are one node; shards hold them
dealt out by hash, and their results are merged.

Nodes go into a graph a group at a time, and queries walk it a block at a time: all of a
group take their steps together, so that a step is a few array operations.  A group's own
members, and the first few hundred nodes, are compared by a matrix product.

A graph is stored in rows of some MB.  Queries are sent to the graphs: a shard's rows and
its queries meet in one task, the graph's first, and the queries stream by, so that each
graph is shuffled once, however many queries there are.
"""

from __future__ import annotations

import io
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.common import integer_id, scratch, stored, text_batches

LINKS, BUILD, SEARCH = 16, 64, 160
#: Nodes of a shard: SHARD while that makes up to SHARDS of them, then more, up to MOST, or to BYTES of vectors, which bounds a worker's memory.
SHARD, SHARDS, MOST, BYTES = 8192, 256, 1 << 17, 64 << 20
#: Queries that walk a shard's graph together, and nodes that go into it together.
QUERY_BLOCK, GROUP = 512, 512
#: A graph's first nodes, which a matrix product compares, BLOCK at a time, as a walk through so few finds no other; beyond that nodes find their neighbours by the walk.
SMALL, BLOCK = 512, 4096
#: Bytes of a stored graph's rows.
PART = 4 << 20


class Graph:
    """A navigable small-world graph over float32 vectors; levels by the node's number."""

    def __init__(self, vectors: np.ndarray, links: int = LINKS, build: int = BUILD, small: int = SMALL):
        self._set(vectors, links)
        n = len(self.x)
        rng = np.random.default_rng(12345)
        self.level = np.minimum((-np.log(1 - rng.random(n)) / math.log(max(2, links))).astype(np.int64), 8)
        self.ground = np.full((n, 2 * links), -1, np.int32)
        upper = np.cumsum(np.r_[0, self.level])
        self.place, self.upper = upper[:-1], np.full((int(upper[-1]), links), -1, np.int32)
        self.entry = -1
        begin = 0
        while begin < n:
            # a group is never larger than the graph that it goes into, but for the first
            end = min(n, begin + min(GROUP, max(64, begin)))
            self._insert(begin, end, build, small)
            begin = end

    def _set(self, vectors: np.ndarray, links: int) -> None:
        self.x = np.ascontiguousarray(vectors, np.float32)
        self.square = np.einsum("ij,ij->i", self.x, self.x)
        self.links = links

    @classmethod
    def of(cls, x: np.ndarray, level: np.ndarray, ground: np.ndarray, upper: np.ndarray, entry: int, links: int) -> Graph:
        """A graph from its stored arrays."""
        g = cls.__new__(cls)
        g._set(x, links)
        g.level, g.entry = level, entry
        g.ground, g.upper, g.place = ground.reshape(-1, 2 * links), upper.reshape(-1, links), np.cumsum(np.r_[0, level])[:-1]
        return g

    def _rows(self, nodes: np.ndarray, level: int) -> np.ndarray:
        return self.ground[nodes] if level == 0 else self.upper[self.place[nodes] + level - 1]

    def _put(self, nodes: np.ndarray, level: int, rows: np.ndarray) -> None:
        if level == 0:
            self.ground[nodes] = rows
        else:
            self.upper[self.place[nodes] + level - 1] = rows

    def _walk(self, q: np.ndarray, start: np.ndarray, width: int, level: int) -> tuple[np.ndarray, np.ndarray]:
        """For each query the width nearest nodes that a best-first walk finds, nearest first: squared distances (less the query's own square) and nodes, -1 where there are fewer.

        start: a node for each query.  Each step opens a query's few nearest nodes that
        aren't open yet, and ends once all of the width are.
        """
        m, step = len(q), 1 if width == 1 else 4
        row = np.arange(m)
        near = np.full((m, width), np.inf, np.float32)
        node = np.full((m, width), -1, np.int32)
        opened = np.zeros((m, width), bool)
        seen = np.zeros((m, len(self.x)), bool)
        near[:, 0] = self.square[start] - 2 * np.einsum("ij,ij->i", self.x[start], q)
        node[:, 0] = start
        seen[row, start] = True
        live = row
        while len(live):
            # the nearest that aren't open, of those queries that still have any
            waiting = np.where(opened[live], np.inf, near[live])
            pick = np.argpartition(waiting, step - 1, axis=1)[:, :step] if step < width else np.zeros((len(live), 1), np.int64)
            good = np.take_along_axis(waiting, pick, 1) < np.inf
            some = good.any(1)
            live, pick, good = live[some], pick[some], good[some]
            if not len(live):
                break
            opened[live[:, None], pick] = True
            rows = np.where(good[:, :, None], self._rows(np.where(good, node[live[:, None], pick], 0), level), -1).reshape(len(live), -1)
            of, at = np.nonzero(rows >= 0)
            to = rows[of, at]
            fresh = ~seen[live[of], to]
            of, to = of[fresh], to[fresh]
            # a node that two opened ones name counts once
            _, once = np.unique(of.astype(np.int64) << 32 | to, return_index=True)
            of, to = of[once], to[once]
            mine = live[of]
            seen[mine, to] = True
            d = self.square[to] - 2 * np.einsum("ij,ij->i", self.x[to], q[mine])
            better = d < near[mine].max(1) if width > 1 else d < near[mine, 0]
            of, to, d = of[better], to[better], d[better]
            if len(of):
                count = np.bincount(of, minlength=len(live))
                slot = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
                got = np.flatnonzero(count)
                wide = int(count.max())
                more, which = np.full((len(live), wide), np.inf, np.float32), np.full((len(live), wide), -1, np.int32)
                more[of, slot], which[of, slot] = d, to
                at = live[got]
                both, names = np.hstack([near[at], more[got]]), np.hstack([node[at], which[got]])
                done = np.hstack([opened[at], np.zeros((len(got), wide), bool)])
                best = np.argpartition(both, width - 1, axis=1)[:, :width]
                near[at], node[at], opened[at] = (np.take_along_axis(c, best, 1) for c in (both, names, done))
        order = np.argsort(near, axis=1, kind="stable")
        return np.take_along_axis(near, order, 1), np.take_along_axis(node, order, 1)

    def _descend(self, q: np.ndarray, level: int) -> np.ndarray:
        """The node that a walk from the top finds nearest on the level above, for each query."""
        at = np.full(len(q), self.entry)
        for k in range(int(self.level[self.entry]), level, -1):
            at = self._walk(q, at, 1, k)[1][:, 0]
        return at

    def _choose(self, near: np.ndarray, node: np.ndarray, most: int) -> np.ndarray:
        """Of each row's candidates, nearest first, up to most neighbours: those nearer to the row's own node than to one chosen before; the rest fills up.

        near: squared distances.  A row of -1 has none.
        """
        m, width = node.shape
        known = node >= 0
        if width <= most:
            return np.hstack([node, np.full((m, most - width), -1, np.int32)]) if width < most else node
        free, taken = known.copy(), np.zeros_like(known)
        row, x, square = np.arange(m), self.x[node], self.square[node]
        for _ in range(most):
            first = np.argmax(free, axis=1)
            any_ = free[row, first]
            if not any_.any():
                break
            taken[row[any_], first[any_]] = True
            between = square + square[row, first][:, None] - 2 * np.matmul(x, x[row, first][:, :, None])[:, :, 0]
            free &= ~taken & ((between > near) | ~any_[:, None])
        # chosen ones first, then the others, each nearest first
        order = np.argsort(np.where(taken, 0, np.where(known, 1, 2)), axis=1, kind="stable")[:, :most]
        return np.take_along_axis(node, order, 1)

    def _candidates(self, begin: int, end: int, members: np.ndarray, start: np.ndarray, level: int, build: int, small: int) -> tuple[np.ndarray, np.ndarray]:
        """For each member of the group (numbers in it) its nearest nodes on a level, those of the group among them: squared distances and nodes, nearest first."""
        new = begin + members
        q, own = self.x[new], self.square[new]
        if begin <= small:
            there = np.flatnonzero(self.level[:begin] >= level)
            near, node = np.zeros((len(new), 0), np.float32), np.zeros((len(new), 0), np.int32)
            for low in range(0, len(there), BLOCK):
                some = there[low : low + BLOCK]
                d = self.square[some] - 2 * (q @ self.x[some].T)
                near, node = np.hstack([near, d]), np.hstack([node, np.broadcast_to(some.astype(np.int32), d.shape)])
                if near.shape[1] > build:
                    best = np.argpartition(near, build - 1, axis=1)[:, :build]
                    near, node = np.take_along_axis(near, best, 1), np.take_along_axis(node, best, 1)
        else:
            near, node = self._walk(q, start, build, level)
        beside = self.square[new] - 2 * (q @ q.T)
        np.fill_diagonal(beside, np.inf)
        near, node = np.hstack([near, beside]), np.hstack([node, np.broadcast_to(new.astype(np.int32), beside.shape)])
        order = np.argsort(near, axis=1, kind="stable")[:, : min(build, near.shape[1] - 1)]
        near, node = np.take_along_axis(near, order, 1), np.take_along_axis(node, order, 1)
        return np.maximum(near + own[:, None], 0), np.where(np.isfinite(near), node, -1)

    def _insert(self, begin: int, end: int, build: int, small: int) -> None:
        levels = self.level[begin:end]
        top = int(self.level[self.entry]) if self.entry >= 0 else -1
        at = np.full(end - begin, self.entry)
        walks = begin > small
        for level in range(max(top, int(levels.max())), -1, -1):
            if walks and level <= top:
                # those that aren't on this level only pass
                passing = np.flatnonzero(levels < level)
                if len(passing):
                    at[passing] = self._walk(self.x[begin + passing], at[passing], 1, level)[1][:, 0]
            members = np.flatnonzero(levels >= level)
            if not len(members):
                continue
            if walks and level > top:
                near, node = self._candidates(begin, end, members, at[members], level, build, 1 << 62)
            else:
                near, node = self._candidates(begin, end, members, at[members], level, build, small)
            if not node.shape[1]:
                continue
            if walks and level > 0:
                # the way down goes on from the nearest node of the graph as it was
                old = np.where((node >= 0) & (node < begin), np.arange(node.shape[1]), node.shape[1]).min(1)
                has = old < node.shape[1]
                at[members[has]] = node[has, old[has]]
            mine = self._choose(near, node, self.links)
            most = 2 * self.links if level == 0 else self.links
            rows = np.full((len(members), most), -1, np.int32)
            rows[:, : self.links] = mine
            self._put(begin + members, level, rows)
            self._link_back(begin + members, mine, level, most)
        highest = begin + int(np.argmax(levels))
        if self.entry < 0 or self.level[highest] > top:
            self.entry = highest

    def _link_back(self, new: np.ndarray, mine: np.ndarray, level: int, most: int) -> None:
        """Let the neighbours of new nodes name them as well; a node that would have more than most chooses anew."""
        of, slot = np.nonzero(mine >= 0)
        to, by = mine[of, slot].astype(np.int64), new[of]
        order = np.lexsort((by, to))
        to, by = to[order], by[order]
        heads = np.flatnonzero(np.r_[True, to[1:] != to[:-1]])
        if not len(heads):
            return
        count = np.diff(np.r_[heads, len(to)])
        wide = int(count.max())
        added = np.full((len(heads), wide), -1, np.int32)
        added[np.repeat(np.arange(len(heads)), count), np.arange(len(to)) - np.repeat(heads, count)] = by
        target = to[heads]
        old = self._rows(target, level)
        # a node that is named already isn't named twice
        added[(added[:, :, None] == old[:, None, :]).any(2)] = -1
        both = np.hstack([old, added])
        both = np.take_along_axis(both, np.argsort(both < 0, axis=1, kind="stable"), 1)
        total = (both >= 0).sum(1)
        fits = total <= most
        if fits.any():
            self._put(target[fits], level, np.hstack([both[fits], np.full((int(fits.sum()), most), -1, np.int32)])[:, :most])
        full = np.flatnonzero(~fits)
        full = full[np.argsort(-total[full], kind="stable")]
        while len(full):
            # as many at a time as keep the gathered vectors few
            width = int(total[full[0]])
            part, full = full[: max(1, 32768 // width)], full[max(1, 32768 // width) :]
            names, here = both[part][:, :width], target[part]
            near = self.square[names] + self.square[here][:, None] - 2 * np.matmul(self.x[names], self.x[here][:, :, None])[:, :, 0]
            near = np.where(names >= 0, np.maximum(near, 0), np.inf)
            by_distance = np.argsort(near, axis=1, kind="stable")
            self._put(here, level, self._choose(np.take_along_axis(near, by_distance, 1), np.take_along_axis(names, by_distance, 1), most))

    def nearest(self, q: np.ndarray, k: int, width: int = 0) -> np.ndarray:
        """About the k nearest nodes of each query, nearest first, -1 where there are fewer. width: of the walk; by default SEARCH, and half more for each doubling of the graph beyond SHARD."""
        width = width or int(SEARCH * max(1.0, 1 + 0.5 * math.log2(max(1, len(self.x)) / SHARD)))
        q = np.ascontiguousarray(q, np.float32)
        if self.entry < 0:
            return np.full((len(q), k), -1, np.int32)
        return self._walk(q, self._descend(q, 0), max(width, k), 0)[1][:, :k]


def proper(vector) -> F.Column:
    """Whether a vector has numbers only, all finite, and isn't zero."""
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda v: v != 0), F.lit(False))


def shards_for(nodes: int, shard: int, numbers: int = 64) -> int:
    """How many shards so many nodes, of vectors of so many numbers, take."""
    return max(1, -(-nodes // min(MOST, max(1, BYTES // (8 * max(1, numbers))), max(shard, -(-nodes // SHARDS)))))


def _vectors(rows: DataFrame, id_col: str, vector_col: str, name: str) -> DataFrame:
    """(name, v): ids and vectors in double precision, both proper."""
    integer_id(rows, id_col)
    own = rows.select(F.col(f"`{id_col}`").cast("long").alias(name), F.transform(F.col(f"`{vector_col}`"), lambda v: v.cast("double") + F.lit(0.0)).alias("v"))
    return own.where(F.col(name).isNotNull() & proper(F.col("v")))


def packed(graph: Graph, vectors: np.ndarray, ids: list) -> bytes:
    """A graph, its vectors and their ids as one blob of arrays."""
    out = io.BytesIO()
    single = bool((vectors == vectors.astype(np.float32)).all())
    np.savez(
        out, vectors=vectors.astype(np.float32) if single else vectors, begin=np.cumsum([0, *map(len, ids)]), ids=np.concatenate(ids).astype(np.int64),
        level=graph.level.astype(np.int8), ground=graph.ground, upper=graph.upper, entry=np.int64(graph.entry))
    return out.getvalue()


class Shard:
    """A stored graph, which queries walk."""

    def __init__(self, blob: bytes):
        with np.load(io.BytesIO(blob), allow_pickle=False) as a:
            self.vectors, self.begin, self.ids = a["vectors"], a["begin"], a["ids"]
            self.graph = Graph.of(self.vectors.astype(np.float32), a["level"].astype(np.int64), a["ground"], a["upper"], int(a["entry"]), LINKS)

    def best(self, asking: np.ndarray, q: np.ndarray, k: int) -> pd.DataFrame:
        """(query_id, vec_id, score): each query's k nearest ids but its own, of 2 * k candidates by distances in double precision."""
        found = self.graph.nearest(q, 2 * k)
        of, slot = np.nonzero(found >= 0)
        node = found[of, slot]
        score = np.empty(len(of))
        for low in range(0, len(of), 4096):
            part = slice(low, low + 4096)
            score[part] = np.sqrt(((self.vectors[node[part]].astype(np.float64) - q[of[part]]) ** 2).sum(1))
        counts = np.diff(self.begin)[node]
        each = np.repeat(np.arange(len(of)), counts)
        named = self.ids[np.repeat(self.begin[node], counts) + np.arange(len(each)) - np.repeat(np.cumsum(counts) - counts, counts)]
        table = pd.DataFrame({"query_id": asking[of[each]], "vec_id": named, "score": score[each]})
        table = table[table["query_id"] != table["vec_id"]].sort_values(["query_id", "score", "vec_id"], kind="stable").drop_duplicates(["query_id", "vec_id"])
        return table.groupby("query_id", sort=False).head(k)


def build_index(rows: DataFrame, k: int, id_col: str, vector_col: str, shard: int = SHARD) -> tuple[DataFrame, int]:
    """A graph for each shard of the distinct vectors, (d, s, part, blob), and the number of shards of each length of vectors.

    Every vector is indexed.  A node carries the k + 1 smallest ids of its vector, which
    are all that a result of k can name; that choice limits each partition's rows before
    they meet.  Vectors are kept in double precision, graphs compare them in single.
    """
    own = _vectors(rows, id_col, vector_col, "id")
    ranked = own.distinct().withColumn("r", F.row_number().over(W.partitionBy("v").orderBy("id"))).where(F.col("r") <= k + 1)
    nodes = stored(ranked.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids")), "vectors")
    # vectors of another length can't be compared; they have shards of their own
    sizes = {r["d"]: r["n"] for r in nodes.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).collect()}
    shards = max([1, *(shards_for(n, shard, d) for d, n in sizes.items())])

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("first", kind="stable")
        x = np.stack(pdf["v"].to_numpy())
        # links follow from the order of nodes; neighbours in the table needn't be neighbours here
        order = np.random.default_rng(7).permutation(len(x))
        x, ids = x[order], [pdf["ids"].iloc[k] for k in order]
        blob = packed(Graph(x), x, ids)
        parts = [blob[low : low + PART] for low in range(0, len(blob), PART)]
        return pd.DataFrame({"d": int(pdf["d"].iloc[0]), "s": int(pdf["s"].iloc[0]), "part": range(len(parts)), "blob": parts})

    dealt = nodes.select(F.size("v").alias("d"), F.pmod(F.xxhash64("v"), F.lit(shards)).cast("int").alias("s"), "v", "ids", F.col("ids")[0].alias("first"))
    return stored(dealt.groupBy("d", "s").applyInPandas(build, "d int, s int, part int, blob binary"), "graphs"), shards


def sent(graphs: DataFrame, asked: DataFrame, shards: int) -> DataFrame:
    """(d, s, part, blob, query_id, q): each row of each graph, once, and each query once for each shard, with part as null."""
    left = graphs.select("d", "s", "part", "blob", F.lit(None).cast("long").alias("query_id"), F.lit(None).cast("array<double>").alias("q"))
    every = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    return left.union(asked.select(F.size("q").alias("d"), every.alias("s"), F.lit(None).cast("int"), F.lit(None).cast("binary"), "query_id", "q"))


def _walks(k: int):
    """Queries that stream by a graph; a shard's rows come first, in their order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts, shard, asking, vectors = None, [], None, [], []

        def told() -> Iterator[pa.RecordBatch]:
            if asking and shard is not None:
                yield pa.RecordBatch.from_pandas(shard.best(np.array(asking), np.stack(vectors), k), preserve_index=False)
            asking.clear()
            vectors.clear()

        for batch in batches:
            d, s, part, blob, query, q = batch.columns
            flat, offsets = q.flatten().to_numpy(), q.offsets.to_numpy() - q.offsets[0].as_py()
            for row, key in enumerate(zip(d.to_pylist(), s.to_pylist())):
                if key != at:
                    yield from told()
                    at, parts, shard = key, [], None
                if part[row].is_valid:
                    parts.append(blob[row].as_py())
                    continue
                if parts:
                    shard, parts = Shard(b"".join(parts)), []
                asking.append(query[row].as_py())
                vectors.append(flat[offsets[row] : offsets[row + 1]])
                if len(asking) == QUERY_BLOCK:
                    yield from told()
        yield from told()

    return run


def search(rows: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", shard: int = SHARD) -> DataFrame:
    """Each query's k nearest of rows but itself, by Euclidean distance: (query_id, rank, vec_id, score).

    Each shard's graph finds 2 * k candidates, whose distances are then taken on the
    vectors in double precision; ties go to the smaller id.  Queries stream by each graph
    of their length, and the k best of each shard are merged.  Vectors that are null, zero
    or hold a null or a number that isn't finite take no part, nor do rows without an id.
    Ids that aren't integers: a TypeError.  Repeated rows count once; an id with several
    vectors can be found by each of them, but named once, and asks with one of them, the
    smallest.  Empty table: no rows.  Other columns aren't read.  The result is a table in
    the shared folder; what led to it is deleted.
    """
    text_batches(rows.sparkSession)
    with scratch() as keep:
        graphs, shards = build_index(rows, k, id_col, vector_col, shard)
        asked = stored(_vectors(queries, id_col, vector_col, "query_id").groupBy("query_id").agg(F.min("v").alias("q")), "queries")
        dealt = sent(graphs, asked, shards).repartition("d", "s").sortWithinPartitions("d", "s", F.col("part").asc_nulls_last())
        found = dealt.mapInArrow(_walks(k), "query_id long, vec_id long, score double")
        found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
        best = W.partitionBy("query_id").orderBy("score", "vec_id")
        out = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
        return keep(stored(out, "nearest"))
