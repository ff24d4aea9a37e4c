"""Hard-negative mining: a full sort of each anchor's scores, in blocks of rows and anchors.

1. Vectors become integers; a row's score is its inner product with the anchor.
2. Rows and anchors are dealt into blocks by hash.  In a cell of a row block and an anchor
   block each anchor's scores are sorted, high ones first, ties by smaller id.
3. First pass: the first rows of the anchor's own label; the cells' firsts are merged into
   the anchor's positives.
4. Second pass: for each positive a binary search finds where its upper limit stands in the
   sorted scores; the first entries of other labels from there, down to its lower limit,
   are read, and the cells' firsts merged.

Memory is a cell's: the bytes of a block are bounded, whatever the table's size.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.common import integer_id, scratch, stored

#: Bytes of a block's vectors as 64-bit numbers; rows of a block at most, and while more blocks are of use to the session's partitions.
SIDE, ROWS, LEAST = 8 << 20, 1 << 14, 1 << 10
#: Scores of a cell that are sorted at a time.
SORTED = 1 << 20


def integers(vector: F.Column, scale: int) -> F.Column:
    """floor(scale * x) of each component, as doubles."""
    return F.transform(vector, lambda v: F.floor(F.lit(float(scale)) * v.cast("double")).cast("double"))


def whole(vector: F.Column) -> F.Column:
    """Whether a vector is there and has no component that is null or not finite."""
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers (given as doubles), exact; an OverflowError where 64 bits can't hold them."""
    most = (np.abs(a).max(initial=0.0) * np.abs(b).max(initial=0.0)) * max(1, a.shape[1])
    if most < 2.0**53:
        return (a @ b.T).astype(np.int64)
    if most < 2.0**62:
        return a.astype(np.int64) @ b.astype(np.int64).T
    exact = np.array([[int(x) for x in r] for r in a], object).reshape(a.shape) @ np.array([[int(x) for x in r] for r in b], object).reshape(b.shape).T
    if any(abs(int(x)) >= 1 << 63 for x in exact.reshape(-1)):
        raise OverflowError("a score needs more than 64 bits")
    return exact.astype(np.int64)


def ranked(scores: np.ndarray) -> np.ndarray:
    """The order of each row's scores, high ones first; ties in the order given, which is that of ids."""
    return np.argsort(-scores, axis=1, kind="stable")


def first_positives(ids: np.ndarray, labels: np.ndarray, x: np.ndarray, anchor: np.ndarray, own: np.ndarray, q: np.ndarray, count: int) -> pd.DataFrame:
    """(anchor_id, positive_id, positive_score): of rows in the order of ids, each anchor's first `count` of its own label, but itself."""
    parts = []
    for label in np.unique(own):
        rows, asking = np.flatnonzero(labels == label), np.flatnonzero(own == label)
        for low in range(0, len(asking) if len(rows) else 0, max(1, SORTED // len(rows) if len(rows) else 1)):
            some = asking[low : low + max(1, SORTED // len(rows))]
            scores = products(q[some], x[rows])
            best = ranked(scores)[:, : count + 1]
            of = np.repeat(some, best.shape[1])
            found = pd.DataFrame({"anchor_id": anchor[of], "positive_id": ids[rows[best.reshape(-1)]], "positive_score": np.take_along_axis(scores, best, 1).reshape(-1)})
            parts.append(found[found["anchor_id"] != found["positive_id"]].groupby("anchor_id", sort=False).head(count))
    return pd.concat(parts) if parts else pd.DataFrame({c: pd.Series(dtype="int64") for c in ("anchor_id", "positive_id", "positive_score")})


def limits(score: int, low: int, high: int) -> tuple[int, int]:
    """The least and the largest whole score s with low * score <= 100 * s <= high * score."""
    return -((-low * score) // 100), (high * score) // 100


def first_negatives(ids: np.ndarray, labels: np.ndarray, x: np.ndarray, anchor: np.ndarray, own: np.ndarray, q: np.ndarray, positives: list, scores_of: list, low: int, high: int, count: int) -> pd.DataFrame:
    """(anchor_id, positive_id, positive_score, negative_id, negative_score): of rows in the order of ids, each positive's first `count` of other labels within its limits."""
    out: dict[str, list] = {c: [] for c in ("anchor_id", "positive_id", "positive_score", "negative_id", "negative_score")}
    step = max(1, SORTED // max(1, len(ids)))
    for begin in range(0, len(anchor), step):
        scores = products(q[begin : begin + step], x)
        order = ranked(scores)
        for k, (line, by) in enumerate(zip(scores, order, strict=True), begin):
            down = -line[by]  # ascending
            for positive, score in zip(positives[k], scores_of[k], strict=True):
                least, most = limits(int(score), low, high)
                at, end = int(np.searchsorted(down, -most, "left")), int(np.searchsorted(down, -least, "right"))
                taken, width = np.zeros(0, np.int64), 4 * count
                while at < end and len(taken) < count:
                    part = by[at : min(end, at + width)]
                    taken = np.r_[taken, part[labels[part] != own[k]]][:count]
                    at, width = at + width, 2 * width
                out["anchor_id"] += [anchor[k]] * len(taken)
                out["positive_id"] += [positive] * len(taken)
                out["positive_score"] += [score] * len(taken)
                out["negative_id"] += ids[taken].tolist()
                out["negative_score"] += line[taken].tolist()
    return pd.DataFrame({c: np.array(v, np.int64) for c, v in out.items()})


def _cells(rows: DataFrame, anchors: DataFrame, row_blocks: int, anchor_blocks: int, work: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """work() on each cell: a block of rows, of one length of vectors, and a block of anchors."""
    key = ("d", "b", "c")
    of = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.select(F.size("x").alias("d"), of("id", row_blocks).alias("b"), every(anchor_blocks).alias("c"), "id", "label", "x")
    right = anchors.withColumn("c", of("id", anchor_blocks)).withColumn("b", every(row_blocks)).withColumn("d", F.size("x"))
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(lambda a, b: work(a.sort_values("id"), b), schema)


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(np.float64)


def hard_negatives(
    rows: DataFrame, anchors: F.Column, positives: int = 5, count: int = 10, low: int = 30, high: int = 90, scale: int = 256,
    id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding", block: int = ROWS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): each positive's first `count` rows of another label whose score is from `low` to `high` hundredths of its own.

    anchors: which rows are anchors, a condition on the table's columns.  An anchor's
    positives are the first rows of its label but itself.  Rows without an id, a label or
    a vector, or with a component that is null or not finite, take no part.  Repeated rows
    count once; of an id with several labels or vectors the smallest counts.  Vectors of
    another length than the anchor's have no score.  A score beyond 64 bits: an
    OverflowError.  Ids and labels that aren't integers: a TypeError.  Empty table: no rows.
    Other columns aren't read.  The result is a table in the shared folder; what led to it
    is deleted.
    """
    integer_id(rows, id_col)
    integer_id(rows, label_col)
    spark = rows.sparkSession
    vector = F.col(f"`{vector_col}`")
    own = rows.where(whole(vector)).select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("long").alias("label"), integers(vector, scale).alias("x"), F.coalesce(anchors, F.lit(False)).alias("asks"))
    own = own.where("id is not null and label is not null").groupBy("id").agg(F.min(F.struct("label", "x", "asks")).alias("r")).select("id", "r.*")
    no_rows = {c: pd.Series(dtype="int64") for c in ("anchor_id", "positive_id", "positive_score", "negative_id", "negative_score")}
    with scratch() as keep:
        table = stored(own, "vectors")
        asking = table.where("asks").drop("asks")
        size = table.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("d"), F.count(F.when(F.col("asks"), 1)).alias("q")).first()
        most = max(1, min(block, SIDE // (8 * max(1, size["d"] or 0))))
        useful = min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size["n"] // LEAST))
        row_blocks, anchor_blocks = max(1, -(-size["n"] // most), useful), max(1, -(-size["q"] // most))

        def same(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            if not len(left) or not len(right):
                return pd.DataFrame({c: no_rows[c] for c in ("anchor_id", "positive_id", "positive_score")})
            return first_positives(left["id"].to_numpy(), left["label"].to_numpy(), _matrix(left["x"]), right["id"].to_numpy(), right["label"].to_numpy(), _matrix(right["x"]), positives)

        def other(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            if not len(left) or not len(right):
                return pd.DataFrame(no_rows)
            return first_negatives(
                left["id"].to_numpy(), left["label"].to_numpy(), _matrix(left["x"]), right["id"].to_numpy(), right["label"].to_numpy(), _matrix(right["x"]),
                right["positives"].tolist(), right["scores"].tolist(), low, high, count)

        near = _cells(table, asking, row_blocks, anchor_blocks, same, "anchor_id long, positive_id long, positive_score long")
        best = W.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
        near = near.withColumn("p", F.row_number().over(best)).where(F.col("p") <= positives)
        told = F.array_sort(F.collect_list(F.struct("p", "positive_id", "positive_score"))).alias("told")
        known = near.groupBy("anchor_id").agg(told).select(F.col("anchor_id").alias("id"), F.col("told.positive_id").alias("positives"), F.col("told.positive_score").alias("scores"))
        armed = stored(asking.join(known, "id"), "anchors")
        far = _cells(table, armed, row_blocks, anchor_blocks, other, "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
        best = W.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
        far = far.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= count)
        return keep(stored(far.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"), "negatives"))


#: The registered query in DuckDB's SQL: labels of ids that 7 divides moved on by one, anchors those that 100 divides, the default limits.
ORACLE = """
    WITH own AS (
        SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x
        FROM (SELECT DISTINCT vec_id, label, embedding FROM embeddings)
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scores AS (
        SELECT a.vec_id AS anchor_id, a.label AS anchor_label, b.vec_id AS id, b.label, CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
        FROM own a JOIN own b ON len(a.x) = len(b.x) WHERE a.vec_id % 100 = 0),
    positives AS (
        SELECT anchor_id, id AS positive_id, score AS positive_score FROM scores WHERE label = anchor_label AND id <> anchor_id
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
    SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank,
           s.id AS negative_id, p.positive_score, s.score AS negative_score
    FROM positives p JOIN scores s ON p.anchor_id = s.anchor_id AND s.label <> s.anchor_label AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
    QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id) <= 10"""
