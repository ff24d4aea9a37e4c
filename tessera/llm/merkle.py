"""A Merkle manifest of a dataset: a digest for each row, a tree of them for each group, a tree of the groups' roots.

1. A row's leaf digest is taken of its columns, in Spark's own functions; texts go no further.
2. Leaves get their places in their group by a range sort.
3. A tree is cut into aligned blocks of BLOCK places.  A block is traversed recursively in
   postorder: a subtree returns its digest, and while the recursion unwinds, what stands
   beside a subtree is appended to the proofs of the leaves below it.
4. The blocks' roots are the leaves of the next traversal, until a group has one node; the
   groups' roots go through the same.  Proofs from above are appended to the blocks' leaves.

No task holds more than a block; a traversal's input is a BLOCK-th of the one before.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.common import scratch, stored

#: Nodes that become one, and levels of a block.
FAN, LEVELS = 3, 5
BLOCK = FAN**LEVELS


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_digest(columns: list[Column]) -> Column:
    """sha256 of columns: `-` for a null, else the value's UTF-8 byte count, `:` and the value; integers are decimal."""
    told = [F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string"))) for c in columns]
    return F.sha2(F.concat(*told), 256)


def traverse(digests: list[str], width: int) -> tuple[str, list[list[str]], list[list[str]]]:
    """The root of a subtree that spans width places, of which digests are the first; for each of them what stands before and after it, level by level."""
    before: list[list[str]] = [[] for _ in digests]
    after: list[list[str]] = [[] for _ in digests]

    def visit(low: int, high: int, span: int) -> str:
        if span == 1:
            return digests[low]
        part = span // FAN
        begins = range(low, high, part)
        tops = [visit(b, min(b + part, high), part) for b in begins]
        for k, b in enumerate(begins):
            left, right = "".join(tops[:k]), "".join(tops[k + 1 :])
            for place in range(b, min(b + part, high)):
                before[place].append(left)
                after[place].append(right)
        return digest("".join(tops))

    return visit(0, len(digests), width), before, after


def _block(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("pos")
    width, n = 1, int(pdf["n"].iloc[0])
    while width < min(n, BLOCK):
        width *= FAN
    top, before, after = traverse(pdf["digest"].tolist(), width)
    return pd.DataFrame({"tree": pdf["tree"], "block": pdf["block"], "n": n, "pos": pdf["pos"], "top": top, "before": before, "after": after})


def _climb(nodes: DataFrame, finish: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(tree, pos, before, after) and finish()'s columns for each node (tree, pos, n, digest): its proof as far as finish() goes.

    finish() gets (tree, top), a row a tree, and gives (tree, over_before, over_after) and more.
    """
    of_block = nodes.select("tree", "pos", "n", "digest", F.expr(f"pos div {BLOCK}").alias("block"))
    cut = stored(of_block.groupBy("tree", "block").applyInPandas(_block, "tree binary, block long, n long, pos long, top string, before array<string>, after array<string>"), "blocks")
    firsts = cut.where(F.col("pos") == F.col("block") * BLOCK)
    if cut.where(F.col("n") > BLOCK).isEmpty():
        over = finish(firsts.select("tree", "top"))
        met = cut.join(over, "tree")
    else:
        roots = firsts.select("tree", F.col("block").alias("pos"), F.expr(f"(n + {BLOCK - 1}) div {BLOCK}").alias("n"), F.col("top").alias("digest"))
        over = _climb(roots, finish).withColumnRenamed("pos", "block").withColumnRenamed("before", "over_before").withColumnRenamed("after", "over_after")
        met = cut.join(over, ["tree", "block"])
    more = [c for c in over.columns if c not in ("tree", "block", "over_before", "over_after")]
    return met.select("tree", "pos", F.concat("before", "over_before").alias("before"), F.concat("after", "over_after").alias("after"), *more)


def _placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """rows with (pos, n): each one's place from 0 in its tree, and the tree's size; order begins with the tree."""
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    sorted_ = stored(rows.orderBy(*order).select("*", F.spark_partition_id().alias("part"), place.alias("row")), "leaves")
    # a row for each partition of the sort, and one more for each tree
    runs = sorted_.groupBy("part", "tree").agg(F.count(F.lit(1)).alias("rows"), F.min("row").alias("first"))
    within = W.partitionBy("tree")
    shift = F.sum("rows").over(within.orderBy("part").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("rows") - F.col("first")
    runs = runs.select("part", "tree", shift.alias("shift"), F.sum("rows").over(within).alias("n"))
    return sorted_.join(runs, ["part", "tree"]).withColumn("pos", F.col("row") + F.col("shift")).drop("part", "row", "shift")


def manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "source", columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), carry: dict[str, Column] | None = None) -> DataFrame:
    """(id, leaf, subroot, root, before, after) and what carry names: each row's leaf digest, the roots above it and its proof.

    Leaves of a group stand by id (null first), those of one id by digest; every FAN nodes
    become one, a last run of fewer, or one, too, while there is more than one.  Groups
    stand by their bytes, null first, and give the root likewise.  before and after hold
    what stands beside the path at each level, from the leaf up: see folded().  Repeated
    rows are leaves of their own.  A single row: its leaf is subroot and root, without a
    proof.  Empty table: no rows.  Columns that aren't named aren't read.
    """
    carry = carry or {}
    q = lambda c: F.col(f"`{c}`")
    tree = F.when(q(group_col).isNull(), F.lit(b"\x00")).otherwise(F.concat(F.lit(b"\x01"), q(group_col).cast("string").cast("binary")))
    leaves = docs.select(tree.alias("tree"), q(id_col).alias("id"), leaf_digest([q(c) for c in columns]).alias("leaf"), *[c.alias(f"carry_{k}") for k, c in carry.items()])
    leaves = stored(leaves, "digests")  # a range sort goes through its input twice
    carried = [f"carry_{k}" for k in carry]
    own = stored(_placed(leaves, ["tree", "id", "leaf", *carried]), "placed")

    def whole(tops: DataFrame) -> DataFrame:
        return tops.select("tree", F.array().cast("array<string>").alias("over_before"), F.array().cast("array<string>").alias("over_after"), F.col("top").alias("root"))

    def groups(tops: DataFrame) -> DataFrame:
        """The tree of the groups' roots."""
        named = tops.select(F.lit(b"").alias("tree"), F.col("tree").alias("group"), F.col("top").alias("digest"))
        stand = stored(_placed(named, ["tree", "group"]), "subroots")
        up = _climb(stand, whole).drop("tree").withColumnRenamed("before", "over_before").withColumnRenamed("after", "over_after")
        return stand.select("pos", F.col("group").alias("tree"), F.col("digest").alias("subroot")).join(up, "pos").drop("pos")

    proofs = _climb(own.select("tree", "pos", "n", F.col("leaf").alias("digest")), groups)
    out = own.join(proofs, ["tree", "pos"])
    return out.select(F.col("id").alias(id_col), "leaf", "subroot", "root", "before", "after", *[F.col(f"carry_{k}").alias(k) for k in carry])


def folded(leaf: Column, before: Column, after: Column) -> Column:
    """The root that a leaf and a proof give."""
    return F.aggregate(F.arrays_zip(before.alias("b"), after.alias("a")), leaf, lambda so_far, step: F.sha2(F.concat(step["b"], so_far, step["a"]), 256))


def proof_digest(before: Column, after: Column) -> Column:
    """sha256 of all that stands beside the path, from the leaf up, left to right."""
    return F.sha2(F.array_join(F.zip_with(before, after, lambda b, a: F.concat(b, a)), ""), 256)


def tamper_check(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The manifest of documents, and whether each row's proof holds once line ends are deleted from the texts of those whose id's crc32 is even.

    (id, leaf, subroot, root, proof_sha256, folded_root, verified).  A null text stays null;
    a row without an id isn't tampered with; a text without line ends stays as it is, and
    holds.  The result is a table in the shared folder; what led to it is deleted.
    """
    fields = (id_col, "source", "lang", "n_chars", text_col)
    q = lambda c: F.col(f"`{c}`")
    hit = F.coalesce(F.crc32(q(id_col).cast("string").cast("binary")) % 2 == 0, F.lit(False))
    text = F.when(hit, F.translate(q(text_col), "\n", "")).otherwise(q(text_col))
    changed = leaf_digest([text if c == text_col else q(c) for c in fields])
    root = folded(F.col("changed"), F.col("before"), F.col("after"))
    with scratch() as keep:
        made = manifest(docs, id_col, "source", fields, {"changed": changed})
        told = made.select(q(id_col), "leaf", "subroot", "root", proof_digest(F.col("before"), F.col("after")).alias("proof_sha256"), root.alias("folded_root"))
        return keep(stored(told.withColumn("verified", F.col("folded_root") == F.col("root")), "manifest"))


#: The same in DuckDB's SQL, for the documents table.
ORACLE = """
    WITH RECURSIVE told AS (
        -- hit: the checksum is even; it is the register's complement, which is odd then
        SELECT doc_id, source, row_number() OVER () AS r,
               list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(unicode(c) AS BIGINT))),
                           lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0, 0, 0, 0, 0, 0, 0, 0]),
                                                      lambda v, z: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END)) % 2 = 1 AS hit,
               CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id END
               || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END
               || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END
               || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars END AS head,
               text, replace(text, chr(10), '') AS cut
        FROM documents),
    leaves AS (
        SELECT doc_id, source, r, sha256(head || CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END) AS leaf,
               sha256(head || CASE WHEN text IS NULL THEN '-' WHEN hit THEN strlen(cut) || ':' || cut ELSE strlen(text) || ':' || text END) AS changed
        FROM told),
    placed AS (
        SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, changed) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n FROM leaves),
    nodes AS (
        SELECT source, 0 AS level, pos, n, leaf AS digest FROM placed
        UNION ALL
        SELECT source, level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos)) FROM nodes WHERE n > 1 GROUP BY source, level, pos // 3, n),
    subroots AS (SELECT source, digest AS subroot, level AS height, row_number() OVER (ORDER BY source IS NOT NULL, encode(source)) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
    above AS (
        SELECT 0 AS level, pos, n, subroot AS digest FROM subroots
        UNION ALL
        SELECT level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos)) FROM above WHERE n > 1 GROUP BY level, pos // 3, n),
    -- what stands beside each node, of its run
    beside AS (
        SELECT a.source, a.level, a.pos,
               coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos), '') AS bef, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos), '') AS aft
        FROM nodes a JOIN nodes b ON a.source IS NOT DISTINCT FROM b.source AND a.level = b.level AND a.pos // 3 = b.pos // 3
        WHERE a.n > 1 GROUP BY a.source, a.level, a.pos),
    beside_above AS (
        SELECT a.level, a.pos,
               coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos), '') AS bef, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos), '') AS aft
        FROM above a JOIN above b ON a.level = b.level AND a.pos // 3 = b.pos // 3
        WHERE a.n > 1 GROUP BY a.level, a.pos),
    steps AS (
        SELECT p.r, b.level, b.bef, b.aft FROM placed p JOIN beside b ON p.source IS NOT DISTINCT FROM b.source AND b.pos = p.pos // CAST(3 ** b.level AS BIGINT)
        UNION ALL
        SELECT p.r, s.height + b.level, b.bef, b.aft
        FROM placed p JOIN subroots s ON p.source IS NOT DISTINCT FROM s.source JOIN beside_above b ON b.pos = s.pos // CAST(3 ** b.level AS BIGINT)),
    proofs AS (SELECT r, list(bef || '|' || aft ORDER BY level) AS path, string_agg(bef || aft, '' ORDER BY level) AS beside FROM steps GROUP BY r)
    SELECT p.doc_id, p.leaf, s.subroot, (SELECT digest FROM above WHERE n = 1) AS root, sha256(coalesce(f.beside, '')) AS proof_sha256,
           list_reduce(list_prepend(p.changed, coalesce(f.path, [])), lambda v, x: sha256(split_part(x, '|', 1) || v || split_part(x, '|', 2))) AS folded_root,
           folded_root = (SELECT digest FROM above WHERE n = 1) AS verified
    FROM placed p JOIN subroots s ON p.source IS NOT DISTINCT FROM s.source LEFT JOIN proofs f ON p.r = f.r"""
