"""Sequence variants of cells: per-cell clustering, registry, filters, abundance."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import seq as S
from tessera.functions.kernels import Texts
from tessera.operators.order import numbered
from tessera.params import Variants

SUMMARY = "cell string, reads_used long, raw_unique long, dominant_reads long, coexisting long, secondary long, final_reads long, max_distance long, status string, core struct<r1:string,r2:string>"


def core_counts(packets: DataFrame, p: Variants = Variants()) -> DataFrame:
    """(cell, core, n, first): 16S reads of a cell by core sequence, and the place of the first; reads too short for a core aren't counted."""
    core = S.core(F.col("r1_seq"), F.col("r2_seq"), p.r1, p.r2, F.coalesce("r1_primer_start", F.lit(0)))
    reads = packets.where("gene_class = '16s'").withColumn("core", core).where("core is not null")
    return reads.groupBy("cell", "core").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("barcode_ord", "read_index")).alias("first"))


def fold(n: np.ndarray, begin: np.ndarray, cores: Texts, p: Variants) -> dict[str, np.ndarray]:
    """summarise()'s numbers for many cells at once; a cell's cores, by abundance, are those from its begin to the next one's, n their reads.

    All cells take their next core together.  It is held against their dominant ones first,
    and where it is near against all that have joined so far: one comparison of many rows.
    """
    first, count = begin[:-1], np.diff(begin)
    total = np.add.reduceat(n, first) if len(first) else np.zeros(0, np.int64)
    gate = np.maximum(2, (p.gate_ratio * total).astype(np.int64))
    joined = np.zeros(len(n), bool)
    joined[first] = True
    final, coexisting, secondary, widest = n[first].copy(), np.zeros_like(total), np.zeros_like(total), np.zeros_like(total)
    for k in range(1, int(count.max(initial=1))):
        cells = np.flatnonzero(count > k)
        own = first[cells] + k
        far = cores.apart(own, first[cells], p.max_shift)
        clash = np.where(far > p.max_distance, far, -1)
        near = np.flatnonzero(far <= p.max_distance)
        if len(near) and k > 1:
            # each of these cores with the later members of its cell, in their order
            of = np.repeat(near, k - 1)
            member = first[cells[of]] + 1 + np.tile(np.arange(k - 1), len(near))
            of, member = of[joined[member]], member[joined[member]]
            d = cores.apart(own[of], member, p.max_shift)
            over = np.flatnonzero(d > p.max_distance)
            some, at = np.unique(of[over], return_index=True)
            clash[some] = d[over[at]]
        free = clash < 0
        joined[own[free]] = True
        final[cells[free]] += n[own[free]]
        coexisting[cells[free]] += n[own[free]]
        widest[cells[free]] = np.maximum(widest[cells[free]], far[free])
        apart = ~free & (n[own] >= gate[cells])
        secondary[cells[apart]] += n[own[apart]]
        widest[cells[apart]] = np.maximum(widest[cells[apart]], clash[apart])
    share = secondary / (final + secondary)
    status = np.select([total < p.min_reads, secondary == 0, share >= p.mixed_ratio], ["low_depth", "single_ASV", "mixed_ASV"], "corrupted_single_ASV")
    return {"reads_used": total, "raw_unique": count, "dominant_reads": n[first], "coexisting": coexisting, "secondary": secondary, "final_reads": final, "max_distance": widest, "status": status}


def summarise(counts: DataFrame, p: Variants = Variants()) -> DataFrame:
    """One row a cell: its dominant core, what merges with it, what stands beside it, and the status.

    Cores come in order of abundance.  A core near the dominant one joins it if it is near
    every core that joined before; else it counts as secondary where it has enough reads.
    A cell is one row here, with its distinct cores, already counted; cells come in Arrow
    batches, which fold() takes whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            items = batch.column(1)
            begin = items.offsets.to_numpy().astype(np.int64)
            n, r1, r2 = items.flatten().flatten()
            begin = begin - begin[0]
            found = fold(n.to_numpy(zero_copy_only=False), begin, Texts(r1, r2), p)
            heads = pa.array(begin[:-1])
            core = pa.StructArray.from_arrays([r1.take(heads), r2.take(heads)], ["r1", "r2"])
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c.astype(object) if c.dtype.kind == "U" else c) for c in found.values()], core], names=["cell", *found, "core"])

    item = F.struct((-F.col("n")).alias("n"), F.col("first"), F.col("core"))
    listed = counts.groupBy("cell").agg(F.array_sort(F.collect_list(item)).alias("items"))
    plain = F.transform("items", lambda x: F.struct((-x["n"]).alias("n"), x["core"]["r1"].alias("r1"), x["core"]["r2"].alias("r2")))
    return listed.select("cell", plain.alias("items")).mapInArrow(run, SUMMARY)


def with_unused(cells: DataFrame, summary: DataFrame) -> DataFrame:
    """cells with their summary; a cell without usable reads has the status no_usable_reads."""
    out = cells.join(summary, "cell", "left")
    numbers = ["reads_used", "raw_unique", "dominant_reads", "coexisting", "secondary", "final_reads", "max_distance"]
    return out.fillna(0, numbers).fillna("no_usable_reads", ["status"])


def registry(summary: DataFrame, place: DataFrame | None = None) -> DataFrame:
    """(asv_no, asv_id, core, cells): dominant cores of single and corrupted cells, by number of cells; ties by the first cell's place."""
    own = summary.where("status in ('single_ASV', 'corrupted_single_ASV')")
    own = own.join(place, "cell") if place is not None else own.withColumn("place", F.col("cell"))
    counted = own.groupBy("core").agg(F.count(F.lit(1)).alias("cells"), F.min("place").alias("place"))
    return numbered(counted, [F.desc("cells"), "place", "core"], "asv_no").withColumn("asv_no", F.col("asv_no").cast("int")).select("asv_no", F.concat(F.lit("ASV_"), F.col("asv_no").cast("string")).alias("asv_id"), "core", "cells")


def assign(summary: DataFrame, asvs: DataFrame) -> DataFrame:
    """summary with asv_id, null where its core isn't registered."""
    return summary.join(asvs.select("core", "asv_id"), "core", "left")


REMOVED = ("mixed_ASV", "low_depth", "no_usable_reads")


def conflicts(cells: DataFrame, p: Variants = Variants()) -> DataFrame:
    """cells with conflict: whether the cell's phylum differs from its variant's, where that is well supported.

    Support and shares are aggregated to one row a variant, then joined back.
    """
    by = cells.groupBy("asv_id", F.col("path.P").alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    top = by.groupBy("asv_id").agg(F.sum("_n").alias("_support"), F.max(F.struct("_n", F.when(F.col("_p").isNull(), 0).otherwise(1).alias("known"))).alias("_m"), F.max("_n").alias("_top"))
    lead = by.join(top.select("asv_id", "_support", "_top"), "asv_id").where("_n = _top").groupBy("asv_id", "_support", "_top").agg(F.min("_p").alias("_lead"))
    lead = lead.withColumn("_strong", (F.col("_support") >= p.conflict_cells) & (F.col("_top") / F.col("_support") >= p.conflict_share) & F.col("_lead").isNotNull())
    out = cells.join(lead.select("asv_id", "_lead", "_strong"), "asv_id", "left")
    return out.withColumn("conflict", F.coalesce(F.col("_strong") & F.col("path.P").isNotNull() & (F.col("path.P") != F.col("_lead")), F.lit(False))).drop("_lead", "_strong")


def filtered(cells: DataFrame, p: Variants = Variants(), drop_corrupted: bool = False) -> DataFrame:
    """cells with stage and reason of removal: first by status, then, among the rest, by conflict; null where they survive."""
    removed = REMOVED + (("corrupted_single_ASV",) if drop_corrupted else ())
    bad = F.col("status").isin(*removed)
    kept = conflicts(cells.where(~bad), p).withColumn("stage", F.when(F.col("conflict"), "asv_taxonomy_conflict")).withColumn("reason", F.when(F.col("conflict"), "asv_phylum_conflict"))
    gone = cells.where(bad).withColumn("conflict", F.lit(False)).withColumn("stage", F.lit("asv_status_quality")).withColumn("reason", F.col("status"))
    return kept.unionByName(gone)


def abundance(cells: DataFrame, p: Variants = Variants()) -> DataFrame:
    """(asv_id, cells, share, passed): whether a variant has enough of the cells."""
    counted = cells.groupBy("asv_id").agg(F.count(F.lit(1)).alias("cells"))
    share = F.col("cells") / cells.agg(F.count(F.lit(1))).scalar()
    return counted.withColumn("share", share).withColumn("passed", (F.col("cells") >= p.final_min_cells) & (F.col("share") >= p.final_min_fraction))
