"""The whole path from read pairs to result tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import barcodes, cells, demux, sequences, variants
from tessera.params import Params
from tessera.plans import results
from tessera.storage import forget_shuffles, release, scratch, stored


@dataclass
class Results:
    """A run's tables; sequences is None where no reconstruction was asked for."""

    summary: dict
    candidates: DataFrame
    all_asvs: DataFrame
    cells: DataFrame
    asvs: DataFrame
    sequences: DataFrame | None
    target_summary: DataFrame
    calls: DataFrame | None

    def problems(self, spark: SparkSession, panel_names: list[str], p: Params = Params()) -> list[str]:
        """What the validators find; empty when all is well."""
        run_id = self.summary["run_id"]
        none = spark.createDataFrame([], results.SEQUENCE)
        found = results.violations(run_id, self.cells, self.asvs, self.sequences if self.sequences is not None else none, panel_names)
        found = found.unionByName(results.provenance_violations(run_id, self.candidates, self.all_asvs, self.cells, self.asvs, p.variants))
        counts = (self.cells.count(), self.asvs.count(), self.candidates.count(), self.all_asvs.count())
        # the first hundred suffice to refuse a run
        return results.summary_violations(self.summary, run_id, *counts) + [f"{r['rule']}: {r['key']}" for r in found.limit(100).collect()]


def run(pairs: DataFrame, panel: DataFrame, labels: DataFrame, taxa: DataFrame, params: Params = Params(), reconstruct_all: bool = False, reference: DataFrame | None = None, software: dict | None = None, inputs: dict | None = None) -> Results:
    """Read pairs to results.

    Packets, the barcode map and the surviving cells become tables in the shared folder, as
    later steps read them several times; all else is one plan.  From the barcode map on,
    rows meet by cell.  Tables of reads are compressed, hold what later steps ask for, and go
    with the step that reads them last; in the end the results' tables alone stay.  pairs and
    what they are read from are the caller's.
    """
    with scratch() as keep:
        return _run(keep, pairs, panel, labels, taxa, params, reconstruct_all, reference, software, inputs)


def _run(keep: Callable[[DataFrame], DataFrame], pairs: DataFrame, panel: DataFrame, labels: DataFrame, taxa: DataFrame, params: Params, reconstruct_all: bool, reference: DataFrame | None, software: dict | None, inputs: dict | None) -> Results:
    """run() over tables of the scratch() block around it."""
    spark, rows = pairs.sparkSession, demux.panel_list(panel)
    _, _, fwd, rev, _ = rows[0]
    names, modes = [r[1] for r in rows[1:]], panel.select("target", "mode")
    checked = demux.with_qc(pairs, params.read_qc)
    qc = demux.qc_counts(checked)
    # a table between the primer steps: their expressions are large, and plans that combine them larger
    passed = checked.where("qc_reason is null").select("read_index", "read_id", "r1_seq", "r2_seq")
    passed = stored(demux.place_16s(passed, fwd, rev, params.matching), "placed", "zstd")
    genes = stored(demux.packets(passed, rows, params.matching, params.read_qc.barcode_length), "genes", "zstd")
    release(passed)
    own = genes.join(F.broadcast(panel.select("panel_index", "target")), "panel_index", "left")
    # labels are asked for 16S reads alone: the others don't go through the join's shuffle
    is16, columns = F.col("gene_class") == "16s", ["read_index", "read_id", "barcode", "gene_class", "panel_index", "target", "path", "r1_primer_start", "r1_seq", "r2_seq"]
    own = demux.classify(own.where(is16), labels, taxa).select(*columns).union(own.where(~is16).withColumn("path", F.lit(None).cast(demux.EMPTY_PATH)).select(*columns))
    packets = stored(own, "packets", "zstd")
    release(genes)
    forget_shuffles(spark)
    clustered = stored(barcodes.with_cells(packets, params.cells.barcode_shift), "clustered", "zstd")
    # what the record counts of all packets
    kinds = stored(packets.select("gene_class", "r1_primer_start"), "kinds", "zstd")
    release(packets)
    forget_shuffles(spark)

    counts = stored(cells.target_counts(clustered), "counts")
    summary = stored(cells.consensus(cells.path_counts(clustered), params.consensus), "summary")
    order = barcodes_order(clustered)
    stage1 = stored(cells.stage1(summary, params.cells), "stage1")
    sized = cells.taxon_size(stage1, params.cells.min_cells_per_taxon)
    typed = variants.summarise(variants.core_counts(clustered.join(sized.select("cell"), "cell", "left_semi"), params.variants), params.variants)
    joined = variants.with_unused(sized, typed)
    asvs = keep(stored(variants.registry(joined, order), "asvs"))
    judged = stored(variants.filtered(variants.assign(joined, asvs), params.variants), "judged")
    alive = stored(judged.where("stage is null"), "alive")
    tested = keep(stored(cells.background(alive, counts.join(alive.select("cell"), "cell", "left_semi"), params.targets.background_alpha), "tested"))
    stats = cells.background_stats(tested, names)

    eligible = names if reconstruct_all else [r[1] for r in rows[1:] if r[4] == "ssr"]
    calls = named = None
    if eligible:
        kept = tested.where((F.col("filtered") > 0) & F.col("target").isin(*eligible)).select("cell", "target")
        seqs = stored(sequences.target_cores(clustered.join(alive.select("cell"), "cell", "left_semi"), params.targets).where(F.col("target").isin(*eligible)), "cores")
        clusters = sequences.cluster_cores(seqs, params.targets)
        calls = keep(stored(sequences.call_sequences(seqs.join(kept, ["cell", "target"], "left_semi"), clusters, params.consensus), "calls"))
        named = stored(sequences.denoise(sequences.name_sequences(calls, order), params.targets), "named")
        assigned = sequences.assignments(tested, calls, named, eligible)
    else:
        kind = F.when(F.col("filtered") == 0, "filtered_out").otherwise("detected")
        assigned = tested.select("cell", "target", "n", "filtered", kind.alias("assignment_type"), F.lit(None).cast("string").alias("sequence_id"))

    run_id = results.new_run_id()
    dead = counts.join(judged.where("stage is not null").select("cell"), "cell", "left_semi")
    candidates = keep(stored(results.candidate_cells(judged, results.nested_targets(assigned, panel, calls), results.not_evaluated(dead, panel), variants.abundance(alive, params.variants), run_id), "candidates"))
    final = keep(stored(results.final_cells(candidates), "final"))
    all_asvs, final_asvs = results.candidate_asvs(candidates, asvs, run_id, params.variants), results.final_asvs(final, asvs, run_id)
    seq_rows = phase = None
    if named is not None:
        phases = sequences.phase_calls(named.where("retained"), modes)
        matches = sequences.reference_matches(named.where("retained"), reference) if reference is not None else None
        seq_rows = keep(stored(results.final_sequences(final, named, run_id, phases, matches), "sequences"))
        if any(r[4] == "ssr" for r in rows):
            phase = results.cell_phases(final, seq_rows)
    target_rows = results.target_summary(stats, final)
    funnel = {"raw_unique_barcodes": clustered.select("barcode").distinct().count(), "clustered_barcodes": clustered.select("cell").distinct().count(), "after_stage1_taxonomy_filter": stage1.count(), "after_minimum_cells_per_taxon": sized.count()}
    record = results.run_summary(run_id, software or {}, inputs or {}, rows, asdict(params), qc, kinds, demux.stagger_counts(kinds, params.matching.r1_starts), funnel, candidates, all_asvs, final, final_asvs, target_rows, phase)
    return Results(record, candidates, all_asvs, final, final_asvs, seq_rows, target_rows, calls)


def barcodes_order(clustered: DataFrame) -> DataFrame:
    """(cell, place): a cell's place among all, by its dominant barcode."""
    return clustered.where("barcode = cell").groupBy("cell").agg(F.min("barcode_ord").alias("place"))
