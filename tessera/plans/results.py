"""Nested result tables, provenance, run summary, validators and reports."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import seq as S
from tessera.params import Variants
from tessera.sources import tables

# Fixed values of the result format: its version, the names of states and of all fields below.
VERSION = "3.1.0"
STATUSES = ("single_ASV", "corrupted_single_ASV")
ASSIGNMENTS = ("filtered_out", "detected", "sequence_unresolved", "sequence_cluster")
RANKS = "struct<domain:string,phylum:string,class:string,order:string,family:string,genus:string,species:string>"
TAXONOMY = f"struct<ranks:{RANKS},confidence:double,contamination:double>"
EVIDENCE = "struct<total_16s_reads:bigint,technical_noise_reads:bigint>"
ASV = "struct<asv_id:string,status:string,reads_used:bigint,raw_unique_core_sequences:bigint,dominant_raw_read_count:bigint,coexisting_2bp_reads:bigint,unauthorized_secondary_reads:bigint,final_cell_asv_reads:bigint,max_internal_distance:bigint>"
QC = "struct<confidence:double,contamination:double,total_reads:bigint,technical_noise_reads:bigint>"
TARGET = f"struct<target_name:string,raw_read_count:bigint,filtered_read_count:bigint,assignment_type:string,sequence_cluster_id:string,sequence_call_qc:{QC}>"
FILTER = "struct<passed:boolean,stage:string,reason:string>"
CORE = "struct<r1:string,r2:string>"
HEAD = "schema_version string, record_type string, run_id string"
CELL = f"{HEAD}, cell_barcode string, taxonomy {TAXONOMY}, taxonomy_evidence {EVIDENCE}, asv {ASV}, targets array<{TARGET}>"
CANDIDATE = f"{CELL}, final_filter {FILTER}"
CANDIDATE_ASV = f"{HEAD}, asv_id string, core_sequence {CORE}, candidate_cell_count long, candidate_cell_fraction double, final_filter {FILTER}"
ASV_ROW = f"{HEAD}, asv_id string, core_sequence {CORE}, final_surviving_cell_count long"
PHASE = "struct<mode:string,call:string,motif:string,repeat_count:int,start:int,end:int,direct_similarity:double,evidence:string>"
MATCH = "struct<subject:string,r1_start:int,r1_end:int,r1_percent_identity:double,r2_start:int,r2_end:int,r2_percent_identity:double>"
SEQUENCE = f"{HEAD}, sequence_cluster_id string, parent_target string, core_sequence {CORE}, final_surviving_cell_count long, phase_variation {PHASE}, reference_matches array<{MATCH}>"
LEGACY = (
    f"schema_version string, cell_barcode string, taxonomy struct<lineage:string,ranks:{RANKS},confidence:double,contamination:double>, asv struct<assignment:string,status:string,reads:bigint,max_internal_distance:bigint>, "
    "read_qc struct<total_16s_reads:bigint,technical_noise_reads:bigint,reads_used_for_asv:bigint>, targets array<struct<target:string,assignment:string>>, "
    "phase_variation array<struct<target:string,mode:string,sequence_assignment:string,call:string,motif:string,repeat_count:int,start:int,end:int,direct_similarity:double,evidence:string>>")


def new_run_id() -> str:
    return str(uuid.uuid4())


def _head(kind: str, run_id: str) -> list[Column]:
    return [F.lit(VERSION).alias("schema_version"), F.lit(kind).alias("record_type"), F.lit(run_id).alias("run_id")]


def _body() -> list[Column]:
    """The columns that cells and candidate cells share, from a flat cell row."""
    return [
        F.col("cell").alias("cell_barcode"),
        F.struct(S.ranks_struct(F.col("path")).alias("ranks"), "confidence", "contamination").alias("taxonomy"),
        F.struct(F.col("total_16s").alias("total_16s_reads"), F.col("noise").alias("technical_noise_reads")).alias("taxonomy_evidence"),
        F.struct("asv_id", "status", "reads_used", F.col("raw_unique").alias("raw_unique_core_sequences"), F.col("dominant_reads").alias("dominant_raw_read_count"), F.col("coexisting").alias("coexisting_2bp_reads"), F.col("secondary").alias("unauthorized_secondary_reads"), F.col("final_reads").alias("final_cell_asv_reads"), F.col("max_distance").alias("max_internal_distance")).alias("asv"),
    ]


def nested_targets(assigned: DataFrame, panel: DataFrame, calls: DataFrame | None = None) -> DataFrame:
    """(cell, targets): each cell's observed targets in the panel's order. A cell has as many as the panel has rows, at most."""
    own = assigned.join(F.broadcast(panel.select("panel_index", "target")), "target")
    if calls is not None:
        own = own.join(calls.where("core is not null").select("cell", "target", F.struct("confidence", "contamination", F.col("total").alias("total_reads"), F.col("noise").alias("technical_noise_reads")).alias("qc")), ["cell", "target"], "left")
    else:
        own = own.withColumn("qc", F.lit(None).cast(QC))
    item = F.struct("panel_index", F.struct(F.col("target").alias("target_name"), F.col("n").alias("raw_read_count"), F.col("filtered").alias("filtered_read_count"), "assignment_type", F.col("sequence_id").alias("sequence_cluster_id"), F.col("qc").alias("sequence_call_qc")).alias("t"))
    return own.where("n > 0").groupBy("cell").agg(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["t"]).alias("targets"))


def candidate_cells(cells: DataFrame, targets: DataFrame, raw_targets: DataFrame, passing: DataFrame, run_id: str) -> DataFrame:
    """All cells before the variant filters, with what became of them.

    cells: from variants.filtered().  targets: of surviving cells.  raw_targets: (cell,
    targets) of the others, not evaluated.  passing: from variants.abundance().
    """
    alive = F.col("stage").isNull()
    own = cells.join(passing.select("asv_id", "passed"), "asv_id", "left").join(targets, "cell", "left").join(raw_targets.withColumnRenamed("targets", "_raw"), "cell", "left")
    passed = alive & F.coalesce("passed", F.lit(False))
    stage = F.when(passed, "final").when(alive, "asv_abundance").otherwise(F.col("stage"))
    reason = F.when(passed, F.lit(None).cast("string")).when(alive, "low_asv_support").otherwise(F.col("reason"))
    none = F.array().cast(f"array<{TARGET}>")
    listed = F.coalesce(F.when(alive, F.col("targets")).otherwise(F.col("_raw")), none)
    return own.select(*_head("candidate_cell", run_id), *_body(), listed.alias("targets"), F.struct(passed.alias("passed"), stage.alias("stage"), reason.alias("reason")).alias("final_filter"))


def not_evaluated(counts: DataFrame, panel: DataFrame) -> DataFrame:
    """(cell, targets) of cells that were removed before the background test."""
    plain = counts.select("cell", "target", "n", F.lit(None).cast("long").alias("filtered"), F.lit("not_evaluated").alias("assignment_type"), F.lit(None).cast("string").alias("sequence_id"))
    return nested_targets(plain, panel)


def final_cells(candidates: DataFrame) -> DataFrame:
    return candidates.where("final_filter.passed").withColumn("record_type", F.lit("cell")).drop("final_filter")


def candidate_asvs(candidates: DataFrame, asvs: DataFrame, run_id: str, p: Variants = Variants()) -> DataFrame:
    """Variants before the abundance filter; asvs: the registry."""
    counted = candidates.where("final_filter.stage in ('final', 'asv_abundance')").groupBy("asv.asv_id").agg(F.count(F.lit(1)).alias("n"))
    share = F.col("n") / counted.agg(F.sum("n")).scalar()
    passed = (F.col("n") >= p.final_min_cells) & (F.col("share") >= p.final_min_fraction)
    rows = counted.withColumn("share", share).join(asvs.select("asv_id", "core"), "asv_id")
    verdict = F.struct(passed.alias("passed"), F.when(passed, "final").otherwise("asv_abundance").alias("stage"), F.when(~passed, "low_asv_support").alias("reason"))
    return rows.select(*_head("candidate_asv", run_id), "asv_id", F.col("core").alias("core_sequence"), F.col("n").alias("candidate_cell_count"), F.col("share").alias("candidate_cell_fraction"), verdict.alias("final_filter"))


def final_asvs(cells: DataFrame, asvs: DataFrame, run_id: str) -> DataFrame:
    counted = cells.groupBy("asv.asv_id").agg(F.count(F.lit(1)).alias("final_surviving_cell_count"))
    return counted.join(asvs.select("asv_id", F.col("core").alias("core_sequence")), "asv_id").select(*_head("asv", run_id), "asv_id", "core_sequence", "final_surviving_cell_count")


def final_sequences(cells: DataFrame, names: DataFrame, run_id: str, phases: DataFrame | None = None, matches: DataFrame | None = None) -> DataFrame:
    """Target sequences that final cells carry, with their phase variation and reference matches where there are any."""
    used = cells.select(F.explode("targets").alias("t")).where("t.assignment_type = 'sequence_cluster'").groupBy(F.col("t.sequence_cluster_id").alias("sequence_id")).agg(F.count(F.lit(1)).alias("final_surviving_cell_count"))
    out = used.join(names.select("sequence_id", "target", "core"), "sequence_id")
    if phases is not None:
        fields = ("mode", "call", "motif", "repeat_count", "start", "end", "direct_similarity", "evidence")
        out = out.join(phases.select("sequence_id", F.struct(*fields).alias("phase_variation")), "sequence_id", "left")
    else:
        out = out.withColumn("phase_variation", F.lit(None).cast(PHASE))
    if matches is not None:
        item = F.struct("subject", "r1_start", "r1_end", F.col("percent_identity").alias("r1_percent_identity"), "r2_start", "r2_end", F.col("percent_identity").alias("r2_percent_identity"))
        out = out.join(matches.groupBy("sequence_id").agg(F.array_sort(F.collect_list(item)).alias("reference_matches")), "sequence_id", "left")
        out = out.withColumn("reference_matches", F.coalesce("reference_matches", F.array().cast(f"array<{MATCH}>")))
    else:
        out = out.withColumn("reference_matches", F.lit(None).cast(f"array<{MATCH}>"))
    return out.select(*_head("target_sequence", run_id), F.col("sequence_id").alias("sequence_cluster_id"), F.col("target").alias("parent_target"), F.col("core").alias("core_sequence"), "final_surviving_cell_count", "phase_variation", "reference_matches")


def target_summary(stats: DataFrame, cells: DataFrame) -> DataFrame:
    """Positive cells of each target before and after the background test and in the final cells; retention is of the final ones."""
    final = cells.select(F.explode("targets").alias("t")).where("t.filtered_read_count > 0").groupBy(F.col("t.target_name").alias("target")).agg(F.count(F.lit(1)).alias("final"))
    out = stats.join(final, "target", "left").fillna(0, ["final"])
    return out.select(
        "panel_index", F.col("target").alias("target_name"), F.col("original").alias("original_positive_cells"), F.col("filtered_out").alias("filtered_out_cells"),
        F.col("remaining").alias("remaining_positive_cells"), (F.col("remaining") - F.col("final")).alias("asv_abundance_excluded_positive_cells"),
        F.col("final").alias("final_positive_cells"), F.when(F.col("original") > 0, F.col("final") / F.col("original") * 100).otherwise(0.0).alias("retention_percent"))


def run_summary(run_id: str, software: dict, inputs: dict, panel: list[tuple], parameters: dict, qc: DataFrame, packets: DataFrame, stagger: DataFrame, funnel: dict[str, int], candidates: DataFrame, all_asvs: DataFrame, cells: DataFrame, asvs: DataFrame, targets: DataFrame, phase: DataFrame | None = None) -> dict:
    """The run's one record: a handful of counts, each aggregated on the executors; the balances are checked here."""
    row = qc.first().asDict()
    kinds = {r["gene_class"]: r["count"] for r in packets.groupBy("gene_class").count().collect()}
    reads = {"accepted_16s_reads": kinds.get("16s", 0), "target_reads": kinds.get("target", 0), "unclassified_reads": kinds.get("unclassified", 0)}
    starts = {str(r["start"]): r["n"] for r in stagger.orderBy("start").collect()}
    if row["passed_pairs"] != sum(reads.values()):
        raise ValueError("read classes don't add up to the passed pairs")
    if sum(starts.values()) != reads["accepted_16s_reads"]:
        raise ValueError("primer starts don't add up to the accepted 16S reads")
    stages = {r["stage"]: r["count"] for r in candidates.groupBy("final_filter.stage").count().collect()}
    eligible, final = stages.get("final", 0) + stages.get("asv_abundance", 0), stages.get("final", 0)
    conflicts = stages.get("asv_taxonomy_conflict", 0)
    n_all, n_final = all_asvs.count(), asvs.count()
    out = {
        "schema_version": VERSION, "record_type": "run_summary", "run_id": run_id, "status": "completed", "software": software, "inputs": inputs,
        "target_panel": [{"target_name": t, "forward_primer": f, "reverse_primer": r, "mode": m} for _, t, f, r, m in panel[1:]], "parameters": parameters,
        "read_qc": {"raw_read_pairs": row["total_pairs"], "passed_read_pairs": row["passed_pairs"], "filtered_read_pairs": row["filtered_pairs"], "rejected": {k: row[k] for k in ("read_length_or_quality_length", "mean_phred", "barcode_length", "barcode_q25")}},
        "read_classification": reads, "16s_r1_primer_starts": starts,
        "barcode_funnel": funnel | {"before_asv_filter": sum(stages.values()), "after_asv_status_filter": eligible + conflicts, "asv_taxonomy_conflicts_removed": conflicts, "before_asv_abundance_filter": eligible, "asv_abundance_filtered_cells": eligible - final, "final_cells": final},
        "asv_summary": {"before_abundance_filter_count": n_all, "filtered_out_asv_count": n_all - n_final, "final_asv_count": n_final},
        "target_filtering_summary": [{k: v for k, v in r.asDict().items() if k != "panel_index"} for r in targets.orderBy("panel_index").collect()],
    }
    if phase is not None:
        calls = {r["call"]: r["count"] for r in phase.groupBy("call").count().orderBy(F.desc("count"), "call").collect()}
        out["phase_variation_summary"] = {"cell_calls": sum(calls.values()), "calls": calls}
    return out


def cell_phases(cells: DataFrame, sequences: DataFrame) -> DataFrame:
    """A row for each call of a cell's ssr sequence, in the panel's order."""
    own = cells.select("cell_barcode", F.posexplode("targets").alias("k", "t")).where("t.assignment_type = 'sequence_cluster'")
    return own.join(sequences.where("phase_variation is not null").select(F.col("sequence_cluster_id"), "phase_variation"), F.col("t.sequence_cluster_id") == F.col("sequence_cluster_id")).select("cell_barcode", "k", F.col("t.target_name").alias("target"), "sequence_cluster_id", "phase_variation.*")


def _broken(df: DataFrame, rule: str, condition: Column, key: Column) -> DataFrame:
    return df.where(F.coalesce(condition, F.lit(True))).select(F.lit(rule).alias("rule"), key.cast("string").alias("key"))


def _twice(df: DataFrame, rule: str, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.lit(rule).alias("rule"), F.col(key).cast("string").alias("key"))


def violations(run_id: str, cells: DataFrame, asvs: DataFrame, sequences: DataFrame, panel_names: list[str]) -> DataFrame:
    """(rule, key) of everything wrong with the final tables; empty when all is well."""
    key = F.col("cell_barcode")
    numbers = [F.col(f"asv.{c}") for c in ("reads_used", "raw_unique_core_sequences", "dominant_raw_read_count", "coexisting_2bp_reads", "unauthorized_secondary_reads", "final_cell_asv_reads", "max_internal_distance")] + [F.col("taxonomy_evidence.total_16s_reads"), F.col("taxonomy_evidence.technical_noise_reads")]
    negative = reduce(lambda a, b: a | b, [n.isNull() | (n < 0) for n in numbers])
    targets = cells.select("cell_barcode", F.explode("targets").alias("t")).select("cell_barcode", "t.*")
    of = F.concat_ws("/", "cell_barcode", "target_name")
    kind, count = F.col("assignment_type"), F.col("filtered_read_count")
    head = lambda df, k, kind_: (_broken(df, f"{kind_}_identity", (F.col("schema_version") != VERSION) | (F.col("record_type") != kind_) | (F.col("run_id") != run_id), k))
    asv_used = cells.groupBy(F.col("asv.asv_id").alias("asv_id")).agg(F.count(F.lit(1)).alias("used"))
    seq_used = targets.where(kind == "sequence_cluster").groupBy("sequence_cluster_id").agg(F.count(F.lit(1)).alias("used"))
    asv_both = asvs.select("asv_id", "final_surviving_cell_count").join(asv_used, "asv_id", "full")
    seq_both = sequences.select("sequence_cluster_id", "final_surviving_cell_count").join(seq_used, "sequence_cluster_id", "full")
    prefix = F.concat(F.col("parent_target"), F.lit("_seq_"))
    tail = F.expr("substr(sequence_cluster_id, length(parent_target) + 6)")
    checks = [
        head(cells, key, "cell"), _twice(cells, "cell_unique", "cell_barcode"),
        _broken(cells, "cell_barcode", key == "", key), _broken(cells, "cell_numbers", negative, key),
        _broken(cells, "cell_status", ~F.col("asv.status").isin(*STATUSES) | F.col("asv.asv_id").isNull(), key),
        _broken(targets, "target_known", ~F.col("target_name").isin(*panel_names), of), _twice(targets.withColumn("k", of), "target_unique", "k"),
        _broken(targets, "target_reads", F.col("raw_read_count") <= 0, of), _broken(targets, "target_assignment", ~kind.isin(*ASSIGNMENTS), of),
        _broken(targets, "target_count", F.when(kind == "filtered_out", count != 0).otherwise(count <= 0), of),
        _broken(targets, "target_sequence", (kind == "sequence_cluster") != F.col("sequence_cluster_id").isNotNull(), of),
        head(asvs, F.col("asv_id"), "asv"), _twice(asvs, "asv_unique", "asv_id"), _broken(asvs, "asv_name", ~F.col("asv_id").rlike(r"^ASV_[1-9]\d*$"), F.col("asv_id")),
        _broken(asvs, "asv_core", F.col("core_sequence.r1").isNull() | F.col("core_sequence.r2").isNull(), F.col("asv_id")),
        _broken(asv_both, "asv_cells", F.coalesce(F.col("final_surviving_cell_count"), F.lit(-1)) != F.coalesce(F.col("used"), F.lit(-2)), F.col("asv_id")),
        head(sequences, F.col("sequence_cluster_id"), "target_sequence"), _twice(sequences, "sequence_unique", "sequence_cluster_id"),
        _broken(sequences, "sequence_name", ~F.col("sequence_cluster_id").startswith(prefix) | ~tail.rlike(r"^[1-9]\d*$"), F.col("sequence_cluster_id")),
        _broken(sequences, "sequence_parent", ~F.col("parent_target").isin(*panel_names), F.col("sequence_cluster_id")),
        _broken(sequences, "sequence_phase", F.col("phase_variation").isNotNull() & (F.col("phase_variation.mode").isNull() | F.col("phase_variation.call").isNull() | F.col("phase_variation.evidence").isNull()), F.col("sequence_cluster_id")),
        _broken(seq_both, "sequence_cells", F.coalesce(F.col("final_surviving_cell_count"), F.lit(-1)) != F.coalesce(F.col("used"), F.lit(-2)), F.col("sequence_cluster_id")),
    ]
    return reduce(DataFrame.unionByName, checks)


def provenance_violations(run_id: str, candidates: DataFrame, all_asvs: DataFrame, cells: DataFrame, asvs: DataFrame, p: Variants = Variants()) -> DataFrame:
    """(rule, key) of everything wrong between candidates and final results."""
    key, verdict = F.col("cell_barcode"), F.col("final_filter")
    body = F.struct("asv", "targets", "taxonomy", "taxonomy_evidence")
    a = candidates.select("cell_barcode", "final_filter", body.alias("a"))
    both = a.join(cells.select("cell_barcode", body.alias("b")), "cell_barcode", "full")
    passed = F.coalesce(verdict["passed"], F.lit(False))
    counted = candidates.where("final_filter.stage in ('final', 'asv_abundance')").groupBy("asv.asv_id").agg(F.count(F.lit(1)).alias("n"))
    counted = counted.withColumn("share", F.col("n") / counted.agg(F.sum("n")).scalar())
    every = all_asvs.select("asv_id", "candidate_cell_count", "candidate_cell_fraction", "final_filter").join(counted, "asv_id", "full").join(asvs.select("asv_id", F.lit(True).alias("is_final")), "asv_id", "left")
    expected = (F.col("n") >= p.final_min_cells) & (F.col("share") >= p.final_min_fraction)
    checks = [
        _broken(candidates, "candidate_identity", (F.col("schema_version") != VERSION) | (F.col("record_type") != "candidate_cell") | (F.col("run_id") != run_id), key),
        _twice(candidates, "candidate_unique", "cell_barcode"),
        _broken(candidates, "abundance_asv", verdict["stage"].isin("final", "asv_abundance") & F.col("asv.asv_id").isNull(), key),
        _broken(candidates, "passed_state", verdict["passed"] & ((verdict["stage"] != "final") | verdict["reason"].isNotNull()), key),
        _broken(candidates, "excluded_reason", ~verdict["passed"] & verdict["reason"].isNull(), key),
        _broken(both, "passed_is_final", passed != F.col("b").isNotNull(), key),
        _broken(both.where(passed & F.col("b").isNotNull()), "same_record", F.to_json("a") != F.to_json("b"), key),
        _broken(all_asvs, "candidate_asv_identity", (F.col("schema_version") != VERSION) | (F.col("record_type") != "candidate_asv") | (F.col("run_id") != run_id), F.col("asv_id")),
        _twice(all_asvs, "candidate_asv_unique", "asv_id"),
        _broken(every, "candidate_asv_count", F.coalesce("candidate_cell_count", F.lit(-1)) != F.coalesce("n", F.lit(-2)), F.col("asv_id")),
        _broken(every, "candidate_asv_share", F.abs(F.col("candidate_cell_fraction") - F.col("share")) > 1e-15, F.col("asv_id")),
        _broken(every, "candidate_asv_verdict", verdict["passed"] != expected, F.col("asv_id")),
        _broken(every, "passed_asv_is_final", passed != F.col("is_final").isNotNull(), F.col("asv_id")),
    ]
    return reduce(DataFrame.unionByName, checks)


def summary_violations(summary: dict, run_id: str, n_cells: int, n_asvs: int, n_candidates: int, n_all_asvs: int) -> list[str]:
    """What is wrong with a run's record."""
    out = []

    def need(ok: bool, what: str) -> None:
        if not ok:
            out.append(what)

    try:
        parsed = uuid.UUID(run_id)
        need(parsed.version == 4 and str(parsed) == run_id, "run_id is no canonical UUIDv4")
    except ValueError:
        out.append("run_id is no UUID")
    keys = {"schema_version", "record_type", "run_id", "status", "software", "inputs", "target_panel", "parameters", "read_qc", "read_classification", "16s_r1_primer_starts", "barcode_funnel", "asv_summary", "target_filtering_summary"}
    need(keys <= set(summary) <= keys | {"phase_variation_summary"}, "the record's keys")
    if out:
        return out
    need(summary["schema_version"] == VERSION and summary["record_type"] == "run_summary" and summary["run_id"] == run_id and summary["status"] == "completed", "identity")
    funnel, variants, reads = summary["barcode_funnel"], summary["asv_summary"], summary["read_classification"]
    need(summary["read_qc"]["passed_read_pairs"] == sum(reads.values()), "passed pairs and read classes")
    need(sum(summary["16s_r1_primer_starts"].values()) == reads["accepted_16s_reads"], "primer starts and 16S reads")
    need(funnel["final_cells"] == n_cells and variants["final_asv_count"] == n_asvs, "final counts")
    need(funnel["before_asv_filter"] == n_candidates, "candidate cells")
    need(funnel["asv_abundance_filtered_cells"] == funnel["before_asv_abundance_filter"] - n_cells, "cells that the abundance filter excluded")
    need(variants["before_abundance_filter_count"] == n_all_asvs and variants["filtered_out_asv_count"] == n_all_asvs - n_asvs, "candidate variants")
    return out


def cell_target_matrix(cells: DataFrame, names: list[str]) -> DataFrame:
    """The wide report: a column for each target, with its sequence, its parent, its filtered count or 0."""
    t = F.col("t")
    value = F.when(t["assignment_type"] == "sequence_cluster", t["sequence_cluster_id"]).when(t["assignment_type"] == "sequence_unresolved", F.concat(t["target_name"], F.lit("_parent"))).when(t["assignment_type"] == "filtered_out", "0").otherwise(t["filtered_read_count"].cast("string"))
    long = cells.select("cell_barcode", F.explode("targets").alias("t")).select("cell_barcode", t["target_name"].alias("target"), value.alias("value"))
    wide = long.groupBy("cell_barcode").pivot("target", names).agg(F.first("value"))
    ranks = F.col("taxonomy.ranks")
    path = F.concat_ws(" | ", *[F.concat(F.lit(f"{c} - "), F.coalesce(ranks[n], F.lit("None"))) for c, n in S.RANKS.items()])
    fixed = [
        F.col("cell_barcode").alias("Barcode"), path.alias("Predicted taxonomy"), F.col("taxonomy.confidence").alias("Confidence"), F.col("taxonomy.contamination").alias("Contamination"),
        F.col("taxonomy_evidence.total_16s_reads").alias("Total # of 16s reads"), F.col("taxonomy_evidence.technical_noise_reads").alias("Technical noise count"),
        F.col("asv.reads_used").alias("Reads_used_for_ASV"), F.col("asv.raw_unique_core_sequences").alias("Raw unique_core_sequences"), F.col("asv.dominant_raw_read_count").alias("Dominant_raw_read_count"),
        F.col("asv.coexisting_2bp_reads").alias("Coexisting_2bp_reads"), F.col("asv.unauthorized_secondary_reads").alias("Unauthorized_secondary_reads"), F.col("asv.final_cell_asv_reads").alias("Final_cell_asv_reads"),
        F.col("asv.max_internal_distance").alias("Max_internal_distance"), F.col("asv.asv_id").alias("Assigned_core_asv"), F.col("asv.status").alias("Status")]
    joined = cells.join(wide, "cell_barcode", "left")
    return joined.select(*fixed, *[F.coalesce(F.col(f"`{n}`"), F.lit("0")).alias(n) for n in names])


def asv_report(asvs: DataFrame) -> DataFrame:
    return asvs.select(F.col("asv_id").alias("Core_ASV_ID"), F.col("final_surviving_cell_count").alias("cell_count"), F.concat_ws("|", "core_sequence.r1", "core_sequence.r2").alias("core_sequence")).orderBy(F.regexp_extract("Core_ASV_ID", r"(\d+)$", 1).cast("long"))


def taxonomy_report(cells: DataFrame) -> DataFrame:
    ranks = F.col("taxonomy.ranks")
    path = F.concat_ws(" | ", *[F.concat(F.lit(f"{c} - "), F.coalesce(ranks[n], F.lit("None"))) for c, n in S.RANKS.items()])
    return cells.groupBy(path.alias("MLE_Taxonomic_Classification")).agg(F.count(F.lit(1)).alias("Cell_Count"), F.min("cell_barcode").alias("_first")).orderBy(F.desc("Cell_Count"), "_first").drop("_first")


def target_report(summary: DataFrame) -> DataFrame:
    return summary.orderBy("panel_index").select(F.col("target_name").alias("ARG"), F.col("original_positive_cells").alias("Original"), (F.col("original_positive_cells") - F.col("final_positive_cells")).alias("Filtered Out"), F.col("final_positive_cells").alias("Remaining"), F.col("retention_percent").alias("% Retention"))


def phase_report(cells: DataFrame, sequences: DataFrame) -> DataFrame:
    rows = cell_phases(cells, sequences).orderBy("cell_barcode", "k")
    return rows.select(F.col("cell_barcode").alias("Barcode"), F.col("target").alias("Target"), F.col("mode").alias("Mode"), F.col("sequence_cluster_id").alias("Sequence_assignment"), F.col("call").alias("Call"), F.col("motif").alias("Motif"), F.col("repeat_count").alias("Repeat_count"), F.col("start").alias("Start"), F.col("end").alias("End"), F.col("direct_similarity").alias("Direct_similarity"), F.col("evidence").alias("Evidence"))


def reference_report(sequences: DataFrame, names: list[str]) -> DataFrame:
    order = F.array_position(F.array(*map(F.lit, names)), F.col("parent_target"))
    m, shown = F.col("m"), lambda c: F.concat(F.regexp_replace(c.cast("string"), r"\.0$", ""), F.lit("%"))
    rows = sequences.select("sequence_cluster_id", "core_sequence", order.alias("o"), F.regexp_extract("sequence_cluster_id", r"(\d+)$", 1).cast("long").alias("no"), F.posexplode("reference_matches").alias("k", "m")).orderBy("o", "no", "k")
    return rows.select(F.col("sequence_cluster_id").alias("sub-ARG_name"), m["subject"].alias("subject"), m["r1_start"].alias("read1_start"), m["r1_end"].alias("read1_end"), shown(m["r1_percent_identity"]).alias("read1_percent_identity"), m["r2_start"].alias("read2_start"), m["r2_end"].alias("read2_end"), shown(m["r2_percent_identity"]).alias("read2_percent_identity"), F.col("core_sequence.r1").alias("read1_seq"), F.col("core_sequence.r2").alias("read2_seq"))


def overview(spark: SparkSession, summary: dict) -> DataFrame:
    """(section, metric, value) of a run's record."""
    rows = [("reads", k, summary["read_qc"][k]) for k in ("raw_read_pairs", "passed_read_pairs", "filtered_read_pairs")]
    rows += [("reads", k, v) for k, v in summary["read_classification"].items()]
    rows += [("cells", k, v) for k, v in summary["barcode_funnel"].items()]
    rows += [("asvs", "final_asv_count", summary["asv_summary"]["final_asv_count"])]
    rows += [("targets", f"{t['target_name']}.positive_cells", t["final_positive_cells"]) for t in summary["target_filtering_summary"]]
    if phase := summary.get("phase_variation_summary"):
        rows += [("phase_variation", "cell_calls", phase["cell_calls"])] + [("phase_variation", f"calls.{k}", v) for k, v in phase["calls"].items()]
    return spark.createDataFrame(rows, "section string, metric string, value long")


def asv_target_fractions(cells: DataFrame, asvs: DataFrame, names: list[str], min_cells: int = 30, mask: float = 0.0) -> DataFrame:
    """(asv_id, taxonomy, one column a target): share of a well supported variant's cells that are positive; shares below mask become 0."""
    big = asvs.where(F.col("final_surviving_cell_count") >= min_cells).select("asv_id")
    own = cells.select("cell_barcode", F.col("asv.asv_id").alias("asv_id"), "taxonomy", "targets").join(big, "asv_id", "left_semi")
    ranks = F.col("taxonomy.ranks")
    path = F.concat_ws(" | ", *[F.concat(F.lit(f"{c} - "), F.coalesce(ranks[n], F.lit("None"))) for c, n in S.RANKS.items()])
    label = own.groupBy("asv_id", path.alias("taxonomy")).agg(F.count(F.lit(1)).alias("n"), F.min("cell_barcode").alias("first")).groupBy("asv_id").agg(F.min_by("taxonomy", F.struct(-F.col("n"), F.col("first"))).alias("taxonomy"))
    positive = lambda n: F.avg(F.exists("targets", lambda t: (t["target_name"] == n) & (t["filtered_read_count"] > 0)).cast("double"))
    shares = own.groupBy("asv_id").agg(*[positive(n).alias(n) for n in names])
    masked = [F.when(F.col(f"`{n}`") < mask, 0.0).otherwise(F.col(f"`{n}`")).alias(n) for n in names]
    return label.join(shares, "asv_id").select("asv_id", "taxonomy", *masked)


def legacy_export(cells: DataFrame, phases: DataFrame | None = None) -> DataFrame:
    """The flat JSON record of version 2.0; cells: candidates that reached the abundance filter, before it."""
    own = cells.where("final_filter.stage in ('final', 'asv_abundance')") if "final_filter" in cells.columns else cells
    ranks = F.col("taxonomy.ranks")
    path = F.concat_ws(" | ", *[F.concat(F.lit(f"{c} - "), F.coalesce(ranks[n], F.lit("None"))) for c, n in S.RANKS.items()])
    value = lambda t: F.when(t["assignment_type"] == "sequence_cluster", t["sequence_cluster_id"]).when(t["assignment_type"] == "sequence_unresolved", F.concat(t["target_name"], F.lit("_parent"))).otherwise(t["target_name"])
    found = F.transform(F.filter("targets", lambda t: t["filtered_read_count"] > 0), lambda t: F.struct(t["target_name"].alias("target"), value(t).alias("assignment")))
    if phases is not None:
        item = F.struct("k", F.struct("target", "mode", F.col("sequence_cluster_id").alias("sequence_assignment"), "call", "motif", "repeat_count", "start", "end", "direct_similarity", "evidence").alias("p"))
        own = own.join(phases.groupBy("cell_barcode").agg(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["p"]).alias("pv")), "cell_barcode", "left")
    pv = F.col("pv") if phases is not None else F.array().cast("array<string>")
    return own.select(
        F.lit("2.0").alias("schema_version"), "cell_barcode", F.struct(path.alias("lineage"), ranks.alias("ranks"), "taxonomy.confidence", "taxonomy.contamination").alias("taxonomy"),
        F.struct(F.col("asv.asv_id").alias("assignment"), "asv.status", F.col("asv.final_cell_asv_reads").alias("reads"), "asv.max_internal_distance").alias("asv"),
        F.struct(F.col("taxonomy_evidence.total_16s_reads"), "taxonomy_evidence.technical_noise_reads", F.col("asv.reads_used").alias("reads_used_for_asv")).alias("read_qc"),
        found.alias("targets"), pv.alias("phase_variation"))


def write_tables(folder: str, summary: dict, candidates: DataFrame, all_asvs: DataFrame, cells: DataFrame, asvs: DataFrame, sequences: DataFrame | None) -> None:
    """All result tables below a folder, JSON Lines each."""
    tables.write_json(cells.sparkSession, summary, f"{folder}/run_summary.json")
    for name, df in (("candidate_cells", candidates), ("candidate_asvs", all_asvs), ("cells", cells), ("asvs", asvs)):
        tables.write_jsonl(df, f"{folder}/{name}.jsonl")
    if sequences is not None:
        tables.write_jsonl(sequences, f"{folder}/target_sequences.jsonl", optional=("phase_variation", "reference_matches"))


def write_results(folder: str, summary: dict, candidates: DataFrame, all_asvs: DataFrame, cells: DataFrame, asvs: DataFrame, sequences: DataFrame | None) -> None:
    """write_tables() under a name that is the folder's only once all are whole."""
    with tables.Staged(cells.sparkSession, folder) as work:
        write_tables(work, summary, candidates, all_asvs, cells, asvs, sequences)
