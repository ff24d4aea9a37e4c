"""The reports of a stored run: all of them, from its result folder alone."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.plans import results
from tessera.sources import tables
from tessera.sources.commit import Published
from tessera.storage import exists

TARGET_SUMMARY = "panel_index int, target_name string, original_positive_cells long, filtered_out_cells long, remaining_positive_cells long, asv_abundance_excluded_positive_cells long, final_positive_cells long, retention_percent double"


def load(spark: SparkSession, folder: str, published: bool = True) -> tuple[dict, DataFrame, DataFrame, DataFrame | None]:
    """A result folder's record, cells, variants and target sequences (None where the run has none).

    Of a published folder only the files that its manifest names are read.  Rows of another
    run than the record's are refused: reports never mix runs.
    """
    if published:
        whole = Published(spark, folder)
        record, read = whole.paths("run_summary.json"), whole.read_json
    else:
        record, read = f"{folder}/run_summary.json", lambda name, schema: tables.read_jsonl(spark, f"{folder}/{name}", schema) if exists(spark, f"{folder}/{name}") else None
    summary = json.loads(spark.read.text(record, wholetext=True).first()["value"])
    cells, asvs, sequences = read("cells.jsonl", results.CELL), read("asvs.jsonl", results.ASV_ROW), read("target_sequences.jsonl", results.SEQUENCE)
    for name, table in (("cells", cells), ("asvs", asvs), ("target_sequences", sequences)):
        if table is not None and not table.where(~F.col("run_id").eqNullSafe(summary["run_id"])).isEmpty():
            raise ValueError(f"{name}.jsonl has rows of another run than run_summary.json")
    return summary, cells, asvs, sequences


def build(spark: SparkSession, summary: dict, cells: DataFrame, asvs: DataFrame, sequences: DataFrame | None) -> dict[str, DataFrame]:
    """The reports by file name; those on phase variation and on the reference only where the run asked for them."""
    names = [t["target_name"] for t in summary["target_panel"]]
    rows = [(k, *(t[c] for c in ("target_name", "original_positive_cells", "filtered_out_cells", "remaining_positive_cells", "asv_abundance_excluded_positive_cells", "final_positive_cells", "retention_percent"))) for k, t in enumerate(summary["target_filtering_summary"])]
    out = {
        "summary.tsv": results.overview(spark, summary),
        "cell_target_matrix.tsv": results.cell_target_matrix(cells, names).orderBy("Predicted taxonomy", "Barcode"),
        "asv_summary.tsv": results.asv_report(asvs),
        "taxonomy_summary.tsv": results.taxonomy_report(cells),
        "target_summary.tsv": results.target_report(spark.createDataFrame(rows, TARGET_SUMMARY)),
    }
    phases = any(t["mode"] == "ssr" for t in summary["target_panel"])
    matches = summary["inputs"].get("reference_fasta") is not None
    if (phases or matches) and sequences is None:
        raise ValueError("the run's phase variation and reference reports need target_sequences.jsonl")
    if phases:
        out["cell_phase_variation.tsv"] = results.phase_report(cells, sequences)
    if matches:
        out["reference_matches.tsv"] = results.reference_report(sequences, names)
    return out


def write_reports(spark: SparkSession, folder: str, target: str, published: bool = True) -> list[str]:
    """Write every report of a result folder (of one that isn't published yet, if so told) below target, which must not be there yet; give their names. A report without rows has its header alone."""
    if exists(spark, target):
        raise FileExistsError(f"{target} is there already")
    found = build(spark, *load(spark, folder, published))
    for name, table in found.items():
        tables.write_tsv(table, f"{target}/{name}")
    return list(found)
