"""One command from read files to a result folder: python -m tessera.cli --help."""

from __future__ import annotations

import argparse
import contextlib
import sys
from dataclasses import replace

from pyspark.sql import SparkSession

from tessera import __version__
from tessera.functions.seq import FLAGS
from tessera.params import Params
from tessera.plans import reports, results, run
from tessera.sources import fastq, tables, validate
from tessera.storage import exists, listed, release, scratch


def parse_bool(text: str) -> bool:
    """An option's word, by the table that columns of flags are read by."""
    try:
        return FLAGS[text.strip().lower()]
    except KeyError:
        raise argparse.ArgumentTypeError(f"neither true nor false: {text}") from None


def parser() -> argparse.ArgumentParser:
    """The command's options; their names and defaults are fixed values of the interface."""
    out = argparse.ArgumentParser(prog="tessera", description="Single-cell targeted sequencing: from paired reads to cells, variants and targets.")
    files = {
        "-1 --r1": "first mates, FASTQ: a file, a folder of files or a pattern; plain, BGZF or gzip", "-2 --r2": "their second mates, in the same order", "-p --primers": "primer panel, CSV",
        "--classified": "a classifier's label of each 16S read", "--report": "the classifier's report, which has its taxa", "-o --output": "result folder; it must not be there yet"}
    for names, what in files.items():
        out.add_argument(*names.split(), required=True, help=what)
    out.add_argument("--version", action="version", version=f"tessera {__version__}")
    out.add_argument("-r", "--reference", help="FASTA to look target sequences up in")
    out.add_argument("-@", "--threads", type=int, default=0, help="threads of a local session; by default the session is what spark-submit says")
    out.add_argument("--min-cells-per-taxon", type=int, default=10, help="taxa with fewer cells are left out; with 0 none is")
    switches = {"--reconstruct-all": (False, "sequences of all targets are reconstructed, not only of ssr ones"), "--reports": (True, "reports are written beside the results"), "--keep-tmp": (False, "tables between the steps stay in the shared folder")}
    for name, (usual, what) in switches.items():
        out.add_argument(name, type=parse_bool, default=usual, metavar="BOOL", help=f"whether {what}; by default {str(usual).lower()}")
    return out


def found(spark: SparkSession, path: str) -> bool:
    """Whether a file, a folder or a pattern names any file."""
    try:
        return bool(listed(spark, path))
    except FileNotFoundError:
        return False


def guard(spark: SparkSession, args: argparse.Namespace) -> str | None:
    """All that is wrong with the arguments at once, before any work is done; where nothing is, the first fault in the files."""
    named = {"R1": args.r1, "R2": args.r2, "primers": args.primers, "classified": args.classified, "report": args.report, "reference": args.reference}
    faults = [f"no such file for {what}: {path}" for what, path in named.items() if path is not None and not found(spark, path)]
    faults += [f"{option} can't be negative" for option, value in (("--min-cells-per-taxon", args.min_cells_per_taxon), ("--threads", args.threads)) if value < 0]
    if exists(spark, args.output):
        faults.append(f"the result folder is there already: {args.output}")
    if faults:
        return "; ".join(faults)
    said = validate.check_inputs(spark, args.r1, args.r2, args.primers, args.reference)
    return None if said == tables.VALID else said


def work(spark: SparkSession, args: argparse.Namespace, params: Params = Params()) -> dict:
    """Run, check the results, and publish them with their reports; gives the run's record. Tables between the steps go, unless they are to stay."""
    with contextlib.nullcontext() if args.keep_tmp else scratch():
        return _published(spark, args, replace(params, cells=replace(params.cells, min_cells_per_taxon=args.min_cells_per_taxon)))


def _published(spark: SparkSession, args: argparse.Namespace, params: Params) -> dict:
    pairs, panel = fastq.read_pairs(spark, args.r1, args.r2), tables.read_panel(spark, args.primers)
    labels, taxa = tables.read_classified(spark, args.classified), tables.read_taxa(spark, args.report)
    reference = tables.read_fasta(spark, args.reference) if args.reference else None
    inputs = {"r1_fastq": args.r1, "r2_fastq": args.r2, "primer_csv": args.primers, "reference_fasta": args.reference}
    done = run.run(pairs, panel, labels, taxa, params, args.reconstruct_all, reference, {"name": "tessera", "version": __version__}, inputs)
    names = [t["target_name"] for t in done.summary["target_panel"]]
    faults = done.problems(spark, names, params)
    if faults:
        raise ValueError("the results contradict one another: " + "; ".join(faults[:10]))
    with tables.Staged(spark, args.output) as folder:
        results.write_tables(folder, done.summary, done.candidates, done.all_asvs, done.cells, done.asvs, done.sequences)
        if args.reports:
            reports.write_reports(spark, folder, f"{folder}/reports", published=False)
    if not args.keep_tmp:
        release(pairs)  # files that were written anew
    return done.summary


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    own = parser()
    args = own.parse_args(argv)
    if spark is None:
        builder = SparkSession.builder.appName("tessera")
        spark = (builder.master(f"local[{args.threads}]") if args.threads > 0 else builder).getOrCreate()
    fault = guard(spark, args)
    if fault:
        own.error(fault)
    work(spark, args)
    print(f"done: {args.output}", file=sys.stderr)


if __name__ == "__main__":
    main()
