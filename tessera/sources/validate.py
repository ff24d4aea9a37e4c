"""All input checks of a run in one call."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tessera.sources import fastq, tables
from tessera.sources.tables import VALID
from tessera.storage import release, scratch


def check_inputs(spark: SparkSession, r1: str, r2: str, primers: str, reference: str | None = None) -> str:
    """"Valid", or the first fault: of the primer file, then of the read files, then of the reference where there is one.

    A check runs only once all before it found nothing, as later ones depend on it.
    """
    with scratch():
        said = tables.check_panel(spark, primers)
        if said == VALID:
            pairs = fastq.read_pairs(spark, r1, r2, check=False)
            said = fastq.check_paired(pairs)
            release(pairs)
        if said == VALID and reference is not None:
            said = tables.check_fasta(spark, reference)
    return said
