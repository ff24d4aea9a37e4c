"""Effective parameters of a run."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class ReadQC:
    min_length: int = 130
    min_mean_phred: int = 25
    barcode_length: int = 20
    min_barcode_bases: int = 15


@dataclass(frozen=True)
class Matching:
    max_shift: int = 4
    max_edits: int = 4
    r2_primer_start: int = 42
    r1_starts: tuple[int, ...] = tuple(range(10))


@dataclass(frozen=True)
class Cells:
    barcode_shift: int = 1
    min_16s_reads: int = 5  # strictly more are needed
    max_contamination: float = 0.1  # strictly less is needed
    min_cells_per_taxon: int = 10


@dataclass(frozen=True)
class Consensus:
    p_match: float = 0.90
    p_none: float = 0.09
    p_error: float = 0.01
    alpha: float = 1.0
    beta: float = 9.0
    min_confidence: float = 0.95
    min_noise_reads: int = 2
    noise_ratio: float = 0.05


@dataclass(frozen=True)
class Variants:
    max_distance: int = 3
    max_shift: int = 3
    min_reads: int = 5
    mixed_ratio: float = 0.10
    gate_ratio: float = 0.05
    r1: tuple[int, int] = (30, 120)
    r2: tuple[int, int] = (70, 120)
    conflict_cells: int = 10
    conflict_share: float = 0.99
    final_min_fraction: float = 0.005
    final_min_cells: int = 10


@dataclass(frozen=True)
class Targets:
    background_alpha: float = 0.05
    sequence_alpha: float = 0.05
    max_shift: int = 2
    max_mismatches: int = 0
    r1: tuple[int, int] = (30, 120)
    r2: tuple[int, int] = (70, 120)
    control: str = "meca"


@dataclass(frozen=True)
class Figures:
    min_cells: int = 30
    mask: float = 0.01


@dataclass(frozen=True)
class Params:
    """All parameters; the defaults are those of the published method."""

    read_qc: ReadQC = field(default_factory=ReadQC)
    matching: Matching = field(default_factory=Matching)
    cells: Cells = field(default_factory=Cells)
    consensus: Consensus = field(default_factory=Consensus)
    variants: Variants = field(default_factory=Variants)
    targets: Targets = field(default_factory=Targets)
    figures: Figures = field(default_factory=Figures)

    def table(self, spark: SparkSession) -> DataFrame:
        """One row: a struct a group."""
        from pyspark.sql import Row

        return spark.createDataFrame([Row(**{k: Row(**{n: list(v) if isinstance(v, tuple) else v for n, v in group.items()}) for k, group in asdict(self).items()})])
