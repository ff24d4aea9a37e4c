"""Cells: taxonomy consensus, stage-1 filter, taxon size filter, target counts and background."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.functions import seq as S
from tessera.functions import stats
from tessera.params import Cells, Consensus


def path_counts(packets: DataFrame) -> DataFrame:
    """(cell, path, n): 16S reads of a cell by path; aggregated before any cell's rows meet, so that a large cell is a few rows."""
    reads = packets.where("gene_class = '16s'").withColumn("path", F.struct(*[F.col("path")[c].alias(c) for c in S.RANKS]))
    return reads.groupBy("cell", "path").agg(F.count(F.lit(1)).alias("n"))


def consensus(counts: DataFrame, p: Consensus = Consensus()) -> DataFrame:
    """(cell, total_16s, noise, path, confidence, contamination) from path_counts()' rows.

    A chain of projections, a few for each rank, over the cell's own array.
    """
    cells = counts.groupBy("cell").agg(F.collect_list(F.struct("path", "n")).alias("paths"), F.sum("n").alias("total_16s"))
    out = cells.withColumn("_s", stats.consensus_start())
    for k in range(len(S.RANKS)):
        for name, column in stats.consensus_steps(k, p):
            out = out.withColumn(name, column)
    codes = list(S.RANKS)
    rank = F.greatest(F.col("_s.depth") - 1, F.lit(0))
    value = lambda path: F.element_at(F.array(*[path[c] for c in codes]), rank + 1)
    deep = F.transform("paths", lambda x: F.struct(value(x["path"]).alias("v"), x["n"].alias("n")))
    out = out.withColumn("_accepted", value(F.col("_s"))).withColumn("_deep", F.filter(deep, lambda x: x["v"].isNotNull()))
    out = out.withColumn("_names", F.transform(F.array_distinct(F.transform("_deep", lambda x: x["v"])), lambda v: F.struct(v.alias("v"), F.aggregate(F.filter("_deep", lambda x: x["v"] == v), F.lit(0).cast("long"), lambda t, x: t + x["n"]).alias("n"))))
    out = out.withColumn("_split", stats.noise_split(F.col("_names"), F.col("_accepted"), F.col("total_16s"), p))
    # a generator of one row: filters on these columns stay above it, where they don't repeat their expressions
    result = F.struct(
        F.col("_split.noise").alias("noise"), F.struct(*[F.col("_s")[c].alias(c) for c in codes]).alias("path"), F.col("_s.confidence").alias("confidence"),
        stats.contamination_mean(F.col("_split.contam"), F.col("_split.match"), F.col("_split.noise"), p).alias("contamination"))
    return out.select("cell", "total_16s", F.inline(F.array(result)))


def target_counts(packets: DataFrame) -> DataFrame:
    """(cell, target, n): target reads of a cell."""
    return packets.where("gene_class = 'target'").groupBy("cell", "target").agg(F.count(F.lit(1)).alias("n"))


def cell_order(packets: DataFrame) -> DataFrame:
    """(cell, ord): a cell's place by its dominant barcode."""
    return packets.where("barcode = cell").groupBy("cell").agg(F.min("barcode_ord").alias("ord"))


def stage1(cells: DataFrame, p: Cells = Cells()) -> DataFrame:
    """Cells with more than min_16s_reads 16S reads, less than max_contamination, and a rank below domain."""
    known = F.coalesce(*[F.col("path")[c] for c in list(S.RANKS)[1:]]).isNotNull()
    kept = cells.where((F.col("total_16s") > p.min_16s_reads) & (F.col("contamination") < p.max_contamination) & known)
    return kept.withColumn("path", S.species_complex(F.col("path")))


def taxon_size(cells: DataFrame, least: int) -> DataFrame:
    """Cells of lineages with at least `least` cells; 0 keeps all. The sizes are aggregated first and joined back."""
    if not least:
        return cells
    sizes = cells.groupBy(S.lineage(F.col("path")).alias("_lineage")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= least).select("_lineage")
    return cells.withColumn("_lineage", S.lineage(F.col("path"))).join(sizes, "_lineage", "left_semi").drop("_lineage")


def background(cells: DataFrame, counts: DataFrame, alpha: float = 0.05) -> DataFrame:
    """(cell, target, n, rate, p, filtered): Poisson test of each target count against its background.

    The rate of a cell is its 16S reads times the target's share over all cells; a count is
    kept where P(X >= count) is below alpha, else it becomes 0.  The sums are one row a
    target.
    """
    own = counts.join(cells.select("cell", "total_16s"), "cell")
    totals = own.groupBy("target").agg(F.sum("n").alias("_t"))
    whole = cells.agg(F.sum("total_16s").alias("_s"))
    # one row, and one a target of the panel
    rates = totals.join(F.broadcast(whole)).select("target", (F.col("_t") / F.col("_s")).alias("_r"))
    out = own.join(F.broadcast(rates), "target").withColumn("rate", F.col("total_16s") * F.col("_r"))
    out = out.withColumn("p", stats.poisson_tail(F.col("n"), F.col("rate")))
    return out.select("cell", "target", "n", "rate", "p", F.when(F.col("p") < alpha, F.col("n")).otherwise(F.lit(0)).cast("long").alias("filtered"))


def background_stats(filtered: DataFrame, names: list[str]) -> DataFrame:
    """(target, original, filtered_out, remaining, retention) for every target of the panel."""
    every = filtered.sparkSession.createDataFrame([(k, t) for k, t in enumerate(names)], "panel_index int, target string")
    counted = filtered.groupBy("target").agg(F.count_if(F.col("n") > 0).alias("original"), F.count_if(F.col("filtered") > 0).alias("remaining"))
    both = every.join(counted, "target", "left").fillna(0, ["original", "remaining"])
    return both.select("panel_index", "target", "original", (F.col("original") - F.col("remaining")).alias("filtered_out"), "remaining", F.when(F.col("original") > 0, F.col("remaining") / F.col("original") * 100).otherwise(0.0).alias("retention"))


def ratios(cells: DataFrame, counts: DataFrame) -> DataFrame:
    """(cell, target, ratio): target reads over target and 16S reads of positive cells."""
    return counts.where("n > 0").join(cells.select("cell", "total_16s"), "cell").select("cell", "target", (F.col("n") / (F.col("n") + F.col("total_16s"))).alias("ratio"))


def ratio_histogram(balance: DataFrame, low: float = 0.1, high: float = 1.0, bins: int = 100) -> DataFrame:
    """(target, bin, n): bin 1 begins at low; high itself is in the last bin, values below low in none."""
    bin_ = F.least(F.width_bucket("ratio", F.lit(low), F.lit(high), F.lit(bins)), F.lit(bins))
    return balance.where(F.col("ratio") >= low).groupBy("target", bin_.cast("long").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def lorenz(sizes: DataFrame, size: str = "size") -> DataFrame:
    """(size, groups, share): share of all reads in groups of up to that size.

    Groups are counted by size first; the running sum is over distinct sizes, a short table
    however many groups there are.
    """
    by_size = sizes.groupBy(F.col(size).alias("size")).agg(F.count(F.lit(1)).alias("groups"))
    run = W.orderBy("size").rowsBetween(W.unboundedPreceding, 0)
    whole = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    reads = F.col("size") * F.col("groups")
    return by_size.withColumn("share", F.sum(reads).over(run) / F.sum(reads).over(whole))


def group_sizes(packets: DataFrame) -> DataFrame:
    """(series, cell, size): reads of a cell, of 16S alone ("16s"), with targets ("classified"; both for cells that have 16S reads), and of every kind ("all")."""
    counted = packets.groupBy("cell").agg(F.count_if(F.col("gene_class") == "16s").alias("16s"), F.count_if(F.col("gene_class") == "target").alias("target"), F.count(F.lit(1)).alias("all"))
    own = counted.select("cell", F.when(F.col("16s") > 0, F.col("16s")).alias("16s"), F.when(F.col("16s") > 0, F.col("16s") + F.col("target")).alias("classified"), "all")
    return own.unpivot(["cell"], ["16s", "classified", "all"], "series", "size").where("size is not null")


def group_curves(sizes: DataFrame) -> DataFrame:
    """lorenz() of each series: (series, size, groups, share)."""
    by_size = sizes.groupBy("series", "size").agg(F.count(F.lit(1)).alias("groups"))
    whole = W.partitionBy("series")
    run = whole.orderBy("size").rowsBetween(W.unboundedPreceding, 0)
    reads = F.col("size") * F.col("groups")
    # distinct sizes of three series: a short table however many groups there are
    return by_size.withColumn("share", F.sum(reads).over(run) / F.sum(reads).over(whole))


def by_lineage(cells: DataFrame) -> DataFrame:
    """cells in the order of their lineages, then barcodes."""
    return cells.orderBy(S.lineage(F.col("path")), "cell")
