"""Barcode clustering: greedy by abundance, one shifted base apart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.storage import Log, scratch, stored

CLASS_ORDER = {"16s": 0, "target": 1, "unclassified": 2}


def read_order():
    """A read's place among all: 16S reads first, then targets, then the rest, each in file order."""
    rank = F.when(F.col("gene_class") == "16s", 0).when(F.col("gene_class") == "target", 1).otherwise(2)
    return F.struct(rank.alias("class"), F.col("read_index").alias("index"))


def barcode_counts(packets: DataFrame) -> DataFrame:
    """(barcode, n, first): reads of each barcode and the first one's place."""
    return packets.groupBy("barcode").agg(F.count(F.lit(1)).alias("n"), F.min(read_order()).alias("first"))


def shift_edges(counts: DataFrame, max_shift: int = 1) -> DataFrame:
    """(earlier, later) barcodes that match when shifted, earlier by (n desc, first).

    Each barcode emits what is left of it after dropping up to max_shift bases at either end;
    suffixes meet prefixes, an equi-join on the rest.  At most four barcodes times the
    shift's bases share a key, so no key is hot.
    """
    own = counts.select("barcode", F.struct((-F.col("n")).alias("n"), F.col("first").alias("first")).alias("ord"))
    tail = F.array(*[F.struct(F.lit(s).alias("s"), F.substring("barcode", F.lit(s + 1), F.length("barcode")).alias("k")) for s in range(1, max_shift + 1)])
    head = F.array(*[F.struct(F.lit(s).alias("s"), F.substring("barcode", F.lit(1), F.length("barcode") - s).alias("k")) for s in range(1, max_shift + 1)])
    a = own.select("barcode", "ord", F.explode(tail).alias("e")).select(F.col("barcode").alias("a"), F.col("ord").alias("ao"), "e.s", "e.k").where("k <> ''")
    b = own.select("barcode", "ord", F.explode(head).alias("e")).select(F.col("barcode").alias("b"), F.col("ord").alias("bo"), "e.s", "e.k").where("k <> ''")
    met = a.join(b, ["s", "k"]).where(F.col("a") != F.col("b"))
    before = F.col("ao") < F.col("bo")
    pick = lambda x, y: F.when(before, F.col(x)).otherwise(F.col(y))
    return met.select(pick("a", "b").alias("earlier"), pick("ao", "bo").alias("earlier_ord"), pick("b", "a").alias("later")).distinct()


def cluster(counts: DataFrame, max_shift: int = 1) -> DataFrame:
    """(barcode, cell): each barcode joins its earliest dominant neighbour, or is dominant itself.

    A barcode is dominant once all earlier neighbours are absorbed, absorbed once one of
    them is dominant: rounds settle the sequential definition without an order of
    processing.  Only barcodes with earlier neighbours take part.  What has one earlier
    neighbour left is the opposite of that one: a link, and links jump to their neighbour's
    neighbour, so that rounds grow with the logarithm of a chain.  The result is a table in
    the shared folder.
    """
    with scratch() as keep:
        return keep(stored(_clusters(counts, max_shift), "clusters"))


def _clusters(counts: DataFrame, max_shift: int) -> DataFrame:
    """cluster() as a plan over tables of the scratch() block around it."""
    edges = stored(shift_edges(counts, max_shift), "edges")
    settled = _settled(edges)
    owner = edges.join(settled.where("dominant").select(F.col("barcode").alias("earlier")), "earlier").join(settled.where("not dominant").select(F.col("barcode").alias("later")), "later").groupBy("later").agg(F.min_by("earlier", "earlier_ord").alias("cell"))
    return counts.select("barcode").join(owner.withColumnRenamed("later", "barcode"), "barcode", "left").select("barcode", F.coalesce("cell", "barcode").alias("cell"))


def _settled(edges: DataFrame) -> DataFrame:
    """(barcode, dominant) of all ends of edges (earlier, later).

    A round is one table of rows: what it settles, and links (barcode, ref, other), by which
    a barcode is what ref is, or the other.
    """
    schema = "barcode string, dominant boolean, ref string, other boolean"
    log = Log(edges.sparkSession, "settled", schema)
    ends, none = edges.select("earlier", "later"), [F.lit(None).cast("string").alias("ref"), F.lit(None).cast("boolean").alias("other")]
    later = ends.select(F.col("later").alias("barcode")).distinct()
    last = log.append(ends.select(F.col("earlier").alias("barcode")).distinct().join(later, "barcode", "left_anti").select("barcode", F.lit(True).alias("dominant"), *none))
    while not last.where("dominant is not null").isEmpty():
        settled = log.table().where("dominant is not null").select("barcode", "dominant")
        links = last.where("dominant is null").select("barcode", "ref", "other")
        further = links.select(F.col("barcode").alias("ref"), F.col("ref").alias("ref2"), F.col("other").alias("other2"))
        jumped = links.join(further, "ref", "left").select("barcode", F.coalesce("ref2", "ref").alias("ref"), (F.col("other") != F.coalesce("other2", F.lit(False))).alias("other"))
        asked = jumped.join(settled.withColumnRenamed("barcode", "ref"), "ref", "left").select("barcode", (F.col("dominant") != F.col("other")).alias("dominant"), "ref", "other")
        # what is neither settled nor a link, with what is known of its earlier neighbours
        done = settled.select(F.col("barcode").alias("later")).union(links.select("barcode"))
        told = ends.join(done, "later", "left_anti").join(settled.withColumnRenamed("barcode", "earlier"), "earlier", "left")
        unknown = F.col("dominant").isNull()
        each = told.groupBy("later").agg(F.bool_or(F.coalesce("dominant", F.lit(False))).alias("taken"), F.count_if(unknown).alias("left"), F.min(F.when(unknown, F.col("earlier"))).alias("ref"))
        own = F.when(F.col("taken"), F.lit(False)).when(F.col("left") == 0, F.lit(True))
        each = each.where("taken or left < 2").select(F.col("later").alias("barcode"), own.alias("dominant"), F.when(own.isNull(), F.col("ref")).alias("ref"), F.when(own.isNull(), F.lit(True)).alias("other"))
        last = log.append(asked.unionByName(each))
    return log.table().where("dominant is not null").select("barcode", "dominant")


def with_cells(packets: DataFrame, max_shift: int = 1) -> DataFrame:
    """packets with their cell and within: the order of a read among its cell's."""
    with scratch() as keep:
        counts = stored(barcode_counts(packets), "barcodes")
        cells = _clusters(counts, max_shift).join(counts, "barcode").select("barcode", "cell", F.struct((-F.col("n")).alias("n"), F.col("first")).alias("barcode_ord"))
        cells = keep(stored(cells, "cells"))
    return packets.join(cells, "barcode")
