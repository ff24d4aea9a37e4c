"""Numbering rows through in an order, with no task that holds them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.storage import stored


def numbered(df: DataFrame, order: list[Column | str], no: str = "no") -> DataFrame:
    """df with each row's place from 1 in an order that leaves no ties.

    The order is a range sort.  The sorted table is stored with each row's partition and
    place there, so that the partitions' sizes, a row each, are all that is summed up in
    one place.
    """
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    rows = stored(df.orderBy(*order).select("*", F.spark_partition_id().alias("_part"), place.alias("_row")), "sorted")
    sizes = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # a row for each partition of the sort
    before = sizes.select("_part", (F.sum("_n").over(W.orderBy("_part")) - F.col("_n")).alias("_before"))
    return rows.join(F.broadcast(before), "_part").select(*df.columns, (F.col("_before") + F.col("_row") + 1).alias(no))


def numbered_in(df: DataFrame, group: str, order: list[Column | str], no: str = "no") -> DataFrame:
    """df with each row's place from 1 in its group; groups are few (a panel's targets), their rows needn't be."""
    rows = numbered(df, [group, *order], "_no")
    # a row for each group
    first = rows.groupBy(group).agg(F.min("_no").alias("_first"))
    return rows.join(F.broadcast(first), group).select(*df.columns, (F.col("_no") - F.col("_first") + 1).cast("int").alias(no))
