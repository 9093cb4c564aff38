"""Ranks over a whole table that no single task sorts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palate.sources.staging import stage


def ranked(df: DataFrame, *order: Column, into: str = "rank") -> DataFrame:
    """``df`` with its rank from 1 in the given total order.

    Rows are dealt to ranges of the order, as many as the session's shuffle partitions; each range
    is ranked by itself and shifted by the rows of the ranges before it.
    """
    placed = stage(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    before = Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    counts = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    shift = counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return placed.withColumn(into, inside).join(F.broadcast(shift), "_range").withColumn(into, (F.col(into) + F.col("_before")).cast("int")).drop("_range", "_before")


def ranked_within(df: DataFrame, group: str, *order: Column, into: str = "rank", total: str = "total") -> DataFrame:
    """``df`` with its rank from 1 within ``group`` in the given order, and the rows of the group.

    Ranges of (group, order) as in :func:`ranked`, so a group of any size is no single task.
    """
    placed = stage(df.repartitionByRange(F.col(group), *order).withColumn("_range", F.spark_partition_id()), "ranges")
    counts = placed.groupBy(group, "_range").agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(group)  # a row per group and range
    before = F.sum("_n").over(whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    shift = counts.select(group, "_range", F.coalesce(before, F.lit(0)).alias("_before"), F.sum("_n").over(whole).alias(total))
    inside = F.row_number().over(Window.partitionBy(group, "_range").orderBy(*order))
    return placed.withColumn(into, inside).join(shift, [group, "_range"]).withColumn(into, F.col(into) + F.col("_before")).drop("_range", "_before")
