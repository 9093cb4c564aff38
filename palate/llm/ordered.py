"""Running sums in a total order, over groups of any size, without sorting a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palate.sources.staging import stage


def running(df: DataFrame, order: Sequence[Column], into: str, value: str | None = None, group: str | None = None, total: str | None = None) -> DataFrame:
    """``df`` with ``into``: the sum of ``value`` (without one, the number of rows) over the rows of
    the same ``group`` that come before in ``order``; ``total`` names the sum over the whole group.

    Rows are dealt to ranges of (group, order), summed inside their range and shifted by the sums of
    the group's earlier ranges, of which there is one row per group and range. Add a column that
    tells equal rows apart where many rows may be equal in the order, else they share a range. The
    input is read twice (once to find the ranges) and staged: pass narrow rows that are staged already.
    """
    group_columns = [F.col(group)] if group else []
    placed = stage(df.repartitionByRange(*group_columns, *order).withColumn("_ordered_range", F.spark_partition_id()), "ordered")
    amount = F.col(value) if value else F.lit(1).cast("long")
    name = F.col(group) if group else F.lit("")
    sums = placed.groupBy(name.alias("_ordered_group"), F.col("_ordered_range").alias("_ordered_at")).agg(F.sum(amount).alias("_ordered_sum"))
    whole = Window.partitionBy("_ordered_group")
    earlier = whole.orderBy("_ordered_at").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sums.select("_ordered_group", "_ordered_at", F.coalesce(F.sum("_ordered_sum").over(earlier), F.lit(0)).alias("_ordered_before"), F.sum("_ordered_sum").over(whole).alias("_ordered_total"))
    inside = Window.partitionBy(*group_columns, "_ordered_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = placed.withColumn("_ordered_inside", F.coalesce(F.sum(amount).over(inside), F.lit(0)))
    found = summed.join(shifts, (F.col("_ordered_range") == F.col("_ordered_at")) & name.eqNullSafe(F.col("_ordered_group")))
    found = found.withColumn(into, (F.col("_ordered_before") + F.col("_ordered_inside")).cast("long"))
    if total:
        found = found.withColumn(total, F.col("_ordered_total").cast("long"))
    return found.drop("_ordered_range", "_ordered_at", "_ordered_group", "_ordered_before", "_ordered_inside", "_ordered_total")
