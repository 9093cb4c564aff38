"""Gapless numbers within groups of any size, without sorting a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palate.llm.ordered import running
from palate.sources.staging import stage


def numbered(df: DataFrame, group: str, key: str, number: str, order: Sequence[str] = ()) -> DataFrame:
    """``df`` with ``number``: 0, 1, 2, … within each ``group``.

    Rows are numbered by a hash of the key, then the key, then the columns ``order``, in ranges that
    cut through any group and any key, also one that most rows share. Null groups and keys count as
    values like any other; rows equal in all of it are interchangeable. The frame is staged: pass
    narrow columns only.
    """
    rows = stage(df.withColumn("_numbered_row", F.monotonically_increasing_id()), "numbered")
    by = [F.xxhash64(F.col(key), F.lit("order")), F.col(key), *[F.col(c) for c in order], F.col("_numbered_row")]
    return running(rows, by, number, group=group).drop("_numbered_row")
