"""Shards by rendezvous hashing of stable record keys.

Every (key, shard) pair has a pseudo-random number u in (0, 1); a record goes to the shard with
the largest ``-weight / ln(u)``. So a shard's share of the keys follows its weight, and a new
shard takes records only into itself: for all other shards nothing changed.

Only keys move: a record is numbered within its shard by ranges of a hash order, so no task ever
sorts a whole shard, nor all rows of one key. Rows with equal keys share a shard and get
neighbouring slots. A null key is a key like any other. A shard of weight 0 gets nothing; at
least one weight must be positive. Columns of the input other than those named pass through.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palate.llm.numbering import numbered

def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """Index of the shard of ``key`` among shards with these weights; ties go to the smaller."""
    if not any(w > 0 for w in weights):
        raise ValueError("a shard with a positive weight is needed")
    listed = F.array(*[F.struct(F.lit(i).alias("shard"), F.lit(float(w)).alias("weight")) for i, w in enumerate(weights) if w > 0])

    def rank(s: Column) -> Column:
        u = (F.shiftrightunsigned(F.xxhash64(key, s["shard"]), 12) + F.lit(0.5)) / F.lit(2.0**52)
        return F.struct((-s["weight"] / F.ln(u)).alias("score"), (-s["shard"]).alias("order"))

    return -F.array_max(F.transform(listed, rank))["order"]


def sharded(df: DataFrame, key: str, weights: Sequence[float], shard: str = "shard", slot: str = "slot", order: Sequence[str] = ()) -> DataFrame:
    """``df`` with its shard and a gapless number from 0 within the shard (order: hash of the
    key, then the key, then the columns ``order``). The frame is staged once; name narrow columns only."""
    return numbered(df.withColumn(shard, shard_of(F.col(key), weights)), shard, key, slot, order)
