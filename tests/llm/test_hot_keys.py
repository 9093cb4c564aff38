"""Keys that most rows share: no task gets them all, and results stay those of the definition."""

from __future__ import annotations

import collections
import os
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

pytest.importorskip("public_tokenizers")

from palate.llm import learned_partitions, numbering, ordered, packing, sharding  # noqa: E402


@pytest.fixture()
def ranges(spark, monkeypatch):
    """Rows per range of every running sum that a test makes."""
    seen = []
    keep = ordered.stage
    monkeypatch.setattr(ordered, "stage", lambda df, name: seen.append(keep(df, name)) or seen[-1])
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield lambda: [r["n"] for r in seen[-1].groupBy("_ordered_range").agg(F.count(F.lit(1)).alias("n")).collect()]
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("key", ["hot", None])
def test_one_key_of_most_rows_is_numbered_in_many_ranges(spark, ranges, key):
    df = spark.range(5_000).select(F.when(F.col("id") % 50 == 0, F.col("id").cast("string")).otherwise(F.lit(key)).alias("k"), F.lit("g").alias("g"), F.lit(1).alias("same"))
    got = numbering.numbered(df, "g", "k", "n", ["same"]).collect()
    assert sorted(r["n"] for r in got) == list(range(5_000))
    assert max(ranges()) < 1_500  # of 5,000 rows in 8 ranges
    places = [r["n"] for r in got if r["k"] == key]
    assert max(places) - min(places) == len(places) - 1  # equal keys are neighbours


def test_shards_and_buckets_of_a_hot_key(spark, ranges):
    df = spark.range(4_000).select(F.when(F.col("id") < 3_000, 7).otherwise(F.col("id")).alias("doc_id"))
    placed = sharding.sharded(df, "doc_id", [1.0] * 5).collect()
    assert max(ranges()) < 1_500
    slots = collections.defaultdict(list)
    for r in placed:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    lengths = df.select("doc_id", F.lit(10).alias("n_tokens"))
    packed = packing.packed(lengths, max_length=16, token_budget=64, buckets=3).collect()
    assert max(ranges()) < 1_500 and len(packed) == 4_000
    assert sorted((r["batch"], r["slot"]) for r in packed) == [(i // 6, i % 6) for i in range(4_000)]


def test_an_id_of_most_vectors_is_cut_into_blocks(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(1 if i % 3 else i, [float(x) for x in rng.standard_normal(6)]) for i in range(900)]
    rows += [(2_000, rows[0][1])] * 500  # one row, five hundred times
    monkeypatch.setattr(learned_partitions, "BLOCK", 64)
    monkeypatch.setattr(learned_partitions, "SAMPLE", 300)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got = collections.defaultdict(list)
    for r in learned_partitions.nearest(df, F.col("id") % 50 == 0).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    x = np.array([v for _, v in rows])
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    for i in range(0, 900, 150):  # ids that stand once
        near = sorted((-float(unit[i] @ unit[j]), rows[j][0]) for j in range(len(rows)) if rows[j][0] != i)[:5]
        assert [round(s, 9) for _, _, s in sorted(got[i])] == [round(-s, 9) for s, _ in near]
