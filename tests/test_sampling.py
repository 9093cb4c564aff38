from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from palate.functions import keys
from palate.operators import sampling
from palate.operators.dedup import dedup_exact, first_per_group


def keyed(spark, n, groups=3):
    return spark.range(n).select(F.concat(F.lit("r"), "id").alias("record_id"), (F.col("id") % groups).cast("int").alias("label"))


def plain_split(df, kind):
    group = Window.partitionBy("label")
    rank = F.row_number().over(group.orderBy(keys.order_hash(F.col("record_id"), kind=kind), "record_id"))
    share = rank.cast("double") / F.count(F.lit(1)).over(group)
    return df.withColumn("dataset_split", F.when(share <= 0.8, "train").when(share <= 0.9, "validation").otherwise("test"))


@pytest.mark.parametrize("kind", ["xxhash64", "sha2"])
@pytest.mark.parametrize("n", [1, 7, 30, 5003])
def test_split_equals_the_plain_window(spark, kind, n):
    rows = keyed(spark, n)
    found = {tuple(r) for r in sampling.stratified_split(rows, "label", "record_id", kind=kind).collect()}
    assert found == {tuple(r) for r in plain_split(rows, kind).collect()}


@pytest.mark.parametrize(("n", "expected"), [(1, {"test": 1}), (10, {"train": 8, "validation": 1, "test": 1})])
def test_small_classes(spark, n, expected):
    split = sampling.stratified_split(keyed(spark, n, 1), "label", "record_id")
    assert Counter(r["dataset_split"] for r in split.collect()) == expected


def test_split_does_not_depend_on_partitions(spark):
    rows = keyed(spark, 999)
    one = sampling.stratified_split(rows.coalesce(1), "label", "record_id").collect()
    many = sampling.stratified_split(rows.repartition(13), "label", "record_id").collect()
    assert {tuple(r) for r in one} == {tuple(r) for r in many}


def test_split_is_exact_when_a_third_of_all_rows_share_a_key(spark):
    hot = spark.range(3000).select(
        F.when(F.col("id") < 1500, "hot").otherwise(F.concat(F.lit("r"), "id")).alias("record_id"),
        F.lit(1).alias("label"),
        F.concat(F.lit("text "), "id").alias("clean_text"),
    )
    split = sampling.stratified_split(hot, "label", "record_id", tie="clean_text").collect()
    assert Counter(r["dataset_split"] for r in split) == {"train": 2400, "validation": 300, "test": 300}
    again = sampling.stratified_split(hot.repartition(7), "label", "record_id", tie="clean_text").collect()
    assert {tuple(r) for r in split} == {tuple(r) for r in again}


def test_many_groups_use_the_window(spark, monkeypatch):
    monkeypatch.setattr(sampling, "MAX_CUT_GROUPS", 2)
    rows = keyed(spark, 200)
    found = {tuple(r) for r in sampling.stratified_split(rows, "label", "record_id").collect()}
    assert found == {tuple(r) for r in plain_split(rows, "xxhash64").collect()}


@pytest.mark.parametrize("quota", [999, 1000, 1001, 1500])
def test_quota_is_exact_when_keys_repeat(spark, quota):
    """On both sides of a thousand, over rows that share keys and rows that are equal throughout."""
    rows = spark.range(8000).select((F.col("id") % 20).cast("string").alias("k"), (F.col("id") % 40 >= 20).cast("int").alias("label"), (F.col("id") % 100).alias("x"))
    found = sampling.take_quota(rows, "label", {0: quota, 1: 7}, "k").collect()
    assert Counter(r["label"] for r in found) == {0: quota, 1: 7}
    again = sampling.take_quota(rows.repartition(5), "label", {0: quota, 1: 7}, "k").collect()
    assert Counter(map(tuple, found)) == Counter(map(tuple, again))


@pytest.mark.parametrize("groups", [1, 10_000])
def test_null_labels_are_a_class_like_any_other(spark, monkeypatch, groups):
    monkeypatch.setattr(sampling, "MAX_CUT_GROUPS", groups)
    rows = spark.range(1000).select(F.col("id").cast("string").alias("k"), F.when(F.col("id") % 2 == 0, 1).alias("label"))
    counts = Counter((r["label"], r["part"]) for r in sampling.stratified_split(rows, "label", "k", into="part").collect())
    assert counts == {(y, p): n for y in (1, None) for p, n in (("train", 400), ("validation", 50), ("test", 50))}
    assert Counter(r["label"] for r in sampling.take_quota(rows, "label", {None: 30, 1: 20}, "k").collect()) == {None: 30, 1: 20}


def counted(spark, df):
    """``df``, and a function that tells how often a row of it was made since it was last asked."""
    seen = spark.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    made = [0]

    def asked():
        made[0], since = seen.value, seen.value - made[0]
        return since

    return df.mapInArrow(run, df.schema), asked


def test_splits_and_quotas_evaluate_their_input_once(spark):
    rows, asked = counted(spark, keyed(spark, 600, 2))
    assert sampling.stratified_split(rows, "label", "record_id").count() == 600 and asked() == 600
    assert sampling.take_quota(rows, "label", {0: 100, 1: 50}, "record_id").count() == 150 and asked() == 600
    assert sampling.balance_train(rows, cap=120).count() == 240 and asked() == 600
    assert sampling.realistic_sample(rows, 0.78, 100, key="record_id").count() == 100 and asked() == 600
    assert sampling.balanced_sample(rows, "label", 20, [0, 1], "record_id").count() == 40 and asked() == 600
    split = sampling.stratified_split(rows, "label", "record_id").filter("dataset_split = 'train'")
    assert sampling.balance_train(split).count() == 480 and asked() == 600


def test_search_for_cuts_reads_no_other_columns(spark, monkeypatch):
    read = []
    locate = sampling._locate
    monkeypatch.setattr(sampling, "_locate", lambda rows, *rest: read.extend(rows.columns) or locate(rows, *rest))
    rows = keyed(spark, 50).withColumn("clean_text", F.lit("long text"))
    assert sampling.stratified_split(rows, "label", "record_id", tie="clean_text").count() == 50
    assert set(read) <= {"_by", *sampling.ORDER}


@pytest.mark.parametrize("quota", [100, 333, 999])
def test_rows_with_times_maps_and_repeats_give_exact_quotas(spark, quota):
    rows = spark.range(3000).select(
        (F.col("id") % 7).cast("string").alias("k"), (F.col("id") % 3).cast("int").alias("label"), F.current_timestamp().alias("at"), F.rand().alias("noise"),
        F.create_map(F.lit("m"), F.col("id")).alias("m"), F.array(F.create_map(F.lit(1), F.lit(2))).alias("deep"), F.parse_json(F.lit("[1]")).alias("v"), F.lit(None).cast("string").alias("odd.name"),
    )
    found = sampling.take_quota(rows, "label", {0: quota, 2: 5}, "k")
    assert found.columns == rows.columns and Counter(r["label"] for r in found.collect()) == {0: quota, 2: 5}
    shares = Counter((r["label"], r["dataset_split"]) for r in sampling.stratified_split(rows, "label", "k").collect())
    assert shares == {(g, p): n for g in range(3) for p, n in (("train", 800), ("validation", 100), ("test", 100))}


def test_equal_rows_are_cut_without_meeting_in_a_task(spark):
    rows = spark.range(900).select(F.lit("same").alias("k"), F.lit(1).alias("label"))
    split = sampling.stratified_split(rows, "label", "k")
    assert Counter(r["dataset_split"] for r in split.collect()) == {"train": 720, "validation": 90, "test": 90}
    assert "Window" not in split._jdf.queryExecution().executedPlan().toString()


def test_pool_is_what_the_sample_leaves(spark):
    rows = spark.range(1000).select(F.col("id").cast("string").alias("k"), F.when(F.col("id") % 3 < 2, (F.col("id") % 3).cast("int")).alias("label"))
    sample = sampling.stratified_sample(rows, "label", {0: 0.3, 1: 0.8}, "k")
    pool = sampling.pool_outside(rows, "label", {0: 0.3, 1: 0.8}, "k")
    assert pool.count() + sample.count() == 1000 and pool.join(sample, "k", "left_semi").isEmpty()


def test_hash_sample_counts_keys_and_not_rows(spark):
    rows = spark.range(20_000).select((F.col("id") % 2000).cast("string").alias("k"))
    assert 850 < sampling.hash_sample(rows, "k", 1000).count() <= 1000


def test_quota_takes_the_first_rows_by_hash(spark):
    rows = keyed(spark, 3000)
    found = sampling.take_quota(rows, "label", {0: 100, 1: 2000, 2: 0}, "record_id", seed=7).collect()
    assert Counter(r["label"] for r in found) == {0: 100, 1: 1000}
    rank = F.row_number().over(Window.partitionBy("label").orderBy(keys.order_hash(F.col("record_id"), seed=7)))
    expected = rows.withColumn("n", rank).filter("label = 0 and n <= 100 or label = 1").drop("n").collect()
    assert {tuple(r) for r in found} == {tuple(r) for r in expected}


def test_share_rank_equals_the_division():
    for total in range(1, 400):
        for share in (0.8, 0.9, 0.1, 0.3, 0.7):
            assert sampling.share_rank(share, total) == max([r for r in range(total + 1) if r / total <= share])


def test_balanced_sample_is_complete_or_fails(spark):
    rows = keyed(spark, 300)
    sample = sampling.balanced_sample(rows, "label", 20, [0, 1, 2], "record_id").collect()
    assert Counter(r["label"] for r in sample) == {0: 20, 1: 20, 2: 20}
    with pytest.raises(ValueError, match="3: 0"):
        sampling.balanced_sample(rows, "label", 20, [0, 3], "record_id")


def test_balance_train(spark):
    rows = keyed(spark, 100).filter("label = 0 or record_id like '%1'")
    counts = Counter(r["label"] for r in sampling.balance_train(rows, cap=50).collect())
    smallest = min(Counter(r["label"] for r in rows.collect()).values())
    assert set(counts.values()) == {smallest}


@pytest.mark.parametrize(
    ("p", "n", "quotas"), [(10_000, 10_000, {1: 6240, 0: 1760}), (10, 10, {1: 10, 0: 5}), (100, 3, {1: 80, 0: 3})]
)
def test_realistic_quotas(p, n, quotas):
    assert sampling.realistic_quotas(p, n) == quotas


def test_realistic_quotas_without_a_cap():
    assert sampling.realistic_quotas(100_000, 100_000, 0.8, None) == {1: 100_000, 0: 25_000}
    assert sampling.realistic_quotas(100_000, 10_000, 0.8, None) == {1: 40_000, 0: 10_000}


def test_group_split_keeps_groups_together(spark):
    rows = spark.range(2000).select((F.col("id") % 300).cast("string").alias("record_id"))
    split = sampling.group_split(rows)
    assert split.groupBy("record_id").agg(F.countDistinct("development_split").alias("n")).filter("n > 1").isEmpty()
    assert {r[0] for r in split.select("development_split").distinct().collect()} == {"train", "validation", "test"}


def test_hash_sample_is_capped_and_unique(spark):
    rows = spark.range(5000).select((F.col("id") % 4000).cast("string").alias("k"))
    sample = sampling.hash_sample(rows, "k", 500).collect()
    assert 350 < len(sample) <= 500 and len({r["k"] for r in sample}) == len(sample)
    small = spark.range(10).select(F.col("id").cast("string").alias("k"))
    assert sampling.hash_sample(small, "k", 500).count() == 10


def test_stratified_sample_and_pool_are_disjoint(spark):
    rows = keyed(spark, 1000, 2).withColumnRenamed("record_id", "row_id")
    sample = sampling.stratified_sample(rows, "label", {0: 1.5, 1: 0.2}, "row_id")
    counts = Counter(r["label"] for r in sample.collect())
    assert counts[0] == 500 and 60 < counts[1] < 140
    pool = sampling.holdout_pool(rows, sample)
    assert pool.count() + sample.count() == 1000 and pool.join(sample, "row_id", "left_semi").isEmpty()


def test_shuffle_is_repeatable(spark):
    rows = spark.range(100).select(F.col("id").cast("string").alias("k"))
    once = [r["k"] for r in sampling.shuffle(rows, "k").collect()]
    assert once == [r["k"] for r in sampling.shuffle(rows.repartition(5), "k").collect()] and once != sorted(once, key=int)


def test_dedup_of_a_hot_group_prunes_before_the_shuffle(spark, capsys):
    rows = spark.range(1000).select(F.when(F.col("id") >= 0, "same").alias("t"), F.col("id"))
    kept = first_per_group(rows, [F.col("t")], [F.col("id").desc()])
    assert [r["id"] for r in kept.collect()] == [999]
    kept.explain()
    plan = capsys.readouterr().out
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_dedup_exact_keeps_the_first_by_order(spark):
    rows = spark.createDataFrame([("u", "t", 2), ("u", "t", 1), ("u", "x", 3)], "u string, t string, id int")
    assert {r["id"] for r in dedup_exact(rows, ["u"], ["id"], text="t").collect()} == {1, 3}
