"""Frequent n-grams by buckets: the same vocabulary as counting all, with less to shuffle."""

from __future__ import annotations

import random

import pytest

from palate.operators import features
from palate.operators.features import TermRules


def docs(spark, n=400, words=300, seed=5):
    rnd = random.Random(seed)
    pool = [f"w{i}" for i in range(words)]
    weights = [1 / (i + 1) for i in range(words)]
    made = [(i, " ".join(rnd.choices(pool, weights, k=rnd.randint(0, 40)))) for i in range(n)] + [(n, None), (n + 1, ""), (n + 2, "w1 w1 w1 w2")]
    return spark.createDataFrame(made, "doc_id long, text string").repartition(4)


def plain(df, rules, n):
    kept = features.document_frequencies(df, "text", rules)
    least, most = features._as_documents(rules.min_df, n), features._as_documents(rules.max_df, n)
    rows = [(r["term"], r["df"], r["cf"]) for r in kept.collect() if least <= r["df"] <= most]
    return sorted(rows, key=lambda r: (-r[2], r[0]))[: rules.max_features]


@pytest.mark.parametrize("buckets", [64, 1 << 12, 1 << 18])
@pytest.mark.parametrize("rules", [TermRules(1, 2, 3, 0.5, 60), TermRules(2, 3, 1, 1.0, 25), TermRules(1, 2, 2, 1.0, 100_000), TermRules(1, 2, 0.05, 0.3, 10), TermRules(1, 2, 1, 1.0, 0)])
def test_vocabulary_is_that_of_counting_all(spark, monkeypatch, rules, buckets):
    monkeypatch.setattr(features.frequent_terms, "__defaults__", (buckets,))
    monkeypatch.setattr(features, "PRUNE_FROM", 0)
    df = docs(spark)
    n = df.count()
    got = sorted(((r["term"], r["df"], r["cf"]) for r in features.vocabulary(df, "text", n, rules).collect()), key=lambda r: (-r[2], r[0]))
    assert got == plain(df, rules, n)


def test_no_documents(spark, monkeypatch):
    monkeypatch.setattr(features, "PRUNE_FROM", 0)
    assert features.vocabulary(docs(spark).limit(0), "text", 0, TermRules(1, 2, 1, 1.0, 5)).count() == 0


def shuffled_bytes(spark, run) -> int:
    store = spark.sparkContext._jsc.sc().statusStore()
    known = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
    before = known.size()
    run()
    after = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
    return sum(after.apply(i).shuffleWriteBytes() for i in range(after.size() - before))


def test_less_is_shuffled(spark):
    df = docs(spark, 6_000, 20_000).repartition(8).cache()
    df.count()
    rules = TermRules(1, 2, 3, 0.9, 50)
    one = shuffled_bytes(spark, lambda: features.document_frequencies(df, "text", rules).count())
    features.frequent_terms.__defaults__ = (1 << 12,)
    try:
        two = shuffled_bytes(spark, lambda: features.frequent_terms(df, "text", rules, 3, 5_400).count())
    finally:
        features.frequent_terms.__defaults__ = (features.BUCKETS,)
    assert two * 4 < one, (two, one)
