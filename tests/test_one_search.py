"""Steps that must not search, score or gather more often than once per row."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from checks import fixture as fx
from palate.operators import aspects, linear, models, sampling
from palate.plans import training


def sentences(spark, n=200):
    rows = [(f"s{i}", ["this was for that", "none here", "from it", "with this and for"][i % 4] + f" word{i % 9}") for i in range(n)]
    return spark.createDataFrame(rows, "sentence_id string, sentence_text string")


def test_sentences_are_searched_once_for_their_aspects(spark):
    rows = aspects.weak_labels(sentences(spark), fx.ASPECTS).select("sentence_id", "seed_aspects")
    found = aspects.sentence_aspects(rows)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(") == 1
    expected = sorted((r["sentence_id"], a) for r in rows.collect() for a in r["seed_aspects"])
    assert sorted((r["sentence_id"], r["aspect"]) for r in found.collect()) == expected


def test_lists_that_are_empty_or_null_or_hold_null(spark):
    rows = spark.createDataFrame([(1, ["a", None]), (2, []), (3, None), (4, ["b"])], "k int, seed_aspects array<string>")
    found = aspects.sentence_aspects(rows)
    assert found.columns == ["k", "aspect"]
    assert {tuple(r) for r in found.collect()} == {(1, None), (1, "a"), (4, "b")}


def test_one_sum_a_slice_reaches_the_driver(spark, monkeypatch):
    """However many tasks a pass has."""
    monkeypatch.setattr(linear, "SLICE", 8)
    monkeypatch.setattr(linear, "LANES", 3)
    rnd = np.random.default_rng(1)
    x, y = rnd.normal(size=(60, 20)), rnd.integers(0, 2, 60)
    from pyspark.ml.linalg import Vectors

    df = spark.createDataFrame([(Vectors.dense(v), int(t)) for v, t in zip(x, y)], ["features", "y"]).repartition(11)
    blocks = linear.blocks_of(df, ["y"], 20)
    gathered = []
    kept = type(df).toArrow
    monkeypatch.setattr(type(df), "toArrow", lambda self: gathered.append(kept(self)) or gathered[-1])
    assert linear.LANES < blocks.tasks or spark.sparkContext.defaultParallelism < 11
    point = rnd.normal(size=(21, 1))
    loss, gradient = linear.evaluate(blocks, linear.LOGISTIC, point, np.ones(1), np.ones(1))
    margin = (2 * y - 1) * (x @ point[:-1, 0] + point[-1, 0])
    slope = -(2 * y - 1) / (1 + np.exp(margin))
    assert [t.num_rows for t in gathered] == [-(-(21 + 1) // 8)]
    assert np.isclose(loss[0], np.logaddexp(0, -margin).sum()) and np.allclose(gradient[:, 0], [*(slope @ x), slope.sum()])


def test_the_fit_sample_is_dealt_to_all_cores(spark):
    rows = sentences(spark, 400)
    plain = sampling.hash_sample(rows, "sentence_id", 100)
    found = training.fit_sample(rows, "sentence_id", 100)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, plain.collect()))
    used = found.select(F.input_file_name().alias("f")).distinct().count()
    assert used > 1


def test_predictions_have_the_polarity_of_their_sentence(spark):
    rows = aspects.weak_labels(sentences(spark), fx.ASPECTS).drop("seed_aspects")
    model = models.fit_aspects(rows, list(fx.ASPECTS), rules=models.TermRules(1, 2, 1, 1.0, 50))
    keep = ["sentence_id", "sentence_text"]
    apart = aspects.sentence_polarity(models.predict_aspects(model, rows, keep), fx.POLARITY)
    found = models.predict_aspects(model, rows, keep, polarity=fx.POLARITY)
    assert found.columns == apart.columns
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, apart.collect())) and found.count() > 0


def test_topic_terms_are_those_of_the_counter_and_do_not_hang_on_the_tasks(spark):
    from pyspark.ml.feature import CountVectorizer

    from palate.operators import topics

    rows = sentences(spark, 300)
    rules = models.TermRules(1, 2, 10, 0.7, 500, stop_words=["none"])
    bags = rows.select(rules.terms(F.col("sentence_text")).alias("terms"))
    plain = CountVectorizer(inputCol="terms", outputCol="f", vocabSize=500, minDF=10, maxDF=0.7).fit(bags).vocabulary
    found = topics.topic_vocabulary(rows, "sentence_text", rules)
    assert sorted(found) == sorted(plain) and len(found) > 20
    assert topics.topic_vocabulary(rows.repartition(5), "sentence_text", rules) == found
