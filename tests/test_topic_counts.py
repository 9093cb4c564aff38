"""Topics split a text once; the counts are those of Spark's own counter."""

from __future__ import annotations

from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import functions as F

from palate.operators import features, topics
from palate.operators.features import TermRules, TokenRules
from palate.sources import staging

RULES = TermRules(low=1, high=2, min_df=2, max_df=0.9, max_features=40, stop_words=["the"])
TEXTS = ["the red cup", "red cup red cup", "", "cup", "the the", "tea in the red cup", "Tea in a cup", "ÉTÉ tea", None, "other words here", "x"] * 3


def texts(spark):
    return spark.createDataFrame([(t,) for t in TEXTS], "t string").repartition(3)


def test_counts_are_those_of_sparks_counter(spark):
    rows = texts(spark).filter(F.col("t").isNotNull())
    listed = topics.topic_vocabulary(rows, "t", RULES)
    counter = CountVectorizerModel.from_vocabulary(listed, inputCol="terms", outputCol="features")
    plain = counter.transform(rows.select(RULES.terms(F.col("t")).alias("terms"))).select("features")
    tokens = rows.select(RULES.tokens(F.col("t")).alias("tokens"))
    found = features.count_vectors(tokens, "tokens", listed, RULES)
    assert found.schema == plain.schema or found.schema["features"].dataType == plain.schema["features"].dataType
    assert sorted(str(r[0]) for r in found.collect()) == sorted(str(r[0]) for r in plain.collect())
    assert topics.topic_vocabulary(tokens, "tokens", TokenRules(**vars(RULES))) == listed


def test_a_null_text_counts_nothing(spark):
    tokens = texts(spark).filter("t is null").select(RULES.tokens(F.col("t")).alias("tokens"))
    found = features.count_vectors(tokens, "tokens", ["cup", "red cup"], RULES).collect()
    assert [(r[0].size, r[0].numNonzeros()) for r in found] == [(2, 0)] * 3


def test_a_text_is_split_once(spark, monkeypatch):
    plans = {}

    def recorded(df, name, *rest):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return staging.stage(df, name, *rest)

    monkeypatch.setattr(topics, "stage", recorded)
    asked = []
    vocabulary = topics.vocabulary
    monkeypatch.setattr(topics, "vocabulary", lambda df, *rest: asked.append(df._jdf.queryExecution().optimizedPlan().toString()) or vocabulary(df, *rest))
    rows = texts(spark).filter(F.col("t").isNotNull())
    found = topics.fit_topics(rows, "t", RULES, topics=2, iterations=2, top=3)
    assert found.count() == 6
    assert "regexp_extract_all" in plans["topic_tokens"] and "regexp" not in plans["topic_counts"] and "regexp" not in asked[0]
