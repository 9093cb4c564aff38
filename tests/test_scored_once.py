"""A sentence is scored once, and a text is stored once, on the way to the aspect reports."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from checks import fixture as fx
from checks import spark_queries
from palate.functions import text
from palate.functions.polarity import PolarityRules, polarity
from palate.operators import aspects, dedup
from palate.plans import layers

WORDS = ["this", "With", "for", "THAT", "was", "from", "are", "in", "and", "to", "of", "by", "coffee", "ÉTÉ", "it's", "I", "42", "été!", "so?", "straße", "what??", "forty"]
SCHEMA = "sentence_id string, sentence_index int, sentence_text string"


def sentences(spark, n=400):
    rnd = random.Random(5)
    texts = [" ".join(rnd.choice(WORDS) for _ in range(rnd.randint(0, 9))) for _ in range(n)]
    return spark.createDataFrame([(f"s{i}", i, t) for i, t in enumerate([*texts, None])], SCHEMA).repartition(3)


@pytest.mark.parametrize("query", ["aspect_summary", "sentiment_mix"])
def test_a_sentence_is_scored_before_its_aspects_become_rows(spark, monkeypatch, query):
    monkeypatch.setattr(fx, "sentences", lambda *_: sentences(spark))
    found = getattr(spark_queries, query)(spark, "")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    explode, scoring = plan.index("Generate posexplode(seed_aspects"), [i for i in range(len(plan)) if plan.startswith("regexp_extract_all(", i)]
    assert len(scoring) == 1 and explode < scoring[0]

    rows = aspects.weak_labels(sentences(spark), fx.ASPECTS)
    apart = aspects.sentence_polarity(aspects.sentence_aspects(rows), fx.POLARITY)
    apart = apart.withColumn("aspect_probability", (F.col("sentence_index") * 37 % 101) / 100.0)
    plain = {r["aspect"]: r for r in getattr(aspects, query)(apart).collect()}
    got = found.collect()
    assert len(got) == len(plain) == len(fx.ASPECTS)
    for r in got:
        assert all(v == pytest.approx(plain[r["aspect"]][k], abs=1e-6) if isinstance(v, float) else v == plain[r["aspect"]][k] for k, v in r.asDict().items())


def test_only_sentences_with_an_aspect_are_scored(spark):
    rows = spark.createDataFrame([(1, "this", ["a", "b"]), (2, "this", []), (3, "this", None), (4, None, ["a"]), (5, "no", ["b", None])], "k int, sentence_text string, seed_aspects array<string>")
    found = sorted(((r["k"], r["aspect"] or "", r["polarity"] is None) for r in aspects.aspect_polarity(rows, fx.POLARITY).collect()))
    assert found == [(1, "a", False), (1, "b", False), (4, "a", True), (5, "", False), (5, "b", False)]


def test_many_and_few_words_and_odd_lists_score_alike(spark):
    rare = {f"rare{i}": 1.0 for i in range(60)}
    base = fx.POLARITY
    many = PolarityRules({**base.valence, **rare}, [*base.negators, *rare], base.boosters, [*base.contrast, "never"])
    odd = PolarityRules({**base.valence, "": 3.0}, ["", *base.negators], base.boosters, base.contrast)
    df = sentences(spark).select("sentence_id", *[F.expr(polarity("sentence_text", r)).alias(n) for n, r in (("a", base), ("b", many), ("c", odd))])
    for r in df.collect():
        assert r["a"] == r["b"] == r["c"], r


def test_blanks_and_breaks_are_found_as_before(spark):
    rnd = random.Random(7)
    texts = ["".join(rnd.choice(" \t\n\r.!?ab  é") for _ in range(rnd.randint(0, 12))) for _ in range(3_000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(
        text.collapse(F.col("t")).alias("c"), F.regexp_replace("t", r"\s{2,}|[^\S ]", " ").alias("c0"),
        text.split_sentences(F.col("t")).alias("s"), F.split("t", r"(?<=[.!?])\s+").alias("s0"),
    )
    assert all(r["c"] == r["c0"] and r["s"] == r["s0"] for r in df.collect())


def test_a_review_is_stored_with_one_text(spark, monkeypatch):
    names = list(layers.BRONZE_NAMES)
    rows = [[str(i), "p", "u", "n", "1", "2", "5", str(i % 2), "s", t] for i, t in enumerate(["Good one. Two", "good ONE. two", "GOOD one. two", "b", "", "  "])]
    bronze = layers.to_bronze(spark.createDataFrame(rows, names), F.lit("f"), F.lit(0).cast("timestamp"))
    stored, stage = [], dedup.stage
    monkeypatch.setattr(dedup, "stage", lambda df, name: stored.append(df.columns) or stage(df, name))
    whole = layers.to_silver(bronze, F.lit(0).cast("timestamp"))
    unread = ("review_text", "summary", "profile_name", "review_time_raw", "_source_file")
    narrow = layers.to_silver(bronze, F.lit(0).cast("timestamp"), leave_out=unread)
    assert "normalized_text" not in stored[0] and not {"normalized_text", *unread} & set(stored[1])
    assert narrow.columns == [c for c in whole.columns if c not in unread]
    assert sorted(narrow.collect()) == sorted(whole.select(*narrow.columns).collect())
    assert sorted((r["id"], r["normalized_text"]) for r in whole.collect()) == [(0, "good one. two"), (1, "good one. two"), (3, "b")]
