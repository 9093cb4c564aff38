"""The detector's check stores its text and labels once, shuffles sums only, and a fit leaves no blocks behind."""

from __future__ import annotations

import os
import random

import numpy as np

from checks import fixture as fx
from checks import spark_queries
from palate.operators import aspects, linear, models
from palate.plans import training
from palate.sources import staging

WORDS = ["this", "with", "for", "that", "was", "from", "are", "in", "and", "coffee", "tea", "cup", "box", "late", "soon", "cold"]
RULES = models.TermRules(1, 2, 1, 1.0, 80)


def sentences(spark, n=300):
    rnd = random.Random(7)
    rows = [(f"s{i // 2}", f"r{i // 4}", " ".join(rnd.choice(WORDS) for _ in range(rnd.randint(1, 6)))) for i in range(n)]
    return spark.createDataFrame(rows, "sentence_id string, record_id string, sentence_text string").repartition(3)


def test_the_fit_is_stationary_where_sentence_ids_repeat(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(models, "MAX_STEPS", 100)
    monkeypatch.setattr(fx, "sentences", lambda *_: sentences(spark))
    names = list(fx.ASPECTS)
    train = spark_queries.sampling.group_split(aspects.weak_labels(sentences(spark), fx.ASPECTS), kind="md5").filter("development_split = 'train'")
    model = models.fit_aspects(train, names, rules=RULES)
    stored = spark.createDataFrame(
        [(a, float(b), i, float(w)) for a, b, ws in zip(names, model.intercepts, model.weights.T) for i, w in enumerate(ws)], "aspect string, intercept double, id int, w double"
    )
    monkeypatch.setattr(spark_queries, "_stored_detector", lambda *_: (model, stored))
    staged = {}

    def recorded(df, name, *rest, **more):
        staged[name] = df.columns
        return staging.stage(df, name, *rest, **more)

    monkeypatch.setattr(spark_queries, "stage", recorded)
    found = {r["aspect"]: r for r in spark_queries.detector_fit_is_stationary(spark, "").collect()}
    flags = [f"weak_{a}" for a in names]
    want = train.selectExpr("count(*) AS n", *[f"sum({f}) AS {f}" for f in flags]).first()
    assert {a: (r["n"], r["positives"]) for a, r in found.items()} == {a: (want["n"], want[f"weak_{a}"]) for a in names}
    assert all(r["stationary"] for r in found.values())
    assert staged["labelled"] == ["sentence_text", *flags] and "outcomes" not in staged

    shifted = models.AspectModel(model.features, model.aspects, model.weights + 0.5, model.intercepts)
    monkeypatch.setattr(spark_queries, "_stored_detector", lambda *_: (shifted, stored))
    assert not any(r["stationary"] for r in spark_queries.detector_fit_is_stationary(spark, "").collect())


def test_blocks_are_deleted_after_the_fit_and_sentences_after_the_run(spark, monkeypatch):
    before = staging.staged_count()
    made = []
    blocks_of = linear.blocks_of
    monkeypatch.setattr(linear, "blocks_of", lambda *a: made.append(blocks_of(*a)) or made[-1])
    rows = aspects.weak_labels(sentences(spark), fx.ASPECTS)
    model = models.fit_aspects(rows, list(fx.ASPECTS), rules=RULES)
    assert np.isfinite(model.weights).all() and len(made) == 1
    left = staging._staged[before:]
    assert left and not [p for p in left if "blocks" in p] and all(os.path.isdir(p) for p in left)

    kept = []

    def run(rows, *_, **__):
        kept.append((rows, staging.stage(rows, "copy")))

    def read(*_):
        return staging.stage(sentences(spark), "dedup")

    monkeypatch.setattr(training, "aspect_layer", run)
    monkeypatch.setattr(fx, "sentences", read)
    spark_queries.forget_runs()
    start = staging.staged_count()
    spark_queries._aspect_layer(spark, "somewhere")
    spark_queries.forget_runs()
    assert [os.path.basename(p).split("-")[0] for p in staging._staged[start:]] == ["copy"]
    assert kept[0][1].count() == 300
