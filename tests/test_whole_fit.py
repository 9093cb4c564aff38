"""Models are fitted on all rows of their train part, however many there are."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from palate.functions.polarity import PolarityRules
from palate.operators import models, sampling
from palate.plans import training


class Seen(Exception):
    """Ends a run once the fit has its rows."""


def test_the_detector_is_fitted_on_every_train_sentence(spark, monkeypatch):
    rows = [(f"s{i // 2}", f"r{i // 3}", "great taste" if i % 2 else "nothing here") for i in range(300)]
    sentences = spark.createDataFrame(rows, "sentence_id string, record_id string, sentence_text string")
    sentences = sentences.withColumns({c: F.lit(1) for c in training.PREDICTION_CONTEXT if c not in sentences.columns})

    def fitted(labelled, *_, **__):
        raise Seen(labelled.count())

    monkeypatch.setattr(models, "fit_aspects", fitted)
    with pytest.raises(Seen) as seen:
        training.aspect_layer(sentences, {"taste": ["taste"]}, PolarityRules({"great": 1.0}))
    assert seen.value.args == (sampling.group_split(sentences).filter("development_split = 'train'").count(),)


def test_only_the_smallest_class_bounds_the_rows_of_the_sentiment_fit(spark, monkeypatch):
    rows = [(f"r{i}", f"text {i}", i % 2, ("train", "validation", "test")[i % 3], 4 * (i % 2) + 1) for i in range(60)]
    model_input = spark.createDataFrame(rows, "record_id string, clean_text string, label int, dataset_split string, score int")
    monkeypatch.setattr(training.quality, "valid_model_rows", lambda df: df)
    monkeypatch.setattr(training.quality, "check_model_input", lambda df: df)

    def taken(df, by, quotas, *_):
        raise Seen(quotas({0: 90_000, 1: 200_000}))

    monkeypatch.setattr(sampling, "take_quota", taken)
    with pytest.raises(Seen) as seen:
        training.train_sentiment(model_input)
    assert seen.value.args == ({0: 90_000, 1: 90_000},)
