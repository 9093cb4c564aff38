"""Model training on the finished layers, end to end."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palate.functions.polarity import PolarityRules
from palate.operators import aspects, metrics, models, quality, sampling, topics
from palate.operators.features import TermRules
from palate.sources.staging import scope, stage
from palate.sources.tables import write_layer, write_metrics, write_report

@dataclass(frozen=True)
class SentimentRun:
    """Measures of the candidates, the chosen model, all measures as ``(part, model, measure, value)``,
    and what the chosen model does on test rows: confusion, class report, worst errors."""

    results: DataFrame
    model: models.TextModel
    report: DataFrame
    confusion: DataFrame
    classes: DataFrame
    errors: DataFrame


def run_sentiment(model_input: DataFrame, path: str, **options) -> None:
    """Train, measure and store below ``path``; what was staged on the way is deleted."""
    with scope(model_input.sparkSession):
        write_sentiment_run(train_sentiment(model_input, **options), path)


def run_aspects(sentences: DataFrame, path: str, lexicon: aspects.Lexicon, polarity: PolarityRules, **options) -> None:
    """Fit, measure and apply the detector, store all below ``path``; what was staged is deleted."""
    with scope(sentences.sparkSession):
        write_aspect_run(aspect_layer(sentences, lexicon, polarity, **options), path)


def write_sentiment_run(run: SentimentRun, path: str) -> None:
    """The artifact and every report of a run below ``path``."""
    models.save_model(run.model, f"{path}/model")
    for name in ("results", "report", "classes", "errors"):
        write_report(getattr(run, name), f"{path}/{name}")
    metadata = run.confusion.withColumns({"model": F.lit(run.model.kind), "features": F.lit(run.model.features.size), "rules": F.lit(json.dumps(asdict(run.model.features.rules)))})
    write_metrics(metadata, f"{path}/metadata")


def _long_rows(part: str, model: str, measures: dict) -> list[tuple]:
    return [(part, model, k, float(v)) for k, v in measures.items() if not isinstance(v, str)]


def train_sentiment(model_input: DataFrame, rules: TermRules = models.SENTIMENT_RULES) -> SentimentRun:
    """Balance train only, without a cap, fit three candidates on its features, choose on validation by
    F1, then measure the chosen one once on test."""
    columns = ["record_id", "clean_text", "label", "dataset_split"]
    rows = quality.check_model_input(stage(quality.valid_model_rows(model_input).select(*columns), "model_rows"))

    def part(name: str) -> DataFrame:
        return rows.filter(F.col("dataset_split") == name)

    train = stage(sampling.balance_train(part("train"), cap=None), "train")
    results, fitted = models.compare_classifiers(train, part("validation"), rules)
    best = fitted[models.select_model(results).first()["model"]]
    outcome = stage(best.score(part("test"), "clean_text", ["record_id", "clean_text", "label"]), "outcome")
    final = metrics.evaluate(outcome, score="score_positive")
    report = [r for row in results.collect() for r in _long_rows("validation", row["model"], row.asDict())]
    report += _long_rows("test", best.kind, final)
    schema = "part string, model string, measure string, value double"
    errors = quality.error_review(outcome, "label", "prediction", "score_positive", "record_id")
    return SentimentRun(
        results, best, rows.sparkSession.createDataFrame(report, schema), metrics.confusion(outcome), metrics.class_report(outcome), errors
    )


def train_baseline(model_input: DataFrame, rules: TermRules = models.TRAINER_RULES, c: float = 1.0) -> DataFrame:
    """Class-weighted logistic regression on train rows; predictions for validation rows by
    the model as loaded back from storage."""
    rows = stage(quality.valid_model_rows(model_input), "model_rows")
    train = rows.filter(F.col("dataset_split") == "train")
    features = models.fit_tfidf(train, "clean_text", rules)
    vectors = stage(features.vectors(train, "clean_text", ["label"]), "train_vectors")
    model = models.TextModel(features, models.logistic_regression(vectors, c, balanced=True), "logistic_regression")
    loaded = models.round_trip(model, rows.sparkSession)
    held_out = rows.filter(F.col("dataset_split") == "validation")
    return loaded.score(held_out, "clean_text", ["record_id", "label"])


@dataclass(frozen=True)
class AspectRun:
    """Fitted detector, its ``(part, measure, value)`` report, predictions for every sentence, their
    summary and sentiment mix, and the topics of the corpus with the aspects they point to."""

    model: models.AspectModel
    report: DataFrame
    predictions: DataFrame
    summary: DataFrame
    mix: DataFrame
    topics: DataFrame | None = None


def write_aspect_run(run: AspectRun, path: str) -> None:
    """The artifact, the predictions and every report of a run below ``path``."""
    run.model.save(f"{path}/model")
    write_layer(run.predictions, f"{path}/predictions")
    for name in ("report", "summary", "mix", "topics"):
        if getattr(run, name) is not None:
            write_report(getattr(run, name), f"{path}/{name}")
    about = [(list(run.model.aspects), run.model.threshold, run.model.features.size, json.dumps(asdict(run.model.features.rules)))]
    schema = "aspects array<string>, threshold double, features int, rules string"
    write_metrics(run.report.sparkSession.createDataFrame(about, schema), f"{path}/metadata")


PREDICTION_CONTEXT = [
    "sentence_id", "record_id", "product_id", "score", "review_timestamp", "review_year",
    "helpfulness_numerator", "helpfulness_denominator", "helpfulness_ratio", "sentence_text",
]


def fit_sample(rows: DataFrame, key: str, max_rows: int) -> DataFrame:
    """A sample for trial fits, chosen once, stored, and dealt to all cores: a capped sample ends in one
    task, and every step of a fit would run there again. No plan here fits on a sample."""
    sample = sampling.hash_sample(rows, key, max_rows)
    return stage(sample.repartition(rows.sparkSession.sparkContext.defaultParallelism, key), "fit_rows")


def aspect_layer(
    sentences: DataFrame,
    lexicon: aspects.Lexicon,
    polarity: PolarityRules,
    rules: TermRules = models.ASPECT_RULES,
    topic_rules: TermRules | None = None,
    kind: str = "xxhash64",
) -> AspectRun:
    """Seed labels, split by review, fit a detector per aspect on all train sentences, measure it on
    all held-out sentences and apply it to every sentence. With ``topic_rules`` topics are fitted on
    all sentences too. ``kind`` is the hash of the split."""
    names = list(lexicon)
    known = sentences.select(*PREDICTION_CONTEXT)
    labelled = stage(sampling.group_split(aspects.weak_labels(known, lexicon), kind=kind).drop("seed_aspects"), "labelled", codec="zstd")
    aspects.check_aspect_support(labelled, names)

    def part(name: str) -> DataFrame:
        return labelled.filter(F.col("development_split") == name)

    model = models.fit_aspects(part("train"), names, rules=rules)
    report = []
    for name in ("validation", "test"):
        outcomes = stage(models.aspect_outcomes(model, part(name), names), f"outcomes_{name}")
        report += [(name, k, float(v)) for k, v in metrics.multilabel_metrics(outcomes).first().asDict().items()]
        for r in metrics.aspect_report(outcomes).collect():  # one row per aspect
            report += [(name, f"{r['aspect']} {k}", float(r[k])) for k in ("precision", "recall", "f1", "support")]
    scored = stage(models.predict_aspects(model, labelled, PREDICTION_CONTEXT, polarity=polarity), "predictions")
    found = topics.map_topics(topics.fit_topics(known, "sentence_text", topic_rules), lexicon) if topic_rules else None
    schema = "part string, measure string, value double"
    table = labelled.sparkSession.createDataFrame(report, schema)
    return AspectRun(model, table, scored, aspects.aspect_summary(scored), aspects.sentiment_mix(scored), found)
