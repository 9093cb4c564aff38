"""Distributed classifiers over TF-IDF features, their comparison, storage and scoring."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    LinearSVC,
    LinearSVCModel,
    LogisticRegression,
    LogisticRegressionModel,
    NaiveBayes,
    NaiveBayesModel,
)
from pyspark.ml.common import _py2java
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer, StopWordsRemover
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palate.functions import labels
from palate.functions.polarity import PolarityRules
from palate.functions.polarity import polarity as polarity_of
from palate.functions.text import review_sentences
from palate.operators import aspects, linear, metrics
from palate.operators.features import TermRules, Tfidf, class_weights, fit_tfidf
from palate.sources.staging import scope, stage, staging_path

# Buckets of the hashed features, and settings of the research models.
HASH_BUCKETS = 1 << 16
RESEARCH_ITERATIONS, RESEARCH_PENALTY = 50, 0.01
TOLERANCE = 1e-4

#: Largest entry of the gradient at which the joint solver stops.
LINEAR_TOLERANCE = 1e-4

#: Steps of the quasi-Newton solvers; each is one pass over the stored feature rows.
MAX_STEPS = 100

# Feature rules of the sentiment and the aspect model.
SENTIMENT_RULES = TermRules(low=1, high=2, min_df=3, max_df=0.98, max_features=100_000, accents=False)
TRAINER_RULES = TermRules(low=1, high=2, min_df=2, max_features=50_000)
ASPECT_RULES = TermRules(low=1, high=2, min_df=3, max_df=0.98, max_features=80_000, accents=False)

_CLASSIFIER_MODELS = {
    "logistic_regression": LogisticRegressionModel,
    "linear_svm": LinearSVCModel,
    "naive_bayes": NaiveBayesModel,
}


def hashing_stages(idf: bool = True, stop_words: list[str] | None = None) -> list:
    """Blank tokens, stop words out (English ones without a list), hashed counts and, if asked, IDF."""
    stages = [
        RegexTokenizer(inputCol="clean_text", outputCol="words", pattern="\\s+", minTokenLength=2),
        StopWordsRemover(inputCol="words", outputCol="filtered", **({"stopWords": stop_words} if stop_words else {})),
        HashingTF(inputCol="filtered", outputCol="tf", numFeatures=HASH_BUCKETS),
    ]
    return [*stages, IDF(inputCol="tf", outputCol="features")] if idf else stages


def hashed_tf(df: DataFrame, stop_words: list[str] | None = None) -> DataFrame:
    return PipelineModel(hashing_stages(idf=False, stop_words=stop_words)).transform(df)


def research_pipelines() -> dict[str, Pipeline]:
    """Three pipelines on hashed features; naive Bayes takes counts, the others TF-IDF."""
    options = {"maxIter": RESEARCH_ITERATIONS, "regParam": RESEARCH_PENALTY}
    return {
        "logistic_regression": Pipeline(stages=[*hashing_stages(), LogisticRegression(**options)]),
        "linear_svm": Pipeline(stages=[*hashing_stages(), LinearSVC(**options)]),
        "naive_bayes": Pipeline(stages=[*hashing_stages(idf=False), NaiveBayes(featuresCol="tf", modelType="multinomial")]),
    }


def positive_score(df: DataFrame) -> Column:
    """Probability of the positive class, or the margin of a model without probabilities."""
    column = "probability" if "probability" in df.columns else "rawPrediction"
    return vector_to_array(F.col(column))[1]


def scored(model, df: DataFrame) -> DataFrame:
    predicted = model.transform(df)
    return predicted.withColumns({"score_positive": positive_score(predicted), "prediction": F.col("prediction").cast("int")})


def compare_models(pipelines: dict[str, Pipeline], train: DataFrame, tests: dict[str, DataFrame]) -> tuple[DataFrame, dict]:
    """Fit every pipeline on ``train``; one row of measures per model and test set."""
    fitted, rows = {}, []
    train = stage(train, "train")
    tests = {tag: stage(test, tag) for tag, test in tests.items()}
    for name, pipeline in pipelines.items():
        fitted[name] = bare(pipeline.fit(train), train.sparkSession)
        for tag, test in tests.items():
            measures = metrics.evaluate(scored(fitted[name], test), score="score_positive")
            rows.append({"model": name, "test_set": tag, **measures})
    return train.sparkSession.createDataFrame([_floats(r) for r in rows]), fitted


def _floats(row: dict) -> dict:
    return {k: v if isinstance(v, str) else float(v) for k, v in row.items()}


def select_model(results: DataFrame) -> DataFrame:
    """The model with the best F1, then average precision, then name."""
    key = F.struct((-F.col("f1")).alias("a"), (-F.col("average_precision")).alias("b"), "model")
    return results.agg(F.min(key).alias("k")).select(
        F.col("k.model").alias("model"), (-F.col("k.a")).alias("f1"), (-F.col("k.b")).alias("average_precision")
    )


def bare(model, spark: SparkSession):
    """The model as stored: without its training summary, which holds the session and the
    training frame and would travel to every task with the model."""
    path = staging_path(spark, "fitted")
    model.write().overwrite().save(path)
    return type(model).load(path)


def logistic_regression(rows: DataFrame, c: float = 1.0, balanced: bool = False, label: str = "label", iterations: int | None = None):
    """Fit with inverse penalty ``c``. With ``balanced``, each class weighs the same in all."""
    if balanced:
        weights = {r[label]: r["weight"] for r in class_weights(rows, label).collect()}
        weight = F.when(F.col(label) == 1, weights.get(1, 1.0)).otherwise(weights.get(0, 1.0))
        rows = rows.withColumn("_weight", weight)
    total = rows.agg(F.sum("_weight") if balanced else F.count(F.lit(1))).first()[0]
    estimator = LogisticRegression(
        labelCol=label, regParam=1.0 / (c * total), standardization=False, maxIter=iterations or MAX_STEPS, tol=TOLERANCE,
        **({"weightCol": "_weight"} if balanced else {}),
    )
    return bare(estimator.fit(rows), rows.sparkSession)


def linear_svm(rows: DataFrame, c: float = 1.0, label: str = "label", tolerance: float = TOLERANCE) -> LinearSVCModel:
    """Support vector machine with the squared hinge loss, intercept penalised like a weight. Spark's
    own estimator has the plain hinge; its model class takes the fitted plane."""
    width = F.max(F.coalesce(F.col("features.size"), F.size("features.values")))
    size = rows.select(F.unwrap_udt("features").alias("features")).agg(width).first()[0] or 0
    fitted = linear.fit_linear(linear.blocks_of(rows, [label], size), linear.SQUARED_HINGE, c, penalise_intercept=True, tolerance=tolerance, steps=MAX_STEPS)
    jvm = rows.sparkSession._jvm
    plane = _py2java(rows.sparkSession.sparkContext, Vectors.dense(fitted.weights[:, 0]))
    return LinearSVCModel(jvm.org.apache.spark.ml.classification.LinearSVCModel(f"linear_svm_{uuid.uuid4().hex[:12]}", plane, float(fitted.intercepts[0])))


def naive_bayes(rows: DataFrame, smoothing: float = 1.0, label: str = "label"):
    return NaiveBayes(labelCol=label, smoothing=smoothing, modelType="multinomial").fit(rows)


@dataclass(frozen=True)
class TextModel:
    """Features and classifier as one artifact: scoring repeats the training features."""

    features: Tfidf
    classifier: object
    kind: str

    def score(self, df: DataFrame, text: str, keep: list[str]) -> DataFrame:
        """``keep`` columns with prediction and positive score. Narrow."""
        vectors = self.features.vectors(df, text, keep)
        return scored(self.classifier, vectors).select(*keep, "prediction", "score_positive")

    def save(self, path: str) -> None:
        self.features.save(f"{path}/features")
        self.classifier.write().overwrite().save(f"{path}/{self.kind}")
        self.features.terms.sparkSession.createDataFrame([(self.kind,)], "value string").write.mode("overwrite").text(f"{path}/kind")

    @staticmethod
    def load(spark: SparkSession, path: str) -> TextModel:
        kind = spark.read.text(f"{path}/kind").first()["value"]
        return TextModel(Tfidf.load(spark, f"{path}/features"), _CLASSIFIER_MODELS[kind].load(f"{path}/{kind}"), kind)


def save_model(model: TextModel, path: str) -> None:
    model.save(path)


def load_model(spark: SparkSession, path: str) -> TextModel:
    """The stored model; its kind is part of the artifact."""
    return TextModel.load(spark, path)


def classifier_fits() -> dict:
    """The three candidates of the sentiment comparison."""
    return {
        "logistic_regression": lambda rows: logistic_regression(rows, c=1.0),
        "linear_svm": lambda rows: linear_svm(rows, c=1.0),
        "naive_bayes": lambda rows: naive_bayes(rows, smoothing=1.0),
    }


def compare_classifiers(
    train: DataFrame, validation: DataFrame, rules: TermRules = SENTIMENT_RULES, text: str = "clean_text"
) -> tuple[DataFrame, dict[str, TextModel]]:
    """Features fitted on ``train`` once, every candidate measured on ``validation``."""
    features = fit_tfidf(train, text, rules)
    fit_rows = stage(features.vectors(train, text, ["label"]), "train_vectors")
    test_rows = stage(features.vectors(validation, text, ["label"]), "validation_vectors")
    models, rows = {}, []
    for name, fit in classifier_fits().items():
        models[name] = TextModel(features, fit(fit_rows), name)
        measures = metrics.evaluate(scored(models[name].classifier, test_rows), score="score_positive")
        rows.append(_floats({"model": name, **measures}))
    return train.sparkSession.createDataFrame(rows), models


BAD_REQUEST = 'expected JSON such as {"texts": ["great product"]}'


def request_texts(body: Column) -> Column:
    """Texts of a JSON request, ``{"texts": [...]}`` or ``[...]``; null if it is neither, or holds
    anything but strings."""
    parsed = F.try_parse_json(body)
    inner = F.when(F.schema_of_variant(parsed).startswith("OBJECT"), F.try_variant_get(parsed, "$.texts", "variant")).otherwise(parsed)
    texts = F.try_variant_get(inner, "$", "array<string>")
    strings = F.schema_of_variant(inner).isin("ARRAY<STRING>", "ARRAY<VOID>")
    return F.when(strings & F.forall(texts, lambda t: t.isNotNull()), texts)


def parse_requests(df: DataFrame, body: str = "body") -> DataFrame:
    """Texts of JSON requests with their position; requests without texts give no row."""
    return df.select("*", F.posexplode(request_texts(F.col(body))).alias("position", "text")).drop(body)


def score_json(model: TextModel, df: DataFrame, key: str, body: str = "body") -> DataFrame:
    """One JSON answer per request: predictions and positive probabilities in text order, empty
    lists for an empty request, an error for a body that is not a request.

    Requests are numbered when they are stored, so two with one key get two answers.
    """
    texts = request_texts(F.col(body))
    asked = stage(df.select(F.col(key).alias("_key"), texts.alias("_texts")).withColumn("_request", F.monotonically_increasing_id()), "requests")
    rows = asked.select("_request", F.posexplode("_texts").alias("position", "text"))
    answers = model.score(rows, "text", ["_request", "position"])
    ordered = F.sort_array(F.collect_list(F.struct("position", "prediction", "score_positive")))
    given = answers.groupBy("_request").agg(ordered.alias("a"))
    none = F.array().cast("array<struct<position:int,prediction:int,score_positive:double>>")
    found = asked.select("_key", "_request", F.col("_texts").isNull().alias("_bad")).join(given, "_request", "left").withColumn("a", F.coalesce("a", none))
    good = F.to_json(F.struct(F.col("a.prediction").alias("predictions"), F.col("a.score_positive").alias("positive_probabilities")))
    bad = F.to_json(F.struct(F.lit(BAD_REQUEST).alias("error")))
    return found.select(F.col("_key").alias(key), F.when(F.col("_bad"), bad).otherwise(good).alias("answer"))


@dataclass(frozen=True)
class AspectModel:
    """A logistic classifier per aspect over shared features, all as one matrix."""

    features: Tfidf
    aspects: tuple[str, ...]
    weights: np.ndarray
    intercepts: np.ndarray
    threshold: float = 0.50
    passes: int = 0

    def probabilities(self, df: DataFrame, text: str, keep: list[str]) -> DataFrame:
        """``keep`` columns and ``detected``: ``(aspect, probability)`` for all aspects. Narrow: terms,
        features and all classifiers in one pass over Arrow batches."""
        names, k = self.aspects, len(self.aspects)
        shared = df.sparkSession.sparkContext.broadcast((self.weights, self.intercepts))
        pair = T.StructType([T.StructField("aspect", T.StringType(), False), T.StructField("probability", T.DoubleType())])

        def detect(starts: np.ndarray, index: np.ndarray, weight: np.ndarray) -> list[pa.Array]:
            found = linear.probabilities(starts, index, weight, *shared.value)
            pairs = pa.StructArray.from_arrays([pa.array(list(names) * len(found), pa.string()), pa.array(found.ravel())], ["aspect", "probability"])
            return [pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1, dtype=np.int32) * k), pairs)]

        return self.features.mapped(df, text, keep, [T.StructField("detected", T.ArrayType(pair))], detect)

    def save(self, path: str) -> None:
        """Features, weights, aspects and threshold: the stored model needs nothing else to be loaded."""
        self.features.save(f"{path}/features")
        rows = [(i, a, float(self.threshold), float(b), w.tolist()) for i, (a, b, w) in enumerate(zip(self.aspects, self.intercepts, self.weights.T))]
        schema = "position int, aspect string, threshold double, intercept double, weights array<double>"
        self.features.terms.sparkSession.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{path}/aspects")

    @staticmethod
    def load(spark: SparkSession, path: str) -> AspectModel:
        rows = spark.read.parquet(f"{path}/aspects").orderBy("position").collect()  # a row per aspect
        weights = np.array([r["weights"] for r in rows]).T
        return AspectModel(Tfidf.load(spark, f"{path}/features"), tuple(r["aspect"] for r in rows), weights, np.array([r["intercept"] for r in rows]), rows[0]["threshold"])


def fit_aspects(
    labelled: DataFrame, aspects: list[str], text: str = "sentence_text", rules: TermRules = ASPECT_RULES, c: float = 1.0, tolerance: float = LINEAR_TOLERANCE
) -> AspectModel:
    """One balanced logistic regression per aspect, all in the same passes over the stored features."""
    features = fit_tfidf(labelled, text, rules)
    flags = [f"weak_{a}" for a in aspects]
    with scope(labelled.sparkSession):  # only the fit reads its blocks
        blocks = linear.blocks_of(features.vectors(labelled, text, flags), flags, features.size)
        fitted = linear.fit_linear(blocks, linear.LOGISTIC, c, balanced=True, tolerance=tolerance, steps=MAX_STEPS)
    return AspectModel(features, tuple(aspects), fitted.weights, fitted.intercepts, passes=fitted.passes)


def predict_aspects(
    model: AspectModel, df: DataFrame, keep: list[str], text: str = "sentence_text", polarity: PolarityRules | None = None
) -> DataFrame:
    """One row per sentence and aspect at or above the threshold; with ``polarity`` (``text`` is among
    ``keep`` then) also the sentence's polarity and its class, found once for all its aspects."""
    found = model.probabilities(df, text, keep)
    added = []
    if polarity is not None:
        found, added = aspects.sentence_polarity(found, polarity, text), ["polarity", "polarity_class"]
    kept = F.filter("detected", lambda d: d["probability"] >= model.threshold)
    return found.select(*keep, F.inline(kept), *added).withColumnRenamed("probability", "aspect_probability")


def aspect_outcomes(
    model: AspectModel, labelled: DataFrame, aspects: list[str], text: str = "sentence_text"
) -> DataFrame:
    """``(aspect, y, p)`` for every sentence and aspect: input of the multi-label measures."""
    found = model.probabilities(labelled, text, [f"weak_{a}" for a in aspects])
    rows = [
        F.struct(
            F.lit(a).alias("aspect"),
            F.col(f"weak_{a}").alias("y"),
            labels.predict_at(F.col("detected")[i]["probability"], model.threshold).alias("p"),
        )
        for i, a in enumerate(aspects)
    ]
    return found.select(F.inline(F.array(*rows)))


# Fixed value: aspect of a sentence without one.
NO_ASPECT = "no aspect above threshold"
NO_TEXT = "no text"


def score_reviews(
    model: AspectModel, df: DataFrame, key: str, text: str, rules: PolarityRules
) -> DataFrame:
    """Sentences of whole reviews with their aspects, confidence and polarity; a sentence
    without an aspect keeps its best score under a row of its own, and a null or blank review
    gets one row that says so."""
    sentences = review_sentences(F.col(text))
    rows = df.select(key, F.posexplode_outer(sentences).alias("i", "sentence")).select(
        key, F.coalesce(F.col("i") + 1, F.lit(0)).alias("sentence_number"), "sentence"
    )
    found = model.probabilities(rows, "sentence", [key, "sentence_number", "sentence"])
    hits = F.filter("detected", lambda d: d["probability"] >= model.threshold)
    best = F.array_max(F.transform("detected", lambda d: d["probability"]))
    nothing = F.array(F.struct(F.lit(NO_ASPECT).alias("aspect"), best.alias("probability")))
    blank = F.array(F.struct(F.lit(NO_TEXT).alias("aspect"), F.lit(None).cast("double").alias("probability")))
    polarity = F.expr(polarity_of("sentence", rules))
    return (
        found.withColumn("_hits", F.when(F.col("sentence").isNull(), blank).when(F.size(hits) > 0, hits).otherwise(nothing))
        .withColumns({"sentiment_score": F.when(F.col("sentence").isNotNull(), polarity)})
        .withColumn("sentiment", F.when(F.col("sentence").isNotNull(), labels.polarity_class(F.col("sentiment_score"))))
        .select(key, "sentence_number", "sentence", F.inline("_hits"), "sentiment", "sentiment_score")
        .withColumn("aspect_confidence", F.round("probability", 4))
        .drop("probability")
    )


def round_trip(model: TextModel, spark: SparkSession) -> TextModel:
    """The model as it comes back from storage."""
    path = staging_path(spark, "model")
    save_model(model, path)
    return load_model(spark, path)
