"""Every operator as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from checks import fixture as fx
from palate.functions import keys, labels, text
from palate.operators import aspects, features, metrics, models, quality, sampling, topics
from palate.operators.features import TermRules
from palate.plans import insights, layers, research, training
from palate.sources import tables
from palate.sources.staging import drop_staged, stage, staged_count, staging_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

LEXICON = fx.ASPECTS
POLARITY = fx.POLARITY
ASPECTS = list(LEXICON)
VOCABULARY_RULES = TermRules(min_df=3, max_df=0.9, max_features=2_000, stop_words=["the", "and"])
TFIDF_RULES = TermRules(low=1, high=2, min_df=3, max_df=0.98, max_features=2_000)
MODEL_RULES = TermRules(low=1, high=2, min_df=3, max_df=0.98, max_features=20_000, accents=False)

CSV_AS_IS = {
    "header": True, "quote": '"', "escape": '"', "quoteAll": True,
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


# ---- raw rows and the first layer ----------------------------------------------------


@query
def bronze(spark, d):
    return fx.bronze(spark, d).drop("_bronze_ingested_at")


@query
def null_blank_counts(spark, d):
    columns = ["raw_id", "product_id", "user_id", "raw_score", "raw_review_time", "summary", "review_text"]
    return quality.null_blank_counts(fx.bronze(spark, d), columns)


@query
def parseability(spark, d):
    return quality.parseability(fx.bronze(spark, d))


@query
def rating_counts(spark, d):
    return quality.rating_counts(fx.bronze(spark, d), "raw_score")


@query
def label_preview(spark, d):
    return quality.label_preview(fx.reviews(spark, d))


@query
def describe_numeric(spark, d):
    columns = ["HelpfulnessNumerator", "HelpfulnessDenominator", "Score"]
    return rounded(quality.describe_numeric(fx.reviews(spark, d), columns), "mean", "stddev")


@query
def length_stats(spark, d):
    return quality.length_stats(fx.reviews(spark, d))


@query
def short_texts(spark, d):
    return quality.short_texts(fx.reviews(spark, d), below=60).select("Id", "Score", "Text")


@query
def duplicate_texts(spark, d):
    rows = fx.bronze(spark, d)
    texts = quality.duplicates(rows, "review_text", text=True).withColumn("of", F.lit("review_text"))
    ids = quality.duplicates(rows, "_record_id").withColumn("of", F.lit("record_id"))
    return texts.unionByName(ids)


@query
def balanced_sample(spark, d):
    valid = quality.valid_raw(fx.reviews(spark, d))
    return sampling.balanced_sample(valid, "Score", 20, ["1", "2", "3", "4", "5"], "Id", kind="md5").select("Id", "Score")


@query
def safe_integral(spark, d):
    fields = {"Id": "bigint", "Time": "bigint", "HelpfulnessNumerator": "int", "HelpfulnessDenominator": "int", "Score": "int"}
    return fx.reviews(spark, d).select(
        F.col("Id").alias("raw_id"),
        *[labels.safe_integral(F.col(c), t).alias(f"{c.lower()}_number") for c, t in fields.items()],
    )


@query
def clean_html(spark, d):
    return fx.reviews(spark, d).select("Id", text.clean_html(F.col("Text")).alias("clean"))


@query
def csv_roundtrip(spark, d):
    """Reviews written as CSV and read back as raw files: every value survives."""
    path = staging_path(spark, "csv")
    raw = fx.reviews(spark, d).select(*tables.RAW_COLUMNS)
    raw.write.options(**CSV_AS_IS).csv(path)
    return tables.read_raw(spark, path).drop("_source_file")


@query
def csv_inferred(spark, d):
    path = staging_path(spark, "csv")
    raw = fx.reviews(spark, d).select(*tables.RAW_COLUMNS)
    raw.write.options(**CSV_AS_IS).csv(path)
    return tables.read_raw(spark, path, infer=True).drop("_source_file")


@query
def bronze_lineage(spark, d):
    """Source file and ingest time as a real file read fills them."""
    path = staging_path(spark, "csv")
    raw = fx.reviews(spark, d).select(*tables.RAW_COLUMNS)
    raw.write.options(**CSV_AS_IS).csv(path)
    rows = layers.to_bronze(tables.read_raw(spark, path))
    again = keys.record_id(*[F.col(c) for c in ("_source_file", "raw_id", "product_id", "user_id", "raw_review_time")])
    return rows.select(
        "raw_id",
        F.col("_source_file").rlike(r"/part-[^/]*\.csv$").alias("names_a_part_file"),
        F.col("_bronze_ingested_at").isNotNull().alias("has_ingest_time"),
        (F.col("_record_id") == again).alias("id_holds_the_file_name"),
    )


@query
def verified_write(spark, d):
    """Rows written and read back, per layer."""
    first, second = staging_path(spark, "bronze"), staging_path(spark, "silver")
    bronze_rows = tables.verified_write(fx.bronze(spark, d), first)
    silver_rows = tables.verified_write(layers.to_silver(tables.read_layer(spark, first)), second)
    return spark.createDataFrame([("bronze", bronze_rows), ("silver", silver_rows)], "layer string, rows_written bigint")


# ---- typed layer ---------------------------------------------------------------------


@query
def silver(spark, d):
    return fx.silver(spark, d).drop("_bronze_ingested_at", "_silver_processed_at")


@query
def sentiment_counts(spark, d):
    return quality.sentiment_counts(fx.silver(spark, d))


@query
def silver_profile(spark, d):
    return quality.silver_profile(fx.silver(spark, d))


# ---- labelled text -------------------------------------------------------------------


@query
def model_input(spark, d):
    return fx.model_input(spark, d)


@query
def gold_split_counts(spark, d):
    path = staging_path(spark, "model_input")
    tables.write_layer(fx.model_input(spark, d), path, ["dataset_split"])
    return quality.split_counts(tables.read_splits(spark, path))


@query
def train_rows(spark, d):
    """Two columns of one split: the other splits' files are not read."""
    path = staging_path(spark, "model_input")
    tables.write_layer(fx.model_input(spark, d), path, ["dataset_split"])
    return tables.read_splits(spark, path, "train").select("clean_text", "label")


@query
def all_part_files(spark, d):
    """Two columns of every part file at any depth."""
    path = staging_path(spark, "model_input")
    tables.write_layer(fx.model_input(spark, d), path, ["dataset_split"])
    return tables.read_columns(spark, path, ["clean_text", "label"])


@query
def valid_model_rows(spark, d):
    return quality.valid_model_rows(fx.model_input(spark, d)).select("record_id", "clean_text", "label", "dataset_split")


@query
def integrity_violations(spark, d):
    rows = stage(fx.silver(spark, d), "silver")
    model_rows = stage(layers.model_input(rows, order="sha2").select("record_id", "clean_text", "label", "dataset_split"), "model")
    split = sampling.group_split(layers.aspect_sentences(rows), kind="md5")
    return quality.integrity_violations(model_rows, split)


@query
def balanced_train(spark, d):
    train = fx.model_input(spark, d).filter(F.col("dataset_split") == "train")
    return sampling.balance_train(train, kind="md5").select("record_id", "label")


@query
def class_weights(spark, d):
    train = fx.model_input(spark, d).filter(F.col("dataset_split") == "train")
    return rounded(features.class_weights(train), "weight")


@query
def random_split(spark, d):
    return sampling.hash_split(fx.model_input(spark, d), "record_id", {"train": 0.8, "test": 0.2}, "part", "md5", 42).select(
        "record_id", "part"
    )


@query
def stratified_holdout(spark, d):
    """80/20 of each class, exact."""
    rows = layers.binary_reviews(fx.silver(spark, d)).select("_record_id", "binary_label")
    return sampling.stratified_split(rows, "binary_label", "_record_id", {"train": 0.8}, kind="md5", seed=42)


@query
def shuffled(spark, d):
    return sampling.shuffle(fx.silver(spark, d), "_record_id", seed=42).select("_record_id", "id")


# ---- research rows -------------------------------------------------------------------


@query
def clean_letters(spark, d):
    return fx.reviews(spark, d).select("Id", text.clean_letters(F.col("Text")).alias("clean"))


@query
def research_clean(spark, d):
    return research.research_clean(fx.reviews(spark, d))


@query
def class_balance(spark, d):
    return rounded(research.class_balance(research.research_clean(fx.reviews(spark, d))), "positive_share", "negative_share")


def _half_sample(rows: DataFrame) -> DataFrame:
    return sampling.stratified_sample(rows, "label", {1: 0.25, 0: 0.75}, "row_id", kind="md5")


@query
def stratified_sample(spark, d):
    return _half_sample(research.research_clean(fx.reviews(spark, d))).select("row_id", "label")


@query
def holdout_pool(spark, d):
    rows = stage(research.research_clean(fx.reviews(spark, d)).select("row_id", "label"), "research_rows")
    return sampling.holdout_pool(rows, _half_sample(rows))


@query
def realistic_sample(spark, d):
    rows = research.research_clean(fx.reviews(spark, d)).select("row_id", "label")
    return sampling.realistic_sample(rows, 0.78, 500, key="row_id", kind="md5")


@query
def research_splits(spark, d):
    parts = research.research_splits(research.research_clean(fx.reviews(spark, d)), rows=400, natural_rows=100, kind="md5")
    named = [part.select("row_id", "label", F.lit(name).alias("part")) for name, part in parts.items()]
    return named[0].unionByName(named[1]).unionByName(named[2])


# ---- sentences and aspects -----------------------------------------------------------


@query
def aspect_sentences(spark, d):
    return fx.sentences(spark, d)


@query
def review_sentences(spark, d):
    found = text.review_sentences(F.col("Text"))
    return fx.reviews(spark, d).select("Id", F.posexplode(found).alias("sentence_index", "sentence"))


@query
def hash_sample(spark, d):
    rows = stage(fx.sentences(spark, d).select("sentence_id", "sentence_text"), "sentences")
    return sampling.hash_sample(rows, "sentence_id", 5_000, kind="md5")


@query
def group_split(spark, d):
    split = sampling.group_split(fx.sentences(spark, d), kind="md5")
    return split.select("sentence_id", "record_id", "development_split")


def _labelled(spark, d) -> DataFrame:
    return aspects.weak_labels(fx.sentences(spark, d), LEXICON)


@query
def weak_labels(spark, d):
    flags = [f"weak_{a}" for a in ASPECTS]
    return _labelled(spark, d).select("sentence_id", *flags, F.array_join("seed_aspects", ",").alias("seed_aspects"))


@query
def weak_label_counts(spark, d):
    return rounded(aspects.weak_label_counts(_labelled(spark, d), ASPECTS), "any_share")


@query
def aspect_support(spark, d):
    return aspects.aspect_support(sampling.group_split(_labelled(spark, d), kind="md5"), ASPECTS)


@query
def sentence_aspects(spark, d):
    return aspects.sentence_aspects(_labelled(spark, d).select("sentence_id", "seed_aspects"))


@query
def long_word_lists(spark, d):
    """Two lists of 17,576 phrases each, searched in every sentence."""
    rows = fx.sentences(spark, d).select("sentence_id", "sentence_text")
    lists = fx.long_lists()
    return aspects.with_mentions(rows, lists, {name: name for name in lists}, "sentence_text").drop("sentence_text")


@query
def lexicon_hits(spark, d):
    return aspects.lexicon_hits(fx.sentences(spark, d), LEXICON)


@query
def polarity(spark, d):
    scored = aspects.sentence_polarity(fx.sentences(spark, d).select("sentence_id", "sentence_text"), POLARITY)
    return rounded(scored.drop("sentence_text"), "polarity")


def _long(spark, d) -> DataFrame:
    columns = ["_record_id", "product_id", "helpfulness_numerator", "review_timestamp", "review_text_clean"]
    rows = aspects.aspect_sentiment(fx.silver(spark, d).select(*columns), LEXICON, POLARITY)
    return rows.drop("review_text_clean")


@query
def aspect_sentiment(spark, d):
    return rounded(_long(spark, d).select("_record_id", "aspect", "compound", "sentiment"), "compound")


@query
def aspect_sentiment_wide(spark, d):
    rows = fx.silver(spark, d).select("_record_id", "review_text_clean")
    wide = aspects.aspect_sentiment(rows, LEXICON, POLARITY, wide=True).drop("review_text_clean")
    return rounded(wide, *ASPECTS)


@query
def aspect_coverage(spark, d):
    return rounded(insights.aspect_coverage(_long(spark, d)), "mentioned", "pct_positive", "pct_negative")


def _seeded(spark, d) -> DataFrame:
    """Seeded aspects of every sentence, with a stand-in for the detector's probability."""
    rows = _labelled(spark, d).select("sentence_id", "sentence_index", "sentence_text", "seed_aspects")
    scored = aspects.aspect_polarity(rows, POLARITY)
    return scored.withColumn("aspect_probability", (F.col("sentence_index") * 37 % 101) / 100.0)


@query
def aspect_summary(spark, d):
    return rounded(aspects.aspect_summary(_seeded(spark, d)), "mean_aspect_probability", "mean_polarity")


@query
def sentiment_mix(spark, d):
    return rounded(aspects.sentiment_mix(_seeded(spark, d)), "negative", "neutral", "positive")


# ---- reports -------------------------------------------------------------------------


@query
def aspect_ranking(spark, d):
    shares = ["mention_rate", "pct_negative", "pct_positive", "weighted_pct_negative"]
    return rounded(insights.aspect_ranking(_long(spark, d)), *shares)


@query
def aspect_trend(spark, d):
    return rounded(insights.aspect_trend(_long(spark, d)), "pct_negative")


@query
def worst_trends(spark, d):
    return rounded(insights.worst_trends(_long(spark, d)), "pct_negative")


@query
def product_breakdown(spark, d):
    return rounded(insights.product_breakdown(_long(spark, d), ASPECTS), *ASPECTS)


@query
def headlines(spark, d):
    return rounded(insights.headlines(insights.aspect_ranking(_long(spark, d))), "value")


# ---- text features -------------------------------------------------------------------


def _docs(spark, d) -> DataFrame:
    return fx.spread(fx.table(spark, d, "documents"))


@query
def token_counts(spark, d):
    return features.token_counts(_docs(spark, d), "text", ["the", "and", "is"])


@query
def vocabulary(spark, d):
    docs = _docs(spark, d)
    return features.vocabulary(docs, "text", docs.count(), VOCABULARY_RULES)


@query
def idf(spark, d):
    return rounded(features.idf_table(_docs(spark, d), "text", TermRules()), "idf")


@query
def tfidf(spark, d):
    return rounded(features.tfidf(_docs(spark, d), "doc_id", "text", TFIDF_RULES), "weight").drop("id")


@query
def encode_sequences(spark, d):
    docs = _docs(spark, d)
    rows = features.encode_sequences(docs, features.sequence_vocabulary(docs, "text", 2_000), "doc_id", "text")
    return rows.select("doc", F.array_join("ids", " ").alias("ids"))


@query
def nb_params(spark, d):
    rows = _docs(spark, d).join(fx.table(spark, d, "labels"), "doc_id")
    found = features.naive_bayes_parameters(rows, "text", "quality")
    return rounded(found, "log_prior", "log_probability")


@query
def strip_accents(spark, d):
    return _docs(spark, d).select("doc_id", text.strip_accents(F.col("text")).alias("plain"))


@query
def strip_accents_any(spark, d):
    return _docs(spark, d).select("doc_id", text.strip_accents_any(F.col("text")).alias("plain"))


@query
def json_texts(spark, d):
    """Requests in both JSON forms, one per document with its lines as texts, and read back."""
    lines = F.split("text", "\n")
    body = F.when(F.col("doc_id") % 2 == 0, F.to_json(F.struct(lines.alias("texts")))).otherwise(F.to_json(lines))
    return models.parse_requests(_docs(spark, d).select("doc_id", body.alias("body")))


@query
def map_topics(spark, d):
    """The strongest words of each source as its topic, and the aspect they point to."""
    counts = (
        _docs(spark, d)
        .select("source", F.explode(text.words(F.col("text"))).alias("term"))
        .groupBy("source", "term")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    rank = F.row_number().over(Window.partitionBy("source").orderBy(F.desc("n"), "term"))
    top = counts.withColumn("position", rank).filter(F.col("position") <= 25).select("source", "position", "term")
    return topics.map_topics(stage(top, "topic_terms"), LEXICON, "source")


# ---- measures ------------------------------------------------------------------------


def _scores(spark, d) -> DataFrame:
    rows = fx.table(spark, d, "labels").select(
        "doc_id", F.col("quality").alias("y"), ((F.col("doc_id") * 37 % 101) / 100.0).alias("score")
    )
    return rows.withColumn("p", labels.predict_at(F.col("score")))


def _multilabel(spark, d) -> DataFrame:
    p = labels.predict_at((F.col("doc_id") * 37 % 101) / 100.0)
    every_third = (F.col("doc_id") % 3 == 0).cast("int")
    pairs = F.array(
        F.struct(F.lit("quality").alias("aspect"), F.col("quality").alias("y"), p.alias("p")),
        F.struct(F.lit("toxic").alias("aspect"), F.col("toxic").alias("y"), every_third.alias("p")),
    )
    return fx.table(spark, d, "labels").select("doc_id", F.inline(pairs))


@query
def confusion(spark, d):
    return metrics.confusion(_scores(spark, d), "y", "p")


@query
def binary_metrics(spark, d):
    return rounded(metrics.binary_metrics(_scores(spark, d), "y", "p"), "accuracy", "balanced_accuracy", "precision", "recall", "f1")


@query
def weighted_metrics(spark, d):
    found = metrics.weighted_metrics(_scores(spark, d), "y", "p")
    return rounded(found, *found.columns)


@query
def class_report(spark, d):
    return rounded(metrics.class_report(_scores(spark, d), "y", "p"), "precision", "recall", "f1")


@query
def roc_auc(spark, d):
    return rounded(metrics.roc_auc(_scores(spark, d), "y", "score"), "roc_auc")


@query
def average_precision(spark, d):
    return rounded(metrics.average_precision(_scores(spark, d), "y", "score"), "average_precision")


@query
def multilabel_metrics(spark, d):
    found = metrics.multilabel_metrics(_multilabel(spark, d))
    return rounded(found, *found.columns)


@query
def aspect_report(spark, d):
    return rounded(metrics.aspect_report(_multilabel(spark, d)), "precision", "recall", "f1")


@query
def error_review(spark, d):
    return quality.error_review(_scores(spark, d), "y", "p", "score", "doc_id").select("doc_id", "y", "p", "score", "error")


# ---- models (row counts only) --------------------------------------------------------


def _research(spark, d) -> DataFrame:
    return stage(research.research_clean(fx.reviews(spark, d)), "research_rows")


@query
def hashed_tf(spark, d):
    found = models.hashed_tf(research.research_clean(fx.reviews(spark, d)), fx.STOP_WORDS).select("row_id", F.unwrap_udt("tf").alias("v"))
    pairs = F.zip_with("v.indices", F.transform("v.values", lambda x: x.cast("int")), lambda i, n: F.concat_ws(":", i, n))
    return found.select("row_id", F.array_join(pairs, " ").alias("tf"))


@query
def compare_research_models(spark, d):
    """Three classifiers on hashed features, each on a balanced and a natural test set."""
    parts = research.research_splits(_research(spark, d))
    tests = {"balanced": parts["balanced_test"], "natural": parts["natural_test"]}
    return models.compare_models(models.research_pipelines(), parts["train"], tests)[0]


_runs: dict = {}


def forget_runs() -> None:
    """Make the next query train anew."""
    _runs.clear()


def _once_per_session(run):
    """Queries that look at different results of one training share it."""

    def shared(spark, d):
        key = run.__name__, spark.sparkContext.applicationId, d
        if key not in _runs:
            _runs[key] = run(spark, d)
        return _runs[key]

    return shared


@_once_per_session
def _sentiment_run(spark, d) -> training.SentimentRun:
    return training.train_sentiment(fx.model_input(spark, d), MODEL_RULES)


@query
def train_sentiment(spark, d):
    """Candidates compared on validation rows; the best one measured once on test rows."""
    return _sentiment_run(spark, d).report


@query
def select_model(spark, d):
    return models.select_model(_sentiment_run(spark, d).results)


@query
def trainer_baseline(spark, d):
    """Weighted logistic regression on a fixed 80/20 split, stored, loaded and scored."""
    return training.train_baseline(fx.model_input(spark, d), models.TRAINER_RULES)


@query
def score_json(spark, d):
    model = _sentiment_run(spark, d).model
    body = F.to_json(F.struct(F.split("text", "\n").alias("texts")))
    return models.score_json(model, _docs(spark, d).select("doc_id", body.alias("body")), "doc_id")


#: One body of each kind by document: two good forms, two empty ones, four bad ones.
_BODIES = [None, '{"texts": []}', "[]", "not json", '{"texts": null}', '["x", null]', "[1, 2]"]


def _request_bodies(spark, d) -> DataFrame:
    lines = F.split("text", "\n")
    good = F.when(F.col("doc_id") % 2 == 0, F.to_json(F.struct(lines.alias("texts")))).otherwise(F.to_json(lines))
    body = good
    for i, odd in list(enumerate(_BODIES))[1:]:
        body = F.when(F.col("doc_id") % 10 == i, F.lit(odd)).otherwise(body)
    return _docs(spark, d).select("doc_id", body.alias("body"))


@query
def request_answers(spark, d):
    """Every request gets one answer: as many predictions as texts, or an error."""
    answers = models.score_json(_sentiment_run(spark, d).model, _request_bodies(spark, d), "doc_id")
    shape = "predictions array<int>, positive_probabilities array<double>, error string"
    a = F.from_json("answer", shape)
    chances = F.forall(a["positive_probabilities"], lambda p: p.between(0, 1))
    return answers.select(
        "doc_id", F.size(a["predictions"]).alias("n_predictions"), a["error"].isNotNull().alias("is_error"), F.coalesce(chances, F.lit(True)).alias("in_range")
    )


@query
def sentiment_report_keys(spark, d):
    """Measures of the sentiment run, each within its range."""
    rows = _sentiment_run(spark, d).report
    return rows.filter(F.col("part") == "validation").select("part", "model", "measure", F.col("value").between(0, 1).alias("in_range"))


@query
def sentiment_confusion_total(spark, d):
    """The chosen model predicts every test row."""
    return _sentiment_run(spark, d).confusion.select((F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")).alias("test_rows"))


@query
def selected_model_range(spark, d):
    found = models.select_model(_sentiment_run(spark, d).results)
    return found.select(F.col("model").isin(list(models.classifier_fits())).alias("known"), F.col("f1").between(0, 1).alias("f1_in_range"), F.col("average_precision").between(0, 1).alias("ap_in_range"))


@query
def research_model_keys(spark, d):
    """Models and test sets of the research comparison, measures within their ranges."""
    measures = ["accuracy", "balanced_accuracy", "f1", "precision", "recall", "roc_auc", "average_precision"]
    rows = compare_research_models(spark, d)
    return rows.select("model", "test_set", F.forall(F.array(*measures), lambda v: v.between(0, 1)).alias("in_range"))


@query
def baseline_rows(spark, d):
    """The stored baseline scores every validation row."""
    return trainer_baseline(spark, d).select("record_id", "label", F.col("prediction").isin(0, 1).alias("is_class"), F.col("score_positive").between(0, 1).alias("in_range"))


@query
def aspect_layer_support(spark, d):
    """Held-out sentences that hold an aspect, as the detector's report counts them."""
    rows = _aspect_layer(spark, d).report.filter(F.col("measure").endswith(" support"))
    return rows.select("part", F.regexp_replace("measure", " support$", "").alias("aspect"), F.col("value").cast("bigint").alias("support"))


@query
def predicted_sentences(spark, d):
    """Predictions name known sentences and aspects and stay within their ranges."""
    rows = _aspect_layer(spark, d).predictions
    # a sentence's predictions stand together: they are counted before the shuffle, and one row meets its sentence
    counted = rows.groupBy("sentence_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(~F.col("aspect").isin(ASPECTS), 1)).alias("aspects"),
        F.count(F.when(~F.col("aspect_probability").between(0.5, 1), 1)).alias("ranges"),
    )
    known = counted.join(fx.sentences(spark, d).select("sentence_id", F.lit(True).alias("known")), "sentence_id", "left")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return known.agg(
        total(F.when(F.col("known").isNull(), F.col("n"))).alias("unknown_sentences"),
        total("aspects").alias("unknown_aspects"),
        total("ranges").alias("out_of_range"),
    )


@query
def scored_review_sentences(spark, d):
    """Every sentence of every review is in the scoring; a blank review has a row of its own."""
    return score_reviews(spark, d).select("Id", "sentence_number", "sentence").distinct()


@query
def topic_shapes(spark, d):
    """Topics, listed terms each, and whether the aspect is a known one."""
    rows = aspect_topics(spark, d)
    return rows.select("topic", F.size(F.split("top_terms", ", ")).alias("n_terms"), F.col("suggested_aspect").isin([*ASPECTS, topics.UNCLEAR]).alias("known"))


@query
def ranking_with_missing_scores(spark, d):
    """Ranking measures where scores repeat, are null or are not a number."""
    rows = _scores(spark, d).withColumn("score", F.when(F.col("doc_id") % 7 == 0, None).when(F.col("doc_id") % 7 == 1, float("nan")).otherwise(F.col("doc_id") * 7919 % 100_003 / 100_003))
    return rounded(metrics.ranking_metrics(rows, "y", "score"), "roc_auc", "average_precision")


@query
def quota_of_repeated_keys(spark, d):
    """More rows than a thousand where many share a key: exactly the quota of every class."""
    rows = fx.sentences(spark, d).select("product_id", "score", "sentence_id")
    taken = sampling.take_quota(rows, "score", {1: 1_500, 5: 1_200, 3: 10}, "product_id", kind="md5", tie="sentence_id")
    return taken.groupBy("score").agg(F.count(F.lit(1)).alias("taken"), F.countDistinct("sentence_id").alias("distinct_taken"))


@query
def split_with_null_labels(spark, d):
    """Exact shares of every class, the unlabelled rows among them."""
    rows = _docs(spark, d).select("doc_id").join(fx.table(spark, d, "labels"), "doc_id", "left")
    return sampling.stratified_split(rows.select("doc_id", "quality"), "quality", "doc_id", kind="md5").groupBy("quality", "dataset_split").agg(F.count(F.lit(1)).alias("n"))


@query
def insight_headlines(spark, d):
    """The whole report plan: reviews scored once, headlines from the ranking."""
    found = insights.insights(fx.silver(spark, d), LEXICON, POLARITY)
    return rounded(found.headlines, "value")


@query
def aspect_topics(spark, d):
    rules = TermRules(low=1, high=2, min_df=10, max_df=0.70, max_features=6_000, stop_words=features.english_stop_words())
    return topics.map_topics(topics.fit_topics(fx.sentences(spark, d), "sentence_text", rules), LEXICON)


@_once_per_session
def _aspect_layer(spark, d) -> training.AspectRun:
    start = staged_count()
    rows = fx.sentences(spark, d)
    stop = staged_count()
    run = training.aspect_layer(rows, LEXICON, POLARITY, MODEL_RULES, kind="md5")
    drop_staged(spark, start, stop)  # the run reads its own copy of the sentences
    return run


@query
def aspect_layer(spark, d):
    """Detector fitted on train sentences: its measures on the held-out ones."""
    return _aspect_layer(spark, d).report


@query
def predict_aspects(spark, d):
    return _aspect_layer(spark, d).predictions


@query
def score_reviews(spark, d):
    model = _aspect_layer(spark, d).model
    return models.score_reviews(model, fx.reviews(spark, d).select("Id", "Text"), "Id", "Text", POLARITY)


@query
def quota_with_times(spark, d):
    """Exact quotas of rows that carry the time of the run and a map, with many rows a key."""
    rows = fx.reviews(spark, d).select("Score", "UserId", F.current_timestamp().alias("seen_at"), F.create_map(F.lit("votes"), F.col("HelpfulnessNumerator")).alias("more"))
    taken = sampling.take_quota(rows, "Score", {"1": 30, "4": 77, "x": 5}, "UserId", kind="md5")
    return taken.groupBy("Score").agg(F.count(F.lit(1)).alias("taken"), F.count("seen_at").alias("with_time"))


def _stored_detector(spark, d) -> tuple[models.AspectModel, DataFrame]:
    """The detector as loaded from storage, and its stored numbers as (aspect, intercept, id, w)."""
    path = staging_path(spark, "detector")
    _aspect_layer(spark, d).model.save(path)
    stored = spark.read.parquet(f"{path}/aspects")
    return models.AspectModel.load(spark, path), stored.select("aspect", "intercept", F.posexplode("weights").alias("id", "w"))


@query
def detector_recomputed(spark, d):
    """Probabilities of the loaded detector against the sums of term weights times stored weights."""
    model, stored = _stored_detector(spark, d)
    rows = stage(fx.sentences(spark, d).select("sentence_id", "sentence_text"), "sentences")
    # a row per term with the weights of all aspects: a sentence's terms stand together, so their sums are
    # nearly all made before the shuffle, which carries one narrow row per sentence
    wide = F.broadcast(stored.groupBy("id").pivot("aspect", list(model.aspects)).agg(F.first("w")))
    sums = [F.sum(F.col("weight") * F.col(f"`{a}`")).alias(f"m{i}") for i, a in enumerate(model.aspects)]
    margins = model.features.weights(rows, "sentence_id", "sentence_text").join(wide, "id").groupBy(F.col("doc").alias("sentence_id")).agg(*sums)
    both = model.probabilities(rows, "sentence_text", ["sentence_id"]).join(margins, "sentence_id", "left")
    margin = F.element_at(F.array(*[f"m{i}" for i in range(len(model.aspects))]), F.col("_at") + 1)
    long = both.select("*", F.posexplode("detected").alias("_at", "d")).select("d.aspect", "d.probability", margin.alias("m"))
    long = long.join(F.broadcast(stored.select("aspect", "intercept").distinct()), "aspect")
    plain = 1 / (1 + F.exp(-(F.coalesce("m", F.lit(0.0)) + F.col("intercept"))))
    return long.groupBy("aspect").agg(F.count(F.lit(1)).alias("scored"), F.count_if(F.abs(plain - F.col("probability")) < 1e-9).alias("agreeing"))


@query
def detector_fit_is_stationary(spark, d):
    """At the fitted weights the gradient of every aspect's weighted loss and penalty is nought: the fit of
    all aspects together is the fit of each."""
    model, stored = _stored_detector(spark, d)
    flags = [f"weak_{a}" for a in ASPECTS]
    train = sampling.group_split(_labelled(spark, d), kind="md5").filter("development_split = 'train'")
    labelled = stage(train.select("sentence_text", *flags), "labelled", codec="zstd")
    totals = F.array(*[F.struct(F.lit(a).alias("aspect"), F.count(F.lit(1)).alias("n"), F.sum(f).alias("positives")) for a, f in zip(ASPECTS, flags)])
    sizes = labelled.agg(totals.alias("s")).select(F.inline("s")).collect()  # a row per aspect
    found = model.probabilities(labelled, "sentence_text", ["sentence_text", *flags])

    def residual(i: int) -> Column:
        y, n, positives = F.col(flags[i]), sizes[i]["n"], sizes[i]["positives"] or 0
        weight = F.when(y == 1, n / (2 * max(positives, 1))).otherwise(n / (2 * max(n - positives, 1)))
        return weight * (F.col("detected")[i]["probability"] - y)

    # a sentence's residuals go along with its terms, so nothing but a partial sum per term is shuffled
    rows = found.select("sentence_text", F.array(*[residual(i) for i in range(len(ASPECTS))]).alias("r"))
    terms = model.features.weights(rows, "r", "sentence_text").select("id", "weight", F.col("doc").alias("r"))
    terms = terms.union(rows.select(F.lit(None).cast("int"), F.lit(1.0), "r"))  # the intercept is a term of every sentence
    sums = stage(terms.groupBy("id").agg(*[F.sum(F.col("weight") * F.col("r")[i]).alias(f"g{i}") for i in range(len(ASPECTS))]), "gradient")
    long = sums.select("id", F.inline(F.array(*[F.struct(F.lit(a).alias("aspect"), F.col(f"g{i}").alias("g")) for i, a in enumerate(ASPECTS)])))
    slopes = stored.join(long, ["aspect", "id"], "left").select("aspect", (F.coalesce("g", F.lit(0.0)) + F.col("w")).alias("g"))
    slopes = slopes.union(long.filter(F.col("id").isNull()).select("aspect", "g"))
    known = F.broadcast(spark.createDataFrame(sizes, "aspect string, n long, positives long"))
    steepest = slopes.groupBy("aspect").agg(F.max(F.abs("g")).alias("g")).join(known, "aspect")
    return steepest.select("aspect", "n", "positives", (F.col("g") <= 1.01 * models.LINEAR_TOLERANCE * F.col("n")).alias("stationary"))
