"""Raw reviews to typed, clean, finished tables. Each layer is a function of a DataFrame."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palate.functions import keys, labels, text
from palate.operators import dedup, sampling
from palate.sources.tables import require_columns

# Raw file columns and their first-layer names.
BRONZE_NAMES = {
    "Id": "raw_id",
    "ProductId": "product_id",
    "UserId": "user_id",
    "ProfileName": "profile_name",
    "HelpfulnessNumerator": "raw_helpfulness_numerator",
    "HelpfulnessDenominator": "raw_helpfulness_denominator",
    "Score": "raw_score",
    "Time": "raw_review_time",
    "Summary": "summary",
    "Text": "review_text",
}
BRONZE_COLUMNS = [*BRONZE_NAMES.values(), "_source_file", "_record_id", "_bronze_ingested_at"]

# What the finished layers need of the typed one, and what they publish.
SILVER_NEEDED = [
    "id", "product_id", "user_id", "score", "sentiment_class", "binary_label", "review_text_clean",
    "normalized_text", "review_length", "review_word_count", "review_time_epoch", "review_timestamp",
    "helpfulness_numerator", "helpfulness_denominator", "helpfulness_ratio", "_record_id",
]
MODEL_INPUT_COLUMNS = [
    "record_id", "clean_text", "label", "dataset_split", "score", "product_id", "user_id", "review_timestamp",
    "review_length", "review_word_count", "helpfulness_numerator", "helpfulness_denominator", "helpfulness_ratio",
]
SENTENCE_COLUMNS = [
    "sentence_id", "record_id", "id", "product_id", "user_id", "score", "sentiment_class", "review_time_epoch",
    "review_timestamp", "review_year", "helpfulness_numerator", "helpfulness_denominator", "helpfulness_ratio",
    "sentence_index", "sentence_text", "sentence_normalized",
]


def to_bronze(raw: DataFrame, source_file: Column | None = None, now: Column | None = None) -> DataFrame:
    """Lossless first layer: every raw row and value, renamed, with lineage and a record id."""
    if source_file is None and "_source_file" not in raw.columns:
        if not raw.inputFiles():
            raise ValueError("rows do not come from files: pass source_file, or the record ids would lack it")
        source_file = F.input_file_name()
    elif source_file is None:
        source_file = F.col("_source_file")
    renamed = raw.select(
        *[F.col(name).cast("string").alias(alias) for name, alias in BRONZE_NAMES.items()],
        source_file.alias("_source_file"),
    )
    identity = [F.col(c) for c in ("_source_file", "raw_id", "product_id", "user_id", "raw_review_time")]
    return renamed.withColumns(
        {
            "_bronze_ingested_at": F.current_timestamp() if now is None else now,
            "_record_id": keys.record_id(*identity),
        }
    )


def typed_reviews(bronze: DataFrame) -> DataFrame:
    """Text fields to numbers and timestamps, markup to plain text. No row is dropped."""
    require_columns(bronze, BRONZE_COLUMNS, "bronze")

    def number(name: str, data_type: str) -> Column:
        return labels.safe_integral(F.col(name), data_type)

    epoch = number("raw_review_time", "bigint")
    trimmed = {c: F.trim(F.col(c)).alias(c) for c in ("product_id", "user_id", "profile_name", "summary")}
    typed = bronze.select(
        number("raw_id", "bigint").alias("id"),
        trimmed["product_id"],
        trimmed["user_id"],
        trimmed["profile_name"],
        number("raw_helpfulness_numerator", "int").alias("helpfulness_numerator"),
        number("raw_helpfulness_denominator", "int").alias("helpfulness_denominator"),
        number("raw_score", "int").alias("score"),
        F.col("raw_review_time").alias("review_time_raw"),
        epoch.alias("review_time_epoch"),
        labels.epoch_to_ts(epoch).alias("review_timestamp"),
        trimmed["summary"],
        "review_text",
        "_source_file",
        "_record_id",
        "_bronze_ingested_at",
        text.clean_html(F.col("review_text")).alias("review_text_clean"),
    )
    # clean text is collapsed and trimmed already
    return typed.withColumn("normalized_text", F.lower("review_text_clean"))


def valid_fields(typed: DataFrame) -> DataFrame:
    """Rows with an id, product, user, a rating of 1 to 5 and possible votes."""
    numerator, denominator = F.col("helpfulness_numerator"), F.col("helpfulness_denominator")
    rules = [F.col("id").isNotNull(), F.col("score").between(1, 5), numerator >= 0, numerator <= denominator]
    rules += [F.length(c) > 0 for c in ("product_id", "user_id")]
    return typed.filter(reduce(lambda a, b: a & b, rules))


def with_text(typed: DataFrame) -> DataFrame:
    return typed.filter(F.length("review_text_clean") > 0)


def valid_reviews(typed: DataFrame) -> DataFrame:
    """Rows with valid fields and a text."""
    return with_text(valid_fields(typed))


def to_silver(bronze: DataFrame, now: Column | None = None, leave_out: tuple[str, ...] = ()) -> DataFrame:
    """Typed, valid reviews, one per product, user, time and text, with derived columns. Columns of the
    first layer in ``leave_out`` are not wanted, and not stored on the way."""
    # Empty texts only ever meet each other in the dedup, so they may leave after it. Before
    # it the test would be pushed to the scan and every text cleaned twice.
    typed = valid_fields(typed_reviews(bronze))
    order = [c for c in typed.columns if c not in leave_out]
    # the normalized text is the clean one in lower case: stored once, derived from what is stored
    kept = with_text(dedup.dedup_product(typed.drop("normalized_text", *leave_out)))
    kept = kept.withColumn("normalized_text", F.lower("review_text_clean")).select(*order)
    score = F.col("score")
    return kept.withColumns(
        {
            "sentiment_class": labels.sentiment_class(score),
            "binary_label": labels.binary_label(score),
            "review_length": F.length("review_text_clean"),
            "review_word_count": text.count_words(F.col("normalized_text")),
            "helpfulness_ratio": labels.helpfulness_ratio(
                F.col("helpfulness_numerator"), F.col("helpfulness_denominator")
            ),
            "has_valid_review_time": F.col("review_timestamp").isNotNull(),
            "_silver_processed_at": F.current_timestamp() if now is None else now,
        }
    )


def binary_reviews(silver: DataFrame) -> DataFrame:
    """Positive and negative reviews, one per text, so no text can stand on both sides of a split."""
    require_columns(silver, SILVER_NEEDED, "silver")
    needed = silver.select(*SILVER_NEEDED).drop("review_text_clean", "sentiment_class")
    return dedup.dedup_text(needed.filter(F.col("binary_label").isin(0, 1)))


def model_input(silver: DataFrame, order: str = "xxhash64") -> DataFrame:
    """Labelled text with an exact 80/10/10 split of each class."""
    rows = binary_reviews(silver).withColumnsRenamed(
        {"_record_id": "record_id", "normalized_text": "clean_text", "binary_label": "label"}
    )
    split = sampling.stratified_split(rows, label="label", key="record_id", tie="clean_text", kind=order)
    return split.select(*MODEL_INPUT_COLUMNS)


def aspect_sentences(silver: DataFrame) -> DataFrame:
    """One row per sentence of every review, with the review's context. Narrow."""
    require_columns(silver, SILVER_NEEDED, "silver")
    context = [c for c in SENTENCE_COLUMNS if c in silver.columns]
    exploded = silver.select(
        F.col("_record_id").alias("record_id"),
        *context,
        F.posexplode(text.split_sentences(F.col("review_text_clean"))).alias("sentence_index", "raw_sentence"),
    )
    return (
        exploded.withColumn("sentence_text", F.trim("raw_sentence"))
        .filter(F.length("sentence_text") > 0)
        .withColumns(
            {
                "sentence_normalized": text.normalize_text(F.col("sentence_text")),
                "review_year": F.year("review_timestamp"),
                "sentence_id": keys.sentence_id(F.col("record_id"), F.col("sentence_index")),
            }
        )
        .select(*SENTENCE_COLUMNS)
    )
