"""Typed values and labels derived from review columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Polarity cut-offs and class names.
POSITIVE_FROM = 0.05
NEGATIVE_TO = -0.05
NOT_MENTIONED = "not_mentioned"

INTEGER_PATTERN = r"^[+-]?[0-9]+$"


def is_integral(value: Column) -> Column:
    return F.trim(value).rlike(INTEGER_PATTERN)


def safe_integral(value: Column, data_type: str) -> Column:
    """Integer text to a number; anything else, and numbers too long for the type, to null."""
    return F.when(is_integral(value), F.trim(value).try_cast(data_type))


#: First and last second of the years 1 to 9999.
FIRST_SECOND, LAST_SECOND = -62_135_596_800, 253_402_300_799


def epoch_to_ts(seconds: Column) -> Column:
    """Unix seconds to a timestamp; null outside the years 1 to 9999."""
    return F.when(seconds.between(FIRST_SECOND, LAST_SECOND), F.timestamp_seconds(seconds))


def binary_label(score: Column) -> Column:
    """0 for ratings 1-2, 1 for ratings 4-5, null between."""
    return F.when(score <= 2, 0).when(score >= 4, 1).cast("int")


def sentiment_class(score: Column) -> Column:
    return F.when(score <= 2, "negative").when(score == 3, "neutral").otherwise("positive")


def helpfulness_ratio(numerator: Column, denominator: Column) -> Column:
    return F.when(denominator > 0, numerator.cast("double") / denominator.cast("double"))


def help_weight(df: DataFrame, column: str = "helpfulness_numerator") -> Column:
    """Helpful votes plus one; one for every review when the column is absent."""
    if column not in df.columns:
        return F.lit(1.0)
    return F.coalesce(F.col(column), F.lit(0)).cast("double") + 1.0


def polarity_class(polarity: Column) -> Column:
    return (
        F.when(polarity >= POSITIVE_FROM, "positive")
        .when(polarity <= NEGATIVE_TO, "negative")
        .otherwise("neutral")
    )


def polarity_bucket(polarity: Column) -> Column:
    return F.when(polarity.isNull(), NOT_MENTIONED).otherwise(polarity_class(polarity))


def predict_at(score: Column, threshold: float = 0.5) -> Column:
    return (score >= threshold).cast("int")


def present(df: DataFrame, columns: list[str]) -> list[str]:
    return [c for c in columns if c in df.columns]
