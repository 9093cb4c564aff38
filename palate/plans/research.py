"""Letters-only reviews with a binary label, and their train, balanced and natural test sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palate.functions import keys, labels, text
from palate.operators import sampling
from palate.operators.dedup import dedup_exact
from palate.sources.staging import stage

RESEARCH_COLUMNS = [
    "clean_text", "label", "Score", "HelpfulnessNumerator", "HelpfulnessDenominator", "ProductId", "Time",
]


def research_clean(raw: DataFrame) -> DataFrame:
    """Reviews of known rating, one per user, time and text, cleaned to letters.

    ``row_id`` is a hash of the identifying fields and the text, so that it does not
    depend on the plan; it takes the place of a generated row number.
    """
    numbers = {
        c: labels.safe_integral(F.col(c).cast("string"), "int")
        for c in ("Score", "HelpfulnessNumerator", "HelpfulnessDenominator")
    }
    usable = (
        raw.na.drop(subset=["Text", "Score"])
        .withColumns(numbers)
        .filter(F.col("HelpfulnessNumerator") <= F.col("HelpfulnessDenominator"))
        .withColumn("_id", labels.safe_integral(F.col("Id").cast("string"), "bigint"))
    )
    # the label depends on the rating alone, but copies may differ in it: dedup comes first
    labelled = (
        dedup_exact(usable, ["UserId", "Time"], ["_id", "ProductId"], text="Text")
        .withColumn("label", labels.binary_label(F.col("Score")))
        .filter(F.col("label").isNotNull())
    )
    identity = [F.col(c).cast("string") for c in ("Id", "ProductId", "UserId", "Time", "Text")]
    # explode keeps the length test above the cleaning, which then runs once per text
    cleaned = labelled.withColumns(
        {"row_id": keys.record_id(*identity), "clean_text": F.explode(F.array(text.clean_letters(F.col("Text"))))}
    )
    return cleaned.filter(F.length("clean_text") > 3).select("row_id", *RESEARCH_COLUMNS)


def class_balance(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows and share of each class, in one pass."""
    positive = F.sum(F.when(F.col(label) == 1, 1).otherwise(0))
    negative = F.sum(F.when(F.col(label) == 0, 1).otherwise(0))
    total = F.count(F.lit(1))
    return df.agg(
        total.alias("total"),
        positive.alias("positives"),
        negative.alias("negatives"),
        (positive / total).alias("positive_share"),
        (negative / total).alias("negative_share"),
    )


def balancing_fractions(positives: int, negatives: int, rows: int = 150_000) -> dict[int, float]:
    """Fraction of each class that gives half of ``rows``, never above 1."""
    half = rows // 2
    return {1: min(1.0, half / max(positives, 1)), 0: min(1.0, half / max(negatives, 1))}


def research_splits(
    df: DataFrame,
    rows: int = 150_000,
    natural_rows: int | None = 15_000,
    kind: str = "xxhash64",
    seed: int = 42,
    leave_out: str = "sample",
) -> dict[str, DataFrame]:
    """Train and balanced test from a balanced sample, natural test from the rest.

    ``leave_out="sample"`` keeps all three sets disjoint. ``"train"`` leaves only the
    train rows out of the pool, so the natural test may share rows with the balanced one.
    ``natural_rows=None`` takes the whole pool, at its own balance, as the natural test.
    """
    df = stage(df, "research")
    balance = class_balance(df).first()
    total, positives, negatives = balance["total"], balance["positives"] or 0, balance["negatives"] or 0
    fractions = balancing_fractions(positives, negatives, rows)
    sample = sampling.stratified_sample(df, "label", fractions, "row_id", kind, seed)
    split = sampling.hash_split(sample, "row_id", {"train": 0.8, "test": 0.2}, "part", kind, seed + 100)
    train = split.filter(F.col("part") == "train").drop("part")
    if leave_out == "sample":  # the sample is a hash threshold, so what it leaves is a filter
        pool = sampling.pool_outside(df, "label", fractions, "row_id", kind, seed)
    else:
        pool = sampling.holdout_pool(df, train)
    if natural_rows is None:
        natural = pool
    else:
        share = positives / max(total, 1)
        left = {r["label"]: r["count"] for r in pool.groupBy("label").count().collect()}
        quotas = {
            1: min(left.get(1, 0), round(natural_rows * share)),
            0: min(left.get(0, 0), natural_rows - round(natural_rows * share)),
        }
        natural = sampling.take_quota(pool, "label", quotas, "row_id", kind, seed + 1)
    return {
        "train": sampling.shuffle(train, "row_id", kind, seed),
        "balanced_test": split.filter(F.col("part") == "test").drop("part"),
        "natural_test": natural,
    }
