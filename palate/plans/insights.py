"""Reports over per-review aspect sentiment in long form.

Each input row is one review and aspect: ``aspect``, ``compound``, ``sentiment``, plus
the review's product, votes and time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palate.functions import labels
from palate.functions.polarity import PolarityRules
from palate.operators import aspects
from palate.sources.staging import scope, stage
from palate.sources.tables import write_metrics, write_report


def _mentioned() -> Column:
    return F.col("sentiment") != labels.NOT_MENTIONED


def _is(sentiment: str) -> Column:
    """1.0 or 0.0 for a mention, null for a review that does not mention the aspect."""
    return F.when(_mentioned(), (F.col("sentiment") == sentiment).cast("double"))


def aspect_coverage(long: DataFrame) -> DataFrame:
    """Share of reviews that mention an aspect, and how these mentions divide."""
    return long.groupBy("aspect").agg(
        F.avg(_mentioned().cast("double")).alias("mentioned"),
        F.coalesce(F.avg(_is("positive")), F.lit(0.0)).alias("pct_positive"),
        F.coalesce(F.avg(_is("negative")), F.lit(0.0)).alias("pct_negative"),
    )


def aspect_ranking(long: DataFrame) -> DataFrame:
    """What to fix first: the share of mentions that are negative, plain and weighted by
    helpful votes. Every review is in the input once per aspect, so one pass also knows
    the mention rate. Aspects without a mention are left out."""
    weight = F.when(_mentioned(), labels.help_weight(long))
    negative_weight = F.when(F.col("sentiment") == "negative", labels.help_weight(long)).otherwise(0.0)
    return (
        long.groupBy("aspect")
        .agg(
            F.count(F.when(_mentioned(), 1)).alias("mentions"),
            F.avg(_mentioned().cast("double")).alias("mention_rate"),
            F.avg(_is("negative")).alias("pct_negative"),
            F.avg(_is("positive")).alias("pct_positive"),
            F.try_divide(F.sum(negative_weight), F.sum(weight)).alias("weighted_pct_negative"),
        )
        .filter(F.col("mentions") > 0)
        .orderBy(F.desc("weighted_pct_negative"), "aspect")
    )


def aspect_trend(long: DataFrame, time: str = "review_timestamp") -> DataFrame:
    """Negative share of mentions per aspect and year; mentions without a year are left out."""
    dated = long.filter(_mentioned()).withColumn("year", F.year(time)).filter(F.col("year").isNotNull())
    return dated.groupBy("aspect", "year").agg(F.avg(_is("negative")).alias("pct_negative")).orderBy("aspect", "year")


def product_breakdown(long: DataFrame, aspects: list[str], n: int = 5) -> DataFrame:
    """Negative share per aspect for the ``n`` products with most reviews; null if not mentioned."""
    reviews = F.sum(F.when(F.col("aspect") == aspects[0], 1).otherwise(0))
    per_aspect = [F.avg(F.when(F.col("aspect") == a, _is("negative"))).alias(a) for a in aspects]
    rows = long.groupBy("product_id").agg(reviews.alias("n_reviews"), *per_aspect)
    return rows.orderBy(F.desc("n_reviews"), "product_id").limit(n)


def headlines(ranking: DataFrame) -> DataFrame:
    """Worst aspect, best-liked aspect, and the one where votes change the picture most."""
    gap = F.abs(F.col("weighted_pct_negative") - F.col("pct_negative"))

    def first_by(value: Column, name: str) -> Column:
        # a tie goes to the aspect that comes first in the alphabet
        return F.struct(F.lit(name).alias("headline"), F.min(F.struct((-F.round(value, 9)).alias("rank"), "aspect", value.alias("value"))).alias("m"))

    tops = F.array(
        first_by(F.col("weighted_pct_negative"), "biggest_pain_point"),
        first_by(F.col("pct_positive"), "strongest_positive"),
        first_by(gap, "most_endorsed_complaint"),
    )
    picked = ranking.agg(tops.alias("t")).select(F.inline("t"))
    return picked.select("headline", F.col("m.aspect").alias("aspect"), F.col("m.value").alias("value"))


def worst_trends(long: DataFrame, n: int = 4) -> DataFrame:
    """Yearly series of the ``n`` aspects that rank worst, with at least two years of data.

    One pass counts mentions and votes per aspect and year; ranking and series both follow from
    these few rows.
    """
    weight = labels.help_weight(long)
    negative = (F.col("sentiment") == "negative").cast("int")
    counted = long.filter(_mentioned()).groupBy("aspect", F.year("review_timestamp").alias("year")).agg(
        F.count(F.lit(1)).alias("mentions"), F.sum(negative).alias("negatives"), F.sum(weight).alias("weight"), F.sum(weight * negative).alias("negative_weight")
    )
    of_aspect = Window.partitionBy("aspect")
    share = F.sum("negative_weight").over(of_aspect) / F.sum("weight").over(of_aspect)
    ranked = counted.withColumns({"_share": share, "_years": F.count("year").over(of_aspect)})
    ranked = ranked.withColumn("_place", F.dense_rank().over(Window.orderBy(F.desc("_share"), "aspect")))  # a row per aspect and year
    kept = ranked.filter((F.col("_place") <= n) & F.col("year").isNotNull() & (F.col("_years") > 1))
    return kept.select("aspect", "year", (F.col("negatives") / F.col("mentions")).alias("pct_negative")).orderBy("aspect", "year")


@dataclass(frozen=True)
class Insights:
    """All reports over one scoring of the reviews."""

    coverage: DataFrame
    ranking: DataFrame
    trend: DataFrame
    worst: DataFrame
    products: DataFrame
    headlines: DataFrame


def insights(reviews: DataFrame, lexicon: aspects.Lexicon, rules: PolarityRules, text: str = "review_text_clean") -> Insights:
    """Score reviews once, keep the narrow result, derive every report from it."""
    columns = ["_record_id", "product_id", "helpfulness_numerator", "review_timestamp", text]
    scored = aspects.aspect_sentiment(reviews.select(*columns), lexicon, rules)
    long = stage(scored.drop(text), "insights")
    ranking = aspect_ranking(long)
    return Insights(aspect_coverage(long), ranking, aspect_trend(long), worst_trends(long), product_breakdown(long, list(lexicon)), headlines(ranking))


def run_insights(reviews: DataFrame, path: str, lexicon: aspects.Lexicon, rules: PolarityRules, text: str = "review_text_clean") -> None:
    """Score the reviews and store every report below ``path``; what was staged is deleted."""
    with scope(reviews.sparkSession):
        write_insights(insights(reviews, lexicon, rules, text), path)


def write_insights(found: Insights, path: str) -> None:
    """One CSV report per table, and the headlines as JSON."""
    for name in ("coverage", "ranking", "trend", "worst", "products"):
        write_report(getattr(found, name), f"{path}/{name}")
    write_metrics(found.headlines, f"{path}/headlines")
