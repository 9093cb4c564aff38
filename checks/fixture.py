"""Reviews made from the given tables: prose and copies from documents, markup from pages."""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palate.functions.polarity import PolarityRules
from palate.plans import layers
from palate.session import configure
from palate.sources.staging import spread

# Words that occur in the generated prose of the test tables.
ASPECTS = {
    "taste": ["with", "this"],
    "freshness": ["from"],
    "packaging": ["was", "are"],
    "delivery": ["that"],
    "price": ["for"],
}
POLARITY = PolarityRules(
    valence={"this": 2.0, "with": 0.8, "for": 1.0, "that": -1.5, "was": -2.0, "from": -0.5},
    negators=["are", "in"],
    boosters={"and": 0.293, "to": 0.293, "of": -0.293},
    contrast=["by"],
)


STOP_WORDS = ["the", "of", "and", "that"]


def long_lists() -> dict[str, list[str]]:
    """Some 35,000 phrases: all of three letters, and each after the word "of"."""
    three = [a + b + c for a in string.ascii_lowercase for b in string.ascii_lowercase for c in string.ascii_lowercase]
    return {"three": three, "of_three": [f"of {t}" for t in three]}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{folder}/{name}.parquet")


def reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Raw reviews with their source name.

    Every document is a review. Every tenth stands a second time under another id, as
    repeated rows do in real files, so the table is larger than its sources, not a part
    of them. One pass over the documents makes both.
    """
    docs = spread(table(spark, folder, "documents")).join(table(spark, folder, "labels"), "doc_id", "left")
    copies = F.when(F.col("doc_id") % 10 == 0, F.array(F.lit(0), F.lit(1_000_000))).otherwise(F.array(F.lit(0)))
    from_docs = docs.select(
        F.col("doc_id").alias("k"),
        F.explode(copies).alias("shift"),
        F.col("source").alias("product_id"),
        F.col("text").alias("body"),
        F.lit("documents").alias("src"),
        F.col("quality").alias("q"),
        F.col("toxic").alias("tx"),
    )
    from_pages = spread(table(spark, folder, "pages")).select(
        F.col("page_id").alias("k"),
        F.lit(2_000_000).alias("shift"),
        F.concat(F.lit("src"), (F.col("page_id") % 20).cast("string")).alias("product_id"),
        F.col("html").alias("body"),
        F.lit("pages").alias("src"),
        F.lit(None).cast("int").alias("q"),
        F.lit(None).cast("int").alias("tx"),
    )
    k = F.col("k")
    rating = (
        F.when(k % 41 == 40, "x").when(F.col("q") == 0, (1 + F.col("tx")).cast("string")).otherwise((1 + k % 5).cast("string"))
    )
    seconds = F.when(k % 50 == 49, "n/a").when(k % 61 == 60, "999999999999999999").otherwise((F.lit(939340800) + (k % 156) * 2592000).cast("string"))
    return from_docs.unionByName(from_pages).select(
        (k + F.col("shift")).cast("string").alias("Id"),
        F.col("product_id").alias("ProductId"),
        F.concat(F.lit("u"), (k % 97).cast("string")).alias("UserId"),
        F.concat(F.lit("user "), (k % 97).cast("string")).alias("ProfileName"),
        (k % 7).cast("string").alias("HelpfulnessNumerator"),
        (k % 13).cast("string").alias("HelpfulnessDenominator"),
        rating.alias("Score"),
        seconds.alias("Time"),
        F.substring("body", 1, 40).alias("Summary"),
        F.col("body").alias("Text"),
        F.col("src").alias("source_file"),
    )


def bronze(spark: SparkSession, folder: str) -> DataFrame:
    return layers.to_bronze(reviews(spark, folder), F.col("source_file"))


def silver(spark: SparkSession, folder: str) -> DataFrame:
    return layers.to_silver(bronze(spark, folder))


def model_input(spark: SparkSession, folder: str) -> DataFrame:
    return layers.model_input(silver(spark, folder), order="sha2")


def sentences(spark: SparkSession, folder: str) -> DataFrame:
    unread = ("review_text", "summary", "profile_name", "review_time_raw", "_source_file")
    return layers.aspect_sentences(layers.to_silver(bronze(spark, folder), leave_out=unread))
