"""Keep one row per group.

Where texts are part of the key, whole rows are neither sorted nor compared: rows are stored once and
numbered, the winners are chosen among narrow rows (keys, a digest of the text, order, number), and the
losers, found by number, are left out. Digests of 256 bits stand for the texts: equal texts have equal
digests, and different ones do not share one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from palate.functions.keys import text_digest
from palate.sources.staging import stage


#: Numbers of rows that are sent to every task, at most.
MAX_BROADCAST_ROWS = 200_000


def first_per_group(df: DataFrame, keys: list[Column], order: list[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each group.

    Spark limits each group inside every map task before the shuffle (WindowGroupLimit),
    so a group that holds a third of the table sends ``n`` rows per task, not all of them.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") <= n).drop("_rank")


def first_per_text(df: DataFrame, text: str | Column, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each group of equal ``text`` (a column or what is derived from it) and ``keys``; of
    rows equal in ``order`` any one.

    No text is shuffled while few rows are there or few are dropped (the numbers of up to
    ``MAX_BROADCAST_ROWS`` winners or losers are sent to every task); with more the stored rows meet the
    winners' numbers, which are spread evenly however large a group is.
    """
    seen = Observation()
    rows = stage(df.observe(seen, F.count(F.lit(1)).alias("rows")).withColumn("_place", F.monotonically_increasing_id()), "dedup")
    keyed = rows.select("_place", text_digest(F.col(text) if isinstance(text, str) else text).alias("_text"), *[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], *[o.alias(f"_by{i}") for i, o in enumerate(order)])
    firsts = first_per_group(keyed, [F.col("_text"), *[F.col(f"_key{i}") for i in range(len(keys))]], [*[F.col(f"_by{i}") for i in range(len(order))], F.col("_place")])
    if seen.get["rows"] <= MAX_BROADCAST_ROWS:
        return rows.join(F.broadcast(firsts.select("_place")), "_place", "left_semi").drop("_place")
    losers = rows.select("_place").join(firsts.select("_place"), "_place", "left_anti")
    few = losers.limit(MAX_BROADCAST_ROWS + 1).collect()
    if len(few) > MAX_BROADCAST_ROWS:
        return rows.join(firsts.select("_place"), "_place", "left_semi").drop("_place")
    numbers = df.sparkSession.createDataFrame(few, "_place long")
    return rows.join(F.broadcast(numbers), "_place", "left_anti").drop("_place")


def dedup_product(df: DataFrame) -> DataFrame:
    """One row per product, user, time and text: the lowest id stays. Where the normalized text is not
    given, it is the clean one in lower case."""
    normalized = "normalized_text" if "normalized_text" in df.columns else F.lower("review_text_clean")
    return first_per_text(df, normalized, ["product_id", "user_id", "review_time_epoch"], [F.col("id"), F.col("_record_id")])


def dedup_text(df: DataFrame) -> DataFrame:
    """One row per text: the copy with most votes stays, then the lowest id."""
    # ids are wanted largest last: every order column ascends
    order = [-F.col("helpfulness_denominator"), F.col("id"), F.col("_record_id")]
    return first_per_text(df, "normalized_text", [], order)


def dedup_exact(df: DataFrame, keys: list[str], order: list[str], text: str | None = None) -> DataFrame:
    """One row per key; ``order`` decides which, so reruns agree."""
    columns = [F.col(o) for o in order]
    if text:
        return first_per_text(df, text, keys, columns)
    return first_per_group(df, [F.col(k) for k in keys], columns)
