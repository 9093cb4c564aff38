"""The dealt operators as registered queries, with SQL twins where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palate.llm import (
    bpe_prefix,
    divergence_rules,
    fair_mix,
    learned_partitions,
    merkle,
    near_duplicates,
    packing,
    personal_data,
    quality_ranker,
    repeated_passages,
    sharding,
    token_counts,
    whitening,
)
from palate.llm.oracle import ORACLE as ORACLE

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(make: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[make.__name__] = make
    return make


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % 5 == 0


@query
def op1_quality_ranker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; labels of held-out ids are not seen by the fit."""
    documents = table(spark, sf_dir, "documents")
    ranker = quality_ranker.train_ranker(documents, table(spark, sf_dir, "labels"), ~held_out())
    return quality_ranker.score_documents(documents, ranker).select("doc_id", held_out().alias("held_out"), "score", "predicted")


@query
def op2_divergence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and distance from the language's histograms, for every document."""
    return divergence_rules.judged(table(spark, sf_dir, "documents"))


@query
def op8_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents over 40 equal shards, and where each goes when a 41st is added."""
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32"),
        F.lit("key").alias("law"),
        sharding.shard_of(F.col("doc_id"), [1.0] * 41).alias("grown_shard"),
    )
    placed = sharding.sharded(rows, "doc_id", [1.0] * 40, order=["text_crc32", "size"])
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


@query
def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every whole text."""
    found = personal_data.with_spans(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    of = lambda kind: F.filter("spans", lambda s: s["kind"] == kind)
    base = F.filter("spans", lambda s: s["kind"].isin(personal_data.BASE_KINDS))
    return found.select(
        "doc_id",
        *[F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in personal_data.BASE_KINDS],
        F.sha2(personal_data.listed(base), 256).alias("base_sha256"),
        personal_data.listed(F.col("spans")).alias("spans"),
        F.size("spans").cast("long").alias("n_spans"),
        F.array_max(F.transform("spans", lambda s: s["score"])).alias("top_score"),
    )


@query
def op3_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in the buckets and batches with the least padding."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return packing.packed(token_counts.counted(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN))


@query
def op5_bpe_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text, and the text they decode to, as digests."""
    return bpe_prefix.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document; a token over a line break goes where most of it is."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return token_counts.attributed(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


@query
def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of near duplicates of every document."""
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op7_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that a passage of an earlier document repeats, and what is kept."""
    documents = table(spark, sf_dir, "documents")
    changed = repeated_passages.without_repeats(documents, joined=True)
    changed = changed.select("doc_id", "sig", "n_removed", F.sha2("kept", 256).alias("changed_sha256"))
    words = repeated_passages.word_list(F.col("text"))
    rows = repeated_passages.keyed(documents).select("doc_id", "sig", words.alias("words"))
    rows = rows.select("doc_id", "sig", F.size("words").cast("long").alias("n_words"), F.sha2(F.array_join("words", " "), 256).alias("whole_sha256"))
    return rows.join(changed, ["doc_id", "sig"], "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("changed_sha256", "whole_sha256").alias("kept_sha256"),
    )


@query
def op10_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors found for every fiftieth vector."""
    return learned_partitions.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


@query
def op11_fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of all sources at weights 1, 2, 3 takes of every document."""
    return fair_mix.taken(table(spark, sf_dir, "documents"))


@query
def op12_spectral_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the 16 greatest components, whitened."""
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proof of every document, and whether it still holds where line breaks were deleted."""
    cut = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return merkle.manifest(table(spark, sf_dir, "documents"), cut)
