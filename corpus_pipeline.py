"""From raw documents to packed training pieces: five stages, each one of the library's operators.

Every stage takes (spark, docs, sf_dir) and returns a frame that is written and read again as
the next stage's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from palate.llm import near_duplicates, packing, personal_data, quality_ranker, repeated_passages, token_counts
from palate.sources.staging import stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pairwise ranker predicts good; labels come from the labels table."""
    ranker = quality_ranker.train_ranker(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = quality_ranker.score_documents(docs.select(*COLUMNS), ranker, tuple(COLUMNS))
    return scored.filter(F.col("predicted") == 1).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest doc_id. A repeated
    row is a copy like any other, and texts of one doc_id are judged each for itself; rows without a
    doc_id stay."""
    kept = near_duplicates.verdicts(docs).filter("kept and doc_id is not null").select("doc_id", "version").distinct()
    one = near_duplicates.versioned(docs.select(*COLUMNS)).join(kept, ["doc_id", "version"], "left_semi")
    same_id = Window.partitionBy("doc_id", "version").orderBy("n_chars")  # same placing as the join
    one = one.withColumn("_copy", F.row_number().over(same_id)).filter("_copy = 1")
    return one.select(*COLUMNS).union(docs.filter("doc_id is null").select(*COLUMNS))


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier document has; spacing of the rest stays."""
    changed = repeated_passages.without_repeats(docs).select("doc_id", "sig", "kept")
    rows = docs.select(*COLUMNS).withColumn("sig", repeated_passages.signature(F.col("text"))).join(changed, ["doc_id", "sig"], "left")
    text = F.coalesce("kept", "text")
    size = F.when(F.col("kept").isNull(), F.col("n_chars")).otherwise(F.length("kept").cast("long"))
    return rows.select("doc_id", text.alias("text"), "lang", "source", size.alias("n_chars"))


def personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with every span of personal data replaced by the name of its kind."""
    hidden = personal_data.masked(docs.select(*COLUMNS).withColumn("_before", F.col("text")))
    same = F.col("text").eqNullSafe(F.col("_before"))
    return hidden.withColumn("n_chars", F.when(same, F.col("n_chars")).otherwise(F.length("text").cast("long"))).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, with bucket, padded length, batch and slot."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return packing.packed(token_counts.counted(docs, path, public_tokenizers.PATTERN))


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("passages", passages), ("personal_data", personal), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage; every stage's result is written before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: The ranker and the tokenizer are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None
