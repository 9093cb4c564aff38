"""Layer tables, reports and raw files."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palate.sources.publish import located, publish
from palate.sources.staging import spread

# Columns of a raw review file, in file order.
RAW_COLUMNS = [
    "Id", "ProductId", "UserId", "ProfileName", "HelpfulnessNumerator",
    "HelpfulnessDenominator", "Score", "Time", "Summary", "Text",
]
RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS])


def require_columns(df: DataFrame, columns: Iterable[str], what: str = "input") -> DataFrame:
    """The frame itself, or an error that lists every missing column in order."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"{what} lacks required columns: {missing}")
    return df


def read_raw(spark: SparkSession, path: str, infer: bool = False, corrupt_column: str | None = None) -> DataFrame:
    """Raw review CSV: header, quoted line breaks, doubled quotes, malformed rows kept.

    Columns stay text unless ``infer``. A header in another order is an error, not a
    silent shift. ``corrupt_column`` names a column that keeps the text of bad rows.
    A file with quoted line breaks is read by one task, so the rows are spread after it;
    the file name is taken before that.
    """
    reader = spark.read.options(header=True, multiLine=True, quote='"', escape='"', mode="PERMISSIVE")
    if infer:
        frame = reader.option("inferSchema", True).csv(path)
    else:
        schema = RAW_SCHEMA
        if corrupt_column:
            schema = T.StructType([*RAW_SCHEMA.fields, T.StructField(corrupt_column, T.StringType())])
            reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
        frame = reader.schema(schema).option("enforceSchema", False).csv(path)
    require_columns(frame, RAW_COLUMNS, "raw file")
    return spread(frame.select("*", F.input_file_name().alias("_source_file")))


def read_layer(spark: SparkSession, path: str, columns: Iterable[str] = ()) -> DataFrame:
    """A Parquet layer, or its published version; ``columns`` is the contract the caller relies on."""
    return require_columns(spark.read.parquet(located(spark, path)), columns, path)


def read_columns(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """The named columns of every Parquet file at any depth below ``path``."""
    files = spark.read.options(recursiveFileLookup=True, pathGlobFilter="*.parquet").parquet(located(spark, path))
    return require_columns(files, columns, path).select(*columns)


def read_splits(spark: SparkSession, path: str, *splits: str) -> DataFrame:
    """A table partitioned by ``dataset_split``; other splits' folders are not listed."""
    table = require_columns(spark.read.parquet(located(spark, path)), ["dataset_split"], path)
    return table.filter(F.col("dataset_split").isin(*splits)) if splits else table


def write_layer(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """A plain folder of files that replaces what stood there; see :func:`verified_write` for layers
    that others read."""
    writer = df.write.mode("overwrite").option("compression", "snappy")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def verified_write(
    df: DataFrame, path: str, partition_by: list[str] | None = None, expect: int | None = None, rules: Mapping[str, Column] | None = None
) -> int:
    """Publish a layer and prove it: not empty, the same rows and values read back as were written, as
    many as ``expect`` and all within ``rules`` where these are given. The plan runs once. Until all of
    that holds, readers see the former layer; a write that fails leaves it as it was."""
    return publish(df, path, partition_by, expect, rules).rows


def write_report(df: DataFrame, path: str) -> None:
    """A small finished report as one CSV file with a header; the plan above it stays spread."""
    as_is = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.repartition(1).write.mode("overwrite").options(header=True, quote='"', escape='"', **as_is).csv(path)


def write_metrics(df: DataFrame, path: str) -> None:
    """Small nested metrics as one JSON file."""
    df.repartition(1).write.mode("overwrite").json(path)
