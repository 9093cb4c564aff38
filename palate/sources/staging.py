"""Results that several jobs reuse, and broadcasts whose size is checked."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows a collected side may hold before it is joined as a table instead of broadcast.
MAX_BROADCAST_ROWS = 200_000
#: Spark's setting that deletes the shuffle files of a query at its end.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@lru_cache(maxsize=1)
def _local_scratch() -> str:
    path = tempfile.mkdtemp(prefix="palate-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; a temporary one only in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return _local_scratch()


_staged: list[str] = []


def staging_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_folder(spark)}/palate/{name}-{uuid.uuid4().hex}"
    _staged.append(path)
    return path


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside are deleted at the end: write or collect every result before that."""
    start = len(_staged)
    try:
        yield
    finally:
        drop_staged(spark, start)


def staged_count() -> int:
    """Tables staged so far and not yet deleted: what :func:`drop_staged` counts from."""
    return len(_staged)


def drop_staged(spark: SparkSession, start: int = 0, stop: int | None = None) -> int:
    """Delete the tables staged so far (from the ``start``-th, up to the ``stop``-th), once no result
    needs them any more."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    settings = spark.sparkContext._jsc.hadoopConfiguration()
    dropped = 0
    for name in reversed(_staged[start:stop]):
        path = hadoop(name)
        dropped += path.getFileSystem(settings).delete(path, True)
    del _staged[start:stop]
    return dropped


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is planned and run inside go at the end of each query."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def stage(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write once, read many times.

    Lineage ends at the files, so a lost executor costs a re-read and not the whole plan,
    and each later pass reads only the columns it needs. The shuffle files of the write go with it.
    ``codec`` compresses the files otherwise than the session does.
    """
    spark = df.sparkSession
    path = staging_path(spark, name)
    with shuffles_deleted(spark):
        df.write.options(**({"compression": codec} if codec else {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checked_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` if it holds at most ``max_rows`` rows, else leave the join to Spark.

    One row more than the bound is fetched, never the whole of a large side.
    """
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def spread(df: DataFrame) -> DataFrame:
    """Give a scan of one unsplittable file to all cores; a wide scan stays as it is."""
    target = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(target) if df.rdd.getNumPartitions() < target else df
