"""Publication of a layer that cannot destroy what is published.

A new version is written beside the published one, proven, and only then named in a manifest, which
is replaced in one step. Readers follow the manifest (:func:`located`), so they see the former
version whole or the new one whole; a write that fails, or a version that is not what was meant to
be written, changes nothing for them.

The proof compares two checksums over the content: one observed while the rows are written, in the
same pass, and one of what is read back. A checksum is the number of rows and the sum of a 64-bit hash
of each, so it depends neither on order nor on files; a lost, doubled or changed row is found.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palate.functions.keys import row_hash

VERSIONS, MANIFEST = "_versions", "_current.json"


@dataclass(frozen=True)
class Version:
    """What the manifest says of the published version."""

    name: str
    rows: int
    checksum: str
    schema: str
    previous: str | None
    written_at: float


class Rejected(ValueError):
    """A version that was not published; what was published before still is."""


def _files(spark: SparkSession, path: str) -> tuple:
    """The file system of ``path``, and a maker of paths."""
    maker = spark._jvm.org.apache.hadoop.fs.Path
    return maker(path).getFileSystem(spark._jsc.hadoopConfiguration()), maker


def current(spark: SparkSession, path: str) -> Version | None:
    """The published version of ``path``; None if nothing was published there."""
    files, at = _files(spark, path)
    manifest = at(f"{path}/{MANIFEST}")
    if not files.exists(manifest):
        return None
    stream = files.open(manifest)
    try:
        return Version(**json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
    finally:
        stream.close()


def located(spark: SparkSession, path: str) -> str:
    """The folder of the published version, or ``path`` itself where it is a plain table."""
    found = current(spark, path)
    return f"{path}/{VERSIONS}/{found.name}" if found else path


def checksum_of(df: DataFrame) -> list[Column]:
    """Rows and content of ``df``, as aggregates."""
    return [F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(row_hash(df).cast("decimal(38,0)")), F.lit(0)).cast("string").alias("checksum")]


def _switch(spark: SparkSession, path: str, version: Version) -> None:
    """Make ``version`` the published one, in one step."""
    files, at = _files(spark, path)
    beside, manifest = at(f"{path}/{VERSIONS}/{version.name}.json"), at(f"{path}/{MANIFEST}")
    stream = files.create(beside, True)
    try:
        stream.write(bytearray(json.dumps(asdict(version)).encode()))
    finally:
        stream.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    options = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
    options[0] = getattr(hadoop, "Options$Rename").OVERWRITE
    hadoop.FileContext.getFileContext(manifest.toUri(), spark._jsc.hadoopConfiguration()).rename(beside, manifest, options)


def publish(
    df: DataFrame, path: str, partition_by: list[str] | None = None, expect: int | None = None, rules: Mapping[str, Column] | None = None
) -> Version:
    """Write ``df`` as a new version of ``path``, prove it and publish it.

    It must not be empty, must read back as it was written, must have ``expect`` rows where that is
    given, and every row must satisfy every rule (a condition that is null counts as broken). Otherwise
    :class:`Rejected` is raised, the version removed, and the former one stays published. So it does if
    another version was published meanwhile.
    """
    spark = df.sparkSession
    before = current(spark, path)
    name = f"v-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    folder, seen = f"{path}/{VERSIONS}/{name}", Observation()
    files, at = _files(spark, path)
    try:
        writer = df.observe(seen, *checksum_of(df)).write.option("compression", "snappy")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(folder)
        written = seen.get
        if not written["rows"]:
            raise Rejected(f"nothing to write to {path}")
        back = spark.read.schema(df.schema).parquet(folder)
        broken = {r: F.count_if(~F.coalesce(test, F.lit(False))).alias(f"rule {i}") for i, (r, test) in enumerate((rules or {}).items())}
        stored = back.agg(*checksum_of(back), *broken.values()).first()
        if (stored["rows"], stored["checksum"]) != (written["rows"], written["checksum"]):
            raise Rejected(f"{path}: wrote {written['rows']} rows of checksum {written['checksum']}, read back {stored['rows']} of {stored['checksum']}")
        if expect is not None and stored["rows"] != expect:
            raise Rejected(f"{path}: expected {expect} rows, got {stored['rows']}")
        failed = {r: stored[f"rule {i}"] for i, r in enumerate(broken) if stored[f"rule {i}"]}
        if failed:
            raise Rejected(f"{path}: rows that break a rule: {failed}")
        if current(spark, path) != before:
            raise Rejected(f"{path}: another version was published meanwhile")
    except BaseException:
        files.delete(at(folder), True)
        raise
    version = Version(name, stored["rows"], stored["checksum"], df.schema.json(), before.name if before else None, time.time())
    _switch(spark, path, version)
    return version


def check(spark: SparkSession, path: str) -> bool:
    """Whether the published version still is what was written."""
    found = current(spark, path)
    if found is None:
        raise ValueError(f"nothing is published at {path}")
    table = spark.read.schema(T.StructType.fromJson(json.loads(found.schema))).parquet(located(spark, path))
    now = table.agg(*checksum_of(table)).first()
    return (now["rows"], now["checksum"]) == (found.rows, found.checksum)


def versions(spark: SparkSession, path: str) -> list[str]:
    """Names of the versions that are stored, oldest first."""
    files, at = _files(spark, path)
    folder = at(f"{path}/{VERSIONS}")
    return sorted(f.getPath().getName() for f in files.listStatus(folder) if f.isDirectory()) if files.exists(folder) else []


def remove_old(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Delete stored versions but for the published one and the ``keep - 1`` before it. Readers of an
    old version may still be running: call this when none can be."""
    files, at = _files(spark, path)
    found = current(spark, path)
    stored = versions(spark, path)
    kept = {n for n in stored if found and n <= found.name}
    kept = set(sorted(kept)[-keep:]) | ({found.name} if found else set())
    gone = [n for n in stored if n not in kept]
    for n in gone:
        files.delete(at(f"{path}/{VERSIONS}/{n}"), True)
    return gone
