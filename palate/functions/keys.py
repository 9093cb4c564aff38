"""Record ids and the hash orders that replace random numbers.

A hash of the record key gives the same sample on every run, cluster and partition
count. ``xxhash64`` is the default; the hex digests exist in every SQL engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEPARATOR = "||"

#: Number of order-preserving buckets a hash order is cut into (2 ** 14, or 16 ** 4 for hex).
BUCKET_BITS = 14
HEX_DIGITS = 4


def record_id(*parts: Column) -> Column:
    """SHA-256 over the parts; a null part counts as empty, so the layout never shifts."""
    return F.sha2(F.concat_ws(SEPARATOR, *[F.coalesce(p, F.lit("")) for p in parts]), 256)


def sentence_id(record: Column, index: Column) -> Column:
    return F.sha2(F.concat_ws(SEPARATOR, record, index.cast("string")), 256)


def order_hash(*key: Column, kind: str = "xxhash64", seed: int | None = None) -> Column:
    """Pseudo-random but repeatable order value of a record key."""
    parts = ([F.lit(str(seed))] if seed is not None else []) + list(key)
    if kind == "xxhash64":
        return F.xxhash64(*parts)
    joined = F.concat_ws("|", *[p.cast("string") for p in parts])
    if kind == "md5":
        return F.md5(joined)
    if kind == "sha2":
        return F.sha2(joined, 256)
    raise ValueError(f"unknown hash order: {kind}")


def order_bucket(value: Column, kind: str) -> Column:
    """Leading bits of an order value: sorting by bucket never contradicts sorting by value."""
    if kind == "xxhash64":
        return F.shiftright(value, 64 - BUCKET_BITS)
    return F.substring(value, 1, HEX_DIGITS)


def hash_below(value: Column, fraction: float, kind: str) -> Column:
    """True for about ``fraction`` of all order values; nested for growing fractions."""
    if fraction >= 1.0:
        return value.isNotNull()
    if fraction <= 0.0:
        return F.lit(False)
    if kind == "xxhash64":
        return value < F.lit(int(fraction * 2**64) - 2**63).cast("long")
    return F.substring(value, 1, 8) < f"{int(fraction * 2**32):08x}"


def text_key(text: Column) -> list[Column]:
    """Grouping keys for a long text: an 8-byte hash settles nearly every comparison of
    the sort, and the text itself keeps the grouping exact."""
    return [F.xxhash64(text), text]


def text_digest(text: Column) -> Column:
    """32 bytes that stand for a whole text in distinct counts."""
    return F.unhex(F.sha2(text, 256))


def _unhashable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_unhashable(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _unhashable(kind.elementType)
    return isinstance(kind, (T.MapType, T.VariantType))


def row_hash(df: DataFrame) -> Column:
    """Hash of a whole row, by column names and not by their order; maps and variants by their JSON,
    as Spark hashes neither."""
    fields = sorted(df.schema, key=lambda f: f.name)
    named = {f.name: F.col("`" + f.name.replace("`", "``") + "`") for f in fields}
    return F.xxhash64(*[F.to_json(F.struct(named[f.name])) if _unhashable(f.dataType) else named[f.name] for f in fields])
