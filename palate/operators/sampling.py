"""Splits and samples by hash order.

An exact share of a label class means: sort the class by a hash and cut it at a rank. A
window over the label would sort each class in one task. Here the cut is found instead
of the ranks: rows are counted per hash bucket, the bucket that holds the cut is ranked
alone, and every row is then compared with the order value found. The table itself is
neither sorted nor shuffled, and the result is that of the window, to the row.

The input is evaluated once: its rows are stored with their order, the search for the cuts reads
the order columns alone, and the result reads the stored rows. So a plan below that is costly, or
that gives another time or hash each time it runs, is no matter.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palate.functions.keys import hash_below, order_bucket, order_hash, row_hash
from palate.operators.dedup import first_per_group
from palate.operators.ranks import ranked_within
from palate.sources.staging import checked_broadcast, stage

#: Groups whose cuts are found by bucket counts on the driver. With more, rows are ranked over ranges.
MAX_CUT_GROUPS = 10_000

#: Order of rows within a group: hash of the key, hash of the tie column, hash of the whole row, and
#: a hash of the stored row's number, which no two rows share (the hash maps longs one to one).
ORDER = ["_order", "_tie", "_row", "_place"]
_LAST = 2**63 - 1


def _group_key(value: Column) -> Column:
    """A group as text that is never null, so that null labels form a group like any other."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit("null"))


def _ordered(df: DataFrame, by: str, key: str, tie: str | None, kind: str, seed: int | None, name: str) -> DataFrame:
    """The rows with group and order, stored."""
    rows = df.withColumns(
        {
            "_by": _group_key(F.col(by)) if by else F.lit("="),
            "_order": order_hash(F.col(key), kind=kind, seed=seed),
            "_tie": F.xxhash64(F.col(tie or key)),
            "_row": row_hash(df),
            "_place": F.xxhash64(F.monotonically_increasing_id()),
        }
    )
    return stage(rows, name)


def _locate(rows: DataFrame, targets: DataFrame, value: str, bucket: Column) -> DataFrame:
    """Order value at each wanted rank: ``(_by, cut, value, rank, ties)`` per target.

    ``rank`` becomes the rank among the ``ties`` rows that share the value.
    """
    running = Window.partitionBy("_by", "cut")
    counts = rows.groupBy("_by", bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("n"))
    found = (
        counts.join(F.broadcast(targets), "_by")
        .withColumn("upto", F.sum("n").over(running.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)))
        .filter((F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col("n") < F.col("rank")))
        .select("_by", "cut", "_bucket", (F.col("rank") - F.col("upto") + F.col("n")).alias("rank"))
    )
    found = checked_broadcast(found)
    inside = (
        rows.withColumn("_bucket", bucket)
        .join(found, ["_by", "_bucket"])
        .groupBy("_by", "cut", "rank", value)
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("upto", F.sum("n").over(running.orderBy(value).rowsBetween(Window.unboundedPreceding, 0)))
    )
    return inside.filter((F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col("n") < F.col("rank"))).select(
        "_by", "cut", value, (F.col("rank") - F.col("upto") + F.col("n")).alias("rank"), F.col("n").alias("ties")
    )


def _cuts(narrow: DataFrame, targets: list[tuple], kind: str) -> list[dict]:
    """Order values at the wanted ranks: one entry per (group, cut, rank), with the columns of ORDER as
    far down as needed to tell the rows at the cut apart.

    Rows that share a value are looked at one level deeper; each level counts in buckets like
    the first, so they never meet in one task. No two rows share the last one.
    """
    spark = narrow.sparkSession
    wanted = spark.createDataFrame(targets, "_by string, cut int, rank bigint")
    found = [r.asDict() for r in _locate(narrow, wanted, "_order", order_bucket(F.col("_order"), kind)).collect()]
    for depth, level in enumerate(ORDER[1:], 1):
        shared = [f for f in found if f["rank"] < f["ties"] and ORDER[depth - 1] in f]
        if not shared:
            break
        above = ORDER[:depth]
        kinds = {"_order": narrow.schema["_order"].dataType.simpleString()}
        at = spark.createDataFrame(
            [(f["_by"], f"{f['cut']}", *[f[c] for c in above]) for f in shared],
            ", ".join(["_by string", "_cut_name string", *[f"{c} {kinds.get(c, 'bigint')}" for c in above]]),
        )
        # one row per group and cut
        same = narrow.select("_by", *ORDER[: depth + 1]).join(F.broadcast(at), ["_by", *above]).withColumn("_by", F.concat_ws("#", "_by", "_cut_name"))
        again = spark.createDataFrame([(f"{f['_by']}#{f['cut']}", f["cut"], f["rank"]) for f in shared], "_by string, cut int, rank bigint")
        located = {r["_by"]: r for r in _locate(same, again, level, order_bucket(F.col(level), "xxhash64")).collect()}
        for f in shared:
            r = located[f"{f['_by']}#{f['cut']}"]
            f.update({level: r[level], "rank": r["rank"], "ties": r["ties"]})
    return found


def _mark(rows: DataFrame, ranks: dict, kind: str) -> DataFrame:
    """Adds ``_cut``: the first cut a stored row falls within, null beyond the last.

    ``ranks`` maps a group to its cumulative ranks, one per cut.
    """
    spark = rows.sparkSession
    found = _cuts(rows.select("_by", *ORDER), [(g, i, int(r)) for g, cuts in ranks.items() for i, r in enumerate(cuts) if r > 0], kind)
    entries = [(f["_by"], f["cut"], f["_order"], *[f.get(c, _LAST) for c in ORDER[1:]]) for f in found]
    order_type = rows.schema["_order"].dataType.simpleString()
    schema = f"_by string, cut int, _order {order_type}, " + ", ".join(f"{c} bigint" for c in ORDER[1:])
    # one row per group: an array of its bounds in cut order
    bounds = spark.createDataFrame(entries, schema).groupBy("_by").agg(F.sort_array(F.collect_list(F.struct("cut", *ORDER))).alias("_bounds"))

    def upto(bound: Column) -> Column:
        """Not beyond the bound, level by level."""
        test = F.col(ORDER[-1]) <= bound[ORDER[-1]]
        for c in reversed(ORDER[:-1]):
            test = (F.col(c) < bound[c]) | ((F.col(c) == bound[c]) & test)
        return test

    marked = rows.join(checked_broadcast(bounds), "_by", "left")
    return marked.withColumn("_cut", F.get(F.filter("_bounds", upto), F.lit(0))["cut"]).drop("_bounds")


def _group_sizes(rows: DataFrame) -> dict | None:
    """Rows per group, or None when there are too many groups to list."""
    sizes = rows.groupBy("_by").agg(F.count(F.lit(1)).alias("n")).limit(MAX_CUT_GROUPS + 1).collect()
    return {r["_by"]: r["n"] for r in sizes} if len(sizes) <= MAX_CUT_GROUPS else None


def share_rank(share: float, total: int) -> int:
    """Largest rank whose share of ``total`` does not exceed ``share``."""
    rank = int(share * total)
    if rank < total and (rank + 1) / total <= share:
        return rank + 1
    return rank - 1 if rank and rank / total > share else rank


def stratified_split(
    df: DataFrame,
    label: str,
    key: str,
    cuts: dict[str, float] | None = None,
    rest: str = "test",
    into: str = "dataset_split",
    kind: str = "xxhash64",
    tie: str | None = None,
    seed: int | None = None,
) -> DataFrame:
    """Exact split of each label class by hash order of ``key``.

    ``cuts`` holds cumulative shares in ascending order; rows beyond the last one get
    ``rest``. ``tie`` orders rows that share a key.
    """
    cuts = cuts or {"train": 0.80, "validation": 0.90}
    rows = _ordered(df, label, key, tie, kind, seed, "split")
    names, shares = list(cuts), list(cuts.values())
    sizes = _group_sizes(rows)
    if sizes is None:
        ranks = ranked_within(rows.select("_by", *ORDER), "_by", *[F.col(c) for c in ORDER]).select("_place", "rank", "total")
        share = F.col("rank").cast("double") / F.col("total")
        name = reduce(lambda e, c: e.when(share <= c[1], c[0]), list(cuts.items())[1:], F.when(share <= shares[0], names[0]))
        return rows.join(ranks.select("_place", name.otherwise(rest).alias(into)), "_place").drop("_by", *ORDER)
    marked = _mark(rows, {g: [share_rank(s, n) for s in shares] for g, n in sizes.items()}, kind)
    name = F.coalesce(F.get(F.lit(names), F.col("_cut")), F.lit(rest))
    return marked.withColumn(into, name).drop("_by", *ORDER, "_cut")


Quotas = dict | Callable[[dict], dict]


def take_quota(
    df: DataFrame,
    by: str,
    quotas: Quotas,
    key: str,
    kind: str = "xxhash64",
    seed: int | None = None,
    tie: str | None = None,
) -> DataFrame:
    """Exactly ``quotas[group]`` rows of each group (all of a smaller one), in hash order.

    Rows that share a key are taken in the order of ``tie`` and then of the whole row, so a
    quota is exact at any size, however often a key repeats. None names the null group. ``quotas``
    may be a function of the groups' sizes, so that counting them needs no pass of its own.
    """
    if not callable(quotas):
        known = [g for g in quotas if g is not None]
        wanted = F.col(by).isin(known) if known else F.lit(False)
        df = df.filter(F.coalesce(wanted, F.lit(False)) | F.col(by).isNull() if None in quotas else wanted)
    rows = _ordered(df, by, key, tie, kind, seed, "quota")
    found = rows.groupBy(F.col(by).alias("g"), "_by").agg(F.count(F.lit(1)).alias("n")).collect()  # a row per group
    sizes = {r["g"]: r["n"] for r in found}
    chosen = quotas(sizes) if callable(quotas) else quotas
    ranks = {r["_by"]: [min(chosen[r["g"]], r["n"])] for r in found if r["g"] in chosen}
    return _mark(rows, ranks, kind).filter(F.col("_cut") == 0).drop("_by", *ORDER, "_cut")


def balanced_sample(
    df: DataFrame, by: str, n: int, groups: list, key: str, kind: str = "xxhash64", seed: int = 42, tie: str | None = None
) -> DataFrame:
    """``n`` rows of every group, shuffled; an error names groups that hold fewer."""

    def quotas(sizes: dict) -> dict:
        short = {g: sizes.get(g, 0) for g in groups if sizes.get(g, 0) < n}
        if short:
            raise ValueError(f"not enough rows for a balanced sample of {n}: {short}")
        return {g: n for g in groups}

    return shuffle(take_quota(df.filter(F.col(by).isin(groups)), by, quotas, key, kind, seed, tie), key, kind, seed + 1)


def shuffle(df: DataFrame, key: str, kind: str = "xxhash64", seed: int = 42) -> DataFrame:
    """Rows in a repeatable random order."""
    return df.orderBy(order_hash(F.col(key), kind=kind, seed=seed), F.col(key))


def stratified_sample(
    df: DataFrame, by: str, fractions: dict, key: str, kind: str = "xxhash64", seed: int = 42
) -> DataFrame:
    """A fraction of each group, row by row and without a shuffle; fractions above 1 mean all."""
    value = order_hash(F.col(key), kind=kind, seed=seed)
    keep = [(F.col(by) == group) & hash_below(value, share, kind) for group, share in fractions.items()]
    return df.filter(reduce(lambda a, b: a | b, keep))


def hash_split(
    df: DataFrame, key: str, shares: dict[str, float], into: str = "split", kind: str = "xxhash64", seed: int | None = None
) -> DataFrame:
    """Random split by key: rows of one key share a split. Narrow, no shuffle."""
    value = order_hash(F.col(key), kind=kind, seed=seed)
    total, upto, name = sum(shares.values()), 0.0, None
    for split, share in shares.items():
        upto += share / total
        test = hash_below(value, round(upto, 12), kind)
        name = F.when(test, split) if name is None else name.when(test, split)
    return df.withColumn(into, name)


def group_split(df: DataFrame, key: str = "record_id", into: str = "development_split", kind: str = "xxhash64") -> DataFrame:
    """80/10/10 by review: sentences of one review never part."""
    return hash_split(df, key, {"train": 0.8, "validation": 0.1, "test": 0.1}, into, kind)


def hash_sample(
    df: DataFrame, key: str, max_rows: int, kind: str = "xxhash64", seed: int | None = None, total: int | None = None
) -> DataFrame:
    """About ``max_rows`` keys chosen by key hash, never more, one row each.

    The threshold is a share of the distinct keys, so repeated keys do not shrink the sample, and
    copies leave before the cap. The hash test leaves a sample of bounded size, so the final cap
    sorts that and not the table. ``total`` is the number of distinct keys where it is known.
    """
    total = df.select(key).distinct().count() if total is None else total
    value = order_hash(F.col(key), kind=kind, seed=seed)
    near = df.filter(hash_below(value, min(1.0, max_rows / max(total, 1)), kind)).withColumn("_order", value)
    single = first_per_group(near, [F.col(key)], [F.xxhash64(*df.columns)])
    return single.orderBy("_order", key).limit(max_rows).drop("_order")


def balance_train(
    df: DataFrame, label: str = "label", key: str = "record_id", cap: int | None = 75_000, kind: str = "xxhash64", seed: int = 42
) -> DataFrame:
    """Equal rows of each class: the smallest class sets the number, up to ``cap`` if there is one."""
    most = [] if cap is None else [cap]
    return take_quota(df, label, lambda sizes: {g: min([*sizes.values(), *most]) for g in sizes}, key, kind, seed)


def realistic_quotas(positives: int, negatives: int, share: float = 0.78, max_rows: int | None = 8_000) -> dict[int, int]:
    """Rows per class for a sample with the given positive share, within what is there. Without
    ``max_rows`` the largest sample that has the share."""
    if max_rows is None:
        wanted = positives if share >= 1 else int(min(positives, negatives * share / (1 - share)))
        return {1: wanted, 0: negatives if share <= 0 else min(negatives, round(wanted * (1 - share) / share))}
    rows = min(positives + negatives, max_rows)
    wanted = int(rows * share)
    return {1: min(wanted, positives), 0: min(rows - wanted, negatives)}


def realistic_sample(
    df: DataFrame,
    share: float = 0.78,
    max_rows: int | None = 8_000,
    label: str = "label",
    key: str = "record_id",
    kind: str = "xxhash64",
    seed: int = 42,
) -> DataFrame:
    """Holdout at a natural class balance instead of the training balance."""
    return take_quota(df, label, lambda sizes: realistic_quotas(sizes.get(1, 0), sizes.get(0, 0), share, max_rows), key, kind, seed)


def pool_outside(df: DataFrame, by: str, fractions: dict, key: str, kind: str = "xxhash64", seed: int = 42) -> DataFrame:
    """Rows that :func:`stratified_sample` with the same arguments leaves out: a filter, no join."""
    value = order_hash(F.col(key), kind=kind, seed=seed)
    taken = [(F.col(by) == group) & hash_below(value, share, kind) for group, share in fractions.items()]
    return df.filter(~F.coalesce(reduce(lambda a, b: a | b, taken), F.lit(False)))


def holdout_pool(df: DataFrame, used: DataFrame, key: str = "row_id") -> DataFrame:
    """Rows whose key is not among the used ones."""
    return df.join(used.select(key), key, "left_anti")
