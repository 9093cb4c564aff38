"""Packing into length buckets with the least padding.

Documents are cut into pieces of at most ``max_length`` tokens. The histogram of piece lengths
(at most ``max_length + 1`` rows, whatever the corpus) goes to the driver, where dynamic
programming finds the bucket boundaries with the least padding in total. Inside each bucket the
pieces are numbered without gaps and cut into batches that hold at most ``token_budget`` tokens
with padding; at least one piece each.

Defined cases: a null length counts as 0; a document of length 0 is one empty piece; equal ids
are pieces of their own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palate.llm.numbering import numbered
from palate.sources.staging import stage

MAX_LENGTH = 2_048
TOKEN_BUDGET = 16_384
BUCKETS = 8


def best_boundaries(histogram: Mapping[int, int], buckets: int) -> list[int]:
    """At most ``buckets`` boundaries, ascending, that minimise the padding of all lengths up to
    the next boundary. Of equally good ones the plan whose buckets end sooner is taken."""
    lengths = np.array(sorted(histogram), np.int64)
    if not len(lengths):
        return []
    counts = np.array([histogram[int(x)] for x in lengths], np.int64)
    rows = np.concatenate(([0], np.cumsum(counts)))
    tokens = np.concatenate(([0], np.cumsum(counts * lengths)))
    m, far = len(lengths), np.iinfo(np.int64).max // 4
    # cost[i, j]: padding of the lengths i to j in one bucket that ends at length j
    cost = lengths[None, :] * (rows[None, 1:] - rows[:-1, None]) - (tokens[None, 1:] - tokens[:-1, None])
    cost[np.tril_indices(m, -1)] = far
    best, cuts = cost[0].copy(), []
    for _ in range(min(buckets, m) - 1):
        total = np.concatenate(([far], best[:-1]))[:, None] + cost
        cuts.append(np.minimum(total.argmin(0), m))
        one = total.min(0)
        cuts[-1] = np.where(one < best, cuts[-1], -1)
        best = np.minimum(one, best)
    ends, j = [], m - 1
    for cut in reversed(cuts):
        if cut[j] > 0:
            ends.append(j)
            j = int(cut[j]) - 1
    return [int(lengths[i]) for i in [*ends, j][::-1]]


def bucket_of(length: Column, boundaries: list[int]) -> Column:
    """Index of the first boundary that is not below ``length``."""
    return F.size(F.filter(F.array(*map(F.lit, boundaries)), lambda b: b < length))


def pieces_of(lengths: DataFrame, max_length: int = MAX_LENGTH) -> DataFrame:
    """doc_id, piece, start and length of every piece of documents (doc_id, n_tokens)."""
    n = F.coalesce(F.col("n_tokens"), F.lit(0)).cast("long")
    last = F.greatest(F.lit(0).cast("long"), F.ceil(n / max_length) - 1)
    pieces = lengths.select("doc_id", n.alias("_n"), F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("piece"))
    start = F.col("piece") * max_length
    return pieces.select("doc_id", "piece", start.alias("start"), F.least(F.lit(max_length).cast("long"), F.col("_n") - start).alias("length"))


def packed(lengths: DataFrame, max_length: int = MAX_LENGTH, token_budget: int = TOKEN_BUDGET, buckets: int = BUCKETS) -> DataFrame:
    """Every piece with its bucket, the padded length, its batch within the bucket and its slot."""
    pieces = stage(pieces_of(lengths, max_length), "pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    boundaries = best_boundaries(histogram, buckets) or [max_length]
    placed = numbered(pieces.withColumn("bucket", bucket_of(F.col("length"), boundaries)), "bucket", "doc_id", "_number", ["piece", "length"])
    padded = F.get(F.array(*[F.lit(b).cast("long") for b in boundaries]), F.col("bucket"))
    rows = F.get(F.array(*[F.lit(max(1, token_budget // max(1, b))).cast("long") for b in boundaries]), F.col("bucket"))
    return placed.select(
        "doc_id", "piece", "start", "length", "bucket", padded.alias("padded_length"),
        F.floor(F.col("_number") / rows).alias("batch"), (F.col("_number") % rows).alias("slot"),
    )
