"""Nearest neighbours by learned partitions.

A neighbour graph over a bounded sample is cut into balanced parts, by recursive bisection
along the graph's smoothest vector with swaps that lower the cut. A small network learns to tell the part of a
vector, with the parts of its neighbours as soft labels. Every row is indexed in its most
probable part; a query is routed to its most probable parts, and the rows found there are
ranked by exact cosine in double precision.

The number of parts to search is measured: the fewest that find ``TARGET`` of the true
neighbours of sample queries in the sample. Parts of any size are stored in blocks of about ``BLOCK`` rows;
a query meets each block of its parts in a task of its own, and only its best rows per block travel.

Defined cases: vectors that are null, zero or of another length than most, or that hold a null or a
non-finite number, take no part, neither as query nor as row; equal scores are ranked by the
smaller id; a repeated id is a row of its own, but never a neighbour of its own id; query rows of
equal id and vector are one query with one answer, and each other vector of that id is a query
with ranks of its own; fewer rows than asked for: all of them; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palate.functions.keys import hash_below
from palate.sources.staging import stage

#: Rows the graph and the network are fitted on, at most.
SAMPLE = 8_192
#: Rows a part should hold, and parts at most (a part of the sample needs some rows).
PART_ROWS = 2_000
MAX_PARTS = 128
NEIGHBOURS = 10
TARGET = 0.93
BLOCK = 4_096
QUERY_BLOCK = 512


def unit(x: np.ndarray) -> np.ndarray:
    # the largest component first, so that no square overflows or vanishes
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The k rows of largest cosine to every row of unit vectors, itself excluded."""
    out = np.zeros((len(x), k), np.int64)
    for at in range(0, len(x), 1024):
        near = x[at : at + 1024] @ x.T
        near[np.arange(len(near)), at + np.arange(len(near))] = -np.inf
        out[at : at + 1024] = np.argpartition(-near, k - 1, axis=1)[:, :k]
    return out


def _bisected(nodes: np.ndarray, a: np.ndarray, b: np.ndarray, start: np.ndarray) -> np.ndarray:
    """True for the half of ``nodes`` on one side; edges (a, b) are positions in ``nodes``."""
    n = len(nodes)
    degree = np.bincount(a, minlength=n) + 1.0
    x = start - start.mean()
    for _ in range(60):  # smoothest non-constant vector of the graph
        x = (np.bincount(a, x[b], minlength=n) + x) / degree
        x -= np.average(x, weights=degree)
        x /= max(1e-12, np.abs(x).max())
    side = np.zeros(n, bool)
    side[np.argsort(x, kind="stable")[n // 2 :]] = True
    for _ in range(10):  # swap equally many nodes that would rather be on the other side
        gain = np.bincount(a, np.where(side[a] != side[b], 1.0, -1.0), minlength=n)
        left, right = (np.flatnonzero((side == s) & (gain > 0)) for s in (False, True))
        m = min(len(left), len(right)) // 2
        if not m:
            break
        for group in (left, right):
            moved = group[np.argsort(-gain[group], kind="stable")[:m]]
            side[moved] = ~side[moved]
    return side


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int) -> np.ndarray:
    """A part from 0 to parts - 1 (a power of two) for every row; sizes differ by at most one per cut."""
    a = np.repeat(np.arange(len(x)), graph.shape[1])
    b = graph.ravel()
    a, b = np.concatenate((a, b)), np.concatenate((b, a))
    part = np.zeros(len(x), np.int64)
    direction = np.random.default_rng(11).normal(size=x.shape[1])
    while parts > 1:
        for p in range(int(part.max()) + 1)[::-1]:
            nodes = np.flatnonzero(part == p)
            place = np.full(len(x), -1)
            place[nodes] = np.arange(len(nodes))
            inner = (part[a] == p) & (part[b] == p)
            side = _bisected(nodes, place[a[inner]], place[b[inner]], x[nodes] @ direction)
            part[nodes] = 2 * p + side
        parts //= 2
    return part


@dataclass(frozen=True)
class Router:
    """A network with one hidden layer that gives the probability of every part."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    probes: int

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def ranked(self, x: np.ndarray) -> np.ndarray:
        return np.argsort(-self.logits(x), axis=1, kind="stable")


def fit_network(x: np.ndarray, soft: np.ndarray, hidden: int = 128, steps: int = 800) -> Router:
    """Minimises the cross entropy to the soft labels with Adam on mini-batches."""
    pick = np.random.default_rng(5)
    w = [pick.normal(size=(x.shape[1], hidden)) * np.sqrt(2 / x.shape[1]) * 3, np.zeros(hidden), pick.normal(size=(hidden, soft.shape[1])) * np.sqrt(2 / hidden), np.zeros(soft.shape[1])]
    m, v = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w]
    for step in range(1, steps + 1):
        rows = pick.integers(0, len(x), min(512, len(x)))
        xs, ys = x[rows], soft[rows]
        h = np.maximum(xs @ w[0] + w[1], 0)
        z = h @ w[2] + w[3]
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        dz = (p - ys) / len(rows)
        dh = (dz @ w[2].T) * (h > 0)
        rate = 3e-3 * min(1.0, 2 * (1 - step / (steps + 1)))
        for i, g in enumerate((xs.T @ dh, dh.sum(0), h.T @ dz, dz.sum(0))):
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.999 * v[i] + 0.001 * g * g
            w[i] = w[i] - rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    return Router(*w, 1)


def fit_router(sample: np.ndarray, rows: int, wanted: int) -> Router:
    """Parts, network and number of probes from unit sample vectors, for a table of ``rows`` rows."""
    n, d = sample.shape
    parts = 1
    while parts * 2 * PART_ROWS <= rows and parts * 2 * 4 * NEIGHBOURS <= n and parts < MAX_PARTS:
        parts *= 2
    if parts == 1:
        return Router(np.zeros((d, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1), 1)
    graph = neighbour_graph(sample, NEIGHBOURS)
    part = balanced_parts(sample, graph, parts)
    soft = np.zeros((n, parts))
    np.add.at(soft, (np.repeat(np.arange(n), NEIGHBOURS), part[graph].ravel()), 0.7 / NEIGHBOURS)
    soft[np.arange(n), part] += 0.3
    test = np.arange(n) % 8 == 0
    router = fit_network(sample[~test], soft[~test])
    # rows the network has not seen ask for their neighbours in the whole sample
    order = router.ranked(sample[test])
    home = router.logits(sample).argmax(1)
    near = neighbour_graph(sample, min(wanted, n - 1))[test]
    position = np.argsort(order, axis=1)
    reached = np.take_along_axis(position, home[near], axis=1)
    shares = np.array([(reached < t).mean() for t in range(1, parts + 1)])
    return Router(router.w1, router.b1, router.w2, router.b2, int(np.flatnonzero(shares >= min(TARGET, shares.max()))[0]) + 1)


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """id and vector (array of double) of the rows that take part."""
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("v"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("v").isNotNull() & F.forall("v", number) & F.exists("v", lambda x: x != 0))
    rows = stage(rows, "vectors")
    lengths = rows.groupBy(F.size("v").alias("n")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), "n").first()
    return rows.filter(F.size("v") == (lengths["n"] if lengths else 0))


def _matrix(column) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def _routed(router: Router, probes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                parts = router.ranked(unit(_matrix(batch.column("v"))))[:, :probes].astype(np.int32)
                listed = pa.FixedSizeListArray.from_arrays(pa.array(parts.ravel()), parts.shape[1]).cast(pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), listed], ["id", "v", "parts"])

    return run


def _best(wanted: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for at in range(batch.num_rows):
                ids, asked, numbers = (np.array(batch.column(c)[at].values) for c in ("ids", "asked", "numbers"))
                x = np.array(batch.column("vectors")[at].values).reshape(len(ids), -1)
                q = np.array(batch.column("queries")[at].values).reshape(len(asked), -1)
                order = np.argsort(ids, kind="stable")
                ids, x = ids[order], x[order]
                rough = unit(q) @ unit(x).T
                rough[asked[:, None] == ids[None, :]] = -np.inf
                k = min(wanted, len(ids))
                least = np.partition(rough, len(ids) - k, axis=1)[:, len(ids) - k]
                big = np.abs(x).max(1)
                for i, one in enumerate(q):
                    near = np.flatnonzero((rough[i] >= least[i] - 1e-9) & np.isfinite(rough[i]))
                    # summed row by row, so equal vectors get equal scores in any block
                    a, b = one / np.abs(one).max(), x[near] / big[near, None]
                    score = (a * b).sum(1) / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum(1)))
                    for j in np.lexsort((ids[near], -score))[:wanted]:
                        out.append((int(numbers[i]), int(asked[i]), int(ids[near[j]]), float(score[j])))
            columns = list(zip(*out)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, [pa.int64(), pa.int64(), pa.int64(), pa.float64()])], ["number", "query_id", "vec_id", "score"])

    return run


def nearest(vectors: DataFrame, is_query: Column, wanted: int = 5, id_column: str = "vec_id", vector_column: str = "embedding", probes: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score of the ``wanted`` nearest rows found for every distinct id and
    vector that satisfies ``is_query`` (over the column ``id``). ``probes`` overrides the measured number."""
    rows = usable(vectors, id_column, vector_column)
    total, distinct = rows.agg(F.count(F.lit(1)), F.approx_count_distinct(F.xxhash64("id", "v"), 0.02)).first()
    # a hash threshold first, so that about SAMPLE rows are sorted and sent; copies of a row count once
    drawn = F.xxhash64("id", "v")
    near = rows.filter(hash_below(drawn, min(1.0, 1.2 * SAMPLE / max(distinct, 1)), "xxhash64")).distinct()
    sample = near.orderBy(drawn, "id").limit(SAMPLE).collect()
    spark = vectors.sparkSession
    if not sample:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    router = fit_router(unit(np.array([r["v"] for r in sample])), total, wanted)
    schema = "id long, v array<double>, parts array<int>"
    homes = stage(rows.mapInArrow(_routed(router, 1), schema).select("id", "v", F.get("parts", F.lit(0)).alias("part"), F.monotonically_increasing_id().alias("row")), "homes")
    sizes = homes.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))  # a row per part
    held = homes.join(F.broadcast(sizes), "part").withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"))  # by row: an id may stand often
    gathered = lambda *columns: F.sort_array(F.collect_list(F.struct(*columns)))
    blocks = held.groupBy("part", "block").agg(gathered("id", "v").alias("x"))  # about BLOCK rows
    blocks = blocks.select("part", "block", F.transform("x", lambda r: r["id"]).alias("ids"), F.flatten(F.transform("x", lambda r: r["v"])).alias("vectors"))
    queries = rows.filter(is_query).distinct().mapInArrow(_routed(router, probes or router.probes), schema).withColumn("number", F.monotonically_increasing_id())
    asked = stage(queries.select("id", "number", "v", F.explode("parts").alias("part")), "asked")
    loads = asked.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).cast("int").alias("loads"))  # a row per part
    asked = asked.join(F.broadcast(loads), "part").withColumn("load", F.pmod(F.xxhash64("number", F.lit("q")), F.col("loads")).cast("int"))
    asked = asked.groupBy("part", "load").agg(gathered("id", "number", "v").alias("x")).join(F.broadcast(sizes), "part")
    asked = asked.select("part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.transform("x", lambda r: r["id"]).alias("asked"), F.transform("x", lambda r: r["number"]).alias("numbers"), F.flatten(F.transform("x", lambda r: r["v"])).alias("queries"))
    met = blocks.join(asked, ["part", "block"]).select("ids", "vectors", "asked", "numbers", "queries")
    found = met.mapInArrow(_best(wanted), "number long, query_id long, vec_id long, score double")
    order = Window.partitionBy("number").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= wanted).select("query_id", "rank", "vec_id", "score")
