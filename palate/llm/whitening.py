"""Whitening of embeddings by QDWH spectral divide and conquer.

1. Vectors become fixed-point integers; the distinct ones are the fit list.
2. Two passes over the fit list: count and sums, then products of entries centred on the rounded
   mean. Both are integer sums, exact in any order, so the covariance does not depend on
   partitioning: ``(n * P - D D') / n ** 2`` with products P and sums D of the centred entries.
3. On the covariance (one number per pair of dimensions, whatever the table), the driver splits the
   space: the orthogonal polar factor U of the matrix minus a shift, found by the dynamically
   weighted Halley iteration in QR form, gives the projector (U + I) / 2 on the eigenvectors above
   the shift. Both invariant subspaces are split in the same way until each is a single component;
   subspaces below the wanted components are left whole.
4. The components, a small matrix, travel to all tasks, which whiten every row; a pass over the
   whitened fit list measures how far its covariance is from the identity.

Defined cases: rows whose vector is null or holds null or non-finite entries are dropped, and so are
entries beyond 2 ** 40 (no fixed-point value) and vectors of another length than most (of equally
frequent lengths the larger one); repeated rows get rows of their own and count once in the fit; a
null id is an id like any other; components whose eigenvalue is not above rounding (constant or
dependent dimensions, fewer vectors than dimensions) are left out, so one distinct vector or an
empty table gives no rows; a deviation beyond a long is null; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palate.sources.staging import stage

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
#: Bounds the matrix on the driver.
MAX_DIMENSION = 4_096
LARGEST = float(1 << 40)

#: Entries are multiplied in parts of so many bits, so that float products of a chunk are exact.
PART_BITS = 20
CHUNK = 8_192
_EPS = np.finfo(float).eps


def fixed_point(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """vec_id and x, the integers of every usable vector."""
    c = F.col(vector)
    usable = c.isNotNull() & F.forall(c, lambda v: v.isNotNull() & (F.abs(v.cast("double")) <= LARGEST))
    x = F.transform(c, lambda v: F.floor(v.cast("double") * SCALE).cast("long") + OFFSET)
    return embeddings.select("vec_id", F.when(usable, x).alias("x")).filter("x is not null")


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


def _summed(dimension: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(dimension, object)
        low, high = np.full(dimension, np.iinfo(np.int64).max), np.full(dimension, np.iinfo(np.int64).min)
        for batch in batches:
            x = _matrix(batch.column("x"), dimension)
            if len(x):
                n += len(x)
                total = total + x.sum(0).astype(object)  # below 2 ** 62: entries below 2 ** 47, batches below 2 ** 15
                low, high = np.minimum(low, x.min(0)), np.maximum(high, x.max(0))
        if n:
            at = pa.array(np.arange(dimension, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([at, pa.array([n] * dimension, pa.int64()), pa.array([str(int(t)) for t in total]), pa.array(low), pa.array(high)], ["i", "n", "total", "low", "high"])

    return run


def parts_of(values: np.ndarray, count: int) -> list[np.ndarray]:
    """``values`` as ``count`` float arrays of PART_BITS bits each, least first, with the sign."""
    sign, size = np.sign(values), np.abs(values)
    return [(sign * ((size >> (PART_BITS * k)) & ((1 << PART_BITS) - 1))).astype(float) for k in range(count)]


def _products(dimension: int, middle: np.ndarray, count: int):
    """Sums of products of centred entries: rows (power, i, values), values[j] for j >= i."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, np.ndarray] = {}
        added = 0

        def flush() -> pa.RecordBatch:
            power, at, values = zip(*[(p, i, m[i, i:].tolist()) for p, m in kept.items() for i in range(dimension)])
            return pa.RecordBatch.from_arrays([pa.array(power, pa.int32()), pa.array(at, pa.int32()), pa.array(values, pa.list_(pa.int64()))], ["power", "i", "values"])

        for batch in batches:
            x = _matrix(batch.column("x"), dimension)
            for low in range(0, len(x), CHUNK):
                pieces = parts_of(x[low : low + CHUNK] - middle, count)
                for a, left in enumerate(pieces):
                    for b, right in enumerate(pieces):
                        # at most CHUNK products below 2 ** 40: exact in a float
                        kept[a + b] = kept.get(a + b, 0) + (left.T @ right).astype(np.int64)
                added += 1
                if added >= 256 // count:  # sums stay below 2 ** 62
                    yield flush()
                    kept.clear()
                    added = 0
        if kept:
            yield flush()

    return run


@dataclass(frozen=True)
class Fit:
    """Count, exact sums and covariance of the fit list; range of the entries."""

    n: int
    sums: list[int]
    low: np.ndarray
    high: np.ndarray
    covariance: np.ndarray


def fit(vectors: DataFrame, dimension: int) -> Fit | None:
    """Exact moments of the distinct vectors (x); None if there are none."""
    if dimension > MAX_DIMENSION:
        raise ValueError(f"vectors of {dimension} dimensions; at most {MAX_DIMENSION}")
    one = vectors.select("x").mapInArrow(_summed(dimension), "i int, n long, total string, low long, high long")
    big = F.sum(F.col("total").cast("decimal(38,0)"))
    found = one.groupBy("i").agg(F.sum("n").alias("n"), big.alias("total"), F.min("low").alias("low"), F.max("high").alias("high")).orderBy("i").collect()  # a row per dimension
    if not found:
        return None
    n, sums = found[0]["n"], [int(r["total"]) for r in found]
    low, high = (np.array([r[c] for r in found], np.int64) for c in ("low", "high"))
    middle = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
    count = max(1, -(-int(np.maximum(high - middle, middle - low).max()).bit_length() // PART_BITS))
    two = vectors.select("x").mapInArrow(_products(dimension, middle, count), "power int, i int, values array<long>")
    cells = two.select("power", "i", F.posexplode("values").alias("k", "v")).groupBy("power", "i", "k").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))
    exact = np.zeros((dimension, dimension), object)
    for r in cells.collect():  # a row per pair of dimensions and part
        exact[r["i"], r["i"] + r["k"]] += int(r["v"]) << (PART_BITS * r["power"])
    rest = [s - n * int(m) for s, m in zip(sums, middle)]
    covariance = np.zeros((dimension, dimension))
    for i in range(dimension):
        for j in range(i, dimension):
            covariance[i, j] = covariance[j, i] = (n * exact[i, j] - rest[i] * rest[j]) / (n * n)
    return Fit(n, sums, low, high, covariance)


def polar(a: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Orthogonal polar factor of a symmetric matrix by the dynamically weighted Halley iteration."""
    m = len(a)
    x = a / np.linalg.norm(a)
    below = _EPS / 2  # lower bound of the singular values; smaller ones take more rounds
    for _ in range(rounds):
        s = below * below
        d = np.cbrt(4 * (1 - s) / (s * s)) if s < 1 else 0.0
        root = np.sqrt(1 + d)
        w = root + np.sqrt(max(0.0, 8 - 4 * d + 8 * (2 - s) / (s * root))) / 2
        w, v = max(w, 3.0), 0.0
        v = (w - 1) ** 2 / 4
        u = w + v - 1
        q = np.linalg.qr(np.vstack([np.sqrt(u) * x, np.eye(m)]))[0]
        new = (v / u) * x + ((w - v / u) / np.sqrt(u)) * (q[:m] @ q[m:].T)
        new = (new + new.T) / 2
        moved = np.linalg.norm(new - x)
        x = new
        below = min(1.0, below * (w + v * s) / (1 + u * s))
        if moved <= 4 * m * _EPS and below > 0.9:
            break
    return x


def split(a: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the eigenvectors above and below a shift; None if all eigenvalues are
    equal up to rounding."""
    m = len(a)
    mean = np.trace(a) / m
    spread = np.linalg.norm(a - mean * np.eye(m)) / np.sqrt(m)
    if spread <= 8 * _EPS * np.linalg.norm(a):
        return None
    draw = np.random.default_rng(m).standard_normal((m, m))
    # the mean lies strictly between the least and the greatest eigenvalue; next to one, move away
    best: tuple[float, tuple[np.ndarray, np.ndarray]] | None = None
    for step in (0.0, 0.11, -0.13, 0.29, -0.31, 0.47, -0.53, 0.03, -0.05):
        above = (polar(a - (mean + step * spread) * np.eye(m)) + np.eye(m)) / 2
        rank = round(float(np.trace(above)))
        if not 0 < rank < m:
            continue
        halves = []
        for projector, columns in ((above, draw[:, :rank]), (np.eye(m) - above, draw[:, rank:])):
            for _ in range(3):
                columns = np.linalg.qr(projector @ columns)[0]
            halves.append(columns)
        both = np.linalg.qr(np.hstack(halves))[0]
        upper, lower = both[:, :rank], both[:, rank:]
        left = float(np.linalg.norm(upper.T @ a @ lower))
        if best is None or left < best[0]:
            best = (left, (upper, lower))
        if left <= 32 * m * _EPS * np.linalg.norm(a):
            break
    return best[1] if best else None


def components(covariance: np.ndarray, wanted: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` greatest eigenvalues above rounding, falling, and their eigenvectors as columns."""
    m = len(covariance)
    found: list[np.ndarray] = []
    open_spaces = [np.eye(m)]
    while open_spaces and len(found) < wanted:
        basis = open_spaces.pop()  # the one with the greatest eigenvalues
        inner = basis.T @ covariance @ basis
        inner = (inner + inner.T) / 2
        halves = split(inner) if len(inner) > 1 else None
        if halves is None:
            found += list(basis.T)
        else:
            open_spaces += [np.linalg.qr(basis @ halves[1])[0], np.linalg.qr(basis @ halves[0])[0]]
    vectors = np.array(found).reshape(-1, m).T
    values = np.einsum("ij,ik,kj->j", vectors, covariance, vectors)
    order = np.argsort(-values, kind="stable")[:wanted]
    order = [k for k in order if values[k] > m * _EPS * max(np.trace(covariance), 0.0)]
    return values[order], vectors[:, order]


def _whitened(x: np.ndarray, middle: np.ndarray, rest: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    return ((x - middle).astype(float) - rest) @ matrix


def _deviations(x: np.ndarray, fitted: Fit) -> pa.Array:
    """Sums of (n * x - S) ** 2, exact: in longs where they suffice, else in whole numbers."""
    most = max(max(abs(fitted.n * int(v) - s) for v in (lo, hi)) for lo, hi, s in zip(fitted.low, fitted.high, fitted.sums))
    if fitted.n * int(np.abs([fitted.low, fitted.high]).max()) < 1 << 62 and len(fitted.sums) * most * most < 1 << 63:
        off = fitted.n * x - np.array(fitted.sums, np.int64)
        return pa.array((off * off).sum(1))
    off = fitted.n * x.astype(object) - np.array(fitted.sums, object)
    return pa.array([int(v) if v < 1 << 63 else None for v in (off * off).sum(1)], pa.int64())


def whitened(embeddings: DataFrame, wanted: int = COMPONENTS, vector: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error: a row for every
    usable vector and component."""
    spark = embeddings.sparkSession
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = stage(fixed_point(embeddings, vector), "fixed_point")
    sizes = rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).agg(F.max(F.struct("n", "d")).alias("m")).first()["m"]
    dimension = sizes["d"] if sizes else 0
    rows = rows.filter(F.size("x") == dimension)
    listed = stage(rows.select("x").distinct(), "fit_list")
    fitted = fit(listed, dimension) if dimension else None
    if fitted is None:
        return spark.createDataFrame([], schema)
    values, vectors = components(fitted.covariance, wanted)
    k = len(values)
    if not k:
        return spark.createDataFrame([], schema)
    middle = np.array([(2 * s + fitted.n) // (2 * fitted.n) for s in fitted.sums], np.int64)
    rest = np.array([(s - fitted.n * int(m)) / fitted.n for s, m in zip(fitted.sums, middle)])
    matrix = vectors / np.sqrt(values)
    explained = values / np.trace(fitted.covariance)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k + 1))
        for batch in batches:
            w = _whitened(_matrix(batch.column("x"), dimension), middle, rest, matrix)
            w = np.hstack([w, np.ones((len(w), 1))])
            total += w.T @ w
        at = np.arange((k + 1) * (k + 1), dtype=np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel())], ["at", "v"])

    sums = {r["at"]: r["v"] for r in listed.mapInArrow(products, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()}
    measured = np.array([sums[i] for i in range((k + 1) ** 2)]).reshape(k + 1, k + 1) / fitted.n
    error = float(np.abs(measured[:k, :k] - np.outer(measured[k, :k], measured[k, :k]) - np.eye(k)).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 1_024):
                part = batch.slice(low, 1_024)
                x = _matrix(part.column("x"), dimension)
                w = _whitened(x, middle, rest, matrix)
                m = len(x)
                repeat = pa.array(np.repeat(np.arange(m), k))
                component = pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m))
                same = [pa.array(np.full(m * k, fitted.n)), _deviations(x, fitted).take(repeat), pa.array(w.ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))]
                yield pa.RecordBatch.from_arrays([part.column("vec_id").take(repeat), component, *same], ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), "x").mapInArrow(run, schema)
