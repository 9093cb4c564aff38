"""Near duplicates by bottom-k sketches of one hash function.

A document's set holds the hashes of its distinct shingles (runs of five words, A-Z lower-cased;
a shorter text is one shingle). Its sketch is the K smallest values of the set. Two documents
are linked if the Jaccard similarity of their whole sets reaches the threshold.

1. Documents with equal sets form a class; only the class goes on, with the text of its smallest
   doc_id. Classes have numbers of their own, as texts of one doc_id may be in several.
2. Inverted lists of the retained values generate the overlaps. A link makes two sketches share
   at least ``overlap`` values, so a class is listed only under its rarest values, all but
   ``overlap - 1`` of them: values that a third of all documents share list next to nothing.
3. No pair is emitted to be tested. Every class has a home, its longest list; the classes of a home
   are cut into blocks of about ``BLOCK``, and two blocks meet in a task of their own if a list has
   members of both. So a dense list of m members costs (m / BLOCK)^2 tasks, not m^2 rows.
4. In a task, matrix products count shared values: first of the sketches, which drops the pairs that
   the union's sketch cannot admit, then of the whole sets, which decides. Out come links that
   connect what is linked, at most one per class: a forest, not all links of a group.
5. Components are found by alternating grouped minima over the links.

A pair at the threshold is missed with a probability below ``MISS`` by the sketches; shorter
sets are their own sketch and are never missed.

The texts are read twice and shuffled once, those of listed classes a second time. Sketches, lists
and links are written to the shared folder.

Defined cases: a null text, or one without words, has an empty set and is linked with nothing;
rows with an equal doc_id count as one document per distinct text, each with a result of its own
(of one doc_id's texts in a component, the one with the smallest hash comes first); a null doc_id
is left out of the classes and stands alone; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palate.llm.arrays import chunks, grams, lists, mix, words_of
from palate.llm.components import components
from palate.sources.staging import stage

SHINGLE = 5
PERCENT = 75
K = 64
MISS = 1e-9
#: Classes of one home that meet as one block.
BLOCK = 384
#: Values a matrix product counts at a time: bounds a task's memory.
PRODUCT = 8_192

_SIGN = np.uint64(1 << 63)


def least_overlap(k: int = K, percent: int = PERCENT, miss: float = MISS) -> int:
    """Smallest number of the k smallest union values that both sets hold, but for ``miss``."""
    share, below = percent / 100, 0.0
    for x in range(k + 1):
        below += math.comb(k, x) * share**x * (1 - share) ** (k - x)
        if below > miss:
            return x
    return k


OVERLAP = least_overlap()


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text, as signed 64-bit numbers in sketch order."""
    words = words_of(texts)
    hashes = words.hashes(fold=True)
    long = (grams(hashes, SHINGLE) ^ _SIGN).view(np.int64)
    out = []
    for a, b in zip(words.first[:-1], words.first[1:]):
        if b - a >= SHINGLE:
            own = np.sort(long[a : b - SHINGLE + 1])
            out.append(own[np.concatenate(([True], own[1:] != own[:-1]))])
        elif b > a:
            out.append((grams(hashes[a:b], int(b - a)) ^ _SIGN).view(np.int64))
        else:
            out.append(np.zeros(0, np.int64))
    return out


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in chunks(batch):
            sets = shingle_sets(part.column("text"))
            sizes = np.array([len(s) for s in sets], np.int64)
            # two sums over the set, each of 64 bits: equal sets, equal signature
            one = np.array([s.view(np.uint64).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
            two = np.array([mix(s.view(np.uint64)).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
            kept = [s[:K] for s in sets]
            flat = np.concatenate(kept) if kept else np.zeros(0, np.int64)
            sketch = lists(flat, np.array([len(s) for s in kept], np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("version"), pa.array(sizes), pa.array(one), pa.array(two), sketch], ["doc_id", "version", "n_shingles", "one", "two", "sketch"])


def versioned(documents: DataFrame) -> DataFrame:
    """``documents`` with the hash of the text, which tells the texts of one doc_id apart."""
    return documents.withColumn("version", F.xxhash64("text"))


def sketches(documents: DataFrame) -> DataFrame:
    """doc_id, version, n_shingles, signature (one, two) and sketch of every document."""
    return versioned(documents.select("doc_id", "text")).mapInArrow(_sketched, "doc_id long, version long, n_shingles long, one long, two long, sketch array<long>")


def listed_under(classes: DataFrame) -> DataFrame:
    """value, doc, n_listed: the classes listed under each shared value."""
    values = classes.select("doc", "n_shingles", F.explode("sketch").alias("value"))
    shared = values.groupBy("value").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    found = values.join(shared, "value")
    n = F.col("n_shingles")
    held = F.least(n, F.lit(K))
    # a set below K values is its own sketch; against a longer one it still shares K - n / 3
    need = F.when(n >= K, F.lit(OVERLAP)).otherwise(F.least(F.ceil(n * PERCENT / 100), F.floor(K - n * (100 / PERCENT - 1)), n))
    per_doc = found.groupBy("doc", "n_shingles").agg(F.sort_array(F.collect_list(F.struct("df", "value"))).alias("shared"))  # at most K values
    # values of this class alone are the rarest of all and take up places
    places = held - need + 1 - (held - F.size("shared"))
    cut = per_doc.filter(places > 0).select("doc", F.explode(F.slice("shared", F.lit(1), places.cast("int"))).alias("x"))
    listed = cut.select(F.col("x.value").alias("value"), "doc")
    sizes = listed.groupBy("value").agg(F.count(F.lit(1)).alias("n_listed")).filter("n_listed > 1")
    return listed.join(sizes, "value")


def blocks_of(listed: DataFrame) -> DataFrame:
    """doc, block: classes whose longest list is the same, in blocks of about BLOCK."""
    home = listed.groupBy("doc").agg(F.max(F.struct("n_listed", "value")).alias("home")).select("doc", F.col("home.value").alias("home"))
    cuts = home.groupBy("home").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("cuts"))
    cut = F.pmod(F.xxhash64("doc"), F.col("cuts"))
    return home.join(cuts, "home").select("doc", F.xxhash64("home", cut).alias("block"))


def meetings(listed: DataFrame, blocks: DataFrame) -> DataFrame:
    """low, high: pairs of blocks that have members in one list, every block with itself included."""
    present = stage(listed.join(blocks, "doc").select("value", "block").distinct(), "present")
    crowded = present.groupBy("value").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("value")
    several = present.join(crowded, "value")
    across = several.withColumnRenamed("block", "low").join(several.withColumnRenamed("block", "high"), "value").filter("low < high")
    own = present.select(F.col("block").alias("low"), F.col("block").alias("high"))
    return across.select("low", "high").union(own).distinct()


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Values that every left array shares with every right one; each array holds a value once."""
    sides = [(np.concatenate(side), np.repeat(np.arange(len(side)), [len(x) for x in side])) for side in (left, right)]
    common = np.intersect1d(sides[0][0], sides[1][0])
    total = np.zeros((len(left), len(right)), np.float32)
    places = []
    for flat, row in sides:
        at = np.minimum(np.searchsorted(common, flat), max(0, len(common) - 1))
        known = np.flatnonzero(common[at] == flat) if len(common) else np.zeros(0, np.int64)
        places.append((row[known], at[known]))
    for low in range(0, len(common), PRODUCT):
        width = min(PRODUCT, len(common) - low)
        held = []
        for (row, at), side in zip(places, (left, right)):
            here = (at >= low) & (at < low + width)
            one = np.zeros((len(side), width), np.float32)
            one[row[here], at[here] - low] = 1
            held.append(one)
        total += held[0] @ held[1].T
    return total


def links_between(left: list[np.ndarray], right: list[np.ndarray], same: bool) -> list[tuple[int, int]]:
    """Positions of linked sets, enough of them to connect all that are linked."""
    n, m = (np.array([len(x) for x in side]) for side in (left, right))
    least, most = np.minimum(n[:, None], m[None, :]), np.maximum(n[:, None], m[None, :])
    # what the union's sketch holds of both is at most what the sketches share; sets below K
    # values are their own sketch, so for them the number is exact
    need = np.where(least >= K, OVERLAP, np.minimum(np.ceil(least * PERCENT / 100), K - least * (100 / PERCENT - 1)))
    maybe = (100 * least >= PERCENT * most) & (shared_counts([x[:K] for x in left], [x[:K] for x in right]) >= need)
    if same:
        maybe &= np.triu(np.ones(maybe.shape, bool), 1)
    rows, columns = np.flatnonzero(maybe.any(1)), np.flatnonzero(maybe.any(0))
    if not len(rows):
        return []
    both = shared_counts([left[i] for i in rows], [right[j] for j in columns]).astype(np.int64)
    union = n[rows][:, None] + m[columns][None, :] - both
    linked = maybe[np.ix_(rows, columns)] & (100 * both >= PERCENT * union)
    parent: dict[tuple[bool, int], tuple[bool, int]] = {}

    def find(x: tuple[bool, int]) -> tuple[bool, int]:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for i, j in zip(*np.nonzero(linked)):
        a, b = int(rows[i]), int(columns[j])
        x, y = find((False, a)), find((not same, b))
        if x != y:
            parent[x] = y
            out.append((a, b))
    return out


def _met(group: pa.Table) -> pa.Table:
    """Links (a, b) within one meeting of two blocks."""
    group = group.combine_chunks()
    low, high = group.column("low")[0].as_py(), group.column("high")[0].as_py()
    docs = group.column("doc").to_numpy()
    batches = group.select(["text"]).to_batches()
    sets = [s for batch in batches for part in chunks(batch) for s in shingle_sets(part.column("text"))]
    block = group.column("block").to_numpy()
    left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
    pairs = links_between([sets[i] for i in left], [sets[j] for j in right], low == high)
    a, b = (docs[side[[p[k] for p in pairs]]] if pairs else np.zeros(0, np.int64) for k, side in enumerate((left, right)))
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def links(documents: DataFrame, listed: DataFrame, classes: DataFrame) -> DataFrame:
    """a, b: links between classes that connect every component.

    The texts are joined by sort-merge at any size: the number of listed classes follows the corpus,
    so a plan that broadcasts them on small tables says nothing about large ones.
    """
    blocks = stage(blocks_of(listed), "homes")
    pairs = stage(meetings(listed, blocks), "meetings")
    sides = pairs.select("low", "high", F.explode(F.array_distinct(F.array("low", "high"))).alias("block"))
    firsts = blocks.join(classes.select("doc", "first.doc_id", "first.version"), "doc")
    texts = versioned(documents.select("doc_id", "text")).join(firsts.hint("merge"), ["doc_id", "version"])
    met = texts.join(sides, "block").select("low", "high", "block", "doc", "text")
    return met.groupBy("low", "high").applyInArrow(_met, "a long, b long")


def linked(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The sketch table of all documents, and the first doc_id and version of every class's component."""
    rows = stage(sketches(documents), "sketches")
    named = rows.filter("doc_id is not null and n_shingles > 0")
    classes = named.groupBy("n_shingles", "one", "two").agg(F.min(F.struct("doc_id", "version")).alias("first"), F.min("sketch").alias("sketch"))
    classes = stage(classes.withColumn("doc", F.monotonically_increasing_id()), "classes")
    listed = stage(listed_under(classes), "lists")
    of = components(links(documents, listed, classes)).select(F.col("node").alias("doc"), "component")
    small = classes.select("n_shingles", "one", "two", "doc", "first")
    of = stage(small.join(of, "doc").select("doc", "component", "first"), "linked")
    of = of.select("doc", "component").join(of.groupBy("component").agg(F.min("first").alias("kept")), "component")
    # classes of equal sets: every document gets the component of its class
    small = small.join(of.select("doc", "kept"), "doc", "left")
    return rows, small.select("n_shingles", "one", "two", F.coalesce("kept", "first").alias("first"))


def verdicts(documents: DataFrame) -> DataFrame:
    """doc_id, version, n_shingles, component_id and kept of every document."""
    rows, of = linked(documents)
    every = rows.select("doc_id", "version", "n_shingles", "one", "two").join(of, ["n_shingles", "one", "two"], "left")
    alone = (F.col("n_shingles") == 0) | F.col("doc_id").isNull()
    component = F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id"))
    kept = alone | ((F.col("doc_id") == component) & (F.col("version") == F.col("first.version")))
    return every.select("doc_id", "version", "n_shingles", component.alias("component_id"), kept.alias("kept"))


def near_duplicates(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept (one document of each component) of every document."""
    return verdicts(documents).drop("version")
