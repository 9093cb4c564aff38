"""Passages that repeat across documents, found with a compressed index per shard.

A window is ``window`` consecutive words. A word is repeated if a window that covers it also
occurs in a document with a smaller doc_id; windows are judged on the input.

Shards hold text that can match, not arbitrary documents, so that each is searched only by its
own text and the work grows with the corpus, not with shards times corpus:

1. Every window is named by the smallest hash of its runs of ``RUN`` words. Equal windows have
   equal names, and a stretch of neighbouring windows has one name. Names are aggregated before
   the shuffle; one that only a single document has cannot match and goes no further.
2. Stretches with shared names are cut out of their documents and go to the shard of their name,
   where equal ones become one, with the smallest doc_id as owner. Stretches of a name that is
   found more than ``HOT`` times become one before the shuffle, and only what differs meets in the
   shard. A name with more than ``HOT`` different stretches is never gathered: their windows, spread
   by their own words, are aggregated to their owners instead, and no index is needed for those.
3. Each shard builds an FM-index (BWT in a wavelet matrix) over the word ids of its distinct
   stretches and streams each of them through it by backward search. Matching statistics come out:
   for every word, the length of the longest match that starts there and that an earlier document
   has, until no match can reach a window any more. Word ids are exact, so hashes decide nothing.
4. Intervals whose match reaches a window, and stretches that an earlier document has as a whole,
   give the word ranges to remove.

Texts travel once, compressed, and only those of documents with a shared name are kept.

Defined cases: a null text has no words; fewer words than a window: nothing is repeated; a
document never repeats itself, and rows with an equal doc_id do not remove from one another; a
null doc_id takes no part and keeps its words; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palate.llm.arrays import chunks, grams, lists, words_of
from palate.llm.fm_index import FmIndex
from palate.sources.staging import stage

WINDOW = 13
#: Words of the runs whose smallest hash names a window.
RUN = 6
#: Windows in a stretch at most; longer ones (a repeated word) are cut with an overlap.
STRETCH = 64
#: Bits of a name; equal names by chance only add stretches that are searched in vain.
NAME_BITS = 48
#: Words a shard should hold, and stretches of one name that a shard may hold.
SHARD_WORDS = 250_000
HOT = 20_000

_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def signature(text: Column) -> Column:
    """A short hash that tells rows with one id apart."""
    return F.xxhash64(text).bitwiseAND(0x7FFFFFFF).cast("int")


def keyed(documents: DataFrame) -> DataFrame:
    """doc_id, sig and text."""
    return documents.select("doc_id", signature(F.col("text")).alias("sig"), "text")


def window_names(hashes: np.ndarray, first: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all windows within texts, and their names."""
    runs = grams(hashes, min(RUN, window))
    width = max(1, window - RUN + 1)
    count = len(hashes) - window + 1
    if count <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    least = runs[:count].copy()
    for j in range(1, width):
        np.minimum(least, runs[j : j + count], out=least)
    stop = np.repeat(first[1:], np.diff(first))[:count]
    start = np.flatnonzero(np.arange(count) + window <= stop)
    return start, (least[start] >> np.uint64(64 - NAME_BITS)).view(np.int64)


def _stretches(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                words = words_of(part.column("text"))
                start, name = window_names(words.hashes(), words.first, window)
                doc = words.doc[start]
                new = np.ones(len(start), bool)
                new[1:] = (name[1:] != name[:-1]) | (doc[1:] != doc[:-1])
                at = np.flatnonzero(new)
                size = np.diff(np.concatenate((at, [len(start)])))
                cuts = -(-size // STRETCH)
                which = np.repeat(np.arange(len(at)), cuts)
                nth = np.arange(len(which)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
                rows = at[which] + nth * STRETCH
                n = np.minimum(STRETCH, size[which] - nth * STRETCH)
                owner = pa.array(doc[rows])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(owner), part.column("sig").take(owner), pa.array(name[rows]), pa.array((start[rows] - words.first[doc[rows]]).astype(np.int32)), pa.array(n.astype(np.int32))],
                    ["doc_id", "sig", "name", "first", "n"],
                )

    return run


def _zipped(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for part in chunks(batch):
                long = pa.array(np.diff(words_of(part.column("text")).first) >= window)
                part = part.filter(long)
                packed = [pack.compress(t.as_buffer()) for t in part.column("text")]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("sig"), pa.array(packed, pa.binary())], ["doc_id", "sig", "packed"])

    return run


def _cut_out(window: int, hot: bool):
    """The stretches of names that are not hot, or of those that are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                out: list[tuple] = []
                for row in batch.slice(at, 128).to_pylist():
                    wanted = {(s["name"], s["first"], s["n"]) for s in row["stretches"] if s["hot"] == hot}
                    words = _WORD.findall(unpack.decompress(row["packed"]).decode()) if wanted else []
                    out += [(row["doc_id"], row["sig"], name, a, " ".join(words[a : a + n + window - 1])) for name, a, n in wanted]
                columns = list(zip(*out)) if out else [[]] * 5
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "sig", "name", "first", "words"])

    return run


_CUT = "doc_id long, sig int, name long, first int, words string"


def _index(texts: list[str]) -> tuple[FmIndex, np.ndarray, np.ndarray]:
    """The index over texts, with their word ids and the words of each."""
    split = [t.split(" ") for t in texts]
    ids: dict[str, int] = {}
    flat = np.array([ids.setdefault(w, len(ids) + 1) for words in split for w in words], np.int64)
    sizes = np.array([len(words) for words in split], np.int64)
    return FmIndex(flat, sizes), flat, sizes


def _searched(window: int):
    """doc_id, sig, starts: first words of the windows that an earlier document of the shard has."""

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        doc, first = group.column("doc_id").to_numpy(), group.column("first").to_numpy()
        coded = group.column("words").chunk(0).dictionary_encode() if group.num_rows else None
        which = coded.indices.to_numpy()
        owner = np.full(len(coded.dictionary), np.iinfo(np.int64).max)
        np.minimum.at(owner, which, doc)
        index, flat, sizes = _index(coded.dictionary.to_pylist())
        lengths = index.matching(flat, sizes, owner, owner, window)
        before = np.cumsum(sizes) - sizes
        size = (sizes - window + 1)[which]
        row = np.repeat(np.arange(len(which)), size)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
        whole = (owner[which] < doc)[row]
        hit = whole | (lengths[before[which][row] + nth] >= window)
        row, nth = row[hit], nth[hit]
        rows, counts = np.unique(row, return_counts=True)
        starts = lists((first[row] + nth).astype(np.int32), counts, pa.int32())
        return pa.table({"doc_id": group.column("doc_id").take(pa.array(rows)), "sig": group.column("sig").take(pa.array(rows)), "starts": starts})

    return run


def _owned(window: int):
    """words, owner, at: the windows of distinct stretches that an earlier owner has, by position."""

    def run(group: pa.Table) -> pa.Table:
        owner = group.column("owner").to_numpy()
        index, flat, sizes = _index(group.column("words").to_pylist())
        hit = index.matching(flat, sizes, owner, owner, window) >= window
        begin = np.cumsum(sizes) - sizes
        row = np.repeat(np.arange(len(sizes)), sizes)
        at = lists((np.arange(len(flat)) - begin[row])[hit].astype(np.int32), np.bincount(row[hit], minlength=len(sizes)), pa.int32())
        return pa.table({"words": group.column("words"), "owner": group.column("owner"), "at": at})

    return run


def hot_windows(rows: DataFrame, window: int, hot: int, shard: Callable[[str], Column]) -> DataFrame:
    """doc_id, sig and starts of the repeated windows in stretches of hot names (doc_id, sig, name,
    first, words)."""
    rows = stage(rows, "hot")
    distinct = stage(rows.groupBy("name", "words").agg(F.min("doc_id").alias("owner")), "distinct")
    many = distinct.groupBy("name").agg((F.count(F.lit(1)) > hot).alias("many"))
    kinds = distinct.join(many, "name")  # one row a different stretch
    few = kinds.filter(~F.col("many")).select("words", "owner", shard("name").alias("shard"))
    found = few.groupBy("shard").applyInArrow(_owned(window), "words string, owner long, at array<int>")
    split = F.split("words", " ")
    each = F.transform(F.sequence(F.lit(0), F.size(split) - window), lambda i: F.array_join(F.slice(split, i + 1, window), " "))
    single = kinds.filter("many").select("words", "owner", F.posexplode(each).alias("i", "one"))
    least = single.groupBy("one").agg(F.min("owner").alias("least"))
    late = F.when(F.col("least") < F.col("owner"), F.col("i"))
    found = found.union(single.join(least, "one").groupBy("words", "owner").agg(F.collect_list(late).alias("at")))
    every = F.sequence(F.lit(0), F.size(split) - window)
    at = F.when(F.col("owner") < F.col("doc_id"), every).otherwise(F.col("at"))
    return rows.join(found, "words").select("doc_id", "sig", F.transform(at, lambda i: i + F.col("first")).alias("starts")).filter(F.size("starts") > 0)


def repeated_windows(documents: DataFrame, window: int = WINDOW, hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """The compressed texts of documents that may repeat something (doc_id, sig, packed), and per
    repeating document the first words of its repeated windows (doc_id, sig, starts)."""
    rows = keyed(documents).filter("doc_id is not null")
    stretches = rows.mapInArrow(_stretches(window), "doc_id long, sig int, name long, first int, n int")
    names = stretches.groupBy("name").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count(F.lit(1)).alias("found"))
    names = names.filter("low < high").select("name", (F.col("found") > hot).alias("hot"))
    of_doc = stretches.join(names, "name").groupBy("doc_id", "sig").agg(F.collect_list(F.struct("name", "first", "n", "hot")).alias("stretches"))
    of_doc = stage(of_doc, "of_doc")  # what names and stretches took on disk can go before the texts come
    texts = stage(rows.mapInArrow(_zipped(window), "doc_id long, sig int, packed binary").join(of_doc, ["doc_id", "sig"]), "texts")
    words = F.aggregate("stretches", F.lit(0).cast("long"), lambda total, s: total + s["n"] + window - 1)
    about = texts.agg(F.sum(words).alias("words"), F.max(F.exists("stretches", lambda s: s["hot"])).alias("hot")).first()
    shard = lambda key: F.pmod(F.xxhash64(key), F.lit(max(1, -(-(about["words"] or 0) // SHARD_WORDS))))
    pieces = texts.mapInArrow(_cut_out(window, False), _CUT).withColumn("shard", shard("name"))
    hits = pieces.groupBy("shard").applyInArrow(_searched(window), "doc_id long, sig int, starts array<int>")
    if about["hot"]:
        with_hot = texts.filter(F.exists("stretches", lambda s: s["hot"]))
        hits = hits.union(hot_windows(with_hot.mapInArrow(_cut_out(window, True), _CUT), window, hot, shard))
    hits = hits.groupBy("doc_id", "sig").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("starts")))).alias("starts"))
    return texts.select("doc_id", "sig", "packed"), hits


def _without(window: int, joined: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                out: list[tuple] = []
                for row in batch.slice(at, 128).to_pylist():
                    text = unpack.decompress(row["packed"]).decode()
                    spans = [m.span() for m in _WORD.finditer(text)]
                    gone = np.zeros(len(spans) + 1, np.int64)
                    starts = np.array(row["starts"], np.int64)
                    np.add.at(gone, starts, 1)
                    np.add.at(gone, starts + window, -1)
                    gone = np.cumsum(gone)[:-1] > 0
                    if joined:
                        kept = " ".join(text[a:b] for (a, b), g in zip(spans, gone) if not g)
                    else:  # what follows a kept word stays as it is
                        stops = [*(a for a, _ in spans[1:]), len(text)]
                        kept = text[: spans[0][0]] + "".join(text[a:b] for (a, _), b, g in zip(spans, stops, gone) if not g)
                    out.append((row["doc_id"], row["sig"], int(gone.sum()), kept))
                columns = list(zip(*out)) if out else [[]] * 4
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "sig", "n_removed", "kept"])

    return run


def without_repeats(documents: DataFrame, window: int = WINDOW, hot: int = HOT, joined: bool = False) -> DataFrame:
    """doc_id, sig, n_removed and kept text of the documents that lose words. The kept text has the
    spacing of the original, or with ``joined`` one space between words."""
    texts, hits = repeated_windows(documents, window, hot)
    changed = texts.join(hits, ["doc_id", "sig"]).dropDuplicates(["doc_id", "sig"])  # repeated rows
    return changed.mapInArrow(_without(window, joined), "doc_id long, sig int, n_removed long, kept string")


def word_list(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")
