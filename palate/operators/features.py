"""Vocabularies, TF-IDF weights and id sequences as tables.

A bounded vocabulary is looked up inside the row, batch by batch: weights and vectors need no
shuffle. With an unbounded one a document is placed by its key once, before its terms are exploded,
so that what is shuffled is the text and not the many times larger list of terms.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palate.functions import text as tx
from palate.operators.ranks import ranked
from palate.sources.staging import stage

#: Vocabularies up to this size, in terms and in bytes of terms, are sent to every task;
#: ``max_features`` bounds them.
MAX_BROADCAST_TERMS = 1_000_000
MAX_BROADCAST_BYTES = 64 << 20

#: Hash buckets of terms, whose counts the driver holds (a multiple of 64), and the documents from which
#: n-grams are counted in buckets first: it pays once a task sees many more n-grams than buckets.
BUCKETS = 1 << 18
PRUNE_FROM = 2_000_000

#: Rows whose terms a task looks up at a time, and tokens whose terms it counts at a time.
LOOKUP_ROWS = 512
COUNTED_TOKENS = 1 << 20


@dataclass(frozen=True)
class TermRules:
    """How text becomes terms and which terms count."""

    low: int = 1
    high: int = 1
    min_df: float = 1
    max_df: float = 1.0
    max_features: int | None = None
    sublinear: bool = True
    accents: bool = True
    stop_words: list[str] = field(default_factory=list)

    def tokens(self, text: Column) -> Column:
        tokens = tx.words(text, accents=self.accents)
        return tx.without_stopwords(tokens, self.stop_words) if self.stop_words else tokens

    def terms(self, text: Column) -> Column:
        tokens = self.tokens(text)
        return tokens if (self.low, self.high) == (1, 1) else tx.ngrams(tokens, self.low, self.high)


@dataclass(frozen=True)
class TokenRules(TermRules):
    """The same rules for a column that holds the tokens already."""

    def tokens(self, text: Column) -> Column:
        return text


def english_stop_words() -> list[str]:
    from pyspark.ml.feature import StopWordsRemover

    return StopWordsRemover.loadDefaultStopWords("english")


def term_counts(docs: DataFrame, doc: str, text: str, rules: TermRules) -> DataFrame:
    """``(doc, term, tf)``; one shuffle, of the texts."""
    placed = docs.select(F.col(doc).alias("doc"), F.col(text).alias("_text")).repartition("doc")
    exploded = placed.select("doc", F.explode(rules.terms(F.col("_text"))).alias("term"))
    return exploded.groupBy("doc", "term").agg(F.count(F.lit(1)).alias("tf"))


def token_counts(df: DataFrame, text: str, stop_words: list[str]) -> DataFrame:
    """Occurrences of each blank-separated token of two or more characters, stop words left out."""
    tokens = tx.without_stopwords(tx.blank_tokens(F.col(text)), stop_words)
    return df.select(F.explode(tokens).alias("token")).groupBy("token").count()


def document_frequencies(docs: DataFrame, text: str, rules: TermRules) -> DataFrame:
    """``(term, df, cf)``: documents that hold the term, and its occurrences.

    Terms are counted where the documents lie, so texts are not shuffled to be counted by document:
    each task sends one partial row per term it saw.
    """

    return counted_terms(partial_counts(docs, text, rules))


def partial_counts(docs: DataFrame, text: str, rules: TermRules) -> DataFrame:
    """``(term, df, cf)`` of pieces of Arrow batches; a document lies in one piece."""
    low, high = rules.low, rules.high

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in _pieces(batch.column("_tokens")):
                yield from _piece_counts(piece, low, high)

    return docs.select(rules.tokens(F.col(text)).alias("_tokens")).mapInArrow(run, "term string, df long, cf long")


def _sizes(lists: pa.ListArray) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _pieces(lists: pa.ListArray) -> Iterator[pa.ListArray]:
    """Slices of about ``COUNTED_TOKENS`` tokens, a longer row whole."""
    part = np.cumsum(_sizes(lists)) // COUNTED_TOKENS
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(lists)]
    return (lists.slice(a, b - a) for a, b in zip(cuts, cuts[1:]) if b > a)


def _piece_counts(lists: pa.ListArray, low: int, high: int) -> Iterator[pa.RecordBatch]:
    """``(term, df, cf)`` of the n-grams of ``low`` to ``high`` tokens of some documents."""
    row = np.repeat(np.arange(len(lists)), _sizes(lists))
    if not len(row):
        return
    encoded = lists.flatten().dictionary_encode()
    words, word = encoded.dictionary, encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    at, gram, names = np.arange(len(row)), word, words
    for n in range(1, high + 1):
        if n > 1:  # the token n - 1 places on joins each shorter gram of its document
            at, gram = _same_row(at, gram, row, n)
            pairs, gram = np.unique(gram * len(words) + word[at + n - 1], return_inverse=True)
            names = pc.binary_join_element_wise(names.take(pa.array(pairs // len(words))), words.take(pa.array(pairs % len(words))), " ")
        if n >= low:
            held = np.sort(gram * len(lists) + row[at])  # equal neighbours: one document holds the gram again
            held = held[np.diff(held, prepend=-1) > 0] // len(lists)
            counts = [np.bincount(g, minlength=len(names)).astype(np.int64) for g in (held, gram)]
            yield pa.RecordBatch.from_arrays([names, *map(pa.array, counts)], ["term", "df", "cf"])


def _same_row(at: np.ndarray, gram: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The starts, and their grams, that have ``n`` tokens of one row."""
    inside = at + n <= len(row)
    at, gram = at[inside], gram[inside]
    inside = row[at] == row[at + n - 1]
    return at[inside], gram[inside]


def counted_terms(counts: DataFrame) -> DataFrame:
    return counts.groupBy("term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"))


def _as_documents(bound: float, n_docs: int) -> float:
    """A share of the documents, or a number of them when given as an integer."""
    return bound * n_docs if isinstance(bound, float) else bound


def frequent_terms(docs: DataFrame, text: str, rules: TermRules, least_df: float, most_df: float, buckets: int = BUCKETS) -> DataFrame:
    """``(term, df, cf)`` of all terms that may be among the ``max_features`` most frequent ones within
    the document bounds, and of few others. Exact: what is left out can't be among them.

    A first pass counts hash buckets of terms: a bucket's count bounds those of each of its terms from
    above. The terms of the largest buckets are then counted; the ``max_features``-th of them bounds from
    below what a term needs, and only other buckets that reach this are counted too. So bucket counts
    and few terms are shuffled, not every n-gram that a task sees.
    """
    counts = partial_counts(docs, text, rules)
    bucket = F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int")
    # eight buckets share a row, which is nearly all counts then and little key
    eight = [F.sum(F.when(bucket.bitwiseAND(F.lit(7)) == i, F.col("cf")).otherwise(0)).alias(f"cf{i}") for i in range(8)]
    sums = counts.groupBy(F.shiftright(bucket, 3).alias("b")).agg(*eight).toArrow()
    b = (sums.column("b").to_numpy()[:, None] * 8 + np.arange(8)).ravel()
    cf = np.stack([sums.column(f"cf{i}").to_numpy() for i in range(8)], 1).ravel()
    held = (cf > 0) & (cf >= least_df)  # a term occurs as often as documents hold it, or more often
    b, cf = b[held], cf[held]
    order = np.lexsort((b, -cf))
    b, cf = b[order], cf[order]

    def counted(chosen: np.ndarray) -> DataFrame:
        """Exact counts of the terms of these buckets."""
        bits = np.zeros(buckets, np.uint8)
        bits[chosen] = 1
        words = np.packbits(bits, bitorder="little").view(np.int64)
        mask = F.expr(f"array({', '.join(f'{w}L' if w != -(2**63) else 'bigint(-9223372036854775808)' for w in words.tolist())})")
        known = F.getbit(F.element_at(mask, F.shiftright(bucket, 6) + 1), bucket.bitwiseAND(F.lit(63))) == 1
        return counted_terms(counts.filter(known)).filter((F.col("df") >= least_df) & (F.col("df") <= most_df))

    first = stage(counted(b[: 2 * rules.max_features]), "frequent")
    nth = ranked(first, F.desc("cf"), F.col("term")).filter(F.col("rank") == rules.max_features).select("cf").collect()
    rest = b[2 * rules.max_features :][cf[2 * rules.max_features :] >= (nth[0]["cf"] if nth else 0)]
    return first.union(counted(rest)) if len(rest) else first


def vocabulary(docs: DataFrame, text: str, n_docs: int, rules: TermRules) -> DataFrame:
    """Terms within the document bounds; the ``max_features`` most frequent, ties by term."""
    least, most = _as_documents(rules.min_df, n_docs), _as_documents(rules.max_df, n_docs)
    if rules.max_features is not None and rules.high > 1 and n_docs >= PRUNE_FROM:
        kept = frequent_terms(docs, text, rules, least, most)
    else:
        kept = document_frequencies(docs, text, rules).filter((F.col("df") >= least) & (F.col("df") <= most))
    if rules.max_features is None:
        return kept
    return ranked(kept, F.desc("cf"), F.col("term")).filter(F.col("rank") <= rules.max_features).drop("rank")


def known_terms(terms: DataFrame, value: str, most: int = MAX_BROADCAST_TERMS) -> tuple[pa.Array, np.ndarray]:
    """Terms in the order of ``id`` with one value each, on the driver; too large a table is an error."""
    rows = terms.select("term", value, "id").limit(most + 1).collect()
    size = sum(len(r["term"].encode()) for r in rows)
    if len(rows) > most or size > MAX_BROADCAST_BYTES:
        raise ValueError(f"vocabulary too large to look up in a task: over {min(len(rows), most)} terms or {MAX_BROADCAST_BYTES} bytes")
    rows.sort(key=lambda r: r["id"])
    return pa.array([r["term"] for r in rows], pa.string()), np.array([r[value] for r in rows])


def smooth_idf(df: Column, n_docs: int) -> Column:
    """``ln((1 + n) / (1 + df)) + 1``."""
    return F.log(F.lit(1.0 + n_docs) / (1.0 + df)) + 1.0


def plain_idf(df: Column, n_docs: int) -> Column:
    """``ln((n + 1) / (df + 1))``, the form of Spark's own IDF."""
    return F.log(F.lit(1.0 + n_docs) / (1.0 + df))


def idf_table(docs: DataFrame, text: str, rules: TermRules) -> DataFrame:
    n_docs = docs.count()
    frequencies = document_frequencies(docs, text, rules)
    return frequencies.select("term", "df", plain_idf(F.col("df"), n_docs).alias("idf"))


@dataclass(frozen=True)
class Tfidf:
    """A fitted vocabulary ``(term, df, cf, idf[, id])`` and the rules it was made by."""

    rules: TermRules
    terms: DataFrame
    size: int | None

    @cached_property
    def _known(self) -> tuple:
        """Terms, their IDF and their lookup by id, broadcast once per fitted vocabulary and checked in bytes."""
        if self.size is None:
            raise ValueError("vectors need a vocabulary bounded by max_features")
        terms, idf = known_terms(self.terms, "idf")
        return self.terms.sparkSession.sparkContext.broadcast((terms, idf, TermLookup.of(terms, self.rules.low, self.rules.high)))

    def mapped(self, docs: DataFrame, text: str, keep: list[str], fields: list[T.StructField], make: Callable) -> DataFrame:
        """``keep`` columns, and as ``fields`` the arrays that ``make(starts, index, weight)`` returns
        for the sparse rows of a piece of a batch (``starts`` has one entry more than rows).

        Tokens are looked up in the broadcast vocabulary, their runs and counts found per row over
        whole Arrow batches. No shuffle.
        """
        known, sublinear = self._known, self.rules.sublinear
        chosen = docs.select(*keep, self.rules.tokens(F.col(text)).alias("_tokens"))
        schema = T.StructType([*[f for f in chosen.schema if f.name in keep], *fields])
        names = [f.name for f in fields]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            _, idf, lookup = known.value
            for batch in batches:
                sizes, word = _sizes(batch.column("_tokens")), lookup.places(batch.column("_tokens").flatten())
                ends = np.concatenate(([0], np.cumsum(sizes)))
                for at in range(0, batch.num_rows, LOOKUP_ROWS):
                    part = batch.slice(at, LOOKUP_ROWS)
                    tokens = np.repeat(np.arange(len(part)), sizes[at : at + len(part)])
                    row, index, weight = _row_weights(*lookup.found(word[ends[at] : ends[at + len(part)]], tokens), len(part), idf, sublinear)
                    starts = np.searchsorted(row, np.arange(len(part) + 1)).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], *make(starts, index, weight)], [*keep, *names])

        return chosen.mapInArrow(run, schema)

    def vectors(self, docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
        """``keep`` columns and a sparse ``features`` vector per document, of length 1, or
        the zero vector for a document without known terms."""
        size = self.size

        def sparse(starts: np.ndarray, index: np.ndarray, weight: np.ndarray) -> list[pa.Array]:
            n, offsets = len(starts) - 1, pa.array(starts)
            lists = [pa.ListArray.from_arrays(offsets, pa.array(index.astype(np.int32))), pa.ListArray.from_arrays(offsets, pa.array(weight))]
            return [pa.StructArray.from_arrays([pa.array(np.zeros(n, np.int8)), pa.array(np.full(n, size, np.int32)), *lists], ["type", "size", "indices", "values"])]

        return self.mapped(docs, text, keep, [T.StructField("features", VectorUDT())], sparse)

    def weights(self, docs: DataFrame, doc: str, text: str) -> DataFrame:
        """``(doc, term[, id], weight)``, each document's weights of length 1.

        The numbers of ``vectors``, one row per term, and no shuffle: the terms' places are turned
        into terms inside the batch. A vocabulary without a bound is joined instead.
        """
        if self.size is None:
            return self._joined_weights(docs, doc, text)
        known = self._known
        parts = {"id": T.IntegerType(), "term": T.StringType(), "weight": T.DoubleType()}
        found = T.ArrayType(T.StructType([T.StructField(n, t) for n, t in parts.items()]))

        def listed(starts: np.ndarray, index: np.ndarray, weight: np.ndarray) -> list[pa.Array]:
            place = pa.array(index.astype(np.int32))
            entries = pa.StructArray.from_arrays([place, known.value[0].take(place), pa.array(weight)], list(parts))
            return [pa.ListArray.from_arrays(pa.array(starts), entries)]

        rows = self.mapped(docs.select(F.col(doc).alias("doc"), F.col(text).alias("_text")), "_text", ["doc"], [T.StructField("_found", found)], listed)
        return rows.select("doc", F.inline("_found")).select("doc", "term", "id", "weight")

    def _joined_weights(self, docs: DataFrame, doc: str, text: str) -> DataFrame:
        tf = F.col("tf").cast("double")
        known = term_counts(docs, doc, text, self.rules).join(self.terms, "term")
        raw = known.withColumn("_w", (F.log(tf) + 1.0 if self.rules.sublinear else tf) * F.col("idf"))
        norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy("doc")))
        return raw.select("doc", "term", (F.col("_w") / norm).alias("weight"))

    def save(self, path: str) -> None:
        self.terms.write.mode("overwrite").parquet(f"{path}/terms")
        stored = json.dumps({"rules": asdict(self.rules), "size": self.size})
        self.terms.sparkSession.createDataFrame([(stored,)], "value string").write.mode("overwrite").text(f"{path}/rules")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Tfidf:
        stored = json.loads(spark.read.option("wholetext", True).text(f"{path}/rules").first()["value"])
        return Tfidf(TermRules(**stored["rules"]), spark.read.parquet(f"{path}/terms"), stored["size"])


@dataclass(frozen=True)
class TermLookup:
    """The words of a vocabulary and, for every length of its terms, how a run of words goes on: sorted
    keys (shorter run, next word) whose places name the longer runs, and each run's term id or -1."""

    words: pa.Array
    lengths: tuple[tuple[np.ndarray, np.ndarray], ...]

    @staticmethod
    def of(terms: pa.Array, low: int, high: int) -> TermLookup:
        """``terms`` of ``low`` to ``high`` words joined by single spaces, numbered by their place."""
        split = [(i, t.split(" ")) for i, t in enumerate(terms.to_pylist())]
        split = [(i, ws) for i, ws in split if low <= len(ws) <= high]
        words = sorted({w for _, ws in split for w in ws})
        place = {w: p for p, w in enumerate(words)}
        runs, lengths = {i: 0 for i, _ in split}, []
        for n in range(1, max((len(ws) for _, ws in split), default=0) + 1):
            split = [(i, ws) for i, ws in split if len(ws) >= n]
            of_term = {i: runs[i] * len(words) + place[ws[n - 1]] for i, ws in split}
            keys = np.unique(np.array(list(of_term.values()), np.int64))
            runs = dict(zip(of_term, np.searchsorted(keys, list(of_term.values())).tolist()))
            ids = np.full(len(keys), -1, np.int64)
            for i, ws in split:
                if len(ws) == n:
                    ids[runs[i]] = i
            lengths.append((keys, ids))
        return TermLookup(pa.array(words, pa.string()), tuple(lengths))

    def places(self, tokens: pa.Array) -> np.ndarray:
        """The place of each token among the words, -1 for others."""
        return pc.fill_null(pc.index_in(tokens, value_set=self.words), -1).to_numpy(zero_copy_only=False).astype(np.int64)

    def found(self, word: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row and term id of every known term among the tokens of some rows."""
        rows, ids = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        at, run = np.arange(len(word)), np.zeros(len(word), np.int64)
        for n, (keys, term) in enumerate(self.lengths, 1):
            at, run = _same_row(at, run, row, n)
            following = word[at + n - 1]
            key = run * len(self.words) + following
            run = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            same = (following >= 0) & (keys[run] == key)
            at, run = at[same], run[same]
            hit = term[run] >= 0
            rows.append(row[at[hit]])
            ids.append(term[run[hit]])
        return np.concatenate(rows), np.concatenate(ids)


def _row_weights(row: np.ndarray, found: np.ndarray, n_rows: int, idf: np.ndarray, sublinear: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, term id and weight of every distinct known term, by row and id; rows have length 1."""
    pair, tf = np.unique(row * (len(idf) + 1) + found, return_counts=True)
    row, index = pair // (len(idf) + 1), pair % (len(idf) + 1)
    weight = (np.log(tf) + 1.0 if sublinear else tf.astype(float)) * (idf[index] if len(index) else 1.0)
    norm = np.sqrt(np.bincount(row, weight * weight, minlength=n_rows))
    return row, index, weight / norm[row]


def count_vectors(docs: DataFrame, tokens: str, terms: list[str], rules: TermRules) -> DataFrame:
    """``features``: occurrences of each of ``terms``, numbered by their place, among a row's tokens and runs
    of them, as a sparse vector. What Spark's counter gives, over whole Arrow batches; no shuffle."""
    listed = pa.array(terms, pa.string())
    known = docs.sparkSession.sparkContext.broadcast(TermLookup.of(listed, rules.low, rules.high))
    size = len(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, LOOKUP_ROWS):
                lists = batch.column(tokens).slice(at, LOOKUP_ROWS)
                n = len(lists)
                row, found = known.value.found(known.value.places(lists.flatten()), np.repeat(np.arange(n), _sizes(lists)))
                pair, counts = np.unique(row * size + found, return_counts=True)
                starts = pa.array(np.searchsorted(pair, np.arange(n + 1) * size).astype(np.int32))
                entries = [pa.ListArray.from_arrays(starts, pa.array((pair % size).astype(np.int32))), pa.ListArray.from_arrays(starts, pa.array(counts.astype(np.float64)))]
                vectors = pa.StructArray.from_arrays([pa.array(np.zeros(n, np.int8)), pa.array(np.full(n, size, np.int32)), *entries], ["type", "size", "indices", "values"])
                yield pa.RecordBatch.from_arrays([vectors], ["features"])

    return docs.select(tokens).mapInArrow(run, T.StructType([T.StructField("features", VectorUDT())]))


def fit_tfidf(docs: DataFrame, text: str, rules: TermRules) -> Tfidf:
    """Vocabulary and IDF of ``docs``. Terms are numbered in alphabetical order when
    ``max_features`` bounds them."""
    n_docs = docs.count()
    chosen = vocabulary(docs, text, n_docs, rules)
    chosen = chosen.withColumn("idf", smooth_idf(F.col("df"), n_docs))
    if rules.max_features is None:
        return Tfidf(rules, stage(chosen, "vocabulary"), None)
    # at most max_features rows
    terms = stage(chosen.withColumn("id", F.row_number().over(Window.orderBy("term")) - 1), "vocabulary")
    return Tfidf(rules, terms, terms.count())


def tfidf(docs: DataFrame, doc: str, text: str, rules: TermRules) -> DataFrame:
    return fit_tfidf(docs, text, rules).weights(docs, doc, text)


# Fixed values of the sequence encoder: id 0 pads, id 1 stands for unknown words.
PAD_ID, UNKNOWN_ID = 0, 1


def sequence_vocabulary(docs: DataFrame, text: str, max_words: int = 20_000) -> DataFrame:
    """``(term, id)`` of the most frequent words; ids start at 2, so that ids stay below ``max_words``."""
    counts = docs.select(F.explode(tx.sequence_tokens(F.col(text))).alias("term")).groupBy("term").count()
    top = ranked(counts, F.desc("count"), F.col("term")).filter(F.col("rank") <= max(max_words - 2, 0))
    return top.select("term", (F.col("rank") + 1).alias("id"))


def encode_sequences(
    docs: DataFrame, terms: DataFrame, doc: str, text: str, max_length: int = 200
) -> DataFrame:
    """``(doc, ids)``: word ids, cut and zero-padded at the end to ``max_length``.

    A lookup within the row: no shuffle, and rows that share a key stay rows of their own. The
    vocabulary goes to every task; its size is checked.
    """
    words, ids = known_terms(terms, "id")
    known = docs.sparkSession.sparkContext.broadcast((words, ids))
    chosen = docs.select(F.col(doc).alias("doc"), F.slice(tx.sequence_tokens(F.col(text)), 1, max_length).alias("_words"))
    schema = T.StructType([chosen.schema["doc"], T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, ids = known.value
        by_place = np.append(ids, UNKNOWN_ID).astype(np.int32)
        for batch in batches:
            column = batch.column("_words")
            sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
            place = pc.fill_null(pc.index_in(column.flatten(), value_set=words), len(words)).to_numpy(zero_copy_only=False)
            out = np.full((len(column), max_length), PAD_ID, np.int32)
            row = np.repeat(np.arange(len(column)), sizes)
            out[row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = by_place[place]
            offsets = pa.array(np.arange(len(column) + 1, dtype=np.int32) * max_length)
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.ListArray.from_arrays(offsets, pa.array(out.ravel()))], ["doc", "ids"])

    return chosen.mapInArrow(run, schema)


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """``n / (classes * n_class)`` per class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    everything = Window.partitionBy(F.lit(0))  # one row per class
    weight = F.sum("n").over(everything) / (F.count(F.lit(1)).over(everything) * F.col("n"))
    return counts.select(label, "n", weight.alias("weight"))


def naive_bayes_parameters(docs: DataFrame, text: str, label: str, smoothing: float = 1.0) -> DataFrame:
    """``(label, term, log_prior, log_probability)`` of a multinomial model with two classes."""
    classes = [0, 1]
    flat = docs.filter(F.col(label).isin(classes)).select(F.col(label).alias("y"), F.explode(tx.words(F.col(text))).alias("term"))
    counts = stage(flat.groupBy("term").agg(*[F.count(F.when(F.col("y") == c, 1)).alias(f"n{c}") for c in classes]), "term_counts")
    sums = counts.agg(F.count(F.lit(1)).alias("v"), *[F.sum(f"n{c}").alias(f"n{c}") for c in classes]).first()
    sizes = docs.agg(*[F.count(F.when(F.col(label) == c, 1)).alias(f"d{c}") for c in classes]).first()
    rows = []
    for c in classes:
        prior = F.log(F.lit((sizes[f"d{c}"] + smoothing) / (sizes["d0"] + sizes["d1"] + smoothing * len(classes))))
        total = (sums[f"n{c}"] or 0) + smoothing * sums["v"]
        likelihood = F.log((F.col(f"n{c}") + smoothing) / F.lit(float(total)))
        rows.append(F.struct(F.lit(c).alias("label"), "term", prior.alias("log_prior"), likelihood.alias("log_probability")))
    return counts.select(F.inline(F.array(*rows)))
