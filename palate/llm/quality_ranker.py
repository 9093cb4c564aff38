"""Quality classifier by pairwise ranking.

A Bradley-Terry model gives each document a strength ``w . x`` from features of its whole
text; the chance that document a is preferred to b is ``sigmoid(w . (x_a - x_b))``. The weights
are learned by logistic loss on feature differences of preference pairs (a labelled good
document against a labelled bad one). The strength is turned into a score of 0 to 1 whose
threshold is a quantile of the strengths of the training documents.

Only the weights, a few numbers, leave Spark's tasks: fitting uses at most ``max_labelled``
labelled rows (taken by a hash of the id, so the same on any cluster), scoring is one narrow
pass over all documents.

Defined cases: a null or empty text has zero features and gets a score like any other; a label
row with a null label or an id without a document is ignored; repeated label rows of one id
count once each towards the majority (ties: label 0); without labels of both kinds the model
prefers nothing and every score is 0.5; other columns of either table are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palate.llm.arrays import Words, chunks, words_of

#: Labelled documents the weights are fitted on, at most.
MAX_LABELLED = 20_000
#: Preference pairs drawn from them, at most.
MAX_PAIRS = 200_000
#: Scores at or above this count as good.
THRESHOLD = 0.3

FEATURES = [
    "upper", "digit", "symbol", "exclamation", "stop", "other_punctuation", "non_ascii", "newline",
    "word_length", "log_words", "repeated_words", "repeats_next", "top_word", "few_words",
]


@dataclass(frozen=True)
class Ranker:
    """Weights on standardised features, and the map from strength to score."""

    mean: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]
    cut: float
    slope: float

    def strength(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - np.array(self.mean)) / np.array(self.scale), -8, 8) @ np.array(self.weights)

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 to 1, growing with the strength; THRESHOLD exactly at the cut."""
        if not any(self.weights):
            return np.full(len(x), 0.5)
        at = np.log(THRESHOLD / (1 - THRESHOLD))
        return 1 / (1 + np.exp(-np.clip(at + self.slope * (self.strength(x) - self.cut), -60, 60)))


def features_of(words: Words) -> np.ndarray:
    """A row of FEATURES per text."""
    out = np.zeros((len(words.first) - 1, len(FEATURES)))
    hashes = words.hashes()
    for i in range(len(out)):
        n = int(words.text[i + 1] - words.text[i])
        own = hashes[words.first[i] : words.first[i + 1]]
        if not len(own):
            out[i, -1] = 1
            continue
        of = np.bincount(words.data[words.text[i] : words.text[i + 1]], minlength=256)
        symbols = of[[35, 36, 37, 38, 42, 60, 62, 124]].sum()
        stops = of[[44, 46]].sum()
        punctuation = of[33:48].sum() + of[58:65].sum() + of[91:97].sum() + of[123:127].sum()
        ordered = np.sort(own)
        edges = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1], [True])))
        k = len(own)
        out[i] = (
            of[65:91].sum() / n,
            of[48:58].sum() / n,
            np.log1p(100 * symbols / n),
            np.log1p(100 * of[33] / n),
            stops / k,
            max(0, punctuation - symbols - stops - of[33]) / n,
            of[128:].sum() / n,
            of[10] / k,
            min(30.0, n / k),
            np.log1p(k),
            max(0.0, 1 - (len(edges) - 1) / k - 0.05 * np.log(k)),
            float((own[1:] == own[:-1]).mean()) if k > 1 else 0.0,
            np.diff(edges).max() / (k + 20),
            1 / (1 + k),
        )
    return out


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in chunks(batch):
            rows = features_of(words_of(part.column("text")))
            values = pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), len(FEATURES)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), values], ["doc_id", "x"])


def fit_pairs(good: np.ndarray, bad: np.ndarray, penalty: float = 1e-3, max_pairs: int = MAX_PAIRS) -> np.ndarray:
    """Weights that make ``good`` rows beat ``bad`` rows: Newton steps on the mean logistic loss
    of the differences of at most ``max_pairs`` pairs, plus ``penalty / 2 * |w|^2``."""
    pick = np.random.default_rng(7)
    total = len(good) * len(bad)
    chosen = np.arange(total) if total <= max_pairs else pick.integers(0, total, max_pairs)
    diff = good[chosen // len(bad)] - bad[chosen % len(bad)]
    w = np.zeros(diff.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(np.clip(diff @ w, -60, 60)))
        gradient = -(diff * p[:, None]).mean(0) + penalty * w
        hessian = (diff * (p * (1 - p))[:, None]).T @ diff / len(diff) + penalty * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit_ranker(x: np.ndarray, y: np.ndarray, quantile: float | None = None) -> Ranker:
    """Fit on feature rows and 0/1 labels.

    ``quantile`` is the share of the training strengths that falls below the cut. None takes
    the quantile with the best balanced accuracy on the training rows.
    """
    none = tuple([0.0] * x.shape[1])
    if not len(x) or y.min() == y.max():
        return Ranker(none, tuple([1.0] * x.shape[1]), none, 0.0, 1.0)
    mean, scale = x.mean(0), x.std(0)
    scale[scale < 1e-9] = 1.0
    z = np.clip((x - mean) / scale, -8, 8)
    w = fit_pairs(z[y == 1], z[y == 0])
    s = z @ w
    if quantile is None:
        order = np.argsort(s, kind="stable")
        kept_good = 1 - np.concatenate(([0], np.cumsum(y[order]))) / y.sum()
        dropped_bad = np.concatenate(([0], np.cumsum(1 - y[order]))) / (1 - y).sum()
        both = kept_good + dropped_bad
        best = np.flatnonzero(both >= both.max() - 1e-12)
        quantile = (best[0] + best[-1]) / 2 / len(s)
    cut = float(np.quantile(s, min(1.0, max(0.0, quantile))))
    slope = 4.0 / max(1e-9, float(np.quantile(s, 0.9) - np.quantile(s, 0.1)))
    return Ranker(tuple(mean.tolist()), tuple(scale.tolist()), tuple(w.tolist()), cut, slope)


def train_ranker(
    documents: DataFrame, labels: DataFrame, usable: Column | None = None, max_labelled: int = MAX_LABELLED, quantile: float | None = None
) -> Ranker:
    """Fit on documents (doc_id, text) whose labels (doc_id, quality) satisfy ``usable``."""
    known = labels.select("doc_id", F.col("quality").cast("double").alias("quality")).filter("doc_id is not null and quality in (0, 1)")
    known = known.filter(usable) if usable is not None else known
    known = known.groupBy("doc_id").agg((F.avg("quality") > 0.5).cast("int").alias("quality"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    rows = sample.collect()  # at most max_labelled pairs of numbers
    if not rows:
        return fit_ranker(np.zeros((0, len(FEATURES))), np.zeros(0))
    bounded = documents.sparkSession.createDataFrame([(r["doc_id"], r["quality"]) for r in rows], "doc_id long, quality int")
    texts = documents.select("doc_id", "text").join(F.broadcast(bounded.select("doc_id")), "doc_id", "left_semi")
    featured = texts.mapInArrow(_featured, "doc_id long, x array<double>").groupBy("doc_id").agg(F.min("x").alias("x"))
    of = {r["doc_id"]: r["x"] for r in featured.collect()}  # at most max_labelled short rows
    rows = sorted((r["doc_id"], r["quality"]) for r in rows if r["doc_id"] in of)
    return fit_ranker(np.array([of[d] for d, _ in rows]).reshape(len(rows), len(FEATURES)), np.array([q for _, q in rows], float), quantile)


def score_documents(documents: DataFrame, ranker: Ranker, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of every document, ``score`` and ``predicted``."""
    columns = list(dict.fromkeys([*keep, "text"]))
    chosen = documents.select(*columns)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema if f.name in keep]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                score = ranker.score(features_of(words_of(part.column("text"))))
                kept = [part.column(c) for c in keep]
                predicted = pa.array((score >= THRESHOLD).astype(np.int32))
                yield pa.RecordBatch.from_arrays([*kept, pa.array(score), predicted], [*keep, "score", "predicted"])

    return chosen.mapInArrow(scored, ", ".join([*fields, "score double", "predicted int"]))
