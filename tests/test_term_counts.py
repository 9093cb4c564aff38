"""Terms counted and looked up by batch: the numbers of counting n-grams one by one."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from palate.operators import features
from palate.operators.features import TermRules, TermLookup


def texts(n=60, seed=3):
    rnd = random.Random(seed)
    return [" ".join(rnd.choices([f"w{i}" for i in range(12)], k=rnd.randint(0, 30))) for _ in range(n)] + [None, "", "x y", "w1 w1 w1 w1"]


def grams(text, low, high):
    words = [w for w in (text or "").split() if len(w) > 1]
    return [" ".join(words[i : i + n]) for n in range(low, high + 1) for i in range(len(words) - n + 1)]


@pytest.mark.parametrize("low,high", [(1, 1), (1, 2), (2, 3), (3, 3)])
@pytest.mark.parametrize("tokens", [1, 7, 1 << 20])
def test_counts_are_those_of_the_grams(spark, monkeypatch, low, high, tokens):
    monkeypatch.setattr(features, "COUNTED_TOKENS", tokens)
    df = spark.createDataFrame([(t,) for t in texts()], "text string").repartition(3)
    found = {r["term"]: (r["df"], r["cf"]) for r in features.document_frequencies(df, "text", TermRules(low, high)).collect()}
    cf = Counter(g for t in texts() for g in grams(t, low, high))
    df_ = Counter(g for t in texts() for g in set(grams(t, low, high)))
    assert found == {g: (df_[g], cf[g]) for g in cf}


def test_a_batch_sends_a_term_once():
    """The pieces of a batch, not every occurrence of a term, leave the task."""
    lists = pa.array([["aa", "bb", "aa", "bb"], None, [], ["aa"], ["bb", "aa"]])
    rows = [r for b in features._piece_counts(lists, 1, 2) for r in b.to_pylist()]
    assert sorted(tuple(r.values()) for r in rows) == [("aa", 3, 4), ("aa bb", 1, 2), ("bb", 2, 3), ("bb aa", 2, 2)]


@pytest.mark.parametrize("low,high", [(1, 1), (1, 2), (1, 3), (2, 3)])
def test_lookup_finds_what_the_grams_are(low, high):
    known = sorted({g for t in texts(20, 9) for g in grams(t, 1, 3)})[::3]
    lookup = TermLookup.of(pa.array(known, pa.string()), low, high)
    rows = [(t or "").split() for t in texts()]
    word = lookup.places(pa.array([w for ws in rows for w in ws], pa.string()))
    row, found = lookup.found(word, np.repeat(np.arange(len(rows)), [len(ws) for ws in rows]))
    expected = Counter((i, known.index(g)) for i, ws in enumerate(rows) for n in range(low, high + 1) for g in (" ".join(ws[j : j + n]) for j in range(len(ws) - n + 1)) if g in known)
    assert Counter(zip(row.tolist(), found.tolist())) == expected


def test_lookup_without_terms():
    lookup = TermLookup.of(pa.array([], pa.string()), 1, 2)
    row, found = lookup.found(lookup.places(pa.array(["aa", "bb"])), np.zeros(2, int))
    assert len(row) == len(found) == 0
