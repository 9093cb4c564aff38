"""Operators without SQL against plain versions of what they promise."""

from __future__ import annotations

import collections
import math
import os
import random
import sys

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import nasty  # noqa: E402

public_tokenizers = pytest.importorskip("public_tokenizers")

from palate.llm import quality_ranker, sharding, token_counts  # noqa: E402
from palate.llm.queries import QUERIES  # noqa: E402

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


# --- op1 ---


def test_pairwise_weights_minimise_the_loss():
    """Against plain gradient descent on all pairs."""
    rng = np.random.default_rng(1)
    good, bad = rng.standard_normal((30, 3)) + [1, 0, -0.5], rng.standard_normal((25, 3))
    w = quality_ranker.fit_pairs(good, bad, penalty=0.05)
    slow = np.zeros(3)
    for _ in range(4_000):
        gradient = 0.05 * slow
        diff = (good[:, None, :] - bad[None, :, :]).reshape(-1, 3)
        gradient -= (diff / (1 + np.exp(diff @ slow))[:, None]).mean(0)
        slow -= 0.3 * gradient
    assert np.abs(w - slow).max() < 1e-6


def test_scores_tell_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in QUERIES["op1_quality_ranker"](spark, folder).collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    held = [(got[d]["score"], q, got[d]["predicted"]) for d, q in labels.items() if d in got and got[d]["held_out"]]
    one, zero = [s for s, q, _ in held if q == 1], [s for s, q, _ in held if q == 0]
    auc = sum((a > b) + (a == b) / 2 for a in one for b in zero) / (len(one) * len(zero))
    assert auc > 0.9 and all(0 <= s <= 1 and p == (s >= 0.3) for s, _, p in held)
    assert len(got) == spark.read.parquet(f"{folder}/documents.parquet").count()


# --- op8 ---


def shard(key: int | None, weights: list[float]) -> int:
    """The shard with the largest weighted number, by the hash of key and shard."""
    best = None
    for i, w in enumerate(weights):
        if w <= 0:
            continue
        seed = 42 if key is None else xxhash.xxh64_intdigest(key.to_bytes(8, "little", signed=True), 42)
        h = xxhash.xxh64_intdigest(i.to_bytes(4, "little"), seed)
        u = ((h >> 12) + 0.5) / 2.0**52
        rank = (-w / math.log(u), -i)
        if best is None or rank > best[0]:
            best = rank, i
    return best[1]


def test_shards_against_plain_hashing(spark):
    weights = [1.0, 0.5, 0.0, 2.0, 1.0]
    keys = [None, *random.Random(2).sample(range(-(1 << 40), 1 << 40), 800)]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    for r in df.select("k", sharding.shard_of(F.col("k"), weights).alias("s")).collect():
        assert r["s"] == shard(r["k"], weights)


def test_the_shard_query_against_plain_hashing(spark):
    folder = "/root/testdata/sf0.001"
    got = QUERIES["op8_rendezvous_shards"](spark, folder).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    slots = collections.defaultdict(list)
    for r in got:
        assert r["shard"] == shard(r["doc_id"], [1.0] * 40) and r["grown_shard"] == shard(r["doc_id"], [1.0] * 41)
        assert r["size"] == len((texts[r["doc_id"]] or "").encode()) + 16 and r["law"] == "key"
        slots[r["shard"]].append(r["slot"])
    assert len(got) == len(texts) and all(sorted(s) == list(range(len(s))) for s in slots.values())


# --- op9 ---


def plain_counts(text: str) -> list[int]:
    """Tokens per line: every token to the line that holds most of its characters, the earlier of equals."""
    encoder, _ = token_counts._encoder(RANKS, PATTERN)
    data, at, spans = text.encode(), 0, []
    for token in encoder.encode_ordinary(text):
        size = len(encoder.decode_single_token_bytes(token))
        # characters whose bytes the token holds at least one of
        first = sum(b & 0xC0 != 0x80 for b in data[: at + 1]) - 1
        last = sum(b & 0xC0 != 0x80 for b in data[: at + size]) - 1
        spans.append(range(first, last + 1))
        at += size
    line_of, line = [], 0
    for c in text:
        line_of.append(line)
        line += c == "\n"
    counts = [0] * (text.count("\n") + 1)
    for span in spans:
        held = collections.Counter(line_of[c] for c in span)
        counts[min(held, key=lambda k: (-held[k], k))] += 1
    return counts


def test_tokens_per_line_against_the_tokens_own_bytes(spark):
    texts = [t for t in nasty.texts() if t and len(t) < 3_000] + ["a\n\n\nb", "\n", "日本\n語 テ\n", "x\r\n\r\ny", "😀\n😀😀\n", "é" * 20 + "\n" + " " * 9 + "\n\n\tz"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = collections.defaultdict(dict)
    for r in token_counts.attributed(df, RANKS, PATTERN).collect():
        got[r["doc_id"]][r["section"]] = r["n_tokens"]
    for i, text in enumerate(texts):
        assert [got[i][k] for k in sorted(got[i])] == plain_counts(text), text[:60]
