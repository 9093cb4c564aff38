"""Operators over whole tables: duplicates, passages, shards, search, pipeline."""

from __future__ import annotations

import collections
import os
import random
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import nasty  # noqa: E402

pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402
from palate.llm import components, learned_partitions, near_duplicates, numbering, repeated_passages, sharding  # noqa: E402
from palate.llm.fm_index import BitRank, FmIndex  # noqa: E402


def test_components_are_the_smallest_reachable(spark):
    rnd = random.Random(8)
    edges = [(rnd.randint(0, 150), rnd.randint(0, 150)) for _ in range(110)] + [(i, i + 1) for i in range(200, 230)] + [(300, 300), (5, 4), (4, 5)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def near_by_id(df) -> dict:
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect() if r["doc_id"] is not None}


def dense_group() -> list[tuple[int, str]]:
    """Copies with one to three words changed, in a common frame that other documents share too."""
    rnd = random.Random(12)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(6))
    base, frame = [word() for _ in range(90)], " ".join(word() for _ in range(30))
    out = []
    for i in range(60):
        own = list(base)
        for _ in range(rnd.choice([0, 1, 2, 3])):
            own[rnd.randrange(90)] = word()
        out.append((i, " ".join(own)))
    out += [(100 + i, frame + " " + " ".join(word() for _ in range(rnd.choice([5, 12, 40])))) for i in range(40)]
    return out


@pytest.mark.parametrize("block", [384, 8])
def test_near_duplicates_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(near_duplicates, "BLOCK", block)
    rows = dense_group()
    got = near_by_id(near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)))
    sets = {d: nasty.shingles(t) for d, t in rows}
    of = nasty.components(sets)
    assert got == {d: (len(sets[d]), of[d], of[d] == d) for d in sets}


def test_near_duplicates_of_odd_documents(spark):
    result = near_duplicates.near_duplicates(nasty.documents(spark))
    rows = result.collect()
    assert len(rows) == len(nasty.rows())
    sets = {d: nasty.shingles(t) for d, t, *_ in nasty.rows() if d is not None}
    of = nasty.components(sets)
    assert near_by_id(result) == {d: (len(sets[d]), of[d], of[d] == d) for d in sets}
    assert all(r["component_id"] is None and r["kept"] for r in rows if r["doc_id"] is None)
    assert near_duplicates.near_duplicates(nasty.nothing(spark)).count() == 0


def test_shared_values_are_counted_in_slices(monkeypatch):
    monkeypatch.setattr(near_duplicates, "PRODUCT", 3)
    rnd = random.Random(4)
    one, two = ([np.array(sorted(rnd.sample(range(40), rnd.randint(0, 20))), np.int64) for _ in range(9)] for _ in range(2))
    expected = [[len(set(a.tolist()) & set(b.tolist())) for b in two] for a in one]
    assert near_duplicates.shared_counts(one, two).tolist() == expected


def test_sketch_overlap_is_a_safe_bound():
    rnd = random.Random(1)
    for k in (8, 64):
        assert sum(sum(rnd.random() < 0.75 for _ in range(k)) < near_duplicates.least_overlap(k) for _ in range(3_000)) == 0


def test_bits_and_index_against_scanning():
    rnd = random.Random(5)
    bits = np.array([rnd.random() < 0.4 for _ in range(517)])
    at = np.arange(518)
    assert (BitRank(bits).rank(at) == np.concatenate(([0], np.cumsum(bits)))).all()
    for _ in range(40):
        segments = [[rnd.randint(1, rnd.choice([2, 5, 40])) for _ in range(rnd.randint(1, 30))] for _ in range(rnd.randint(1, 30))]
        index = FmIndex(np.array(sum(segments, [])), np.array([len(s) for s in segments]))
        m = rnd.randint(1, 5)
        patterns = [[rnd.randint(0, 50) for _ in range(m)] for _ in range(20)] + [s[i : i + m] for s in segments for i in range(len(s) - m + 1)]
        low, high = index.search(np.array(patterns))
        owner = np.array([rnd.randint(0, 99) for _ in segments])
        found = {}
        for p, a, b in zip(patterns, low, high):
            places = [k for k, s in enumerate(segments) for i in range(len(s) - m + 1) if s[i : i + m] == p]
            assert len(places) == b - a
            found[tuple(p)] = min((owner[k] for k in places), default=None)
        some = high > low
        for p, least in zip([p for p, x in zip(patterns, some) if x], index.least(low[some], high[some], owner)):
            assert least == found[tuple(p)]


@pytest.mark.parametrize("least", [1, 3, 6])
def test_matching_statistics_against_scanning(least):
    rnd = random.Random(least)
    for _ in range(25):
        segments = [[rnd.randint(1, rnd.choice([2, 4, 30])) for _ in range(rnd.randint(1, 24))] for _ in range(rnd.randint(1, 25))]
        segments += [list(rnd.choice(segments)) for _ in range(3)]
        flat, sizes = np.array(sum(segments, [])), np.array([len(s) for s in segments])
        owner = np.array([rnd.randint(0, 20) for _ in segments])
        before = np.array([rnd.randint(0, 21) for _ in segments])
        got = FmIndex(flat, sizes).matching(flat, sizes, before, owner, least)
        earlier = [[s for s, o in zip(segments, owner) if o < limit] for limit in before]

        def longest(i, k):
            runs = [segments[k][i : i + n] for n in range(len(segments[k]) - i + 1)]
            held = lambda run: any(run == s[a : a + len(run)] for s in earlier[k] for a in range(len(s) - len(run) + 1))
            return max((n for n, run in enumerate(runs) if n and held(run)), default=0)

        expected = np.array([longest(i, k) for k, s in enumerate(segments) for i in range(len(s))])
        assert (np.where(got >= least, got, 0) == np.where(expected >= least, expected, 0)).all()
        if least == 1:
            assert (got == expected).all()
    assert len(FmIndex(np.zeros(0, np.int64), np.zeros(0, np.int64)).matching(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))) == 0


@pytest.mark.parametrize(("hot", "shard"), [(20_000, 250_000), (1, 200)])
def test_repeats_against_plain_python(spark, monkeypatch, hot, shard):
    monkeypatch.setattr(repeated_passages, "SHARD_WORDS", shard)
    by_id = {d: t for d, t, *_ in nasty.rows() if d is not None}
    gone = nasty.removed(by_id)
    got = {r["doc_id"]: r for r in repeated_passages.without_repeats(nasty.documents(spark), hot=hot, joined=True).collect()}
    assert set(got) == {d for d, g in gone.items() if any(g)}
    for d, r in got.items():
        kept = [w for w, g in zip(nasty.words(by_id[d]), gone[d]) if not g]
        assert (r["n_removed"], r["kept"]) == (sum(gone[d]), " ".join(kept)), d


def test_repeats_keep_spacing_and_need_two_documents(spark):
    passage = " ".join(f"w{i}" for i in range(15))
    rows = [(1, passage, 0), (2, f"new\n\n{passage}\tand  on", 0), (2, f"new\n\n{passage}\tand  on", 0), (3, f"x {passage} {passage}", 0), (None, passage, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, sig int")
    got = {r["doc_id"]: (r["n_removed"], r["kept"]) for r in repeated_passages.without_repeats(df).collect()}
    assert got == {2: (15, "new\n\nand  on"), 3: (30, "x ")}
    assert repeated_passages.without_repeats(nasty.nothing(spark)).count() == 0
    alone = spark.createDataFrame([(5, f"{passage} {passage}")], "doc_id long, text string")
    assert repeated_passages.without_repeats(alone).count() == 0


def test_numbers_are_gapless(spark, monkeypatch):
    rows = [(i % 3 if i % 11 else None, i // 2 if i % 13 else None) for i in range(200)]
    got = collections.defaultdict(list)
    for r in numbering.numbered(spark.createDataFrame(rows, "g int, k long"), "g", "k", "n").collect():
        got[r["g"]].append(r["n"])
    assert sum(map(len, got.values())) == 200
    assert all(sorted(x) == list(range(len(x))) for x in got.values())


def test_a_new_shard_only_takes(spark):
    keys = spark.range(4_000).select(F.col("id").alias("k"))
    weights = [1.0, 2.0, 0.0, 1.0]
    got = keys.select("k", sharding.shard_of(F.col("k"), weights).alias("a"), sharding.shard_of(F.col("k"), [*weights, 1.0]).alias("b")).collect()
    assert all(r["b"] in (r["a"], 4) for r in got)
    share = collections.Counter(r["a"] for r in got)
    assert share[2] == 0 and abs(share[1] / 4_000 - 0.5) < 0.04 and abs(share[0] / 4_000 - 0.25) < 0.04
    with pytest.raises(ValueError):
        sharding.shard_of(F.col("k"), [0.0])


def test_sharded_tables(spark):
    rows = [(1, 5), (1, 5), (None, 2), (None, 3), *[(i, i) for i in range(300)]]
    got = sharding.sharded(spark.createDataFrame(rows, "k long, x int"), "k", [1.0] * 7, order=["x"]).collect()
    assert sorted((r["k"] or -1, r["x"]) for r in got) == sorted((k or -1, x) for k, x in rows)
    slots = collections.defaultdict(list)
    shard_of = collections.defaultdict(set)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        shard_of[r["k"]].add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and all(len(s) == 1 for s in shard_of.values())
    assert sharding.sharded(spark.createDataFrame([], "k long, x int"), "k", [1.0] * 3).count() == 0


def exact(ids: np.ndarray, x: np.ndarray, query: int, wanted: int) -> list[int]:
    q = x[list(ids).index(query)]
    score = (x @ q) / (np.sqrt((x * x).sum(1)) * np.sqrt(q @ q))
    return [int(i) for s, i in sorted((-round(float(s), 12), int(i)) for s, i in zip(score, ids) if i != query)][:wanted]


def test_search_finds_most_neighbours(spark, monkeypatch):
    monkeypatch.setattr(learned_partitions, "PART_ROWS", 150)
    monkeypatch.setattr(learned_partitions, "BLOCK", 40)
    monkeypatch.setattr(learned_partitions, "QUERY_BLOCK", 5)
    pick = np.random.default_rng(3)
    centre = pick.normal(size=(12, 16))
    x = (centre[pick.integers(0, 12, 1_500)] + 0.4 * pick.normal(size=(1_500, 16))).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = collections.defaultdict(list)
    for r in learned_partitions.nearest(df, F.col("id") % 50 == 0).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append(r["vec_id"])
        assert r["rank"] == len(got[r["query_id"]])
    ids = np.arange(1_500)
    shares = [len(set(got[q]) & set(exact(ids, x.astype(float), q, 5))) / 5 for q in range(0, 1_500, 50)]
    assert np.mean(shares) >= 0.9
    router = learned_partitions.fit_router(learned_partitions.unit(x.astype(float)), 1_500, 5)
    assert len(router.b2) == 8 and 1 <= router.probes < 8


def test_parts_are_balanced():
    x = learned_partitions.unit(np.random.default_rng(1).normal(size=(515, 8)))
    part = learned_partitions.balanced_parts(x, learned_partitions.neighbour_graph(x, 5), 8)
    assert np.ptp(np.bincount(part, minlength=8)) <= 3


def test_search_over_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (50, [2.0, 0.0]), (7, [3.0, 0.0]), (3, [1.0, 1.0]), (4, [0.0, 0.0]), (5, None), (6, [nan, 1.0]), (8, [inf, 1.0]), (9, [1.0, None]), (10, [1.0]), (100, [0.0, 0.0]), (None, [1.0, 2.0]), (11, [1e300, 1e300])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, id string")
    got = [(r["query_id"], r["rank"], r["vec_id"], round(r["score"], 9)) for r in learned_partitions.nearest(df, F.col("id") % 50 == 0).orderBy("query_id", "rank").collect()]
    half = round(0.5**0.5, 9)
    assert got == [(0, 1, 7, 1.0), (0, 2, 50, 1.0), (0, 3, 3, half), (0, 4, 11, half), (50, 1, 0, 1.0), (50, 2, 7, 1.0), (50, 3, 3, half), (50, 4, 11, half)]
    assert learned_partitions.nearest(df.limit(0), F.col("id") % 50 == 0).count() == 0


@pytest.mark.parametrize("copies", [2, 6])
def test_a_repeated_query_row_gets_all_its_neighbours(spark, monkeypatch, copies):
    monkeypatch.setattr(learned_partitions, "BLOCK", 4)
    monkeypatch.setattr(learned_partitions, "QUERY_BLOCK", 1)
    angle = lambda id, degrees: (id, [float(np.cos(np.radians(degrees))), float(np.sin(np.radians(degrees)))])
    others = [angle(i, 10 * i) for i in range(1, 9)]
    rows = [angle(0, 0)] * copies + [angle(50, 84), angle(50, 1), angle(50, 1)] + others
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got = collections.defaultdict(list)
    for r in learned_partitions.nearest(df, F.col("id") % 50 == 0).orderBy("query_id", "rank", "vec_id").collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"]))
    # a repeated row is found as often as it stands; a query is answered once for each of its vectors
    assert got[0] == [(1, 50), (2, 50), (3, 1), (4, 2), (5, 3)]
    near_1 = [0] * min(copies, 5) + [1, 2, 3]
    assert got[50] == sorted([*enumerate(near_1[:5], 1), *enumerate([8, 7, 6, 5, 4], 1)])


def test_pipeline_stages_take_effect(spark, tmp_path):
    labels = [(i, int(i % 4 > 0)) for i in range(0, 40)]
    nasty.documents(spark).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "near_dedup", "passages", "personal_data", "packing"]
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    judged = stages["quality"](spark, docs, str(tmp_path))
    assert judged.columns == corpus_pipeline.COLUMNS and 0 < judged.count() <= len(nasty.rows())
    single = stages["near_dedup"](spark, docs, str(tmp_path)).collect()
    of = nasty.components({d: nasty.shingles(t) for d, t, *_ in nasty.rows() if d is not None})
    assert sorted(r["doc_id"] for r in single if r["doc_id"] is not None) == sorted(d for d, c in of.items() if c == d)
    assert sum(r["doc_id"] is None for r in single) == 2
    cut = {r["doc_id"]: r for r in stages["passages"](spark, docs, str(tmp_path)).collect()}
    by_id = {d: t for d, t, *_ in nasty.rows() if d is not None}
    for d, gone in nasty.removed(by_id).items():
        assert nasty.words(cut[d]["text"]) == [w for w, g in zip(nasty.words(by_id[d]), gone) if not g]
        assert any(gone) or cut[d]["text"] == by_id[d]
    hidden = {r["doc_id"]: r for r in stages["personal_data"](spark, docs, str(tmp_path)).collect()}
    last = max(by_id)
    assert hidden[last]["text"] == "mail <EMAIL>, <PHONE> and <IP>, card <CARD>; IBAN <IBAN> " and hidden[last]["n_chars"] == len(hidden[last]["text"])
    assert all(hidden[d]["text"] == t for d, t in by_id.items() if d != last)
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert {"doc_id", "bucket", "batch", "slot"} <= set(packed.columns) and packed.count() > 0


def test_texts_of_one_id_are_judged_each_for_itself(spark, tmp_path):
    rnd = random.Random(4)
    prose = lambda: " ".join("".join(rnd.choice("abcdefghij") for _ in range(6)) for _ in range(80))
    copied, near, own, other = prose(), prose(), prose(), prose()
    changed = near + " tail"
    twice = prose()
    texts = [(3, copied), (5, own), (5, copied), (5, own), (6, near), (7, changed), (7, other), (8, other + " tail"), (9, twice), (9, twice + " tail"), (9, twice.upper())]
    docs = spark.createDataFrame([(i, t, "en", "src", len(t)) for i, t in texts], "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    got = sorted((r["doc_id"], r["text"]) for r in corpus_pipeline.near_dedup(spark, docs, str(tmp_path)).collect())
    assert got[:-1] == [(3, copied), (5, own), (6, near), (7, other)]
    assert got[-1] in texts[-3:]


def test_pipeline_of_an_empty_table(spark, tmp_path):
    nasty.nothing(spark).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
