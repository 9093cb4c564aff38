"""Source mix, whitening and Merkle manifest against plain-Python versions of their definitions."""

from __future__ import annotations

import collections
import hashlib
import math
import os
import random
import sys
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import nasty  # noqa: E402

pytest.importorskip("public_tokenizers")

from palate.llm import fair_mix, merkle, ordered, whitening  # noqa: E402
from palate.llm.queries import QUERIES  # noqa: E402

# --- running sums ---


def test_running_sums_over_a_hot_group_and_null_groups(spark):
    rnd = random.Random(3)
    rows = [("hot" if i % 3 else rnd.choice(["a", "b", None]), rnd.randint(0, 40), rnd.randint(0, 9), i) for i in range(900)]
    df = spark.createDataFrame(rows, "g string, k int, v long, u long").repartition(7)
    got = {r["u"]: (r["before"], r["all"]) for r in ordered.running(df, [F.col("k"), F.col("u")], "before", "v", "g", "all").collect()}
    assert len(got) == len(rows)
    for g, k, _, u in rows:
        own = [r for r in rows if r[0] == g]
        assert got[u] == (sum(r[2] for r in own if (r[1], r[3]) < (k, u)), sum(r[2] for r in own))
    flat = {r["u"]: r["n"] for r in ordered.running(df, [F.col("k"), F.col("u")], "n").collect()}
    assert [flat[r[3]] for r in sorted(rows, key=lambda r: (r[1], r[3]))] == list(range(len(rows)))


# --- mixing ---


def plain_targets(sizes: dict, epochs: int = 3) -> dict:
    """Shares by weight, cut at ``epochs`` times the size, the rest shared again by weight."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    full: dict = {}
    while True:
        left = sum(sizes.values()) - sum(full.values())
        weights = sum(weight[s] for s in names if s not in full)
        over = {s: epochs * sizes[s] for s in names if s not in full and weight[s] * left / weights > epochs * sizes[s]}
        if not over:
            return {s: full.get(s, weight[s] * left / weights if s not in full else 0) for s in names}
        full |= over


def mix_rows() -> list[tuple]:
    rnd = random.Random(5)
    rows = [(i, "w " * rnd.randint(0, 60), "b") for i in range(400)]
    rows += [(1_000 + i, "w " * rnd.randint(1, 20), "a") for i in range(25)]
    rows += [(2_000 + i, "w " * rnd.randint(1, 9), "é") for i in range(6)] + [(3_000, "w " * 30_000, "d")]
    rows += [(4_000 + i, None if i % 2 else "one two\x0bthree", None) for i in range(4)] + [(None, "x y", "a"), (5, "w w w", "b"), (5, "w w w", "b"), (70_000, "", "empty")]
    return [(d, t, "en", s, 1, "clash", 9) for d, t, s in rows]


MIX_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, queue string, target int"


def test_mix_meets_targets_and_is_whole(spark):
    rows = mix_rows()
    got = fair_mix.taken(spark.createDataFrame(rows, MIX_SCHEMA).repartition(6)).collect()
    assert len(got) == len(rows)
    sizes: collections.Counter = collections.Counter()
    for _, t, _, s, *_ in rows:
        sizes[s] += len(nasty.words(t))
    assert sorted((r["doc_id"] or -1, r["size"], r["source_size"]) for r in got) == sorted((d or -1, len(nasty.words(t)), sizes[s]) for d, t, _, s, *_ in rows)
    targets = plain_targets(dict(sizes))
    of = {d: s for d, _, _, s, *_ in rows}
    taken: collections.Counter = collections.Counter()
    for r in got:
        s = of[r["doc_id"]]
        assert r["target"] == pytest.approx(targets[s], rel=1e-12) and 0 <= r["taken"] <= 3 * r["size"]
        taken[s] += r["taken"]
    assert sum(taken.values()) == sum(sizes.values())
    assert all(abs(taken[s] - targets[s]) <= len(targets) for s in targets), (taken, targets)
    assert targets["d"] > sizes["b"] or targets["a"] == 3 * sizes["a"]  # the data hold a source that is used up
    again = fair_mix.taken(spark.createDataFrame(rows, MIX_SCHEMA).repartition(3)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_sequence_is_in_the_order_of_virtual_finish(spark):
    rows, sources, mix = fair_mix.mixed(spark.createDataFrame(mix_rows(), MIX_SCHEMA))
    served = sorted(mix.collect(), key=lambda r: r["at"])
    weight = {r["queue"]: r["weight"] for r in sources.collect()}
    words: collections.Counter = collections.Counter()
    total = 0
    for before, r in zip([None, *served], served):
        assert r["at"] == total and (before is None or (before["finish"], before["queue"]) < (r["finish"], r["queue"]))
        words[r["queue"]] += r["words"]
        total += r["words"]
        if r is not served[-1]:
            assert r["finish"] == words[r["queue"]] / weight[r["queue"]]
    whole = {r["row"]: r["size"] for r in rows.collect()}
    epochs: dict = {}
    for r in served:  # a copy is served only after the same document's earlier one
        assert epochs.get(r["row"], -1) == r["epoch"] - 1 and r["words"] <= whole[r["row"]]
        epochs[r["row"]] = r["epoch"]


def test_mix_takes_a_smaller_budget_and_other_weights(spark):
    _, sources, mix = fair_mix.mixed(spark.createDataFrame(mix_rows(), MIX_SCHEMA), weights=(1,), epochs=1, budget=900)
    assert mix.agg(F.sum("words")).first()[0] == 900
    assert sources.agg(F.sum("target")).first()[0] == pytest.approx(900)


def test_mix_of_nothing(spark):
    empty = spark.createDataFrame([], MIX_SCHEMA)
    assert fair_mix.taken(empty).count() == 0
    blank = spark.createDataFrame([(1, None, "en", None, 0, "", 0), (2, "  ", "en", "a", 0, "", 0)], MIX_SCHEMA)
    assert sorted((r["doc_id"], r["size"], r["target"], r["taken"]) for r in fair_mix.taken(blank).collect()) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]


def test_mix_has_no_python(spark):
    plan = fair_mix.taken(spark.createDataFrame(mix_rows(), MIX_SCHEMA))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# --- whitening ---

VECTORS = "vec_id long, embedding array<double>, x string, component string"


def plain_whitening(rows: list[tuple]) -> dict:
    d = collections.Counter(len(v) for _, v in rows).most_common(1)[0][0]
    x = {i: np.array([math.floor(64 * c) + 1_000_000 for c in v], object) for i, v in rows if len(v) == d}
    fit = np.array(sorted({tuple(v) for v in x.values()}), float)
    n, sums = len(fit), fit.sum(0)
    centred = fit - sums / n
    e, v = np.linalg.eigh(centred.T @ centred / n)
    e, v = e[::-1], v[:, ::-1]
    out = {}
    for i, row in x.items():
        deviation = sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums))
        out[i] = (n, deviation, [float((row.astype(float) - sums / n) @ v[:, k] / math.sqrt(e[k])) for k in range(min(16, d))])
    return out | {"explained": e / e.sum()}


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x", "c") for i, v in rows], VECTORS).repartition(4)


def test_whitening_against_a_dense_solver(spark):
    rng = np.random.default_rng(2)
    turn = np.linalg.qr(rng.standard_normal((20, 20)))[0]
    rows = [(i, [float(c) for c in (rng.standard_normal(20) * 2.0 ** -(np.arange(20) / 2)) @ turn * 5 + 3]) for i in range(700)]
    rows += [(900 + i, rows[0][1]) for i in range(300)]  # copies count once in the fit
    bad = [(2_000, None), (2_001, [1.0] * 19 + [None]), (2_002, [1.0] * 19 + [math.nan]), (2_003, [math.inf] + [1.0] * 19), (2_004, []), (2_005, [1.0] * 3), (2_006, [1e300] * 20)]
    got = whitening.whitened(vectors(spark, rows + bad)).collect()
    expected = plain_whitening(rows)
    assert len(got) == 16 * len(rows)
    by = collections.defaultdict(dict)
    for r in got:
        by[r["component"]][r["vec_id"]] = r
        assert (r["n"], r["deviation"]) == expected[r["vec_id"]][:2]
        assert r["explained"] == pytest.approx(expected["explained"][r["component"] - 1], rel=1e-9)
        assert r["identity_error"] < 1e-9
    for k in range(1, 17):
        ours = np.array([by[k][i]["whitened"] for i, _ in rows])
        theirs = np.array([expected[i][2][k - 1] for i, _ in rows])
        assert min(np.abs(ours - theirs).max(), np.abs(ours + theirs).max()) < 1e-7, k


def test_moments_are_exact_for_wide_entries(spark):
    rng = np.random.default_rng(4)
    rows = [[int(v) for v in rng.integers(-(1 << 41), 1 << 41, 3)] for _ in range(50)]
    fitted = whitening.fit(spark.createDataFrame([(r,) for r in rows], "x array<long>").repartition(3), 3)
    assert fitted.sums == [sum(r[i] for r in rows) for i in range(3)]
    for i in range(3):
        for j in range(3):
            exact = (50 * sum(r[i] * r[j] for r in rows) - fitted.sums[i] * fitted.sums[j]) / 2_500
            assert fitted.covariance[i, j] == exact


@pytest.mark.parametrize("values", [[1.0, 2, 3], [5.0, 5, 5, 1, 1], [10.0**-k for k in range(9)], [float(k // 2) for k in range(40)], [2.0, 2.0], [1.0, 0, 0, 0]])
def test_components_of_known_spectra(values):
    turn = np.linalg.qr(np.random.default_rng(len(values)).standard_normal((len(values), len(values))))[0]
    matrix = turn @ np.diag(values) @ turn.T
    matrix = (matrix + matrix.T) / 2
    e, v = whitening.components(matrix, 16)
    wanted = sorted((x for x in values if x > 0), reverse=True)[:16]
    assert np.allclose(e, wanted, rtol=1e-12, atol=1e-15 * max(values) * len(values))
    assert np.abs(v.T @ v - np.eye(len(e))).max() < 1e-13
    assert np.abs(matrix @ v - v * e).max() < 1e-13 * max(values)
    assert np.abs(whitening.polar(matrix - 0.3 * np.eye(len(values))) @ v - v * np.sign(e - 0.3)).max() < 1e-12


def test_whitening_of_little(spark):
    assert whitening.whitened(vectors(spark, [])).count() == 0
    assert whitening.whitened(vectors(spark, [(1, None)])).count() == 0
    assert whitening.whitened(vectors(spark, [(1, [1.0, 2.0]), (None, [1.0, 2.0])])).count() == 0  # one distinct vector
    got = whitening.whitened(vectors(spark, [(1, [1.0, 2.0, 5.0]), (None, [3.0, 2.0, 5.0]), (None, [3.0, 2.0, 5.0])])).collect()
    assert sorted((r["vec_id"] or 0, r["component"], r["n"], round(abs(r["whitened"]), 9), r["deviation"]) for r in got) == [(0, 1, 2, 1.0, 128**2), (0, 1, 2, 1.0, 128**2), (1, 1, 2, 1.0, 128**2)]


# --- Merkle manifest ---


def h(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row: tuple, text: str | None) -> str:
    d, _, lang, source, n = row[:5]
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (d, source, lang, n, text)))


def plain_tree(nodes: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    paths: list[list[tuple[str, str]]] = [[] for _ in nodes]
    at = list(range(len(nodes)))
    while len(nodes) > 1:
        for i, a in enumerate(at):
            low = a - a % 3
            paths[i].append(("".join(nodes[low:a]), "".join(nodes[a + 1 : low + 3])))
            at[i] = a // 3
        nodes = [h("".join(nodes[i : i + 3])) for i in range(0, len(nodes), 3)]
    return nodes[0], paths


def plain_manifest(rows: list[tuple]) -> list[tuple]:
    sources: dict = collections.defaultdict(list)
    for r in rows:
        d, text = r[:2]
        even = d is not None and zlib.crc32(str(d).encode()) % 2 == 0
        sources[r[3]].append((d is not None, d or 0, plain_leaf(r, text), plain_leaf(r, text.replace("\n", "") if even and text else text), d))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: plain_tree([leaf for *_, leaf, _, _ in sorted(sources[s])]) for s in names}
    root, over = plain_tree([trees[s][0] for s in names])
    out = []
    for s, beyond in zip(names, over):
        for (_, _, leaf, seen, d), own in zip(sorted(sources[s]), trees[s][1]):
            path, folded = [*own, *beyond], seen
            for a, b in path:
                folded = h(a + folded + b)
            out.append((d, leaf, trees[s][0], root, h("".join(a + b for a, b in path)), folded, folded == root))
    return out


def merkle_rows() -> list[tuple]:
    rnd = random.Random(8)
    rows = [(i, f"text {i}\nline" if i % 3 else f"plain {i}", "en", "big", i, "x", 1) for i in rnd.sample(range(10_000), 260)]
    rows += [(i, f"a\n\n{i}", None, s, None, "x", 1) for i, s in zip(range(20_000, 20_090), ["é", None, "", "src10", "src2"] * 18)]
    rows += [(7, None, "en", "lone", 1, "x", 1), (None, "no id\n", "en", "big", 1, "x", 1), (None, "no id\n", "en", "big", 1, "x", 1)]
    rows += [(42, "twice\n", "en", "big", 1, "x", 1)] * 3 + [(42, "other", "en", "big", 1, "x", 1), (8, "long " * 50_000, "en", "lone2", 1, "x", 1)]
    return rows


MERKLE_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, block long"


def manifest_of(spark, rows, **options):
    df = spark.createDataFrame(rows, MERKLE_SCHEMA).repartition(5)
    cut = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return [tuple(r) for r in merkle.manifest(df, cut, **options).collect()]


@pytest.mark.parametrize("block", [3, 27, 3**7])
def test_manifest_against_plain_trees(spark, block):
    got = manifest_of(spark, merkle_rows(), size=block)
    expected = plain_manifest(merkle_rows())
    assert sorted(map(str, got)) == sorted(map(str, expected))
    assert any(r[-1] for r in got) and not all(r[-1] for r in got)


def test_superblocks_bound_the_groups(spark):
    nodes, outer = merkle.trees(merkle.leaves(spark.createDataFrame(merkle_rows(), MERKLE_SCHEMA)), 27)
    assert nodes.groupBy("tree", "block").count().agg(F.max("count")).first()[0] <= 27
    assert outer.groupBy("tree", "block").count().filter("count > 1").count() == 0


def test_proofs_fold_to_the_root(spark):
    got = merkle.proofs(spark.createDataFrame(merkle_rows(), MERKLE_SCHEMA), 9).collect()
    assert len(got) == len(merkle_rows()) and len({r["root"] for r in got}) == 1
    assert all(merkle.fold(r["leaf"], r["path"]) == r["root"] for r in got)
    assert all(merkle.fold(h(r["leaf"]), r["path"]) != r["root"] for r in got)


def test_manifest_of_little(spark):
    assert manifest_of(spark, []) == []
    one = [(1, None, None, None, None, "x", 1)]
    assert manifest_of(spark, one) == plain_manifest(one)
    assert manifest_of(spark, one)[0][4] == h("")  # no siblings


def test_queries_are_registered():
    assert {"op11_fair_mix", "op12_spectral_whitening", "op13_merkle_manifest"} <= set(QUERIES)
