"""Polarity rules against plain Python, and long phrase lists against patterns."""

from __future__ import annotations

import math
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from palate import lexicons
from palate.functions import phrases, text
from palate.functions.polarity import PolarityRules, polarity
from palate.operators import aspects

RULES = PolarityRules(lexicons.SEED_VALENCE, lexicons.SEED_NEGATORS, lexicons.SEED_BOOSTERS)


def plain_polarity(sentence: str, rules: PolarityRules) -> float:
    words = re.findall(r"\w+(?:'[^\W\d_]+)?", sentence)
    capitals = [w.upper() == w and w.lower() != w for w in words]
    mixed = any(capitals) and not all(capitals)
    low = [w.lower() for w in words]
    turn = next((i for i, w in enumerate(low) if w in rules.contrast), None)
    total = 0.0
    for i, w in enumerate(low):
        if w not in rules.valence or w in rules.boosters:
            continue
        v = rules.valence[w]
        v += math.copysign(0.733, v) if mixed and capitals[i] else 0.0
        for distance, share in ((1, 1.0), (2, 0.95), (3, 0.9)):
            j = i - distance
            if j < 0:
                break
            if low[j] in rules.boosters:
                v += math.copysign(share, v) * (rules.boosters[low[j]] + (0.733 if mixed and capitals[j] else 0.0))
            if low[j] in rules.negators:
                v *= -0.74
        if turn is not None:
            v *= 0.5 if i < turn else 1.5 if i > turn else 1.0
        total += v
    marks = 0.292 * min(sentence.count("!"), 4)
    questions = sentence.count("?")
    marks += 0.0 if questions < 2 else 0.18 * questions if questions <= 3 else 0.96
    total += marks if total > 0 else -marks if total < 0 else 0.0
    return total / math.sqrt(total * total + 15)


SENTENCES = [
    "The coffee tastes rich and fresh, and I would love it again.",
    "Not good.", "It isn't really very good, it is the worst", "not one two three good", "nothing here", "", "Good good good!",
    "GOOD coffee", "GOOD COFFEE", "good COFFEE", "VERY good but not very TASTY!!!!!", "very very very good", "so bad? really??", "bad????",
    "slightly not bad", "good but", "but good", "no BUT good", "très good, ça", "I LOVE it", "it's so-so good",
]


def random_sentences(n: int) -> list[str]:
    rnd = random.Random(12)
    pool = [*lexicons.SEED_VALENCE, *lexicons.SEED_NEGATORS * 2, *lexicons.SEED_BOOSTERS, "but", "but", "the", "coffee", "été", "it's", "42"]
    word = lambda: (lambda w: w.upper() if rnd.random() < 0.2 else w.capitalize() if rnd.random() < 0.2 else w)(rnd.choice(pool))
    return ["".join(word() + rnd.choice([" ", " ", " ", ", ", "! ", "? ", "-"]) for _ in range(rnd.randint(0, 14))) for _ in range(n)]


def test_polarity_equals_the_plain_rules(spark):
    sentences = SENTENCES + random_sentences(1_500)
    df = spark.createDataFrame(list(enumerate(sentences)), "i int, s string").repartition(3)
    for r in df.select("i", "s", F.expr(polarity("s", RULES)).alias("p")).collect():
        assert r["p"] == pytest.approx(plain_polarity(r["s"], RULES), abs=1e-12), r["s"]


def test_polarity_of_odd_rules_and_rows(spark):
    df = spark.createDataFrame([("It's good, boost'er",), (None,)], "s string")
    rules = PolarityRules({"it's": 1.0, "boost'er": -4.0}, ["o\\'k"], {"so": 1.0})
    got = [r[0] for r in df.select(F.expr(polarity("s", rules))).collect()]
    assert got == [pytest.approx(plain_polarity("It's good, boost'er", rules)), None]
    assert [r[0] for r in df.select(F.expr(polarity("s", PolarityRules({})))).collect()] == [0.0, None]
    scored = aspects.sentence_polarity(df.withColumnRenamed("s", "odd `name"), RULES, "odd `name")
    assert scored.count() == 2 and scored.columns == ["odd `name", "polarity", "polarity_class"]


def test_polarity_stays_in_the_row(spark):
    plan = aspects.sentence_polarity(spark.createDataFrame([("x",)], "sentence_text string"), RULES)._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Python" not in plan


# --- phrases ---

ODD_TEXTS = ["shelf life", "Shelf  life", "shelf-life", "SHELF LIFE.", "xshelf life", "a shelf life b", "shelf", "", None, "ſhelf LIFE", "K kelvin", "STRASSE straße", "ΣΑΣ σας", "İstanbul istanbul ISTANBUL ıstanbul", "sugar-free 5% c++ don't", "_x x_ x", "x", "é É é", "life\nshelf\tlife shelf life"]


def test_phrases_equal_patterns(spark):
    rnd = random.Random(3)
    bits = ["shelf", "life", "x", "LIFE", "Éa", "éA", "5%", "c++", "don't", "it's", "k", "K", "straße", "σας", "istanbul", "_x", "1", "good"]
    texts = ODD_TEXTS + ["".join(rnd.choice(bits) + rnd.choice([" ", " ", "  ", ".", "-", "\n", ", "]) for _ in range(rnd.randint(1, 9))) for _ in range(600)]
    lists = {"one": ["shelf life", "x", "éa", "K"], "two": ["life shelf life", "straße", "ΣΑΣ", "istanbul", "shelf life"], "odd": ["5%", "c++", "don't", "x x"], "odd `n": ["it's", "1"], "empty": []}
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(3)
    found = aspects.with_mentions(df, lists, {n: f"f_{n}" for n in lists}, "t")
    for n, terms in lists.items():
        expected = text.mentions(F.col("t"), terms) if terms else F.when(F.col("t").isNotNull(), False)
        found = found.withColumn(f"e_{n}", expected.cast("int"))
    for r in found.collect():
        for n in lists:
            assert r[f"f_{n}"] == r[f"e_{n}"], (n, r["t"])


def test_letters_fold_like_a_pattern_without_case(spark):
    letters = [chr(c) for c in range(0x21, 0x2000) if chr(c).isalpha() and chr(c) != "ẞ"]  # Java's patterns keep it from ß
    rows = [(c, d) for c in letters for d in {c.lower(), c.upper(), phrases.folded(c)} if len(d) == 1]
    df = spark.createDataFrame(rows, "c string, d string")
    got = df.select("c", "d", (F.expr(phrases.fold("c")) == F.expr(phrases.fold("d"))).alias("same"), F.expr(phrases.fold("c")).alias("f")).collect()
    for r in got:
        assert r["f"] == phrases.folded(r["c"]), r
    regex = df.select("c", "d", F.expr("c RLIKE concat('(?iu)^', d, '$')").alias("same")).collect()
    by = {(r["c"], r["d"]): r["same"] for r in regex}
    assert all(r["same"] == by[r["c"], r["d"]] for r in got), [(r, by[r["c"], r["d"]]) for r in got if r["same"] != by[r["c"], r["d"]]][:9]


def test_twenty_thousand_phrases_cost_what_twenty_cost(spark):
    words = [f"term{i}" for i in range(15_000)] + [f"two part{i}" for i in range(5_000)]
    rnd = random.Random(1)
    rows = [(i, " ".join(rnd.choice(["word", "other", "two part", f"term{rnd.randint(0, 40_000)}", f"part{rnd.randint(0, 9_000)}"]) for _ in range(60))) for i in range(3_000)]
    df = spark.createDataFrame(rows, "i int, t string").repartition(4).cache()
    df.count()

    def timed(terms):
        plan = aspects.with_mentions(df, {"a": terms}, {"a": "a"}, "t").select("i", "a")
        plan.collect()
        started = time.perf_counter()
        out = {r["i"]: r["a"] for r in plan.collect()}
        return time.perf_counter() - started, out

    few, _ = timed(words[:20])
    many, found = timed(words)
    known = set(words)
    for i, t in rows:
        tokens = t.split(" ")
        assert found[i] == int(any(w in known for w in tokens) or any(f"{a} {b}" in known for a, b in zip(tokens, tokens[1:])))
    assert many < 5 * few + 1
