from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from palate import lexicons
from palate.functions.polarity import PolarityRules
from palate.functions.text import split_sentences
from palate.operators import aspects, topics
from palate.plans import insights

RULES = PolarityRules(lexicons.SEED_VALENCE, lexicons.SEED_NEGATORS, lexicons.SEED_BOOSTERS)
REVIEWS = [
    (1, "p", 4, "2010-05-01", "The coffee tastes rich and fresh. I would love to buy it again!"),
    (2, "p", 0, "2010-06-01", "The package arrived crushed. The food was stale and inedible."),
    (3, "q", 2, "2011-06-01", "The flavor is excellent, but the shipping was late. The box was damaged."),
    (4, "q", None, None, "The chocolate tastes delicious. The packaging was damaged. Delivery was very late."),
    (5, "r", 1, "2011-01-01", "Nothing to say here."),
]


@pytest.fixture(scope="module")
def reviews(spark):
    schema = "_record_id int, product_id string, helpfulness_numerator int, day string, review_text_clean string"
    rows = spark.createDataFrame(REVIEWS, schema)
    return rows.withColumn("review_timestamp", F.col("day").cast("timestamp")).drop("day")


@pytest.fixture(scope="module")
def long(reviews):
    return aspects.aspect_sentiment(reviews, lexicons.REVIEW_ASPECTS, RULES).cache()


@pytest.fixture(scope="module")
def sentences(reviews):
    rows = reviews.select("_record_id", F.posexplode(split_sentences(F.col("review_text_clean"))).alias("i", "sentence_text"))
    return rows.withColumn("sentence_id", F.concat_ws("-", "_record_id", "i"))


def test_lexicon_sizes():
    assert len(lexicons.REVIEW_ASPECTS) == 8 and len(lexicons.SENTENCE_ASPECTS) == 9


def test_weak_labels_equal_word_patterns(sentences):
    labelled = aspects.weak_labels(sentences, lexicons.SENTENCE_ASPECTS).collect()
    for row in labelled:
        for aspect, terms in lexicons.SENTENCE_ASPECTS.items():
            hit = re.search(r"\b(?:" + "|".join(map(re.escape, terms)) + r")\b", row["sentence_text"], re.IGNORECASE)
            assert row[f"weak_{aspect}"] == int(bool(hit))
        assert row["seed_aspects"] == [a for a in lexicons.SENTENCE_ASPECTS if row[f"weak_{a}"]]


def test_phrases_of_two_words(spark):
    rows = spark.createDataFrame([("It is sugar free and of HIGH quality",), ("shelf-life",)], "sentence_text string")
    found = [r["seed_aspects"] for r in aspects.weak_labels(rows, lexicons.SENTENCE_ASPECTS).collect()]
    assert found == [["ingredients_health", "quality"], []]


def test_review_sentiment_equals_mean_over_sentences(spark, long, sentences):
    scored = aspects.sentence_polarity(sentences, RULES)
    flagged = aspects.weak_labels(scored, lexicons.REVIEW_ASPECTS).collect()
    found = {(r["_record_id"], r["aspect"]): r for r in long.collect()}
    assert len(found) == len(REVIEWS) * len(lexicons.REVIEW_ASPECTS)
    for (record, aspect), row in found.items():
        hits = [r["polarity"] for r in flagged if r["_record_id"] == record and r[f"weak_{aspect}"]]
        if hits:
            assert row["compound"] == pytest.approx(sum(hits) / len(hits))
        else:
            assert row["compound"] is None and row["sentiment"] == "not_mentioned"


def test_long_form_needs_no_shuffle(long, reviews, capsys):
    aspects.aspect_sentiment(reviews, lexicons.REVIEW_ASPECTS, RULES).explain()
    assert "Exchange" not in capsys.readouterr().out


def test_ranking(long):
    ranking = insights.aspect_ranking(long).collect()
    by_aspect = {r["aspect"]: r for r in ranking}
    assert "portion" not in by_aspect and "health" not in by_aspect
    packaging = by_aspect["packaging"]
    assert packaging["mentions"] == 3 and packaging["mention_rate"] == pytest.approx(3 / 5) and packaging["pct_negative"] == 1.0
    taste = [r for r in long.collect() if r["aspect"] == "taste" and r["compound"] is not None]
    weights = [(r["helpfulness_numerator"] or 0) + 1 for r in taste]
    negative = sum(w for w, r in zip(weights, taste) if r["sentiment"] == "negative")
    assert by_aspect["taste"]["weighted_pct_negative"] == pytest.approx(negative / sum(weights))
    shares = [(-r["weighted_pct_negative"], r["aspect"]) for r in ranking]
    assert shares == sorted(shares)


def test_ranking_without_votes(long):
    ranking = insights.aspect_ranking(long.drop("helpfulness_numerator")).collect()
    assert all(r["weighted_pct_negative"] == pytest.approx(r["pct_negative"]) for r in ranking)


def test_trend_leaves_out_unknown_years(long):
    assert {r["year"] for r in insights.aspect_trend(long).collect()} == {2010, 2011}


def test_product_breakdown(long):
    rows = insights.product_breakdown(long, list(lexicons.REVIEW_ASPECTS), 2).collect()
    assert [(r["product_id"], r["n_reviews"]) for r in rows] == [("p", 2), ("q", 2)]
    assert rows[0]["price"] is None and rows[1]["packaging"] == 1.0


def test_headlines(long):
    found = {r["headline"]: r["aspect"] for r in insights.headlines(insights.aspect_ranking(long)).collect()}
    assert found["strongest_positive"] == "taste" and set(found) == {
        "biggest_pain_point", "strongest_positive", "most_endorsed_complaint",
    }


def test_coverage_of_an_unmentioned_aspect_is_zero(long):
    found = {r["aspect"]: r for r in insights.aspect_coverage(long).collect()}
    assert tuple(found["portion"])[1:] == (0.0, 0.0, 0.0)


def test_support_check(sentences):
    labelled = aspects.weak_labels(sentences, lexicons.SENTENCE_ASPECTS).withColumn("development_split", F.lit("train"))
    found = {r["aspect"]: r for r in aspects.aspect_support(labelled, ["taste", "portion_quantity"], minimum=2).collect()}
    assert found["taste"]["supported"] and not found["portion_quantity"]["supported"]
    with pytest.raises(ValueError, match="portion_quantity"):
        aspects.check_aspect_support(labelled, ["portion_quantity"], 1)


def test_topic_mapping(spark):
    rows = spark.createDataFrame(
        [(0, 0, "fresh"), (0, 1, "stale"), (0, 2, "crisp"), (1, 0, "zebra"), (2, 0, "taste"), (2, 1, "box")],
        "topic int, position int, term string",
    )
    found = {r["topic"]: tuple(r)[1:] for r in topics.map_topics(rows, lexicons.REVIEW_ASPECTS).collect()}
    assert found == {
        0: ("fresh, stale, crisp", "freshness", 3),
        1: ("zebra", "emergent_or_unclear", 0),
        2: ("taste, box", "taste", 1),  # a tie goes to the aspect listed first
    }
