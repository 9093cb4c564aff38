from __future__ import annotations

import hashlib
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from palate.functions import keys, labels, text


@pytest.mark.parametrize(
    ("raw", "number"),
    [(" +5 ", 5), ("-1", -1), ("4.0", None), ("99999999999999999999", None), ("", None), (None, None), ("x", None)],
)
def test_safe_integral(column, raw, number):
    assert column(lambda c: labels.safe_integral(c, "int"), raw) == number


@pytest.mark.parametrize(
    ("raw", "clean"),
    [
        ("good.<br /><br />bad", "good.. . bad"),
        ("&amp;quot;", "and quot;"),
        ("<p></p>", ". ."),
        ("a&quot;b&#39;c&apos;d&nbsp;e&#160;f", "a\"b'c'd e f"),
        ("<B class='x'>bold</B> &AMP; more\n\n\tlines ", "bold and more lines"),
        ("plain text", "plain text"),
        ("   ", ""),
        (None, None),
    ],
)
def test_clean_html(column, raw, clean):
    assert column(text.clean_html, raw) == clean


def test_collapse_equals_plain_pattern(column):
    for raw in ("a  b", "a\tb", "a \n b", "\t\ta", "a b c", "", "a\x0bb", "x \t"):
        assert column(text.collapse, raw) == re.sub(r"[ \t\n\x0b\f\r]+", " ", raw)


@pytest.mark.parametrize("raw", ["one", "one two", "one two three", ""])
def test_count_words(column, raw):
    assert column(text.count_words, raw) == len(re.split(r"\s+", raw))


def test_sentences_of_a_double_break(column):
    parts = column(lambda c: text.split_sentences(text.clean_html(c)), "good.<br /><br />bad")
    assert parts == ["good..", ".", "bad"]


def test_review_sentences_break_at_lines(column):
    raw = "  First one! Second\nthird.\r\n\r\n Fourth?  "
    assert column(text.review_sentences, raw) == ["First one!", "Second", "third.", "Fourth?"]


def test_text_without_sentences_is_one(column):
    assert column(text.spoken_sentences, "no end mark") == ["no end mark"]
    assert column(text.spoken_sentences, "") == [""]


def test_clean_letters_keeps_outer_blanks(column):
    assert column(text.clean_letters, "<b>It's</b> 5 STARS!") == " it s stars "


def test_words_and_ngrams(column):
    assert column(text.words, "I'm a Café-goer, x_1!") == ["café", "goer", "x_1"]
    assert column(lambda c: text.ngrams(text.words(c), 1, 2), "one two three") == ["one", "two", "three", "one two", "two three"]
    assert column(lambda c: text.ngrams(text.words(c), 2, 3), "one two three") == ["one two", "two three", "one two three"]
    assert column(lambda c: text.ngrams(text.words(c), 1, 2), "one") == ["one"]
    assert column(lambda c: text.ngrams(text.words(c), 1, 2), "!") == []


def test_sequence_tokens(column):
    assert column(text.sequence_tokens, "Good, good!\tNot-bad\n") == ["good", "good", "not", "bad"]


def test_strip_accents(column):
    raw = "Éclair à la crème, Ångström Ñandú é ż"
    expected = "".join(c for c in unicodedata.normalize("NFKD", raw) if not unicodedata.combining(c))
    assert column(text.strip_accents, raw) == expected
    assert column(text.strip_accents_any, raw + " ﬁ ½") == expected + " fi 1⁄2"


def test_mentions_whole_words_and_phrases(column):
    def hit(raw, *terms):
        return column(lambda c: text.mentions(c, list(terms)), raw)

    assert hit("Shelf Life was short", "shelf life")
    assert hit("STALE!", "stale")
    assert not hit("installed", "stale")
    assert not hit("éstale", "stale")
    assert not hit("stale_2", "stale")


@pytest.mark.parametrize(
    ("score", "name", "label"), [(1, "negative", 0), (2, "negative", 0), (3, "neutral", None), (4, "positive", 1), (5, "positive", 1)]
)
def test_classes(column, score, name, label):
    assert column(labels.sentiment_class, score, "t int") == name
    assert column(labels.binary_label, score, "t int") == label


@pytest.mark.parametrize(
    ("value", "bucket"),
    [(0.05, "positive"), (0.049, "neutral"), (0.0, "neutral"), (-0.05, "negative"), (None, "not_mentioned")],
)
def test_polarity_bucket(column, value, bucket):
    assert column(labels.polarity_bucket, value, "t double") == bucket


def test_help_weight(spark):
    votes = spark.createDataFrame([(3,), (None,)], "helpfulness_numerator int")
    assert [r[0] for r in votes.select(labels.help_weight(votes)).collect()] == [4.0, 1.0]
    bare = spark.createDataFrame([(1,)], "x int")
    assert bare.select(labels.help_weight(bare)).first()[0] == 1.0


def test_record_id_layout(spark):
    row = spark.createDataFrame([("f", None, "p")], "a string, b string, c string")
    expected = hashlib.sha256(b"f||||p").hexdigest()
    assert row.select(keys.record_id(F.col("a"), F.col("b"), F.col("c"))).first()[0] == expected


@pytest.mark.parametrize("kind", ["xxhash64", "md5", "sha2"])
def test_hash_order_is_kept_by_buckets_and_nested_by_fraction(spark, kind):
    rows = spark.range(2000).select(keys.order_hash(F.col("id"), kind=kind).alias("h"))
    rows = rows.withColumns(
        {
            "b": keys.order_bucket(F.col("h"), kind),
            "some": keys.hash_below(F.col("h"), 0.3, kind),
            "more": keys.hash_below(F.col("h"), 0.6, kind),
            "all": keys.hash_below(F.col("h"), 1.0, kind),
            "none": keys.hash_below(F.col("h"), 0.0, kind),
        }
    )
    found = rows.orderBy("h").collect()
    assert [r["b"] for r in found] == sorted(r["b"] for r in found)
    assert all(r["more"] for r in found if r["some"]) and all(r["all"] for r in found) and not any(r["none"] for r in found)
    assert 500 < sum(r["some"] for r in found) < 700


def test_strip_accents_of_any_script(spark):
    texts = ["plain", "", None, "Ünï ﬁ ½", "Ελλάδα ή", "क्षि नी", "ㄱ 한", "é" * 3_000, "ạ́b"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", text.strip_accents_any(F.col("t")).alias("p")).collect()
    for r in rows:
        expected = None if r["t"] is None else "".join(c for c in unicodedata.normalize("NFKD", r["t"]) if not unicodedata.combining(c))
        assert r["p"] == expected
