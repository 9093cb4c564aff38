from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from checks import fixture
from palate.operators import quality
from palate.plans import layers, research
from palate.sources import tables

SMALL = "/root/testdata/sf0.001"

RAW = "Id string, ProductId string, UserId string, ProfileName string, HelpfulnessNumerator string, HelpfulnessDenominator string, Score string, Time string, Summary string, Text string"


def raw(spark, *rows):
    """Reviews given as the fields that differ from a sound one."""
    sound = {
        "Id": "1", "ProductId": "p", "UserId": "u", "ProfileName": "n", "HelpfulnessNumerator": "1",
        "HelpfulnessDenominator": "2", "Score": "5", "Time": "1303862400", "Summary": "s", "Text": "Good. Very good!",
    }
    return spark.createDataFrame([tuple({**sound, "Id": str(i), **r}.values()) for i, r in enumerate(rows, 1)], RAW)


def silver_of(spark, *rows):
    return layers.to_silver(layers.to_bronze(raw(spark, *rows), F.lit("file")))


def test_bronze_is_lossless(spark):
    rows = raw(spark, {"Score": "x"}, {"Text": None}, {"Id": "007"}, {})
    bronze = layers.to_bronze(rows, F.lit("file"))
    assert bronze.count() == 4
    assert set(layers.BRONZE_COLUMNS) == set(bronze.columns)
    assert bronze.filter("raw_id = '007'").count() == 1


@pytest.mark.parametrize(
    "broken",
    [
        {"Id": "99999999999999999999"}, {"Id": "a"}, {"Id": None}, {"ProductId": " "}, {"UserId": None}, {"Score": "0"},
        {"Score": "6"}, {"Score": "4.0"}, {"Text": "   "}, {"Text": None}, {"HelpfulnessNumerator": "3"},
        {"HelpfulnessNumerator": "-1"}, {"HelpfulnessDenominator": None},
    ],
)
def test_invalid_rows_leave(spark, broken):
    assert [r["id"] for r in silver_of(spark, broken, {"Id": "9", "Time": "5"}).collect()] == [9]


def test_edge_values_stay(spark):
    rows = silver_of(
        spark,
        {"HelpfulnessNumerator": "0", "HelpfulnessDenominator": "0", "Time": "n/a"},
        {"Score": " 3 ", "Text": "<p></p>"},
        {"ProductId": "q"},
        {},
    )
    found = {r["id"]: r for r in rows.collect()}
    assert found[1]["helpfulness_ratio"] is None and not found[1]["has_valid_review_time"] and found[1]["review_timestamp"] is None
    assert found[2]["sentiment_class"] == "neutral" and found[2]["binary_label"] is None and found[2]["review_text_clean"] == ". ."
    assert found[3]["normalized_text"] == found[4]["normalized_text"] == "good. very good!"
    assert str(found[4]["review_timestamp"]) == "2011-04-27 00:00:00"
    assert found[4]["review_word_count"] == 3 and found[4]["review_length"] == 16


def test_copies_within_a_product_leave_but_not_across(spark):
    rows = [{"Id": "7"}, {"Id": "3"}, {"Id": "5", "ProductId": "q"}, {"Id": "8", "Text": "GOOD. very  good!"}]
    silver = silver_of(spark, *rows)
    assert sorted(r["id"] for r in silver.collect()) == [3, 5]
    gold = layers.model_input(silver).collect()
    assert len(gold) == 1 and gold[0]["product_id"] == "p"


def test_null_times_are_one_time_in_the_dedup(spark):
    assert silver_of(spark, {"Time": "n/a"}, {"Time": "?"}).count() == 1


def test_model_input_keeps_the_copy_with_most_votes(spark):
    silver = silver_of(spark, {"Id": "1"}, {"Id": "2", "ProductId": "q", "HelpfulnessDenominator": "9"}, {"Id": "3", "Score": "3"})
    gold = layers.model_input(silver).collect()
    assert [(r["product_id"], r["label"], r["dataset_split"]) for r in gold] == [("q", 1, "test")]


def test_sentences_of_double_break(spark):
    silver = silver_of(spark, {"Text": "good.<br /><br />bad"})
    found = layers.aspect_sentences(silver).orderBy("sentence_index").collect()
    assert [r["sentence_text"] for r in found] == ["good..", ".", "bad"]
    assert [r["sentence_index"] for r in found] == [0, 1, 2] and found[0]["review_year"] == 2011
    assert found[0].asDict().keys() == set(layers.SENTENCE_COLUMNS)


def test_fixture_counts(spark):
    """Counts known from an independent run of the layer rules."""
    silver = fixture.silver(spark, SMALL).cache()
    assert fixture.reviews(spark, SMALL).count() == 270
    assert layers.valid_reviews(layers.typed_reviews(fixture.bronze(spark, SMALL))).count() == 214
    assert silver.count() == 199
    assert silver.filter("sentiment_class = 'neutral'").count() == 40
    # five times that are no number, three too long for a timestamp
    assert silver.filter("not has_valid_review_time").count() == 8
    assert silver.filter("review_time_epoch is null").count() == 5
    assert silver.filter("binary_label is not null").count() == 159
    assert layers.model_input(silver).count() == 156
    assert layers.aspect_sentences(silver).count() == 7636


def test_silver_cleans_each_text_once(spark, capsys):
    fixture.silver(spark, SMALL).explain("simple")
    filters = [line for line in capsys.readouterr().out.splitlines() if "Filter " in line]
    assert filters and not any("regexp_replace" in line for line in filters)


def test_missing_columns_are_listed_in_order(spark):
    with pytest.raises(ValueError, match=r"\['_bronze_ingested_at', '_record_id', '_source_file'\]"):
        layers.to_silver(spark.createDataFrame([], ", ".join(f"{c} string" for c in layers.BRONZE_NAMES.values())))
    with pytest.raises(ValueError, match="binary_label"):
        layers.model_input(spark.createDataFrame([(1,)], "id long"))


def test_research_rows(spark):
    rows = raw(
        spark,
        {"Text": "<b>Great!</b> 5 stars"}, {"Text": "<b>Great!</b> 5 stars", "ProductId": "q"},
        {"Text": "ok", "Time": "1"}, {"Score": "3", "Time": "2"}, {"Text": None}, {"HelpfulnessNumerator": "9", "Time": "3"},
        {"Score": "1", "Text": "Bad, bad", "Time": "4"},
    )
    found = research.research_clean(rows).collect()
    assert sorted((r["clean_text"], r["label"], r["ProductId"]) for r in found) == [(" great stars", 1, "p"), ("bad bad", 0, "p")]
    assert len({r["row_id"] for r in found}) == 2


def test_research_splits_are_disjoint_or_follow_the_reference_mode(spark):
    rows = spark.range(3000).select(
        F.concat(F.lit("r"), "id").alias("row_id"), F.when(F.col("id") % 4 == 0, 0).otherwise(1).alias("label")
    )
    parts = research.research_splits(rows, rows=1000, natural_rows=200)
    ids = {name: {r["row_id"] for r in part.collect()} for name, part in parts.items()}
    assert not ids["train"] & ids["balanced_test"] and not ids["natural_test"] & (ids["train"] | ids["balanced_test"])
    assert Counter(r["label"] for r in parts["natural_test"].collect()) == {1: 150, 0: 50}
    loose = research.research_splits(rows, rows=1000, natural_rows=2000, leave_out="train")
    assert {r["row_id"] for r in loose["natural_test"].collect()} & ids["balanced_test"]


def test_valid_model_rows(spark):
    rows = spark.createDataFrame(
        [("a", " x\n", "1", "train"), ("b", " \t", "1", "train"), ("c", "x", "2", "test"), ("d", "y", "0.0", "test"),
         ("e", "z", "bad", "test"), ("f", None, "1", "test"), ("g", "w", "1", "other")],
        "record_id string, clean_text string, label string, dataset_split string",
    )
    found = {r["record_id"]: (r["clean_text"], r["label"]) for r in quality.valid_model_rows(rows).collect()}
    assert found == {"a": ("x", 1), "d": ("y", 0)}


def test_integrity_violations(spark):
    rows = spark.createDataFrame(
        [("a", "x", 1, "train"), ("a", "y", 1, "test"), ("b", "x", 1, "train")],
        "record_id string, clean_text string, label int, dataset_split string",
    )
    found = {r["check"]: r["violations"] for r in quality.integrity_violations(rows).collect()}
    assert found == {"missing_label_class": 1, "duplicate_record_id": 1, "duplicate_text": 1, "record_in_two_splits": 1}
    with pytest.raises(ValueError, match="duplicate_text"):
        quality.check_model_input(rows)


def test_split_counts_with_margins(spark):
    rows = spark.createDataFrame([("train", 1), ("train", 0), ("test", 1)], "dataset_split string, label int")
    found = {(r[0], r[1]): r[2] for r in quality.split_counts(rows).collect()}
    assert found[(None, None)] == 3 and found[("train", None)] == 2 and found[(None, 1)] == 2


def test_csv_reading(spark, tmp_path):
    header = ",".join(tables.RAW_COLUMNS)
    (tmp_path / "a.csv").write_text(f'{header}\n007,p,u,n,1,2,5,10,"said ""hi""","line one\nline, two"\n2,p,u,n,1,2,5,10,s,t\n')
    rows = tables.read_raw(spark, str(tmp_path / "a.csv")).orderBy("Id").collect()
    assert len(rows) == 2 and rows[0]["Id"] == "007" and rows[0]["Text"] == "line one\nline, two" and rows[0]["Summary"] == 'said "hi"'
    assert rows[0]["_source_file"].endswith("a.csv")
    typed = tables.read_raw(spark, str(tmp_path / "a.csv"), infer=True)
    assert dict(typed.dtypes)["Score"] == "int"
    swapped = header.replace("Id,ProductId", "ProductId,Id")
    (tmp_path / "b.csv").write_text(f"{swapped}\np,1,u,n,1,2,5,10,s,t\n")
    with pytest.raises(Exception, match="(?i)header|schema"):
        tables.read_raw(spark, str(tmp_path / "b.csv")).collect()


def test_bad_csv_rows_are_kept_in_the_corrupt_column(spark, tmp_path):
    (tmp_path / "a.csv").write_text(",".join(tables.RAW_COLUMNS) + "\n1,p,u,n,1,2,5,10,s,t,extra\n2,p,u,n,1,2,5,10,s,t\n")
    rows = tables.read_raw(spark, str(tmp_path / "a.csv"), corrupt_column="_bad").orderBy("Id").collect()
    assert [r["_bad"] is not None for r in rows] == [True, False]


def test_write_and_read_back(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1, "train"), ("b", 0, "test")], "clean_text string, label int, dataset_split string")
    path = str(tmp_path / "gold")
    assert tables.verified_write(rows, path, ["dataset_split"], expect=2) == 2
    assert [r["clean_text"] for r in tables.read_splits(spark, path, "train").collect()] == ["a"]
    assert tables.read_columns(spark, path, ["clean_text", "label"]).count() == 2
    with pytest.raises(ValueError, match="expected 5"):
        tables.verified_write(rows, path, expect=5)
    with pytest.raises(ValueError, match="nothing to write"):
        tables.verified_write(rows.limit(0), str(tmp_path / "empty"))
    with pytest.raises(ValueError, match="absent"):
        tables.read_layer(spark, path, ["absent"])


def test_reports(spark, tmp_path):
    rows = spark.createDataFrame([("a, \"b\" ", 0.5)], "name string, value double")
    tables.write_report(rows, str(tmp_path / "r"))
    assert len(list((tmp_path / "r").glob("part-*.csv"))) == 1
    back = spark.read.options(header=True, quote='"', escape='"').csv(str(tmp_path / "r")).first()
    assert back["name"] == 'a, "b" '
    tables.write_metrics(rows.select(F.struct("name", "value").alias("m")), str(tmp_path / "m"))
    assert spark.read.json(str(tmp_path / "m")).first()["m"]["value"] == 0.5
