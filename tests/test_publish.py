"""Published layers: what readers see when a write goes well, fails or is not what was meant."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from palate.functions.polarity import PolarityRules
from palate.plans import insights
from palate.sources import publish as pb
from palate.sources import staging, tables


def frame(spark, n, start=0):
    return spark.range(start, start + n).select("id", (F.col("id") % 3).alias("part"), F.concat(F.lit("text "), "id").alias("text"), F.create_map(F.lit("a"), F.col("id")).alias("m"), F.lit(None).cast("double").alias("x"))


def ids(spark, path):
    return sorted(r["id"] for r in tables.read_layer(spark, path).collect())


def test_readers_follow_the_manifest(spark, tmp_path):
    path = str(tmp_path / "layer")
    assert pb.current(spark, path) is None and pb.versions(spark, path) == []
    one = pb.publish(frame(spark, 10), path, ["part"], expect=10)
    assert ids(spark, path) == list(range(10)) and one.previous is None and pb.check(spark, path)
    two = pb.publish(frame(spark, 4), path, rules={"has a text": F.col("text").isNotNull()})
    assert two.previous == one.name and ids(spark, path) == [0, 1, 2, 3]
    assert pb.versions(spark, path) == [one.name, two.name]
    assert pb.remove_old(spark, path, keep=2) == [] and pb.remove_old(spark, path) == [one.name]
    assert ids(spark, path) == [0, 1, 2, 3] and pb.versions(spark, path) == [two.name]


@pytest.mark.parametrize(
    ("change", "options", "message"),
    [
        (lambda df: df.limit(0), {}, "nothing to write"),
        (lambda df: df, {"expect": 6}, "expected 6 rows, got 5"),
        (lambda df: df, {"rules": {"small": "id < 4"}}, "'small': 1"),
        (lambda df: df, {"rules": {"known": "x > 0"}}, "'known': 5"),
        (lambda df: df.withColumn("part", F.when(F.col("id") == 2, "").otherwise("p")), {"partition_by": ["part"]}, "read back 5"),  # '' comes back as null
        (lambda df: df.withColumn("id", F.when(F.col("id") < 9, F.col("id")).otherwise(F.raise_error(F.lit("broken row")))).union(df.withColumn("id", F.raise_error(F.lit("broken row")).cast("long"))), {}, "broken row"),
    ],
)
def test_a_failing_write_leaves_the_former_layer(spark, tmp_path, change, options, message):
    path = str(tmp_path / "layer")
    former = pb.publish(frame(spark, 3, 100), path)
    if "rules" in options:
        options = {"rules": {n: F.expr(test) for n, test in options["rules"].items()}}
    with pytest.raises(Exception, match=message):
        tables.verified_write(change(frame(spark, 5)), path, **options)
    assert ids(spark, path) == [100, 101, 102] and pb.current(spark, path) == former
    assert pb.versions(spark, path) == [former.name] and pb.check(spark, path)


def test_a_changed_value_of_equal_count_is_found(spark, tmp_path):
    path = str(tmp_path / "layer")
    published = pb.publish(frame(spark, 20), path)
    folder = f"{path}/{pb.VERSIONS}/{published.name}"
    kept = tables.read_layer(spark, path).withColumn("text", F.when(F.col("id") == 7, "other").otherwise(F.col("text"))).collect()
    changed = spark.createDataFrame(kept, frame(spark, 1).schema)
    changed.coalesce(1).write.mode("overwrite").parquet(str(tmp_path / "changed"))
    for f in os.listdir(folder):
        os.remove(os.path.join(folder, f))
    for f in os.listdir(tmp_path / "changed"):
        if f.endswith(".parquet"):
            with open(tmp_path / "changed" / f, "rb") as source, open(os.path.join(folder, f), "wb") as target:
                target.write(source.read())
    assert spark.read.parquet(folder).count() == 20 and not pb.check(spark, path)


def test_checksum_depends_on_content_alone(spark):
    df = frame(spark, 50)
    sums = [tuple(x.agg(*pb.checksum_of(x)).first()) for x in (df, df.repartition(7), df.orderBy(F.desc("id")), df.select(*reversed(df.columns)))]
    assert len(set(sums)) == 1
    others = [df.limit(49), df.union(df.limit(1)), df.withColumn("x", F.when(F.col("id") == 3, 0.0)), df.withColumn("m", F.create_map(F.lit("b"), F.col("id")))]
    assert all(tuple(x.agg(*pb.checksum_of(x)).first()) != sums[0] for x in others)


def test_another_publication_meanwhile_is_an_error(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "layer")
    pb.publish(frame(spark, 3), path)
    made = pb.checksum_of

    def slow(df):
        if not getattr(slow, "done", False):
            slow.done = True
            pb.publish(frame(spark, 8), path)
        return made(df)

    monkeypatch.setattr(pb, "checksum_of", slow)
    with pytest.raises(pb.Rejected, match="meanwhile"):
        pb.publish(frame(spark, 5), path)
    assert len(ids(spark, path)) == 8


def test_plain_tables_are_read_as_before(spark, tmp_path):
    path = str(tmp_path / "plain")
    tables.write_layer(frame(spark, 3).drop("m"), path, ["part"])
    assert ids(spark, path) == [0, 1, 2] and pb.located(spark, path) == path


def test_a_whole_run_deletes_what_it_staged(spark, tmp_path):
    rows = spark.createDataFrame([("r", "p", 1, None, "good box. bad lid")], "_record_id string, product_id string, helpfulness_numerator int, review_timestamp timestamp, review_text_clean string")
    before = list(staging._staged)
    insights.run_insights(rows, str(tmp_path / "out"), {"packaging": ["box", "lid"]}, PolarityRules({"good": 1.0, "bad": -1.0}))
    assert staging._staged == before and spark.read.option("header", True).csv(str(tmp_path / "out" / "ranking")).count() == 1
