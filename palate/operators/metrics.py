"""Evaluation measures as relational aggregates.

Everything is computed from counts: of (label, prediction) pairs, or of positives and
negatives per distinct score. Undefined ratios are 0.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palate.sources.staging import stage

def _ratio(a: Column, b: Column) -> Column:
    return F.when(b != 0, a / b).otherwise(0.0)


def _f1(precision: Column, recall: Column) -> Column:
    return _ratio(2.0 * precision * recall, precision + recall)


def _count(weight: str | None, condition: Column | None = None) -> Column:
    """Rows that meet the condition; with ``weight``, a row stands for that many."""
    value = F.lit(1) if weight is None else F.col(weight)
    if condition is not None:
        value = F.when(condition, value)
    return F.count(value) if weight is None else F.coalesce(F.sum(value), F.lit(0))


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction", weight: str | None = None) -> DataFrame:
    """``tn, fp, fn, tp`` in one row."""
    y, p = F.col(label), F.col(prediction)

    def cell(actual: int, predicted: int) -> Column:
        return _count(weight, (y == actual) & (p == predicted))

    return df.agg(cell(0, 0).alias("tn"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(1, 1).alias("tp"))


def binary_metrics(
    df: DataFrame, label: str = "label", prediction: str = "prediction", weight: str | None = None
) -> DataFrame:
    """Accuracy, balanced accuracy, and precision, recall, F1 of the positive class."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    rates = confusion(df, label, prediction, weight).select(
        _ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        ((_ratio(tp, tp + fn) + _ratio(tn, tn + fp)) / 2.0).alias("balanced_accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
    )
    return rates.withColumn("f1", _f1(F.col("precision"), F.col("recall")))


def class_rates(df: DataFrame, label: str, prediction: str, weight: str | None = None) -> DataFrame:
    """Precision, recall, F1 and support of every class seen as label or prediction."""
    pairs = df.groupBy(F.col(label).alias("y"), F.col(prediction).cast(df.schema[label].dataType).alias("p")).agg(
        _count(weight).alias("n")
    )
    hit = F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0)
    zero = F.lit(0).cast("bigint")
    sides = pairs.select(
        F.inline(
            F.array(
                F.struct(F.col("y").alias("class"), F.col("n").alias("support"), zero.alias("predicted"), hit.alias("tp")),
                F.struct(F.col("p").alias("class"), zero.alias("support"), F.col("n").alias("predicted"), zero.alias("tp")),
            )
        )
    )
    sums = sides.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "tp")])
    return sums.select(
        "class",
        _ratio(F.col("tp"), F.col("predicted")).alias("precision"),
        _ratio(F.col("tp"), F.col("support")).alias("recall"),
        "support",
        "tp",
    ).withColumn("f1", _f1(F.col("precision"), F.col("recall")))


def _averages(rates: DataFrame, weighted: bool) -> list[Column]:
    weight = F.col("support") if weighted else F.lit(1)
    return [_ratio(F.sum(F.col(c) * weight), F.sum(weight)).alias(c) for c in ("precision", "recall", "f1")]


def weighted_metrics(
    df: DataFrame, label: str = "label", prediction: str = "prediction", weight: str | None = None
) -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1."""
    rates = class_rates(df, label, prediction, weight)
    precision, recall, f1 = _averages(rates, weighted=True)
    return rates.agg(
        _ratio(F.sum("tp"), F.sum("support")).alias("accuracy"),
        precision.alias("weighted_precision"),
        recall.alias("weighted_recall"),
        f1.alias("weighted_f1"),
    )


def class_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """A row per class, then the macro and the support-weighted average."""
    rates = class_rates(df, label, prediction)

    def average(name: str, weighted: bool) -> Column:
        support = F.sum("support").alias("support")
        return F.struct(F.lit(name).alias("class"), *_averages(rates, weighted), support)

    each = F.struct(F.col("class").cast("string").alias("class"), "precision", "recall", "f1", "support")
    # as many entries as there are classes
    rows = F.concat(F.collect_list(each), F.array(average("macro avg", False), average("weighted avg", True)))
    return rates.agg(rows.alias("rows")).select(F.inline("rows"))


def aspect_report(long: DataFrame, aspect: str = "aspect", label: str = "y", prediction: str = "p") -> DataFrame:
    """Precision, recall, F1 and support of the positive class, per aspect."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    sums = long.groupBy(aspect).agg(
        F.count(F.when(y & p, 1)).alias("tp"), F.count(F.when(p, 1)).alias("predicted"), F.count(F.when(y, 1)).alias("support")
    )
    return sums.select(
        aspect,
        _ratio(F.col("tp"), F.col("predicted")).alias("precision"),
        _ratio(F.col("tp"), F.col("support")).alias("recall"),
        _ratio(2.0 * F.col("tp"), F.col("predicted") + F.col("support")).alias("f1"),
        "support",
    )


def multilabel_metrics(long: DataFrame, aspect: str = "aspect", label: str = "y", prediction: str = "p") -> DataFrame:
    """Micro F1, macro F1 and Hamming loss over (row, aspect) pairs."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    sums = long.groupBy(aspect).agg(
        F.count(F.when(y & p, 1)).alias("tp"),
        F.count(F.when(p, 1)).alias("predicted"),
        F.count(F.when(y, 1)).alias("support"),
        F.count(F.when(y != p, 1)).alias("wrong"),
        F.count(F.lit(1)).alias("n"),
    )
    tp, predicted, support = (F.sum(c) for c in ("tp", "predicted", "support"))
    return sums.agg(
        _ratio(2.0 * tp, predicted + support).alias("micro_f1"),
        F.avg(_ratio(2.0 * F.col("tp"), F.col("predicted") + F.col("support"))).alias("macro_f1"),
        _ratio(F.sum("wrong"), F.sum("n")).alias("hamming_loss"),
    )


def score_counts(df: DataFrame, label: str, score: str, weight: str | None = None) -> DataFrame:
    """Positives and negatives per distinct score: all that ranking measures need.

    A null or NaN score says nothing in favour of a row, so it ranks below every number.
    """
    positive = F.col(label) == 1
    value = F.col(score).cast("double")
    ranked = F.when(value.isNull() | F.isnan(value), F.lit(float("-inf"))).otherwise(value)
    return df.groupBy(ranked.alias("score")).agg(_count(weight, positive).alias("pos"), _count(weight, ~positive).alias("neg"))


def running_counts(df: DataFrame, label: str, score: str, weight: str | None = None) -> DataFrame:
    """Score counts with totals over all lower scores (``pos_below``, ``neg_below``) and over
    all scores (``pos_total``, ``neg_total``).

    Distinct scores are dealt to ranges, as many as the session's shuffle partitions and their
    sizes call for; each range keeps its own running sum and gets the total of the ranges below
    it. The cuts only steer the work; the sums are exact wherever they fall.
    """
    dealt = score_counts(df, label, score, weight).repartitionByRange("score")
    ranged = stage(dealt.withColumn("range", F.spark_partition_id()), "scores")
    everything = Window.partitionBy(F.lit(0))  # one row per range
    before = everything.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("range").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n")).select(
        "range",
        F.coalesce(F.sum("p").over(before), F.lit(0)).alias("pos_offset"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("neg_offset"),
        F.sum("p").over(everything).alias("pos_total"),
        F.sum("n").over(everything).alias("neg_total"),
    )
    inside = Window.partitionBy("range").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    return ranged.join(F.broadcast(offsets), "range").select(  # a row per shuffle partition
        "score",
        "pos",
        "neg",
        (F.coalesce(F.sum("pos").over(inside), F.lit(0)) + F.col("pos_offset")).alias("pos_below"),
        (F.coalesce(F.sum("neg").over(inside), F.lit(0)) + F.col("neg_offset")).alias("neg_below"),
        "pos_total",
        "neg_total",
    )


def roc_auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Area under the ROC curve by ranks, tied scores counted half."""
    return ranking_metrics(df, label, score).select("roc_auc")


def average_precision(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Precision averaged over the recall gained at each distinct score."""
    return ranking_metrics(df, label, score).select("average_precision")


def ranking_metrics(
    df: DataFrame, label: str = "label", score: str = "score", weight: str | None = None
) -> DataFrame:
    """ROC AUC and average precision from the same score counts.

    A score catches all positives but those below it, so precision at a score follows
    from the totals; both sums come out of one aggregation.
    """
    counts = running_counts(df, label, score, weight)
    caught, wrong = F.col("pos_total") - F.col("pos_below"), F.col("neg_total") - F.col("neg_below")
    won = F.col("pos").cast("double") * (F.col("neg_below") + F.col("neg") / 2.0)
    return counts.agg(
        _ratio(F.sum(won), F.sum("pos").cast("double") * F.sum("neg")).alias("roc_auc"),
        _ratio(F.sum(F.col("pos") * (caught / (caught + wrong))), F.sum("pos")).alias("average_precision"),
    )


def evaluate(df: DataFrame, label: str = "label", prediction: str = "prediction", score: str = "score") -> dict[str, float]:
    """All binary measures of one set of predictions as plain numbers."""
    # the model runs once; equal outcomes are counted before anything is kept
    outcomes = df.groupBy(label, prediction, score).agg(F.count(F.lit(1)).alias("n"))
    outcomes = stage(outcomes, "outcomes")
    frames = [
        binary_metrics(outcomes, label, prediction, "n"),
        ranking_metrics(outcomes, label, score, "n"),
        weighted_metrics(outcomes, label, prediction, "n"),
    ]
    return reduce(lambda found, frame: {**found, **frame.first().asDict()}, frames, {})
