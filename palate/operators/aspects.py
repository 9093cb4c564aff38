"""Aspects found by word lists, and the polarity of the text around them.

A review's sentences are scored inside its row. Only the finished per-aspect numbers of
a report are ever shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palate.functions import labels, text
from palate.functions.phrases import Lexicon, Phrases
from palate.functions.polarity import PolarityRules
from palate.functions.polarity import polarity as polarity_of
from palate.functions.sqltext import let, member, name, quoted


def lexicon_table(spark, lexicon: Lexicon) -> DataFrame:
    """Word list as rows ``(aspect, ord, term)``; it comes from a dict, so its size is known."""
    rows = [(a, i, t.lower()) for i, (a, terms) in enumerate(lexicon.items(), 1) for t in dict.fromkeys(terms)]
    return spark.createDataFrame(rows, "aspect string, ord int, term string")


def lexicon_hits(df: DataFrame, lexicon: Lexicon, text_column: str = "sentence_text") -> DataFrame:
    """How often each lexicon term occurs, and in how many rows."""
    table = lexicon_table(df.sparkSession, lexicon)
    terms = sorted({t.lower() for listed in lexicon.values() for t in listed})

    def marks(found: Column) -> Column:
        return F.transform(found, lambda t, i: F.struct(t.alias("term"), F.when(F.get(found, i - 1) == t, 0).otherwise(1).alias("first")))

    # known terms are found and marked inside the row; a task sends one partial row per term
    words = f"regexp_extract_all(lower({name(text_column)}), {quoted(text.WORD_PATTERN)}, 0)"
    known = F.sort_array(F.expr(f"filter({words}, t -> {member('t', terms)})"))
    hits = df.select(F.inline(text.let(known, marks))).groupBy("term").agg(F.count(F.lit(1)).alias("hits"), F.sum("first").alias("rows_hit"))
    return hits.join(F.broadcast(table), "term").select("aspect", "term", "hits", "rows_hit")


def weak_labels(df: DataFrame, lexicon: Lexicon, text_column: str = "sentence_text") -> DataFrame:
    """One 0/1 column ``weak_<aspect>`` per aspect, and the list of aspects found."""
    flagged = with_mentions(df, lexicon, {a: f"weak_{a}" for a in lexicon}, text_column)
    return flagged.withColumn("seed_aspects", aspect_list({a: F.col(f"weak_{a}") == 1 for a in lexicon}))


def with_mentions(df: DataFrame, lexicon: Lexicon, into: dict[str, str], text_column: str) -> DataFrame:
    """``df`` with a 0/1 column per list of phrases: whether the text mentions one of it; null for a null
    text. The text is searched once for all lists, at a cost that does not depend on their length."""
    phrases, column = Phrases(lexicon), name(text_column)
    flags = ", ".join(f"CAST({phrases.found(a, column, 'hm')} AS INT) AS {name(flag)}" for a, flag in into.items())
    none = ", ".join(f"CAST(NULL AS INT) AS {name(flag)}" for flag in into.values())
    every = f"IF({column} IS NULL, struct({none}), {let('hm', phrases.hits(column), f'struct({flags})')})"
    found = df.withColumn("_mentions", F.expr(every))
    return found.withColumns({flag: F.col("_mentions")[flag] for flag in into.values()}).drop("_mentions")


def aspect_list(flags: dict[str, Column]) -> Column:
    return F.array_compact(F.array(*[F.when(flag, F.lit(aspect)) for aspect, flag in flags.items()]))


def sentence_aspects(df: DataFrame, column: str = "seed_aspects") -> DataFrame:
    """One row per sentence and aspect; sentences without an aspect have none."""
    # a plain explode is given a filter on the list's size, which would search the text again for every list
    listed = df.select("*", F.posexplode_outer(column).alias("_at", "aspect"))
    return listed.filter(F.col("_at").isNotNull()).drop("_at", column)


def weak_label_counts(labelled: DataFrame, aspects: list[str]) -> DataFrame:
    """Weak positives per aspect, with the share of sentences that have any aspect."""
    any_aspect = F.avg(F.greatest(F.lit(0), *[F.col(f"weak_{a}") for a in aspects]).cast("double"))
    wide = labelled.agg(*[F.sum(f"weak_{a}").alias(a) for a in aspects], any_aspect.alias("any_share"))
    rows = [F.struct(F.lit(a).alias("aspect"), F.col(a).alias("weak_positives"), "any_share") for a in aspects]
    return wide.select(F.inline(F.array(*rows)))


def aspect_support(
    labelled: DataFrame, aspects: list[str], split: str = "development_split", minimum: int = 30
) -> DataFrame:
    """Positives in all rows, positives and negatives in train, and whether that is enough."""
    in_train = F.col(split) == "train"
    sums = []
    for a in aspects:
        flag = F.col(f"weak_{a}")
        sums.append(
            F.struct(
                F.lit(a).alias("aspect"),
                F.sum(flag).alias("positives"),
                F.sum(F.when(in_train, flag).otherwise(0)).alias("train_positives"),
                F.sum(F.when(in_train, 1 - flag).otherwise(0)).alias("train_negatives"),
            )
        )
    rows = labelled.agg(F.array(*sums).alias("s")).select(F.inline("s"))
    enough = (F.col("positives") >= minimum) & (F.col("train_positives") > 0) & (F.col("train_negatives") > 0)
    return rows.withColumn("supported", enough)


def check_aspect_support(labelled: DataFrame, aspects: list[str], minimum: int = 30) -> DataFrame:
    weak = aspect_support(labelled, aspects, minimum=minimum).filter(~F.col("supported")).collect()
    if weak:
        raise ValueError(f"too few examples for aspects: {[r.asDict() for r in weak]}")
    return labelled


def sentence_polarity(df: DataFrame, rules: PolarityRules, text_column: str = "sentence_text", where: Column | None = None) -> DataFrame:
    """Adds ``polarity`` and its class; narrow. With ``where``, only rows that meet it are scored."""
    value = F.expr(polarity_of(name(text_column), rules))
    scored = df.withColumn("polarity", value if where is None else F.when(where, value))
    return scored.withColumn("polarity_class", labels.polarity_class(F.col("polarity")))


def aspect_polarity(df: DataFrame, rules: PolarityRules, text_column: str = "sentence_text", column: str = "seed_aspects") -> DataFrame:
    """One row per sentence and aspect with the polarity of the sentence, which is found once for all its
    aspects, and not for a sentence without one."""
    return sentence_aspects(sentence_polarity(df, rules, text_column, F.size(column) > 0), column)


def aspect_sentiment_wide(df: DataFrame, lexicon: Lexicon, rules: PolarityRules, text_column: str) -> DataFrame:
    """Per review and aspect, the mean polarity of the sentences that mention the aspect
    (null when none does) and its class under ``<aspect>_sent``. Narrow: no shuffle."""
    phrases = Phrases(lexicon)
    split = df.withColumn("_sentences", text.spoken_sentences(F.col(text_column)))
    found = let("hm", phrases.hits("s"), "struct(" + ", ".join(f"{phrases.found(a, 's', 'hm')} AS {name(a)}" for a in lexicon) + ")")
    scored = split.withColumn("_scored", F.expr(f"transform(_sentences, s -> struct({found} AS found, {polarity_of('s', rules)} AS p))"))

    def mean_over(aspect: str) -> Column:
        hits = F.transform(F.filter("_scored", lambda x: x["found"][aspect]), lambda x: x["p"])
        return text.let(
            hits,
            lambda h: F.when(F.size(h) > 0, F.aggregate(h, F.lit(0.0), lambda a, b: a + b) / F.size(h)),
        )

    means = scored.withColumns({a: mean_over(a) for a in lexicon}).drop("_scored", "_sentences")
    return means.withColumns({f"{a}_sent": labels.polarity_bucket(F.col(a)) for a in lexicon})


def to_long(wide: DataFrame, aspects: list[str]) -> DataFrame:
    """Wide aspect columns as rows ``(…, aspect, compound, sentiment)``."""
    rest = [c for c in wide.columns if c not in {*aspects, *[f"{a}_sent" for a in aspects]}]
    rows = [
        F.struct(F.lit(a).alias("aspect"), F.col(a).alias("compound"), F.col(f"{a}_sent").alias("sentiment"))
        for a in aspects
    ]
    return wide.select(*rest, F.inline(F.array(*rows)))


def aspect_sentiment(
    df: DataFrame,
    lexicon: Lexicon,
    rules: PolarityRules,
    text_column: str = "review_text_clean",
    wide: bool = False,
) -> DataFrame:
    """Per-review, per-aspect sentiment, long or wide."""
    columns = aspect_sentiment_wide(df, lexicon, rules, text_column)
    return columns if wide else to_long(columns, list(lexicon))


def aspect_summary(predictions: DataFrame) -> DataFrame:
    """Mentions, mean probability and mean polarity per aspect, most mentioned first."""
    return (
        predictions.groupBy("aspect")
        .agg(
            F.count("sentence_id").alias("mentions"),
            F.avg("aspect_probability").alias("mean_aspect_probability"),
            F.avg("polarity").alias("mean_polarity"),
        )
        .orderBy(F.desc("mentions"), "aspect")
    )


def sentiment_mix(predictions: DataFrame) -> DataFrame:
    """Share of each polarity class within an aspect."""
    classes = ["negative", "neutral", "positive"]
    counts = predictions.groupBy("aspect").pivot("polarity_class", classes).count().na.fill(0)
    total = reduce(lambda a, b: a + b, [F.col(c) for c in classes])
    return counts.select("aspect", *[(F.col(c) / total).alias(c) for c in classes])
