"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its shuffled documents, repeated up to ``epochs`` times (each time in
another order). A copy's virtual finish time is the number of its source's words up to its end,
divided by the source's weight: a source of weight 3 gets three words for each word of a source of
weight 1 while both have some left. All copies are sorted globally by virtual finish time and the
sequence is cut off at the budget, the number of words of all documents unless another is given.

The targets follow from the same law in closed form: at the level v of virtual time where the
budget is used up, a source has had ``min(weight * v, epochs * its words)`` words. The copy that a
source is serving at that level ends there, so a very long document does not carry its source
beyond its target; copies that start later can't be within the budget and are not queued.

Everything is columns. Texts are read once for their word counts; what moves are rows of an id, a
source and a count. Queues and the global order are summed by ranges (:mod:`palate.llm.ordered`), so
a source with most rows is no single task. The level is found by raising it until no further source
is used up: a row of sums per round.

Defined cases: a null text has no words; documents without words are never queued and take nothing;
a null source is a source of its own, the last one; repeated rows and rows with equal or null ids
are documents of their own; with no words at all every target is 0; an empty table gives no rows;
other columns are ignored. Runs agree: the shuffle is a hash of id and epoch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palate.functions.keys import order_hash
from palate.llm.ordered import running
from palate.sources.staging import checked_broadcast, stage

WORD = r"[^\x20\x09-\x0D]++"
EPOCHS = 3
SEED = 11
#: Weights of the sources in their order, from the first again after the last.
WEIGHTS = (1, 2, 3)


def sized(documents: DataFrame) -> DataFrame:
    """doc_id, queue (source as text, null last), size in words and a row number of every document."""
    size = F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long")
    queue = F.coalesce(F.concat(F.lit("0"), F.col("source")), F.lit("1"))
    rows = documents.select("doc_id", queue.alias("queue"), size.alias("size"))
    return rows.withColumn("row", F.monotonically_increasing_id())


def weighted(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """queue, source_size and weight of every source, weights dealt in the order of the sources."""
    sources = stage(rows.groupBy("queue").agg(F.sum("size").alias("source_size")), "sources")
    placed = running(sources, [F.col("queue")], "place")
    listed = F.array(*[F.lit(int(w)).cast("long") for w in weights])
    return stage(placed.select("queue", "source_size", F.get(listed, (F.col("place") % len(weights)).cast("int")).alias("weight")), "weights")


def with_targets(sources: DataFrame, epochs: int = EPOCHS, budget: int | None = None) -> tuple[DataFrame, int]:
    """``sources`` with the words each should give, and the budget they share."""
    most = F.col("source_size") * epochs
    all_words, all_weights = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    budget = (all_words or 0) if budget is None else min(budget, epochs * (all_words or 0))
    level, used_up = (budget / all_weights if all_weights else 0.0), 0
    while True:
        full = most <= F.col("weight") * F.lit(level)
        done, given, rest = sources.agg(F.count_if(full), F.sum(F.when(full, most)), F.sum(F.when(~full, F.col("weight")))).first()
        if not rest or done == used_up:
            break
        level, used_up = (budget - (given or 0)) / rest, done
    target = F.when(full, most.cast("double")).otherwise(F.col("weight") * F.lit(level))
    return sources.withColumn("target", target), budget


def queued(rows: DataFrame, sources: DataFrame, epochs: int = EPOCHS, seed: int = SEED) -> DataFrame:
    """row, queue, epoch, words and virtual finish time of every copy that starts before its
    source's target."""
    known = rows.filter("size > 0").join(checked_broadcast(sources), "queue")
    again = F.explode(F.sequence(F.lit(0), F.lit(epochs - 1)))
    copies = known.select("*", again.alias("epoch")).filter(F.col("epoch") * F.col("source_size") < F.col("target"))
    shuffled: list[Column] = [F.col("epoch"), order_hash(F.col("epoch"), F.col("doc_id"), kind="md5", seed=seed), F.col("doc_id"), F.col("size"), F.col("row")]
    served = running(copies, shuffled, "before", "size", "queue")
    words = F.least(F.col("size"), F.ceil("target") - F.col("before")).cast("long")
    finish = (F.col("before") + F.col("words")) / F.col("weight")
    return served.withColumn("words", words).filter("words > 0").select("row", "queue", "epoch", "words", finish.alias("finish"))


def sequence(copies: DataFrame, budget: int) -> DataFrame:
    """The mix: copies in the order of finish with ``at``, the words before each, cut at the budget.

    Within a source no two copies finish together, so finish and source are a total order.
    """
    placed = running(stage(copies, "copies"), [F.col("finish"), F.col("queue")], "at", "words")
    return placed.filter(F.col("at") < budget).withColumn("words", F.least(F.col("words"), F.lit(budget) - F.col("at")))


def mixed(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS, budget: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The documents as rows, the sources with their targets, and the mix."""
    rows = stage(sized(documents), "sized")
    sources, budget = with_targets(weighted(rows, weights), epochs, budget)
    return rows, sources, sequence(queued(rows, sources, epochs), budget)


def taken(documents: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target and the words taken of every document."""
    rows, sources, mix = mixed(documents)
    words = mix.groupBy("row").agg(F.sum("words").alias("taken"))
    every = rows.join(words, "row", "left").join(checked_broadcast(sources), "queue")
    return every.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"))
