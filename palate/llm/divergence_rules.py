"""Quality rules: how far a document's histograms are from those of its language.

Two histograms of the whole text are compared with the reference of the document's language by
Jensen-Shannon distance (base 2, so 0 to 1): character classes, and the common words of that
language (with all other words as one more bin). A reference is the sum of the histograms of
all documents of that language that pass the base rules, so it follows the corpus. A histogram
is judged only from a minimum length on: short texts say too little about a distribution.

Everything is inside the row but the reference, one short row per language of ``COMMON_WORDS``
(other languages share one more); no text or word is shuffled.

Defined cases: a null text has no words and fails the base rules like an empty one; a null or
unlisted language is compared with the documents of all such languages, on character classes
only; without a reference (no passing document) nothing is judged by distance; repeated rows
are judged each for itself; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palate.sources.staging import stage

# Frequent function words by language.
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "it", "for"],
    "de": ["der", "die", "und", "das", "ist", "in", "mit", "von", "für", "ein"],
    "fr": ["de", "la", "le", "les", "et", "des", "en", "un", "une", "que"],
    "es": ["de", "la", "que", "el", "en", "los", "se", "del", "las", "con"],
}
# Characters counted as symbols.
SYMBOLS = "#*$%&|<>"

SPACE = r"[\x20\x09-\x0D]+"
#: Character classes in the order they are taken away; what is left is ``other``.
CLASSES = {"lower": r"\p{Ll}+", "space": SPACE, "upper": r"\p{Lu}+", "symbol": f"[{SYMBOLS}]+", "digit": "[0-9]+", "mark": r"[!-/:-@\[-`{-~]+"}
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: Words a text needs before a histogram of it is judged.
MIN_WORDS_CLASSES = 60
MIN_WORDS_COMMON = 120
#: Largest distances kept.
MAX_CLASS_DISTANCE = 0.3
MAX_COMMON_DISTANCE = 0.3


def measured(documents: DataFrame) -> DataFrame:
    """doc_id, language, base counts and histograms of every document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    df = documents.select("doc_id", F.when(F.col("lang").isin(*COMMON_WORDS), F.col("lang")).otherwise("").alias("language"), text.alias("text"))
    left = [F.col("text")]
    for i, pattern in enumerate(CLASSES.values()):
        df = df.withColumn(f"left{i}", F.regexp_replace(left[-1], pattern, ""))
        left.append(F.col(f"left{i}"))
    sizes = {name: F.length(left[i]) - F.length(left[i + 1]) for i, name in enumerate(CLASSES)} | {"other": F.length(left[-1])}
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = df.select(
        "doc_id", "language",
        F.array_remove(F.split("text", SPACE), "").alias("words"),
        lines.alias("lines"),
        F.array(*[v.cast("long") for v in sizes.values()]).alias("classes"),
        sizes["symbol"].cast("long").alias("n_symbols"),
        (F.length("text") - sizes["space"]).cast("long").alias("word_chars"),
    )
    every = sorted({v for words in COMMON_WORDS.values() for w in words for v in (w, w.capitalize())})
    df = df.select(
        "doc_id", "language", "classes", "n_symbols", "word_chars",
        F.size("words").cast("long").alias("n_words"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
        F.filter("words", lambda w: w.isin(every)).alias("hits"),
    )
    window = F.transform(
        F.sequence(F.lit(0), F.size("hashes") - WINDOW),
        lambda i: F.xxhash64(*[F.get(F.col("hashes"), i + j) for j in range(WINDOW)]),
    )
    df = df.withColumn("windows", F.when(F.col("n_words") >= WINDOW, window).otherwise(F.array().cast("array<bigint>")))
    df = df.withColumn("found", F.transform("hits", lambda w: F.lower(w))).drop("hits", "hashes")
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.when(repeats, F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    df = df.withColumn("placed", placed).drop("windows")
    twice = F.filter("placed", lambda e, k: F.coalesce(F.get(F.col("placed"), k - 1)["h"] == e["h"], F.lit(False)) | F.coalesce(F.get(F.col("placed"), k + 1)["h"] == e["h"], F.lit(False)))
    df = df.withColumn("at", F.sort_array(F.transform(twice, lambda e: e["i"]))).drop("placed")
    steps = F.transform("at", lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("at"), k + 1) - x, F.lit(WINDOW))).cast("long"))
    covered = F.aggregate(steps, F.lit(0).cast("long"), lambda total, x: total + x)
    listed = F.create_map(*[v for name, words in COMMON_WORDS.items() for v in (F.lit(name), F.array(*map(F.lit, words)))])
    counts = F.transform(listed[F.col("language")], lambda c: F.size(F.filter("found", lambda w: w == c)).cast("long"))
    df = df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).withColumn("counts", F.when(F.col("language") != "", counts))
    rest = F.col("n_words") - F.aggregate("counts", F.lit(0).cast("long"), lambda total, x: total + x)
    return df.select(
        "doc_id", "language", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "classes",
        F.concat("counts", F.array(rest)).alias("common"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def references(rows: DataFrame) -> DataFrame:
    """A row per language: the summed histograms of its passing documents."""
    bins = {"classes": len(CLASSES) + 1, "common": max(map(len, COMMON_WORDS.values())) + 1}
    sums = [F.sum(F.get(F.col(name), F.lit(i))).alias(f"{name}{i}") for name, n in bins.items() for i in range(n)]
    summed = rows.filter(~base_failed()).groupBy("language").agg(*sums)
    arrays = [F.array_compact(F.array(*[F.col(f"{name}{i}") for i in range(n)])).alias(f"{name}_reference") for name, n in bins.items()]
    return summed.select("language", *arrays)


def distance(found: Column, reference: Column) -> Column:
    """Jensen-Shannon distance of two count arrays; null if either is null or sums to zero."""
    total = lambda x: F.aggregate(x, F.lit(0.0), lambda a, v: a + v)
    shares = lambda x: F.transform(x, lambda v: F.try_divide(v.cast("double"), total(x)))
    part = lambda p, m: F.when(p > 0, p * F.log2(p / m)).otherwise(0.0)
    terms = F.zip_with(shares(found), shares(reference), lambda p, q: (part(p, (p + q) / 2) + part(q, (p + q) / 2)) / 2)
    return F.sqrt(F.when(total(terms) > 0, total(terms)).when(total(terms) <= 0, 0.0))


def judged(documents: DataFrame) -> DataFrame:
    """Base counts, both distances and the verdict of every document."""
    rows = stage(measured(documents), "divergence")
    near = rows.join(F.broadcast(references(rows)), "language", "left")  # at most a row per listed language and one more
    near = near.withColumn("class_distance", F.when(F.col("n_words") >= MIN_WORDS_CLASSES, distance(F.col("classes"), F.col("classes_reference"))))
    near = near.withColumn("common_distance", F.when(F.col("n_words") >= MIN_WORDS_COMMON, distance(F.col("common"), F.col("common_reference"))))
    far = F.coalesce(F.col("class_distance") > MAX_CLASS_DISTANCE, F.lit(False)) | F.coalesce(F.col("common_distance") > MAX_COMMON_DISTANCE, F.lit(False))
    return near.withColumn("base_failed", base_failed()).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~far).alias("kept"), "class_distance", "common_distance",
    )
