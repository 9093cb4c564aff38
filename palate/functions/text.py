"""Text cleaning, sentence splitting and tokens as native column expressions."""

from __future__ import annotations

import re
import sys
import unicodedata
from functools import cache, reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Tag rules, then entity rules, each list applied in the order given.
TAG_RULES = (
    (r"(?i)<br\s*/?>", ". "),
    (r"(?i)</?p\s*>", ". "),
    (r"(?i)<[^>]+>", " "),
)
ENTITY_RULES = (
    (r"(?i)&amp;", " and "),
    (r"(?i)&quot;", '"'),
    (r"(?i)&(?:apos|#39);", "'"),
    (r"(?i)&(?:nbsp|lt|gt);|&#[0-9]+;", " "),
)
# Blanks after an end mark. The blank is tried first, as most characters are none.
SENTENCE_BREAK = r"\s(?<=[.!?]\s)\s*"
SENTENCE_OR_LINE_BREAK = r"(?<=[.!?])\s+|[\r\n]+"

# A word is two or more letters, digits or underscores, in any script.
WORD_PATTERN = r"[\p{L}\p{N}_]{2,}"

# A spoken word may also be one letter, and keeps an inner apostrophe ("isn't").
SPOKEN_WORD_PATTERN = r"[\p{L}\p{N}_]+(?:'\p{L}+)?"

# Fixed value: characters a sequence encoder treats as blanks.
SEQUENCE_FILTER = '!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~\t\n'


def _apply(rules: tuple[tuple[str, str], ...], text: Column) -> Column:
    return reduce(lambda c, rule: F.regexp_replace(c, F.lit(rule[0]), F.lit(rule[1])), rules, text)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, also inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def collapse(text: Column) -> Column:
    """Every run of blanks to one space. Lone spaces, nearly all of them, are not touched."""
    return F.regexp_replace(text, r"\s(?:\s+|(?<! ))", " ")


def count_words(collapsed: Column) -> Column:
    """Blank-separated words of a collapsed, trimmed text; 1 for the empty text."""
    return F.length(collapsed) - F.length(F.replace(collapsed, F.lit(" "), F.lit(""))) + 1


def clean_html(text: Column) -> Column:
    """Markup to sentence breaks or blanks, entities to characters, blanks collapsed.

    Most rows hold neither ``<`` nor ``&``; one substring test each spares them the
    seven patterns. Neither rule list can create the other's trigger character.
    """
    untagged = F.when(text.contains("<"), _apply(TAG_RULES, text)).otherwise(text)
    plain = F.when(text.contains("&"), _apply(ENTITY_RULES, untagged)).otherwise(untagged)
    return F.trim(collapse(plain))


def strip(text: Column) -> Column:
    """Outer blanks of every kind off, line breaks and tabs too."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def normalize_text(text: Column) -> Column:
    return F.trim(collapse(F.lower(text)))


def clean_letters(text: Column) -> Column:
    """Lower-case letters and single blanks only; outer blanks stay."""
    no_tags = F.regexp_replace(F.lower(text), r"<[^>]+>", " ")
    return collapse(F.regexp_replace(no_tags, r"[^a-z\s]", " "))


def split_sentences(text: Column, newlines: bool = False) -> Column:
    return F.split(text, SENTENCE_OR_LINE_BREAK if newlines else SENTENCE_BREAK)


def spoken_sentences(text: Column) -> Column:
    """Sentences with something in them; a text without any counts as one sentence."""
    parts = F.filter(split_sentences(text), lambda s: s.rlike(r"\S"))
    return let(parts, lambda p: F.when(F.size(p) > 0, p).otherwise(F.array(text)))


def review_sentences(text: Column) -> Column:
    """Sentences of a raw review, line breaks also ending one; outer blanks off, empty ones out."""
    return F.filter(F.transform(split_sentences(strip(text), newlines=True), strip), lambda s: s != "")


def words(text: Column, lowercase: bool = True, accents: bool = True) -> Column:
    """Words of two or more characters; ``accents=False`` strips Latin accents first."""
    source = F.lower(text) if lowercase else text
    if not accents:
        source = strip_accents(source)
    return F.regexp_extract_all(source, F.lit(WORD_PATTERN), 0)


def blank_tokens(text: Column, min_length: int = 2) -> Column:
    """Split at blanks, lower-case, drop short tokens."""
    return F.filter(F.split(F.lower(text), r"\s+"), lambda t: F.length(t) >= min_length)


def sequence_tokens(text: Column) -> Column:
    """Tokens for id sequences: punctuation is a blank, order and repeats stay."""
    spaced = F.translate(F.lower(text), SEQUENCE_FILTER, " " * len(SEQUENCE_FILTER))
    return F.filter(F.split(spaced, " "), lambda t: t != "")


def without_stopwords(tokens: Column, stop_words: list[str]) -> Column:
    return F.filter(tokens, lambda t: ~t.isin(stop_words))


def ngrams(tokens: Column, low: int = 1, high: int = 1) -> Column:
    """All n-grams of ``low`` to ``high`` tokens, joined by a blank."""

    def all_sizes(toks: Column) -> Column:
        # the token n places on joins each (n-1)-gram; beyond the last token there is none
        sizes = [toks]
        for n in range(2, high + 1):
            following = F.slice(toks, n, F.size(toks))
            sizes.append(F.zip_with(sizes[-1], following, lambda gram, token: F.concat(gram, F.lit(" "), token)))
        return F.concat(*[F.array_compact(s) if n > 1 else s for n, s in enumerate(sizes, 1) if n >= low])

    return let(tokens, all_sizes)


def _latin_fold() -> tuple[str, str]:
    """Accented Latin letters with a one-letter base, and combining marks to delete."""
    source, target = [], []
    for start, stop in ((0x00C0, 0x0250), (0x1E00, 0x1F00)):
        for code in range(start, stop):
            decomposed = unicodedata.normalize("NFKD", chr(code))
            base = "".join(c for c in decomposed if not unicodedata.combining(c))
            if len(base) == 1 and base != chr(code):
                source.append(chr(code))
                target.append(base)
    marks = [chr(code) for code in range(0x0300, 0x0370) if unicodedata.combining(chr(code))]
    return "".join(source + marks), "".join(target)


def strip_accents(text: Column) -> Column:
    """Accented Latin letters to their base letter, JVM-side."""
    source, target = _latin_fold()
    return F.translate(text, source, target)


def strip_accents_any(text: Column) -> Column:
    """Compatibility decomposition without marks, for every script (Arrow batches)."""

    marks = _marks()

    @F.pandas_udf(T.StringType())
    def fold(batch: pd.Series) -> pd.Series:
        return batch.str.normalize("NFKD").str.replace(marks, "", regex=True)

    # texts of ASCII alone, most of all, stay as they are: only nulls are sent to Python for them
    return F.when(text.rlike(r"[^\x00-\x7F]"), fold(F.when(text.rlike(r"[^\x00-\x7F]"), text))).otherwise(text)


@cache
def _marks() -> re.Pattern:
    """Runs of combining characters."""
    ranges: list[list[int]] = []
    for code in range(0x300, sys.maxunicode + 1):
        if unicodedata.combining(chr(code)):
            if ranges and ranges[-1][1] == code - 1:
                ranges[-1][1] = code
            else:
                ranges.append([code, code])
    return re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in ranges) + "]+")


def mentions(text: Column, terms: list[str]) -> Column:
    """True where a term stands as a whole word (or words), in any letter case."""
    return text.rlike(mention_pattern(terms))


def mention_pattern(terms: list[str]) -> str:
    """Boundaries are spelt out: the same answer next to accented letters in any engine."""
    escaped = "|".join("".join(c if c.isalnum() or c == " " else "\\" + c for c in term) for term in terms)
    return rf"(?iu)(?:^|[^\p{{L}}\p{{N}}_])(?:{escaped})(?:[^\p{{L}}\p{{N}}_]|$)"
