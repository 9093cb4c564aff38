"""Expressions as SQL text. Word lists of any length go into one set test; as columns each word would
be a call of its own to the JVM."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Mapping


def quoted(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def name(column: str) -> str:
    """A column's name, however it is spelt."""
    return "`" + column.replace("`", "``") + "`"


def member(value: str, words: Iterable[str]) -> str:
    """True where ``value`` is one of ``words``: one probe of a hash set, however many there are."""
    listed = ", ".join(quoted(w) for w in dict.fromkeys(words))
    return f"({value} IN ({listed}))" if listed else "false"


#: Words that are worth hashing anew for each text; more of them are one set of their own.
FEW_WORDS = 32


def listed(words: Iterable[str]) -> str:
    """An array of the words."""
    return f"CAST(array({', '.join(quoted(w) for w in dict.fromkeys(words))}) AS ARRAY<STRING>)"


def those_in(array: str, words: Iterable[str], variable: str) -> str:
    """Elements of ``array`` that are among ``words``; of a few words each once, and no call per element.
    ``variable`` is a name free inside ``array``'s place."""
    words = list(dict.fromkeys(words))
    if len(words) <= FEW_WORDS:
        return f"array_intersect({array}, {listed(words)})"
    return f"filter({array}, {variable} -> {member(variable, words)})"


def has_one_of(array: str, words: Iterable[str], variable: str) -> str:
    """True where an element of ``array`` is among ``words``."""
    words = list(dict.fromkeys(words))
    if len(words) <= FEW_WORDS:
        return f"arrays_overlap({array}, {listed(words)})"
    return f"exists({array}, {variable} -> {member(variable, words)})"


def number_of(value: str, numbers: Mapping[str, float], otherwise: str = "0D") -> str:
    """The number of a word: one set test per distinct number."""
    words_of: dict[float, list[str]] = defaultdict(list)
    for word, number in numbers.items():
        words_of[float(number)].append(word)
    cases = " ".join(f"WHEN {member(value, words)} THEN {number!r}D" for number, words in sorted(words_of.items()))
    return f"CASE {cases} ELSE {otherwise} END" if cases else otherwise


def let(variable: str, value: str, body: str) -> str:
    """``body`` with ``value`` evaluated once under the name ``variable``."""
    return f"element_at(transform(array({value}), {variable} -> {body}), 1)"
