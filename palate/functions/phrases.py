"""Word lists of any length: hashed phrases, probed with the runs of words of a text, inside the row.

A phrase is found where it stands between characters that belong to no word, in any letter case. The
text is cut once into words and into what separates them; every word, and every run of as many words
as phrases have, joined by single spaces, is looked up in one hash set. The cost of a text does not
depend on the number of phrases. Phrases with other characters than words and single spaces
("sugar-free", "5%") are left to a pattern.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache, cached_property

from palate.functions.sqltext import FEW_WORDS, has_one_of, let, member, quoted, those_in
from palate.functions.text import mention_pattern

Lexicon = dict[str, list[str]]

_CAPITAL_I_DOT = "İ"


def _folded_letter(c: str) -> str:
    """Lower case of the upper case, letter by letter: what equal means to a pattern without case (but
    for capital sharp s, which Java keeps apart from the small one)."""
    upper = c.upper() if len(c.upper()) == 1 else c
    lower = "i" if upper == _CAPITAL_I_DOT else upper.lower()
    return lower if len(lower) == 1 else upper


@cache
def _rare_letters() -> tuple[str, str]:
    """Letters that lower case leaves apart from their fellows, and these (final sigma, long s, …)."""
    pairs = {}
    for code in range(0x80, 0x20000):
        c = chr(code)
        lower, folded = c.lower(), _folded_letter(c)
        if lower != folded and len(lower) == 1:
            pairs[lower] = folded
    return "".join(pairs), "".join(pairs.values())


def folded(phrase: str) -> str:
    return "".join(map(_folded_letter, phrase))


def fold(text: str) -> str:
    """SQL: ``text`` with letters that differ in case only made equal."""
    rare, common = _rare_letters()
    # no such letter is ASCII, as most texts are
    other = f"translate(lower(replace({text}, '{_CAPITAL_I_DOT}', 'i')), {quoted(rare)}, {quoted(common)})"
    return f"IF(octet_length({text}) = length({text}), lower({text}), {other})"


def _is_word(part: str) -> bool:
    return bool(part) and all(c.isalnum() or c == "_" for c in part)


@dataclass(frozen=True)
class Phrases:
    """Phrases under names."""

    lists: Lexicon

    @cached_property
    def _plain(self) -> dict[str, list[str]]:
        return {n: [folded(t) for t in dict.fromkeys(terms) if all(map(_is_word, t.split(" ")))] for n, terms in self.lists.items()}

    @cached_property
    def _odd(self) -> dict[str, list[str]]:
        return {n: [t for t in dict.fromkeys(terms) if not all(map(_is_word, t.split(" ")))] for n, terms in self.lists.items()}

    def hits(self, text: str) -> str:
        """SQL: the known phrases of ``text``, each at least once."""
        every = list(dict.fromkeys(t for terms in self._plain.values() for t in terms))
        sizes = sorted({t.count(" ") + 1 for t in every})
        # other characters become words of their own, and neighbouring spaces an empty one; where no run of
        # words is looked for, they may go
        between = quoted(" \u0001 " if sizes != [1] else " ")
        cut = rf"split(regexp_replace(hf, {quoted(r'[^\p{L}\p{N}_ ]+')}, {between}), ' ')"
        runs = []
        for n in sizes:
            own = [t for t in every if t.count(" ") + 1 == n]
            if n == 1:
                runs.append(those_in("ht", own, "hg"))
                continue
            first = member("element_at(ht, hi)", (t.split(" ")[0] for t in own))
            starts = f"filter(sequence(1, size(ht) - {n - 1}), hi -> {first})"
            joined = f"filter(transform({starts}, hj -> array_join(slice(ht, hj, {n}), ' ')), hg -> {member('hg', own)})"
            runs.append(f"IF(size(ht) >= {n}, {joined}, array())")
        if not runs:
            return "CAST(array() AS ARRAY<STRING>)"
        found = those_in(cut, every, "hg") if sizes == [1] else let("ht", cut, f"concat({', '.join(runs)})")
        if len(every) <= FEW_WORDS:
            # a text is only cut where the letters of some phrase's first word stand in it
            perhaps = " OR ".join(f"contains(hf, {quoted(w)})" for w in dict.fromkeys(t.split(" ")[0] for t in every))
            found = f"IF({perhaps}, {found}, CAST(array() AS ARRAY<STRING>))"
        return let("hf", fold(text), found)

    def found(self, name: str, text: str, hits: str) -> str:
        """SQL: whether ``text`` holds a phrase of ``name``; ``hits`` are those of the text."""
        tests = [has_one_of(hits, self._plain[name], "hn")] if self._plain[name] else []
        tests += [f"({text} RLIKE {quoted(mention_pattern(self._odd[name]))})"] if self._odd[name] else []
        return f"({' OR '.join(tests)})" if tests else "false"
