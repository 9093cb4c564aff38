"""Sentence polarity from a valence lexicon, inside the row.

The rules are those of Hutto & Gilbert (2014). A word's valence grows when it is in capitals among
words that are not; the three words before it are then looked at from near to far: a booster adds or
takes away, the less the further off, and a negator turns the valence round and damps it. What stands
before a contrast word ("but") counts half, what follows half as much again. Exclamation and question
marks add to the sum, which is squashed to (-1, 1) by ``s / sqrt(s^2 + 15)``.

Each valence is a fold over the words before it, and all of it happens inside the row: no token
explode, no window, no shuffle. Word lists are plain data and may be long.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from palate.functions.sqltext import let, member, number_of, quoted, those_in
from palate.functions.text import SPOKEN_WORD_PATTERN

# Fixed values of the published method.
NEGATION_FACTOR = -0.74
CAPITALS = 0.733
DISTANCE_FACTORS = (1.0, 0.95, 0.9)
BEFORE_CONTRAST, AFTER_CONTRAST = 0.5, 1.5
EXCLAMATION, MOST_EXCLAMATIONS = 0.292, 4
QUESTION, MOST_QUESTIONS, MANY_QUESTIONS = 0.18, 3, 0.96
NORMALIZER = 15.0


@dataclass(frozen=True)
class PolarityRules:
    """Valences by word, words that negate, what boosters add to a valence's size, contrast words.
    All in lower case. A booster has no valence of its own."""

    valence: dict[str, float]
    negators: list[str] = field(default_factory=list)
    boosters: dict[str, float] = field(default_factory=dict)
    contrast: list[str] = field(default_factory=lambda: ["but"])


def polarity(text: str, rules: PolarityRules) -> str:
    """Polarity of a sentence in (-1, 1) as SQL; ``text`` is a column or expression in SQL. 0.0 when no
    word is in the lexicon; null for null."""
    words = {w: v for w, v in rules.valence.items() if w and w not in rules.boosters}
    if not words:
        return f"IF({text} IS NULL, CAST(NULL AS DOUBLE), 0D)"
    spoken = f"regexp_extract_all({text}, {quoted(SPOKEN_WORD_PATTERN)}, 0)"
    lowered = "split(lower(array_join(po, ' ')), ' ')"  # all words at once: none holds a blank
    capital = "(upper({0}) = {0} AND lower({0}) <> {0})"
    # capitals stand out only next to other words; the first contrast word divides the sentence
    mixed = f"array_join(po, ' ') <> array_join(pl, ' ') AND exists(po, pc -> {capital.format('pc')}) AND exists(po, pd -> NOT {capital.format('pd')})"
    contrast = list(dict.fromkeys(rules.contrast))
    turn = f"array_position(pl, {quoted(contrast[0])})" if len(contrast) == 1 else f"array_position(transform(pl, pb -> {member('pb', contrast)}), true)"
    changing = [w for w in (*rules.boosters, *rules.negators) if w]
    facts = f"struct(po AS o, pl AS l, ph AS known, {those_in('pl', changing, 'pg')} AS changing, {mixed} AS mixed, {turn} AS turn)"
    loud = f"pz.mixed AND {capital}"
    start = let("pv", number_of("px", words), f"IF({loud.format('get(pz.o, pi)')}, pv + sign(pv) * {CAPITALS}D, pv)")
    factor = f"element_at(array({', '.join(f'{f}D' for f in DISTANCE_FACTORS)}), pn)"
    boost = number_of("pp", rules.boosters, "NULL")
    louder = f"IF({loud.format('get(pz.o, pi - pn)')}, {CAPITALS}D, 0D)"
    added = let("pq", boost, f"pa + coalesce(sign(pa) * {factor} * (pq + {louder}), 0D)")
    negated = f"IF({member('pp', rules.negators)}, {NEGATION_FACTOR}D, 1D)"
    # most words before it change nothing
    step = let("pp", "get(pz.l, pi - pn)", f"IF(pp IS NOT NULL AND array_contains(pz.changing, pp), {added} * {negated}, pa)")
    near = ", ".join(str(n) for n in range(1, len(DISTANCE_FACTORS) + 1))
    weight = f"CASE WHEN pz.turn = 0 OR pi + 1 = pz.turn THEN 1D WHEN pi + 1 < pz.turn THEN {BEFORE_CONTRAST}D ELSE {AFTER_CONTRAST}D END"
    valence = f"IF(size(pz.changing) = 0, {start}, aggregate(array({near}), {start}, (pa, pn) -> {step}))"
    value = f"IF(array_contains(pz.known, px), {weight} * {valence}, 0D)"
    total = f"aggregate(transform(pz.l, (px, pi) -> {value}), 0D, (ps, pt) -> ps + pt)"
    count = lambda mark: f"(length({text}) - length(replace({text}, '{mark}', '')))"
    questions = let("pr", count("?"), f"CASE WHEN pr <= 1 THEN 0D WHEN pr <= {MOST_QUESTIONS} THEN {QUESTION}D * pr ELSE {MANY_QUESTIONS}D END")
    marks = f"({EXCLAMATION}D * least({count('!')}, {MOST_EXCLAMATIONS}) + {questions})"
    squashed = let("pe", let("pf", total, f"pf + sign(pf) * {marks}"), f"pe / sqrt(pe * pe + {NORMALIZER}D)")
    known = let("ph", those_in("pl", words, "pk"), f"IF(size(ph) > 0, {let('pz', facts, squashed)}, 0D)")
    whole = let("po", spoken, let("pl", lowered, known))
    return f"IF({text} IS NULL, CAST(NULL AS DOUBLE), {whole})"
