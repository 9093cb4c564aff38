"""Personal data: patterns propose spans, checksums confirm them, context adjusts the score.

Each kind has a pattern whose leftmost non-overlapping matches are proposals, a validator (Luhn
for cards, mod-97 for IBANs, part and digit counts for addresses and phones) and a base score.
Words such as "card" or "iban" within ``CONTEXT_CHARS`` code points before or after a span raise
its score. A proposal is reported if its validator holds and its score reaches ``MIN_SCORE``:
the four base kinds reach it alone, the added kinds by checksum or by context.

An IBAN may be followed by words or numbers that its pattern would take too, so its proposal is a
start and a bounded stretch behind it; the span is the prefix that has its country's length, or else
the longest (of a country not in ``IBAN_LENGTHS``: the longest that passes), that ends at a word
edge and passes mod-97. Likewise a short card is the longest row of whole digit groups that together
hold 13 to 15 digits and pass Luhn, from any group of a run on, whatever numbers stand before and
behind it. A start inside an accepted span of the kind is none.

All of it is column expressions inside the row: no Python, no shuffle. Patterns are possessive or
bounded and start only where a run of their characters starts, so a long run costs linear time.

Spans are in code points, end exclusive, and refer to the whole text. Defined cases: a null or
empty text has no spans; equal spans of different kinds are all reported; repeated rows are
searched each for itself; other columns pass through unless named like an output.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTEXT_CHARS = 40
MIN_SCORE = 0.5
CONTEXT_BONUS = 0.3


@dataclass(frozen=True)
class Kind:
    """``gate`` is a cheap test that every text with a match passes. A pattern with a group proposes
    a start (one character) and in the group what the span is a prefix of."""

    pattern: str
    gate: str
    score: float
    context: str


# What a span of each kind looks like.
KINDS = {
    "email": Kind(r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", 0.9, "mail|contact|kontakt|correo"),
    "ip": Kind(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", r"[0-9]\.[0-9]", 0.6, r"\bip\b|host|server|address|adresse"),
    "card": Kind(r"[0-9](?:[\x20-]?[0-9])++", r"[0-9][\x20-]?[0-9]", 0.9, "card|visa|karte|carte|tarjeta"),
    "phone": Kind(r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", 0.6, "phone|call|tel|mobil|fax"),
    "iban": Kind(r"(?<![A-Za-z0-9])(?=([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}[A-Za-z0-9]?))[A-Z]", r"[A-Z]{2}[0-9]{2}", 0.8, "iban|bank|konto|account|cuenta|compte"),
    "short_card": Kind(r"(?<![0-9])(?=([0-9](?:[\x20-]?[0-9]){12,14}[0-9]?))[0-9]", r"[0-9][\x20-]?[0-9]", 0.3, "card|visa|amex|karte|carte|tarjeta"),
    "national_id": Kind(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", r"[0-9]{3}-[0-9]{2}-", 0.3, r"ssn|social security|\btax\b|national id"),
}
BASE_KINDS = ["email", "ip", "card", "phone"]
#: Kinds whose span is a prefix of what is proposed, with the fewest and most characters without separators.
PREFIX_KINDS = {"iban": (15, 34), "short_card": (13, 15)}

# Characters of an IBAN by country.
IBAN_LENGTHS = {
    n: countries.split()
    for n, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
        25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
        29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
}


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """True if the digits of ``value`` pass the Luhn test."""
    reversed_digits = F.split(F.reverse(digits(value)), "")

    def weigh(d: Column, i: Column) -> Column:
        n = d.cast("int")
        return F.when(i % 2 == 0, n).otherwise(2 * n - F.when(n > 4, 9).otherwise(0))

    total = F.aggregate(F.transform(F.array_remove(reversed_digits, ""), weigh), F.lit(0), lambda a, x: a + x)
    return total % 10 == 0


def mod97(value: Column) -> Column:
    """True if an IBAN leaves 1: country and check digits behind, letters as 10 to 35."""
    compact = F.regexp_replace(value, " ", "")
    moved = F.concat(F.substr(compact, F.lit(5)), F.substring(compact, 1, 4))
    symbols = F.array_remove(F.split(moved, ""), "")

    def step(rest: Column, c: Column) -> Column:
        number = F.when(c.rlike("[0-9]"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
        return F.pmod(rest * F.when(number > 9, 100).otherwise(10) + number, F.lit(97))

    return F.aggregate(symbols, F.lit(0), step) == 1


def confirmed(kind: str, value: Column) -> Column:
    """The validator of ``kind``."""
    if kind == "ip":
        parts = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.coalesce(F.try_to_number(F.concat(F.lit("0"), F.substring(p, 1, 3)), F.lit("9999")), F.lit(0)) <= 255))
    if kind == "card":
        return F.length(digits(value)).between(16, 19) & luhn(value)
    if kind == "short_card":
        return luhn(value)
    if kind == "phone":
        return F.length(digits(value)).between(8, 15)
    if kind == "iban":
        return mod97(value)
    return F.lit(True)


def prefix_size(kind: str, value: Column) -> Column:
    """Length of the prefix of ``value`` that ends at an edge and is confirmed; null if none is."""
    least, most = PREFIX_KINDS[kind]
    symbols = lambda n: F.length(F.regexp_replace(F.substr(value, F.lit(1), n), "[ -]", ""))
    edge = lambda n: F.substr(value, n, F.lit(2)).rlike("^[A-Z0-9][ -]?$") & symbols(n).between(least, most)
    tried = F.filter(F.sequence(F.length(value), F.lit(least), F.lit(-1)), edge)
    if kind == "iban":
        country = F.substring(value, 1, 2)
        own = F.coalesce(*[F.when(country.isin(names), F.lit(n)) for n, names in IBAN_LENGTHS.items()])
        tried = F.when(own.isNull(), tried).otherwise(F.concat(F.filter(tried, lambda n: symbols(n) == own), F.slice(tried, 1, 1)))
    return F.get(F.filter(tried, lambda n: confirmed(kind, F.substr(value, F.lit(1), n))), F.lit(0))


def spans_of(text: Column, kind: str) -> Column:
    """Confirmed spans of one kind as an array of (kind, start, end, score), by start."""
    rule = KINDS[kind]
    prefix = kind in PREFIX_KINDS
    values = F.regexp_extract_all(text, F.lit(rule.pattern if prefix else f"({rule.pattern})"), F.lit(1))
    gaps = F.split(text, rule.pattern, -1)

    def measure(v: Column, g: Column) -> Column:
        size = prefix_size(kind, v) if prefix else F.when(confirmed(kind, v), F.length(v))
        return F.struct(F.length(g).alias("gap"), (F.lit(1) if prefix else F.length(v)).alias("n"), size.alias("size"))

    sized = F.zip_with(values, F.slice(gaps, 1, F.size(values)), measure)
    empty = F.array().cast("array<struct<start:int,end:int>>")
    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("free"), empty.alias("spans"))

    def place(state: Column, m: Column) -> Column:
        begin = state["at"] + m["gap"]
        end = begin + m["size"]
        found = m["size"].isNotNull() & (begin >= state["free"])
        spans = F.when(found, F.concat(state["spans"], F.array(F.struct(begin.alias("start"), end.alias("end"))))).otherwise(state["spans"])
        return F.struct((begin + m["n"]).alias("at"), F.when(found, end).otherwise(state["free"]).alias("free"), spans.alias("spans"))

    placed = F.aggregate(sized, start, place, lambda state: state["spans"])

    def scored(s: Column) -> Column:
        before = F.substr(text, F.greatest(F.lit(1), s["start"] - CONTEXT_CHARS + 1), F.least(F.lit(CONTEXT_CHARS), s["start"]))
        after = F.substr(text, s["end"] + 1, F.lit(CONTEXT_CHARS))
        near = F.lower(F.concat(before, F.lit(" "), after)).rlike(rule.context)
        score = F.lit(rule.score) + F.when(near, CONTEXT_BONUS).otherwise(0.0)
        return F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.least(F.lit(1.0), score).alias("score"))

    kept = F.filter(F.transform(placed, scored), lambda s: s["score"] >= MIN_SCORE)
    none = F.array().cast("array<struct<kind:string,start:int,end:int,score:double>>")
    return F.when(text.rlike(rule.gate), kept).otherwise(none)


def spans_in(text: Column) -> Column:
    """Confirmed spans of every kind, by kind and start; none for a null text."""
    text = F.coalesce(text, F.lit(""))
    return F.concat(*[spans_of(text, kind) for kind in KINDS])


def with_spans(documents: DataFrame, column: str = "spans") -> DataFrame:
    """``documents`` with the confirmed spans of every kind in the column ``column``."""
    return documents.withColumn(column, spans_in(F.col("text")))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def masked(documents: DataFrame) -> DataFrame:
    """``documents`` with every span in ``text`` replaced by <KIND>; where spans overlap, the one
    that starts first (then the longer, then the first kind) names the whole stretch."""
    order = F.sort_array(F.transform(spans_in(F.col("text")), lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"), s["kind"].alias("kind"))))
    state = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(done: Column, s: Column) -> Column:
        end = -s["back"]
        gap = F.substr(F.col("text"), done["at"] + 1, F.greatest(F.lit(0), s["start"] - done["at"]))
        tag = F.when(s["start"] >= done["at"], F.concat(gap, F.lit("<"), F.upper(s["kind"]), F.lit(">"))).otherwise("")
        return F.struct(F.concat(done["out"], tag).alias("out"), F.greatest(done["at"], end).alias("at"))

    found = "_spans"
    while found in documents.columns:
        found += "_"
    rebuilt = F.aggregate(F.col(found), state, step, lambda done: F.concat(done["out"], F.substr(F.col("text"), done["at"] + 1)))
    return documents.withColumn(found, order).withColumn("text", F.when(F.size(found) > 0, rebuilt).otherwise(F.col("text"))).drop(found)
