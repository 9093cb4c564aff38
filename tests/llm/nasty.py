"""Documents with everything a table may hold, and plain-Python answers to compare with."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, name string, words int, spans string"


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def texts() -> list[str | None]:
    rnd = random.Random(9)
    vocabulary = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 7))) for _ in range(400)] + ["Été", "straße", "😀", "a.b", "1,2"]
    prose = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    base, passage = prose(120), prose(60)
    near = base.split(" ")
    near[7] = near[80] = "changed"
    out: list[str | None] = [None, "", " \n\t ", "one", "One two three", "one TWO three", base, base, base.upper(), " ".join(near)]
    out += [prose(40) + " " + passage + " " + prose(30) for _ in range(6)]
    out += [passage, passage + " tail", "x" * 20_000, "la " * 6_000, "\n".join([prose(12)] * 30), prose(9_000), "été mot mot \x1c a\x0bb\x0cc\rd"]
    out += [prose(rnd.randint(1, 90)) for _ in range(12)]
    out += ["mail bob.a+c@ex-ample.co.uk, +1 (017) 555-7713 and 10.0.0.255, card 4111 1111 1111 1111; IBAN GB82 WEST 1234 5698 7654 32 "]
    return out


def rows() -> list[tuple]:
    every = [(i, t, "en" if i % 3 else None, "src", len(t or ""), "s", "n", i, None) for i, t in enumerate(texts())]
    return [*every, every[6], every[12], (None, texts()[6], "en", None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None)]


def documents(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(5)


def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def shingles(text: str | None) -> frozenset:
    w = words((text or "").translate(LOWER))
    return frozenset(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))) if w else frozenset()


def components(pairs_of: dict) -> dict:
    """Smallest reachable key by Jaccard links of at least 0.75 between sets."""
    parent = {d: d for d in pairs_of}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(pairs_of)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            both = len(pairs_of[a] & pairs_of[b])
            if both and 100 * both >= 75 * (len(pairs_of[a]) + len(pairs_of[b]) - both):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: find(d) for d in keys}


def removed(by_id: dict, window: int = 13) -> dict:
    """Words gone per document: covered by a window that a smaller id has."""
    first: dict = {}
    for d in sorted(by_id):
        w = words(by_id[d])
        for i in range(len(w) - window + 1):
            first.setdefault(tuple(w[i : i + window]), d)
    out = {}
    for d, text in by_id.items():
        w = words(text)
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < d:
                gone[i : i + window] = [True] * window
        out[d] = gone
    return out
