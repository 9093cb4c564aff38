"""Token counts per section: whole documents are encoded once, and every token goes to a section.

Tokens are character spans of the text (a token that holds part of a character spans that
character), sections are character spans too. Both lists are sorted, so they are joined with
binary search inside the document. A token that lies in one section belongs to it. A token that
touches several is allocated by the rule:

* ``most``: the section that holds most of its characters, the earlier of equals;
* ``start``: the section that holds its first character inside any section;
* ``share``: every section, in proportion to the characters held.

Characters in no section belong to none: a token that touches no section counts as outside.
Counting is one narrow pass; a document never leaves its task.

Defined cases: a null text counts as empty: one empty line, no tokens; null sections count as
none; sections must be sorted and disjoint; empty sections hold no tokens; special tokens
written in a text are ordinary text; repeated rows are counted each for itself; other columns
are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

RULES = ("most", "start", "share")

_loaded: dict[tuple[str, str], tuple] = {}


def _encoder(path: str, pattern: str):
    """The encoder of a rank file and the byte length of every token; one per worker."""
    if (path, pattern) not in _loaded:
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, i in ranks.items():
            sizes[i] = len(token)
        encoder = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        _loaded[path, pattern] = (encoder, sizes)
    return _loaded[path, pattern]


def token_spans(text: str, path: str, pattern: str) -> tuple[np.ndarray, np.ndarray]:
    """First character and character after the last one of every token of a text."""
    encoder, sizes = _encoder(path, pattern)
    ends = np.cumsum(sizes[np.array(encoder.encode_ordinary(text), np.int64)])
    raw = np.frombuffer(text.encode(), np.uint8)
    if len(raw) == len(text):
        return np.concatenate(([0], ends))[: len(ends)], ends
    char = np.cumsum((raw & 0xC0) != 0x80) - 1
    return char[np.concatenate(([0], ends))[: len(ends)]], char[ends - 1] + 1


def line_spans(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Lines as sections, each with the line break that ends it: together they are the text."""
    sizes = np.array([len(x) + 1 for x in text.split("\n")], np.int64)
    sizes[-1] -= 1
    ends = np.cumsum(sizes)
    return ends - sizes, ends


def allocated(start: np.ndarray, end: np.ndarray, section_start: np.ndarray, section_end: np.ndarray, rule: str) -> np.ndarray:
    """Tokens per section, as floats (whole numbers but for ``share``)."""
    counts = np.zeros(len(section_start))
    if not len(counts) or not len(start):
        return counts
    first = np.searchsorted(section_end, start, side="right")
    last = np.searchsorted(section_start, end, side="left") - 1
    np.add.at(counts, first[first == last], 1.0)
    for t in np.flatnonzero(first < last):
        touched = np.arange(first[t], last[t] + 1)
        held = np.minimum(end[t], section_end[touched]) - np.maximum(start[t], section_start[touched])
        if held.max() <= 0:
            continue
        if rule == "share":
            counts[touched] += held / held.sum()
        else:
            counts[touched[held.argmax() if rule == "most" else np.flatnonzero(held > 0)[0]]] += 1
    return counts


def attributed(documents: DataFrame, path: str, pattern: str, rule: str = "most", sections: str | None = None) -> DataFrame:
    """A row per document and section: doc_id, section (from 0), start, end, n_tokens, doc_tokens.

    ``sections`` names a column of arrays of (start, end) in characters, end exclusive; without
    it the sections are the lines. ``doc_tokens`` counts the whole document, tokens outside of
    every section included.
    """
    if rule not in RULES:
        raise ValueError(f"unknown rule: {rule}")
    names = ["doc_id", "section", "start", "end", "n_tokens", "doc_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                given = part.column(sections).to_pylist() if sections else [None] * part.num_rows
                columns: list[list] = [[] for _ in names]
                for doc, text, spans in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), given):
                    text = text or ""
                    start, end = token_spans(text, path, pattern)
                    if sections:
                        s, e = (np.array([x[k] for x in spans or []], np.int64) for k in ("start", "end"))
                    else:
                        s, e = line_spans(text)
                    counts = allocated(start, end, s, e, rule)
                    for column, values in zip(columns, ([doc] * len(s), range(len(s)), s, e, counts, [len(start)] * len(s))):
                        column.extend(values)
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    chosen = documents.select(*dict.fromkeys(["doc_id", "text", *([sections] if sections else [])]))
    return chosen.mapInArrow(run, "doc_id long, section int, start long, end long, n_tokens double, doc_tokens long")


def counted(documents: DataFrame, path: str, pattern: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and the number of tokens of every whole document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, _ = _encoder(path, pattern)
        for batch in batches:
            n = [len(encoder.encode_ordinary(t.as_py() or "")) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(n, pa.int64())], [*keep, "n_tokens"])

    chosen = documents.select(*dict.fromkeys([*keep, "text"]))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema if f.name in keep]
    return chosen.mapInArrow(run, ", ".join([*fields, "n_tokens long"]))
