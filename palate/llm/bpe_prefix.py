"""BPE encoding by dynamic programming over prefixes, and decoding.

A BPE vocabulary has one encoding per text, and every prefix of the text has one encoding too;
its last token alone says how to go on. For each prefix the candidates for that last token are
the vocabulary entries that end there (found with an Aho-Corasick automaton over all entries, whose
states are the longest suffixes that still begin an entry). A
candidate t of length k is right if the last token of the prefix k shorter and t stay as they
are when their joined symbols are merged, that is if the pair is compatible. Exactly one
candidate passes. Following the stored tokens back from the end gives the ids; no merge
list is worked off, and a word costs time linear in its length.

Encoding is one narrow pass over the documents: text is normalised and cut at blanks; what stands
between blanks is cut into words and encoded once and remembered in a bounded memory per task.

Letters, numbers and lower case are those of the tokenizer library, also where the Unicode tables
of this Python are older or those of the pattern library are newer.

Defined cases: a null text is encoded as empty (no ids); special tokens written in a text
become their ids; repeated rows are encoded each for itself; columns other than those named
are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: Pieces between blanks, and words in them, that a task remembers in each of two generations, their
#: longest length, and the pairs of tokens whose compatibility it remembers.
REMEMBERED = 150_000
REMEMBERED_PAIRS = 500_000
LONGEST_REMEMBERED = 64

# Letters and numbers by the pattern library's Unicode tables that the tokenizer library
# takes for neither (first and last code point), and capitals this Python may not lower yet (first and
# last code point, first small letter).
NEWER = [
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F), (0x209D, 0x209F),
    (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2), (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D),
    (0x107BB, 0x107BF), (0x10940, 0x10959), (0x10EC5, 0x10EC7), (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB),
    (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1), (0x1246F, 0x1246F), (0x12475, 0x1247F), (0x12550, 0x12686), (0x16EA0, 0x16EB8),
    (0x16EBB, 0x16ED3), (0x16FF2, 0x16FF6), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20), (0x18D80, 0x18DF2),
    (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6), (0x1DF1F, 0x1DF24),
    (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE), (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5),
    (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF), (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD),
    (0x323B0, 0x33479), (0x3D000, 0x3FC3F),
]
CAPITALS = [
    (0x1C89, 0x1C89, 0x1C8A), (0xA7CB, 0xA7CB, 0x264), (0xA7CC, 0xA7CC, 0xA7CD), (0xA7CE, 0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2, 0xA7D3),
    (0xA7D4, 0xA7D4, 0xA7D5), (0xA7DA, 0xA7DA, 0xA7DB), (0xA7DC, 0xA7DC, 0x19B), (0x10D50, 0x10D65, 0x10D70), (0x16EA0, 0x16EB8, 0x16EBB),
]

CONTROLS = re.compile("[\x1c-\x1f]")
BLANKS = regex.compile(r"\p{White_Space}+")

#: Added to the code of a word's last symbol, which BPE with word ends keeps apart.
_FINAL = 0x10000


def byte_symbols() -> list[str]:
    """The printable character that byte-level vocabularies use for each byte: itself if Latin-1
    prints it, else the next free one from U+0100 on."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    names = {b: chr(b) for b in printable}
    for i, b in enumerate(b for b in range(256) if b not in names):
        names[b] = chr(256 + i)
    return [names[b] for b in range(256)]


def _class(ranges: list[tuple[int, int]]) -> str:
    return "".join(f"\\U{a:08X}-\\U{b:08X}" for a, b in ranges)


def _latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class Memory(dict):
    """What ``make`` returned for short keys: the last ``most`` or more that were asked for."""

    def __init__(self, make: Callable[[str], object]) -> None:
        super().__init__()
        self.make, self.older = make, {}

    def __missing__(self, key: str) -> object:
        found = self.older.get(key) or self.make(key)
        if len(key) <= LONGEST_REMEMBERED:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[key] = found
        return found


@dataclass
class PrefixBpe:
    """Vocabulary, merge ranks and automaton of one tokenizer file."""

    vocabulary: dict[str, int]
    merges: list[tuple[str, str]]
    suffix: str
    specials: dict[str, int]
    pattern: str
    names: dict[int, str] = field(default_factory=dict)

    @classmethod
    def from_file(cls, path: str) -> PrefixBpe:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        splits = [p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        return cls(model["vocab"], merges, model.get("end_of_word_suffix") or "", specials, splits[0])

    def __post_init__(self) -> None:
        self.names = {i: t for t, i in self.vocabulary.items()} | {i: t for t, i in self.specials.items()}
        self._bytes = byte_symbols()
        made = {(self.coded(a), self.coded(b)): n for n, (a, b) in enumerate(self.merges)}
        self._rank = made
        self._parts: dict[str, tuple[str, str]] = {}
        for pair in made:
            self._parts.setdefault("".join(pair), pair)
        self._spines: tuple[dict, dict] = ({}, {})
        reachable = {s for b in self._bytes for s in (b, self._final(b))} | self._parts.keys()
        self._id = {self.coded(t): i for t, i in self.vocabulary.items() if self.coded(t) in reachable}
        self._automaton = ahocorasick.Automaton()
        entries = list(self._id)
        for n, t in enumerate(entries):
            self._automaton.add_word(t, n)
        self._automaton.make_automaton()
        # by number of the entry: its symbols, their count, its id and its name
        self._entries, self._sizes = entries, [len(t) for t in entries]
        self._ids = [self._id[t] for t in entries]
        self._name_bytes = [self.names[i].encode("utf-8", "surrogatepass") for i in self._ids]
        self._pieces = Memory(self._piece)
        self._words = Memory(self._word)
        # by the left one of two neighbours: whether it is compatible with the right one
        self._pairs: list[dict[int, bool]] = [{} for _ in entries]
        self._known_pairs = 0
        # \s is White_Space here, as in the file's own dialect
        pattern = self.pattern.replace(r"\s", r"\p{White_Space}")
        newer = _class(NEWER)
        dated = pattern.replace(r"[^\p{White_Space}\p{L}\p{N}]", rf"(?:[^\p{{White_Space}}\p{{L}}\p{{N}}]|[{newer}])")
        for known in (r"[\p{L}]", r"[\p{N}]"):
            dated = dated.replace(known, rf"(?:(?![{newer}]){known})")
        self._cut, self._cut_dated = regex.compile(pattern), regex.compile(dated)
        # ASCII has a simpler form of every class
        self._cut_ascii = re.compile(self.pattern.replace(r"\p{L}", "A-Za-z").replace(r"\p{N}", "0-9").replace(r"\s", r"\x20\x09-\x0D"), re.ASCII)
        self._odd = regex.compile(f"[{newer}{_class([c[:2] for c in CAPITALS])}]")
        self._lower = {c: small + c - a for a, b, small in CAPITALS for c in range(a, b + 1)}
        self._special = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.specials, key=len, reverse=True)) + ")") if self.specials else None

    @staticmethod
    def _final(symbol: str) -> str:
        return chr(ord(symbol) + _FINAL)

    def coded(self, token: str) -> str:
        """A vocabulary entry with one character per symbol; a word's last symbol is moved up."""
        if self.suffix and token.endswith(self.suffix) and token != self.suffix:
            inner = token[: -len(self.suffix)]
            return inner[:-1] + self._final(inner[-1])
        return token

    def _spine(self, token: str, side: int) -> list[tuple[str, int]]:
        """The parts at one end of ``token`` (0 its left end, 1 its right) from the single symbol
        to the whole, each with the rank of the merge that takes it up; the whole is never."""
        known = self._spines[side].get(token)
        if known is None:
            known, part, taken = [], token, len(self._rank)
            while True:
                known.append((part, taken))
                if len(part) == 1:
                    break
                pair = self._parts[part]
                part, taken = pair[side], self._rank[pair]
            known.reverse()
            self._spines[side][token] = known
        return known

    def compatible(self, left: str, right: str) -> bool:
        """True if BPE leaves ``left`` and ``right`` as two tokens when they stand side by side.

        Merges happen in the order of their ranks, so the part of ``left`` and the part of
        ``right`` that meet at the border at any time follow from the two spines. The border
        holds if no meeting pair has a merge that comes before either part is taken up on its
        own side; of equal ranks the one further left comes first.
        """
        lefts, rights, rank = self._spine(left, 1), self._spine(right, 0), self._rank
        i = j = 0
        while True:
            a, a_taken = lefts[i]
            b, b_taken = rights[j]
            across = rank.get((a, b))
            if across is not None and across < a_taken and across <= b_taken:
                return False
            if a_taken <= b_taken:
                i += 1
                if i == len(lefts):
                    return True
            else:
                j += 1

    def _compatible_pair(self, left: int, right: int) -> bool:
        if self._known_pairs >= REMEMBERED_PAIRS:
            for known in self._pairs:
                known.clear()
            self._known_pairs = 0
        self._known_pairs += 1
        fits = self._pairs[left][right] = self.compatible(self._entries[left], self._entries[right])
        return fits

    def _last(self, symbols: str) -> list[int]:
        """The number of the unique last token of the encoding of every non-empty prefix."""
        last = [-1] * len(symbols)
        pairs, sizes = self._pairs, self._sizes
        for end, n in self._automaton.iter(symbols):
            if last[end] < 0:
                before = end - sizes[n]
                if before < 0:
                    last[end] = n
                    continue
                left = last[before]
                if left < 0:
                    continue
                fits = pairs[left].get(n)
                if fits or (fits is None and self._compatible_pair(left, n)):
                    last[end] = n
        return last

    def last_tokens(self, symbols: str) -> list[str]:
        """The unique last token of the encoding of every non-empty prefix of ``symbols``."""
        return [self._entries[n] for n in self._last(symbols)]

    def _numbers(self, word: str) -> list[int]:
        """Entries that encode one word (text between cuts)."""
        coded = "".join([self._bytes[b] for b in word.encode("utf-8", "surrogatepass")])
        if self.suffix:
            coded = coded[:-1] + self._final(coded[-1])
        last, at, found = self._last(coded), len(coded) - 1, []
        while at >= 0:
            found.append(last[at])
            at -= self._sizes[last[at]]
        return found[::-1]

    def encode_word(self, word: str) -> list[int]:
        """Ids of one word."""
        return [self._ids[n] for n in self._numbers(word)]

    def _word(self, word: str) -> tuple[bytes, bytes]:
        found = self._numbers(word)
        return struct.pack(f"<{len(found)}I", *[self._ids[n] for n in found]), b" ".join([self._name_bytes[n] for n in found])

    def _piece(self, piece: str) -> tuple[bytes, bytes]:
        """Ids and decoded text of lower-cased text without blanks."""
        if piece.isalpha():
            return self._words[piece]  # letters of this Python are letters of the library
        if piece.isascii():
            cut = self._cut_ascii
        else:
            cut = self._cut_dated if self._odd.search(piece) else self._cut
        parts = [self._words[word] for word in cut.findall(piece)]
        return b"".join([p[0] for p in parts]), b" ".join([p[1] for p in parts])

    def _plain(self, text: str) -> list[tuple[bytes, bytes]]:
        """Ids and decoded text of every stretch between blanks of a text without special tokens."""
        if text.isascii() or _latin(text):
            text = text.lower()  # nothing to compose or to look up
        else:
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
            text = (text.translate(self._lower) if self._odd.search(text) else text).lower()
        # Python also splits at U+001C to U+001F, which are no blanks to the file
        between = BLANKS.split(text) if CONTROLS.search(text) else text.split()
        return list(map(self._pieces.__getitem__, filter(None, between)))

    def encode_bytes(self, text: str) -> tuple[bytes, bytes]:
        """Ids of a text as little-endian 32-bit integers, and the decoded text in UTF-8."""
        if self._special and any(s in text for s in self.specials):
            pieces = []
            for i, part in enumerate(self._special.split(text)):
                pieces += [(struct.pack("<I", self.specials[part]), part.encode())] if i % 2 else self._plain(part)
        else:
            pieces = self._plain(text)
        if not pieces:
            return b"", b""
        ids, decoded = zip(*pieces)
        return b"".join(ids), b" ".join(decoded)

    def encode(self, text: str) -> tuple[bytes, str]:
        """Ids of a text as little-endian 32-bit integers, and the decoded text."""
        ids, decoded = self.encode_bytes(text)
        return ids, decoded.decode("utf-8", "surrogatepass")

    def decode(self, ids: list[int]) -> str:
        """Token strings joined by a space: the file names no decoder."""
        return " ".join(map(self.names.__getitem__, ids))


_loaded: dict[str, PrefixBpe] = {}


def loaded(path: str) -> PrefixBpe:
    """One tokenizer per worker and file."""
    if path not in _loaded:
        _loaded[path] = PrefixBpe.from_file(path)
    return _loaded[path]


def encoded(documents: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (array of int) and decoded text of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                done = [bpe.encode(t or "") for t in part.column("text").to_pylist()]
                ids = pa.array([np.frombuffer(i, "<u4").astype(np.int32) for i, _ in done], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), ids, pa.array([d for _, d in done])], ["doc_id", "ids", "decoded"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def digests(documents: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens and digests of ids and decoded text: :func:`encoded` without moving the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                n, ids, decoded = [], [], []
                for t in part.column("text").to_pylist():
                    raw, back = bpe.encode_bytes(t or "")
                    n.append(len(raw) // 4)
                    ids.append(hashlib.sha256(raw).hexdigest())
                    decoded.append(hashlib.sha256(back).hexdigest())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids), pa.array(decoded)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
