"""Operators that work inside the row: rules, personal data, tokens, scores."""

from __future__ import annotations

import collections
import hashlib
import itertools
import os
import random
import re
import struct
import sys

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import nasty  # noqa: E402

public_tokenizers = pytest.importorskip("public_tokenizers")

from palate.llm import arrays, bpe_prefix, divergence_rules, packing, personal_data, quality_ranker, token_counts  # noqa: E402

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def test_words_and_hashes_follow_the_definition():
    texts = nasty.texts()
    found = arrays.words_of(pa.array(["skipped", *texts]).slice(1))
    hashes, folded = found.hashes(), found.hashes(fold=True)
    by_word = {}
    for i, text in enumerate(texts):
        own = [bytes(found.data[a:b]).decode() for a, b in zip(found.start[found.first[i] : found.first[i + 1]], found.end[found.first[i] : found.first[i + 1]])]
        assert own == nasty.words(text)
        for w, h in zip(own, hashes[found.first[i] : found.first[i + 1]]):
            assert by_word.setdefault(w, h) == h
    assert len(set(by_word.values())) == len(by_word)
    assert (arrays.words_of(pa.array([(t or "").translate(nasty.LOWER) for t in texts])).hashes() == folded).all()


def test_chunks_keep_every_row_in_order(monkeypatch):
    monkeypatch.setattr(arrays, "CHUNK_BYTES", 50)
    batch = pa.RecordBatch.from_arrays([pa.array(nasty.texts())], ["text"])
    assert pa.concat_arrays([c.column(0) for c in arrays.chunks(batch)]).to_pylist() == nasty.texts()


def test_base_rules_against_plain_python(spark):
    got = {r["doc_id"]: r for r in divergence_rules.judged(nasty.documents(spark)).collect()}
    for d, text, *_ in nasty.rows():
        w, t = nasty.words(text), text or ""
        seen = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        covered = {j for i in range(len(w) - 4) if seen[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
        lines = [x for x in t.split("\n") if nasty.WORD.search(x)]
        if d is not None:
            r = got[d]
            expected = (len(w), sum(map(len, w)), sum(t.count(x) for x in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))
            assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == expected, d
            assert r["base_failed"] == (len(w) < 10 or 100 * len(covered) > 20 * len(w))
            assert not (r["base_failed"] and r["kept"])
    assert divergence_rules.judged(nasty.documents(spark)).count() == len(nasty.rows())
    assert divergence_rules.judged(nasty.nothing(spark)).count() == 0


def test_distance_is_jensen_shannon(spark):
    p, q = np.array([3.0, 0, 5, 2]), np.array([1.0, 4, 4, 1])
    a, b = p / p.sum(), q / q.sum()
    m = (a + b) / 2
    expected = np.sqrt(sum(0.5 * x * np.log2(x / y) for u in (a, b) for x, y in zip(u, m) if x))
    df = spark.createDataFrame([(p.tolist(), q.tolist(), None)], "p array<double>, q array<double>, n array<double>")
    r = df.select(divergence_rules.distance(F.col("p"), F.col("q")).alias("d"), divergence_rules.distance(F.col("p"), F.col("n")).alias("n")).first()
    assert r["d"] == pytest.approx(expected) and r["n"] is None


def test_odd_documents_are_told_from_their_language(spark):
    rnd = random.Random(1)
    sentence = lambda: " ".join(rnd.choice(["the", "of", "and", "house", "tree", "river", "stone", "a", "to"]) for _ in range(150))
    rows = [(i, sentence(), "en") for i in range(30)] + [(99, " ".join("#%&$" + str(rnd.random()) for _ in range(150)), "en")]
    got = {r["doc_id"]: r["kept"] for r in divergence_rules.judged(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert not got[99] and all(got[i] for i in range(30))


def plain_spans(text: str | None) -> list[str]:
    t, out = text or "", []
    luhn = lambda d: sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    tests = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.group().split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m)) <= 15),
    }
    for kind, (pattern, test) in tests.items():
        out += [f"{kind}:{m.start()}:{m.end()}" for m in re.finditer(pattern, t) if test(m)]
    return out


def test_base_spans_against_plain_python(spark):
    rnd = random.Random(3)
    bits = ["a", "@", ".", "b1", "+", "1", "22", "255", ".", "-", " ", "(", ")", "4111111111111111", "é", "😀", "%"]
    texts = [*nasty.texts(), "a@b.c+d@e.f", "1.2.3.4.5.6.7.8 256.1.1.1 0255.1.1.1", "x" * 30_000 + "@y.z", "a@" + "b." * 4_000 + "c", "1" * 20_000, "+49 " + " " * 3_000 + "1"]
    texts += ["".join(rnd.choice(bits) for _ in range(rnd.randint(1, 40))) for _ in range(600)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    base = F.filter("spans", lambda s: s["kind"].isin(personal_data.BASE_KINDS))
    for r in personal_data.with_spans(df).select("text", personal_data.listed(base).alias("found")).collect():
        assert r["found"] == ",".join(plain_spans(r["text"])), r["text"][:80]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("IBAN GB82 WEST 1234 5698 7654 32 x", "iban:5:32"),
        ("DE89370400440532013000", "iban:0:22"),
        ("DE89370400440532013001", ""),
        ("his ssn 123-45-6789", "national_id:8:19"),
        ("part 123-45-6789", ""),
        ("amex card 378282246310005", "short_card:10:25"),
        ("part 378282246310005", ""),
    ],
)
def test_checksums_and_context_decide(spark, text, expected):
    df = spark.createDataFrame([(text,)], "text string")
    assert personal_data.with_spans(df).select(personal_data.listed(F.col("spans"))).first()[0] == expected


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("IBAN DE89370400440532013000 Bank of X", "iban:5:27"),
        ("IBAN DE89 3704 0044 0532 0130 00 BIC COBADEFFXXX", "iban:5:32"),
        ("IBAN DE89370400440532013000 2024", "iban:5:27"),
        ("IBAN DE89370400440532013000 A new", "iban:5:27"),
        ("DE89370400440532013000 GB82 WEST 1234 5698 7654 32 NO9386011117947", "iban:0:22,iban:23:50,iban:51:66"),
        ("REF AB12 DE89370400440532013000 Bank", "iban:9:31"),
        ("ZZ22370400440532013000 Bank", "iban:0:22"),
        ("é😀 DE89370400440532013000 Bank", "iban:3:25"),
        ("DE89370400440532013001 Bank", ""),
        ("DE89370400440532013000Bank", ""),
        ("AB12 " * 4_000, ""),
    ],
)
def test_an_iban_ends_before_the_next_word(spark, text, expected):
    df = spark.createDataFrame([(text,)], "text string")
    found = F.filter("spans", lambda s: s["kind"] == "iban")
    assert personal_data.with_spans(df).select(personal_data.listed(found)).first()[0] == expected


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("amex card 378282246310005 12/25", "short_card:10:25"),
        ("amex card 3782-822463-10005 2025", "short_card:10:27"),
        ("amex card 12/25 378282246310005 1", "short_card:16:31"),
        ("cards 378282246310005 371449635398431", "short_card:6:21,short_card:22:37"),
        ("card 3782822463100059", ""),
        ("card 378282246310006 12/25", ""),
        ("part 378282246310005 12/25", ""),
        ("card 4111 1111 1111 1111", "card:5:24"),
        ("card " + "1" * 20_000, ""),
    ],
)
def test_a_short_card_stands_among_numbers(spark, text, expected):
    df = spark.createDataFrame([(text,)], "text string")
    assert personal_data.with_spans(df).select(personal_data.listed(F.col("spans"))).first()[0] == expected


def test_masking_replaces_spans_once(spark):
    rows = [("write bob@x.org or 4111111111111111@y.com now", 1), (None, 2), ("clean", 3)]
    got = {r["_spans"]: r["text"] for r in personal_data.masked(spark.createDataFrame(rows, "text string, _spans int")).collect()}
    assert got == {1: "write <EMAIL> or <EMAIL> now", 2: None, 3: "clean"}


def test_personal_data_runs_without_python(spark):
    plan = personal_data.with_spans(nasty.documents(spark))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
    rules = divergence_rules.measured(nasty.documents(spark))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", rules)


def test_bpe_equals_the_library(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORD_BPE)
    library.no_truncation()
    library.no_padding()
    rnd = random.Random(4)
    bits = [*"abcdefghijklmnop qrstuvwxyz  ABC'’.,!?\n\t0123é日本ßΣσ İ😀\x85\xa0|<>", "<|endoftext|>", "the", "ing", " 'll", "'S"]
    texts = [*nasty.texts(), "a" * 2_000, "ab" * 1_500, "ÅÅ é"] + ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 50))) for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    whole = {r["doc_id"]: r for r in bpe_prefix.encoded(df, WORD_BPE).collect()}
    for r in bpe_prefix.digests(df, WORD_BPE).collect():
        ids = library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        assert whole[r["doc_id"]]["ids"] == ids and whole[r["doc_id"]]["decoded"] == back
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(back.encode()).hexdigest()
    assert bpe_prefix.digests(nasty.nothing(spark), WORD_BPE).count() == 0


def test_bpe_memory_may_be_emptied(monkeypatch):
    text = "the cat, and the dog and the cat " * 3 + "y" * 100
    whole = bpe_prefix.PrefixBpe.from_file(WORD_BPE).encode(text)
    monkeypatch.setattr(bpe_prefix, "REMEMBERED", 2)
    monkeypatch.setattr(bpe_prefix, "REMEMBERED_PAIRS", 3)
    one = bpe_prefix.PrefixBpe.from_file(WORD_BPE)
    assert one.encode(text) == whole and len(one._pieces) <= 2 and len(one._pieces.older) <= 2 and sum(map(len, one._pairs)) <= 3


@pytest.mark.parametrize("form", ["a?b", " ? ", "??1", "É?\x1c"])
def test_bpe_equals_the_library_at_every_code_point(form):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORD_BPE)
    library.no_truncation()
    library.no_padding()
    bpe = bpe_prefix.loaded(WORD_BPE)
    points = [c for c in range(1, 0x40000) if not 0xD800 <= c <= 0xDFFF and chr(c) != "?"]
    for i in range(0, len(points), 8_192):
        text = " x ".join(form.replace("?", chr(c)) for c in points[i : i + 8_192])
        raw, back = bpe.encode(text)
        found = library.encode(text, add_special_tokens=False).ids
        assert raw == struct.pack(f"<{len(found)}I", *found), hex(points[i])
        assert back == library.decode(found, skip_special_tokens=False)


def test_every_prefix_has_its_last_token():
    bpe = bpe_prefix.loaded(WORD_BPE)
    word = "".join(bpe._bytes[b] for b in b"internationalisation")
    for n, token in enumerate(bpe.last_tokens(word), 1):
        assert bpe_merge(bpe, word[:n])[-1] == token


def bpe_merge(bpe, symbols: str) -> list[str]:
    parts = list(symbols)
    while True:
        ranked = [(bpe._rank[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in bpe._rank]
        if not ranked:
            return parts
        _, i = min(ranked)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def test_sections_share_all_tokens(spark):
    got = collections.defaultdict(list)
    for r in token_counts.attributed(nasty.documents(spark).filter("doc_id is not null").dropDuplicates(["doc_id"]), RANKS, public_tokenizers.PATTERN).collect():
        got[r["doc_id"]].append(r)
    for d, text in enumerate(nasty.texts()):
        own = sorted(got[d], key=lambda r: r["section"])
        assert [r["end"] - r["start"] for r in own] == [len(x) + 1 for x in (text or "").split("\n")][:-1] + [len((text or "").split("\n")[-1])]
        assert sum(r["n_tokens"] for r in own) == own[0]["doc_tokens"]
    assert token_counts.attributed(nasty.nothing(spark), RANKS, public_tokenizers.PATTERN).count() == 0


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_crossing_tokens_follow_the_rule(rule):
    start, end = np.array([0, 3, 7, 9]), np.array([3, 7, 9, 12])
    s, e = np.array([0, 4, 6, 10]), np.array([4, 6, 6, 12])
    expected = np.zeros(4)
    for a, b in zip(start, end):
        held = [max(0, min(b, y) - max(a, x)) for x, y in zip(s, e)]
        if not sum(held):
            continue
        if rule == "share":
            expected += np.array(held) / sum(held)
        elif rule == "most":
            expected[int(np.argmax(held))] += 1
        else:
            expected[[i for i, h in enumerate(held) if h][0]] += 1
    assert token_counts.allocated(start, end, s, e, rule) == pytest.approx(expected)


def test_given_sections_and_unknown_rule(spark):
    rows = [(1, "Hello wörld again", [(0, 5), (6, 11)], 7), (2, None, None, 7), (3, "x", [], 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, parts array<struct<start:int,end:int>>, section int")
    got = token_counts.attributed(df, RANKS, public_tokenizers.PATTERN, sections="parts").collect()
    assert [(r["doc_id"], r["section"]) for r in got] == [(1, 0), (1, 1)]
    with pytest.raises(ValueError):
        token_counts.attributed(df, RANKS, public_tokenizers.PATTERN, rule="other")


def test_boundaries_are_optimal():
    rnd = random.Random(2)
    for _ in range(200):
        histogram = {rnd.randint(0, 30): rnd.randint(1, 9) for _ in range(rnd.randint(1, 8))}
        k, lengths = rnd.randint(1, 4), sorted(histogram)
        padding = lambda b: sum(c * (min(x for x in b if x >= n) - n) for n, c in histogram.items())  # noqa: B023, E731
        best = min(padding([*c, lengths[-1]]) for r in range(k) for c in itertools.combinations(lengths[:-1], r))
        found = packing.best_boundaries(histogram, k)
        assert len(found) <= k and padding(found) == best
    assert packing.best_boundaries({}, 3) == []


def test_packing_is_whole_and_within_budget(spark):
    rows = [(i % 50, n) for i, n in enumerate([0, None, 1, 5, 5, 5, 99, 100, 101, 250, *[7] * 200])]
    got = packing.packed(spark.createDataFrame(rows, "doc_id long, n_tokens long"), max_length=100, token_budget=300, buckets=3).collect()
    assert sum(r["length"] for r in got) == sum(n or 0 for _, n in rows)
    assert len(got) == sum(max(1, -(-(n or 0) // 100)) for _, n in rows)
    batches = collections.defaultdict(list)
    for r in got:
        assert r["length"] <= r["padded_length"] <= 100
        batches[r["bucket"], r["batch"]].append(r)
    for own in batches.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
        assert sum(r["padded_length"] for r in own) <= 300
    assert packing.packed(spark.createDataFrame([], "doc_id long, n_tokens long")).count() == 0


def test_ranker_learns_from_pairs(spark):
    rnd = random.Random(6)
    vocabulary = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 8))) for _ in range(300)]
    good = [" ".join(rnd.choice(vocabulary) for _ in range(60)) for _ in range(80)]
    bad = [" ".join(rnd.choice(vocabulary) + "###" for _ in range(60)) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate([*good, *bad])), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 80), 0, "x") for i in range(0, 120, 2)] + [(None, 1, 0, "x"), (0, None, 0, "x"), (999, 1, 0, "x")], "doc_id long, quality int, toxic int, text string")
    ranker = quality_ranker.train_ranker(docs, labels)
    got = {r["doc_id"]: r for r in quality_ranker.score_documents(docs, ranker).collect()}
    assert all(got[i]["predicted"] == int(i < 80) for i in range(1, 120, 2))
    assert quality_ranker.train_ranker(docs.repartition(7), labels.repartition(3)) == ranker
    assert quality_ranker.train_ranker(docs, labels, max_labelled=30).weights != ranker.weights
    assert quality_ranker.fit_ranker(np.array([[0.0], [1], [2], [3]]), np.array([0.0, 1, 1, 1]), quantile=0.5).cut == pytest.approx(0.0, abs=1.0)


def test_scores_of_odd_tables(spark):
    nothing = spark.createDataFrame([], "doc_id long, quality int")
    flat = quality_ranker.train_ranker(nasty.documents(spark), nothing)
    rows = quality_ranker.score_documents(nasty.documents(spark), flat).collect()
    assert len(rows) == len(nasty.rows()) and {r["score"] for r in rows} == {0.5} and {r["predicted"] for r in rows} == {1}
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, quality int")
    ranker = quality_ranker.train_ranker(nasty.documents(spark), labels)
    assert all(0 <= r["score"] <= 1 for r in quality_ranker.score_documents(nasty.documents(spark), ranker).collect())
    assert quality_ranker.score_documents(nasty.nothing(spark), ranker).count() == 0
