"""The registered questions in SQL, written against the given tables only.

Shared stages are common table expressions; ``sql("silver", ...)`` puts the stages a
question needs, in order, before it.
"""

from __future__ import annotations

from checks import fixture
from palate.functions import polarity as rules

ORACLE: dict[str, str] = {}


def clean(text: str) -> str:
    """Markup rules as nested replacements."""
    rules = [
        (r"(?i)<br\s*/?>", ". "),
        (r"(?i)</?p\s*>", ". "),
        (r"(?i)<[^>]+>", " "),
        (r"(?i)&amp;", " and "),
        (r"(?i)&quot;", '"'),
        (r"(?i)&(?:apos|#39);", "''"),
        (r"(?i)&(?:nbsp|lt|gt);|&#[0-9]+;", " "),
        (r"\s+", " "),
    ]
    for pattern, put in rules:
        text = f"regexp_replace({text}, '{pattern}', '{put}', 'g')"
    return f"trim({text})"


def normal(text: str) -> str:
    return rf"trim(regexp_replace(lower({text}), '\s+', ' ', 'g'))"


def letters(text: str) -> str:
    return (
        rf"regexp_replace(regexp_replace(regexp_replace(lower({text}), '<[^>]+>', ' ', 'g'), '[^a-z\s]', ' ', 'g'), '\s+', ' ', 'g')"
    )


def integral(value: str, kind: str) -> str:
    return f"CASE WHEN regexp_matches(trim({value}), '^[+-]?[0-9]+$') THEN TRY_CAST(trim({value}) AS {kind}) END"


def words(text: str) -> str:
    return rf"regexp_extract_all(lower({text}), '[\p{{L}}\p{{N}}_]{{2,}}')"


def split_sentences(text: str, line_breaks: bool = False) -> str:
    marked = rf"regexp_replace({text}, '([.!?])\s+', '\1' || chr(1), 'g')"
    if line_breaks:
        marked = rf"regexp_replace({marked}, '[\r\n]+', chr(1), 'g')"
    return f"string_split({marked}, chr(1))"


def mention(text: str, terms: list[str]) -> str:
    return rf"regexp_matches({text}, '(?i)(?:^|[^\p{{L}}\p{{N}}_])(?:{'|'.join(terms)})(?:[^\p{{L}}\p{{N}}_]|$)')"


def bucket(value: str) -> str:
    return f"CASE WHEN {value} >= 0.05 THEN 'positive' WHEN {value} <= -0.05 THEN 'negative' ELSE 'neutral' END"


def ratio(a: str, b: str) -> str:
    return f"CASE WHEN ({b}) <> 0 THEN CAST(({a}) AS DOUBLE) / ({b}) ELSE 0.0 END"


def values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(repr(v) for v in row) + ")" for row in rows)


ASPECTS = list(fixture.ASPECTS)
FLAGS = ", ".join(
    f"CAST({mention('sentence_text', terms)} AS INTEGER) AS weak_{a}" for a, terms in fixture.ASPECTS.items()
)
ASPECT_LIST = "concat_ws(',', " + ", ".join(f"CASE WHEN weak_{a} = 1 THEN '{a}' END" for a in ASPECTS) + ")"
LEXICON_ROWS = values(
    [(a, i, t) for i, (a, terms) in enumerate(fixture.ASPECTS.items(), 1) for t in terms]
)
VALENCE_ROWS = values(list(fixture.POLARITY.valence.items()))
BOOSTS = " ".join(f"WHEN {w!r} THEN {b}" for w, b in fixture.POLARITY.boosters.items())
NEGATORS = ", ".join(repr(n) for n in fixture.POLARITY.negators)
CONTRAST = ", ".join(repr(n) for n in fixture.POLARITY.contrast)


def stepped(inner: str, n: int, factor: float) -> str:
    """The valence after the word ``n`` places before it."""
    loud = f"CASE WHEN mixed AND c{n} THEN {rules.CAPITALS} ELSE 0 END"
    boost = f"CASE t{n} {BOOSTS} END"
    return f"""SELECT * REPLACE ((v + coalesce(sign(v) * {factor} * ({boost} + {loud}), 0)) * CASE WHEN t{n} IN ({NEGATORS}) THEN {rules.NEGATION_FACTOR} ELSE 1 END AS v) FROM ({inner})"""


STEPS = f"""SELECT s.*, x.valence + sign(x.valence) * CASE WHEN mixed AND capitals THEN {rules.CAPITALS} ELSE 0 END AS v
  FROM (SELECT *, {", ".join(f"lag(token, {n}) OVER w AS t{n}, lag(capitals, {n}) OVER w AS c{n}" for n in (1, 2, 3))},
          bool_or(capitals) OVER a AND bool_or(NOT capitals) OVER a AS mixed, min(CASE WHEN token IN ({CONTRAST}) THEN pos END) OVER a AS turn
        FROM spoken WINDOW w AS (PARTITION BY sentence_id ORDER BY pos), a AS (PARTITION BY sentence_id)) s
  JOIN (SELECT column0 AS term, CAST(column1 AS DOUBLE) AS valence FROM (VALUES {VALENCE_ROWS}) v(column0, column1)) x ON s.token = x.term"""
for _n, _factor in enumerate(rules.DISTANCE_FACTORS, 1):
    STEPS = stepped(STEPS, _n, _factor)

STAGES: dict[str, str] = {
    "base": """
      SELECT d.doc_id AS k, d.doc_id AS id, d.source AS product_id, d.text AS body,
             'documents' AS src, l.quality AS q, l.toxic AS tx
      FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
      UNION ALL
      SELECT d.doc_id, d.doc_id + 1000000, d.source, d.text, 'documents', l.quality, l.toxic
      FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
      WHERE d.doc_id % 10 = 0
      UNION ALL
      SELECT p.page_id, p.page_id + 2000000, concat('src', CAST(p.page_id % 20 AS VARCHAR)),
             p.html, 'pages', NULL, NULL
      FROM pages p""",
    "reviews": """
      SELECT CAST(id AS VARCHAR) AS Id, product_id AS ProductId,
             concat('u', CAST(k % 97 AS VARCHAR)) AS UserId,
             concat('user ', CAST(k % 97 AS VARCHAR)) AS ProfileName,
             CAST(k % 7 AS VARCHAR) AS HelpfulnessNumerator,
             CAST(k % 13 AS VARCHAR) AS HelpfulnessDenominator,
             CASE WHEN k % 41 = 40 THEN 'x'
                  WHEN q = 0 THEN CAST(1 + tx AS VARCHAR)
                  ELSE CAST(1 + k % 5 AS VARCHAR) END AS Score,
             CASE WHEN k % 50 = 49 THEN 'n/a' WHEN k % 61 = 60 THEN '999999999999999999'
                  ELSE CAST(939340800 + (k % 156) * 2592000 AS VARCHAR) END AS Time,
             substr(body, 1, 40) AS Summary, body AS Text, src AS source_file
      FROM base""",
    "bronze": """
      SELECT Id AS raw_id, ProductId AS product_id, UserId AS user_id, ProfileName AS profile_name,
             HelpfulnessNumerator AS raw_helpfulness_numerator,
             HelpfulnessDenominator AS raw_helpfulness_denominator,
             Score AS raw_score, Time AS raw_review_time, Summary AS summary, Text AS review_text,
             source_file AS _source_file,
             sha256(concat_ws('||', coalesce(source_file, ''), coalesce(Id, ''), coalesce(ProductId, ''),
                              coalesce(UserId, ''), coalesce(Time, ''))) AS _record_id
      FROM reviews""",
    "typed": f"""
      SELECT {integral('raw_id', 'BIGINT')} AS id, trim(product_id) AS product_id, trim(user_id) AS user_id,
             trim(profile_name) AS profile_name,
             {integral('raw_helpfulness_numerator', 'INTEGER')} AS helpfulness_numerator,
             {integral('raw_helpfulness_denominator', 'INTEGER')} AS helpfulness_denominator,
             {integral('raw_score', 'INTEGER')} AS score, raw_review_time AS review_time_raw,
             {integral('raw_review_time', 'BIGINT')} AS review_time_epoch,
             trim(summary) AS summary, review_text, _source_file, _record_id,
             {clean('review_text')} AS review_text_clean
      FROM bronze""",
    "normalized": f"""
      SELECT *, {normal('review_text_clean')} AS normalized_text,
             CASE WHEN review_time_epoch BETWEEN -62135596800 AND 253402300799
                  THEN make_timestamp(review_time_epoch * 1000000) END AS review_timestamp
      FROM typed""",
    "silver": r"""
      SELECT *,
             CASE WHEN score <= 2 THEN 'negative' WHEN score = 3 THEN 'neutral' ELSE 'positive' END AS sentiment_class,
             CAST(CASE WHEN score <= 2 THEN 0 WHEN score >= 4 THEN 1 END AS INTEGER) AS binary_label,
             CAST(length(review_text_clean) AS INTEGER) AS review_length,
             CAST(len(regexp_split_to_array(normalized_text, '\s+')) AS INTEGER) AS review_word_count,
             CASE WHEN helpfulness_denominator > 0
                  THEN CAST(helpfulness_numerator AS DOUBLE) / helpfulness_denominator END AS helpfulness_ratio,
             review_timestamp IS NOT NULL AS has_valid_review_time
      FROM (
        SELECT * FROM normalized
        WHERE id IS NOT NULL AND length(product_id) > 0 AND length(user_id) > 0 AND score BETWEEN 1 AND 5
          AND length(review_text_clean) > 0 AND helpfulness_numerator >= 0 AND helpfulness_denominator >= 0
          AND helpfulness_numerator <= helpfulness_denominator
        QUALIFY row_number() OVER (PARTITION BY product_id, user_id, review_time_epoch, normalized_text
                                   ORDER BY id, _record_id) = 1)""",
    "binary_reviews": """
      SELECT * FROM silver WHERE binary_label IN (0, 1)
      QUALIFY row_number() OVER (PARTITION BY normalized_text
                                 ORDER BY helpfulness_denominator DESC, id, _record_id) = 1""",
    "model_input": """
      SELECT _record_id AS record_id, normalized_text AS clean_text, binary_label AS label,
             CASE WHEN share <= 0.80 THEN 'train' WHEN share <= 0.90 THEN 'validation' ELSE 'test' END AS dataset_split,
             score, product_id, user_id, review_timestamp, review_length, review_word_count,
             helpfulness_numerator, helpfulness_denominator, helpfulness_ratio
      FROM (SELECT *, CAST(row_number() OVER (PARTITION BY binary_label ORDER BY sha256(_record_id), _record_id) AS DOUBLE)
                      / count(*) OVER (PARTITION BY binary_label) AS share
            FROM binary_reviews)""",
    "research": f"""
      SELECT sha256(concat_ws('||', Id, ProductId, UserId, Time, Text)) AS row_id, * FROM (
        SELECT {letters('Text')} AS clean_text,
               CAST(CASE WHEN sc >= 4 THEN 1 WHEN sc <= 2 THEN 0 END AS INTEGER) AS label, sc AS Score,
               hn AS HelpfulnessNumerator, hd AS HelpfulnessDenominator, ProductId, Time, Id, UserId, Text
        FROM (SELECT * EXCLUDE (Score, HelpfulnessNumerator, HelpfulnessDenominator),
                     {integral('Score', 'INTEGER')} AS sc,
                     {integral('HelpfulnessNumerator', 'INTEGER')} AS hn,
                     {integral('HelpfulnessDenominator', 'INTEGER')} AS hd
              FROM reviews WHERE Text IS NOT NULL AND Score IS NOT NULL)
        WHERE hn <= hd
        QUALIFY row_number() OVER (PARTITION BY UserId, Time, Text ORDER BY TRY_CAST(Id AS BIGINT), ProductId) = 1)
      WHERE label IS NOT NULL AND length(clean_text) > 3""",
    "half_sample": """
      SELECT * FROM research
      WHERE (label = 1 AND substr(md5(concat_ws('|', '42', row_id)), 1, 8) < '40000000')
         OR (label = 0 AND substr(md5(concat_ws('|', '42', row_id)), 1, 8) < 'c0000000')""",
    "pieces": f"""
      SELECT *, unnest(parts) AS raw_sentence, CAST(generate_subscripts(parts, 1) - 1 AS INTEGER) AS sentence_index
      FROM (SELECT *, {split_sentences('review_text_clean')} AS parts FROM silver)""",
    "sentences": f"""
      SELECT sha256(concat_ws('||', _record_id, CAST(sentence_index AS VARCHAR))) AS sentence_id,
             _record_id AS record_id, id, product_id, user_id, score, sentiment_class, review_time_epoch,
             review_timestamp, CAST(year(review_timestamp) AS INTEGER) AS review_year,
             helpfulness_numerator, helpfulness_denominator, helpfulness_ratio, sentence_index,
             trim(raw_sentence) AS sentence_text, {normal('trim(raw_sentence)')} AS sentence_normalized
      FROM pieces WHERE length(trim(raw_sentence)) > 0""",
    "split_sentences": """
      SELECT *, CASE WHEN h < 'cccccccc' THEN 'train' WHEN h < 'e6666666' THEN 'validation' ELSE 'test' END AS development_split
      FROM (SELECT *, substr(md5(record_id), 1, 8) AS h FROM sentences)""",
    "labelled": f"SELECT *, {FLAGS} FROM split_sentences",
    "spoken": r"""
      SELECT *, lower(raw) AS token, upper(raw) = raw AND lower(raw) <> raw AS capitals
      FROM (SELECT sentence_id, unnest(w) AS raw, generate_subscripts(w, 1) AS pos
            FROM (SELECT sentence_id, regexp_extract_all(sentence_text, '[\p{L}\p{N}_]+(?:''\p{L}+)?') AS w FROM sentences))""",
    "signed": f"""
      SELECT sentence_id, sum(v * CASE WHEN turn IS NULL OR pos = turn THEN 1.0 WHEN pos < turn THEN {rules.BEFORE_CONTRAST} ELSE {rules.AFTER_CONTRAST} END) AS s
      FROM ({STEPS}) GROUP BY sentence_id""",
    "polar": f"""
      SELECT * EXCLUDE (s, marks, e), coalesce(e / sqrt(e * e + {rules.NORMALIZER}), 0.0) AS polarity
      FROM (SELECT *, s + sign(s) * marks AS e
            FROM (SELECT l.*, s, {rules.EXCLAMATION} * least(length(sentence_text) - length(replace(sentence_text, '!', '')), {rules.MOST_EXCLAMATIONS})
                    + CASE WHEN length(sentence_text) - length(replace(sentence_text, '?', '')) <= 1 THEN 0
                           WHEN length(sentence_text) - length(replace(sentence_text, '?', '')) <= {rules.MOST_QUESTIONS} THEN {rules.QUESTION} * (length(sentence_text) - length(replace(sentence_text, '?', '')))
                           ELSE {rules.MANY_QUESTIONS} END AS marks
                  FROM labelled l LEFT JOIN signed USING (sentence_id)))""",
    "long": " UNION ALL ".join(
        f"""SELECT r._record_id, r.product_id, r.helpfulness_numerator, r.review_timestamp, '{a}' AS aspect, m.compound,
                   CASE WHEN m.compound IS NULL THEN 'not_mentioned' ELSE {bucket('m.compound')} END AS sentiment
            FROM silver r LEFT JOIN (SELECT record_id, avg(polarity) AS compound FROM polar WHERE weak_{a} = 1 GROUP BY record_id) m
              ON r._record_id = m.record_id"""
        for a in ASPECTS
    ),
    "seeded": " UNION ALL ".join(
        f"""SELECT sentence_id, '{a}' AS aspect, polarity, {bucket('polarity')} AS polarity_class,
                   (sentence_index * 37 % 101) / 100.0 AS aspect_probability
            FROM polar WHERE weak_{a} = 1"""
        for a in ASPECTS
    ),
    "ranking": """
      SELECT aspect, count(*) FILTER (WHERE sentiment <> 'not_mentioned') AS mentions,
             avg(CASE WHEN sentiment <> 'not_mentioned' THEN 1.0 ELSE 0.0 END) AS mention_rate,
             avg(CASE WHEN sentiment = 'negative' THEN 1.0 ELSE 0.0 END) FILTER (WHERE sentiment <> 'not_mentioned') AS pct_negative,
             avg(CASE WHEN sentiment = 'positive' THEN 1.0 ELSE 0.0 END) FILTER (WHERE sentiment <> 'not_mentioned') AS pct_positive,
             CAST(sum(CASE WHEN sentiment = 'negative' THEN coalesce(helpfulness_numerator, 0) + 1 ELSE 0 END) AS DOUBLE)
               / sum(coalesce(helpfulness_numerator, 0) + 1) FILTER (WHERE sentiment <> 'not_mentioned') AS weighted_pct_negative
      FROM long GROUP BY aspect HAVING mentions > 0""",
    "trend": """
      SELECT aspect, CAST(year(review_timestamp) AS INTEGER) AS year,
             avg(CASE WHEN sentiment = 'negative' THEN 1.0 ELSE 0.0 END) AS pct_negative
      FROM long WHERE sentiment <> 'not_mentioned' AND review_timestamp IS NOT NULL GROUP BY ALL""",
    "scores": """
      SELECT doc_id, quality AS y, (doc_id * 37 % 101) / 100.0 AS score,
             CAST((doc_id * 37 % 101) / 100.0 >= 0.5 AS INTEGER) AS p
      FROM labels""",
    "cells": """
      SELECT count(*) FILTER (WHERE y = 0 AND p = 0) AS tn, count(*) FILTER (WHERE y = 0 AND p = 1) AS fp,
             count(*) FILTER (WHERE y = 1 AND p = 0) AS fn, count(*) FILTER (WHERE y = 1 AND p = 1) AS tp
      FROM scores""",
    "rates": f"""
      SELECT c AS class, {ratio('t', 'predicted')} AS precision, {ratio('t', 'support')} AS recall,
             {ratio('2.0 * t', 'predicted + support')} AS f1, support, t
      FROM (SELECT c, count(*) FILTER (WHERE y = c) AS support, count(*) FILTER (WHERE p = c) AS predicted,
                   count(*) FILTER (WHERE y = c AND p = c) AS t
            FROM scores, (VALUES (0), (1)) k(c) GROUP BY c)""",
    "pairs": """
      SELECT doc_id, 'quality' AS aspect, quality AS y, CAST((doc_id * 37 % 101) / 100.0 >= 0.5 AS INTEGER) AS p FROM labels
      UNION ALL
      SELECT doc_id, 'toxic', toxic, CAST(doc_id % 3 = 0 AS INTEGER) FROM labels""",
    "pair_sums": """
      SELECT aspect, count(*) FILTER (WHERE y = 1 AND p = 1) AS t, count(*) FILTER (WHERE p = 1) AS predicted,
             count(*) FILTER (WHERE y = 1) AS support, count(*) FILTER (WHERE y <> p) AS wrong, count(*) AS n
      FROM pairs GROUP BY aspect""",
    "word_counts": f"""
      SELECT doc_id AS doc, term, count(*) AS tf
      FROM (SELECT doc_id, unnest({words('text')}) AS term FROM documents) GROUP BY ALL""",
    "placed_words": f"""
      SELECT doc_id AS doc, unnest(w) AS term, generate_subscripts(w, 1) AS pos
      FROM (SELECT doc_id, {words('text')} AS w FROM documents)""",
    "grams": """
      SELECT doc, term FROM placed_words
      UNION ALL
      SELECT doc, gram FROM (SELECT doc, term || ' ' || lead(term) OVER (PARTITION BY doc ORDER BY pos) AS gram FROM placed_words)
      WHERE gram IS NOT NULL""",
    "gram_counts": "SELECT doc, term, count(*) AS tf FROM grams GROUP BY ALL",
    "gram_terms": """
      SELECT term, count(*) AS df, sum(tf) AS cf, ln((1.0 + (SELECT count(*) FROM documents)) / (1.0 + count(*))) + 1.0 AS idf
      FROM gram_counts GROUP BY term
      HAVING count(*) >= 3 AND count(*) <= 0.98 * (SELECT count(*) FROM documents)
      ORDER BY cf DESC, term LIMIT 2000""",
    "gram_weights": """
      SELECT doc, term, (1.0 + ln(tf)) * idf AS w FROM gram_counts JOIN gram_terms USING (term)""",
    "sequence_words": r"""
      SELECT doc_id, list_filter(string_split(regexp_replace(lower(text), '[!"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~\t\n]', ' ', 'g'), ' '),
                                 lambda x: x <> '') AS w
      FROM documents""",
    "sequence_ids": """
      SELECT term, row_number() OVER (ORDER BY n DESC, term) + 1 AS id
      FROM (SELECT term, count(*) AS n FROM (SELECT unnest(w) AS term FROM sequence_words) GROUP BY term
            ORDER BY n DESC, term LIMIT 1998)""",
    "class_words": f"""
      SELECT term, count(*) FILTER (WHERE quality = 0) AS n0, count(*) FILTER (WHERE quality = 1) AS n1
      FROM (SELECT quality, unnest({words('text')}) AS term FROM documents JOIN labels USING (doc_id)) GROUP BY term""",
    "source_terms": f"""
      SELECT source, term, row_number() OVER (PARTITION BY source ORDER BY count(*) DESC, term) AS position
      FROM (SELECT source, unnest({words('text')}) AS term FROM documents) GROUP BY source, term
      QUALIFY position <= 25""",
    "lexicon": f"""
      SELECT column0 AS aspect, column1 AS ord, column2 AS term
      FROM (VALUES {LEXICON_ROWS}) x(column0, column1, column2)""",
}

NEEDS: dict[str, list[str]] = {
    "reviews": ["base"], "bronze": ["reviews"], "typed": ["bronze"], "normalized": ["typed"], "silver": ["normalized"],
    "binary_reviews": ["silver"], "model_input": ["binary_reviews"], "research": ["reviews"], "half_sample": ["research"],
    "pieces": ["silver"], "sentences": ["pieces"], "split_sentences": ["sentences"], "labelled": ["split_sentences"],
    "spoken": ["sentences"], "signed": ["spoken"], "polar": ["labelled", "signed"], "long": ["polar"], "seeded": ["polar"],
    "ranking": ["long"], "trend": ["long"], "cells": ["scores"], "rates": ["scores"], "pair_sums": ["pairs"],
    "grams": ["placed_words"], "gram_counts": ["grams"], "gram_terms": ["gram_counts"], "gram_weights": ["gram_terms"],
    "sequence_ids": ["sequence_words"],
}


def _order(names: list[str], seen: dict[str, None]) -> dict[str, None]:
    for name in names:
        _order(NEEDS.get(name, []), seen)
        seen.setdefault(name)
    return seen


def sql(key: str, stages: str, question: str) -> None:
    names = list(_order(stages.split(), {}))
    # stages used more than once are computed once
    ctes = ",\n".join(f"{n} AS MATERIALIZED ({STAGES[n]})" for n in names)
    ORACLE[key] = (f"WITH {ctes}\n" if names else "") + question


def r6(*columns: str) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in columns)


sql("bronze", "bronze", "SELECT * FROM bronze")
sql("null_blank_counts", "bronze", "SELECT " + ", ".join(
    f"count(*) FILTER (WHERE {c} IS NULL OR trim({c}) = '') AS {c}"
    for c in ("raw_id", "product_id", "user_id", "raw_score", "raw_review_time", "summary", "review_text")) + " FROM bronze")
sql("parseability", "bronze", "SELECT " + ", ".join(
    f"count(*) FILTER (WHERE NOT regexp_matches(trim({c}), '^[+-]?[0-9]+$')) AS {n}" for n, c in (
        ("invalid_id", "raw_id"), ("invalid_score", "raw_score"), ("invalid_time", "raw_review_time"),
        ("invalid_helpfulness_numerator", "raw_helpfulness_numerator"),
        ("invalid_helpfulness_denominator", "raw_helpfulness_denominator"))) + " FROM bronze")
sql("rating_counts", "bronze", "SELECT raw_score, count(*) AS count FROM bronze GROUP BY raw_score")
sql("label_preview", "reviews", f"""
    SELECT CASE WHEN {integral('Score', 'INTEGER')} >= 4 THEN 1 ELSE 0 END AS positive, count(*) AS count
    FROM reviews GROUP BY 1""")
sql("describe_numeric", "reviews", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg(TRY_CAST({c} AS DOUBLE)), 6) AS mean,
        round(stddev_samp(TRY_CAST({c} AS DOUBLE)), 6) AS stddev, min(TRY_CAST({c} AS DOUBLE)) AS min,
        max(TRY_CAST({c} AS DOUBLE)) AS max FROM reviews"""
    for c in ("HelpfulnessNumerator", "HelpfulnessDenominator", "Score")))
sql("length_stats", "reviews", """
    SELECT CAST(min(length(Text)) AS INTEGER) AS min_chars, round(avg(length(Text)), 1) AS avg_chars,
           CAST(quantile_disc(length(Text), 0.5) AS INTEGER) AS median_chars, CAST(max(length(Text)) AS INTEGER) AS max_chars
    FROM reviews""")
sql("short_texts", "reviews", "SELECT Id, Score, Text FROM reviews WHERE length(Text) < 60")
sql("duplicate_texts", "bronze", " UNION ALL ".join(
    f"SELECT count(*) AS total, count(DISTINCT {c}) AS distinct_values, count(*) - count(DISTINCT {c}) AS duplicate_rows, '{n}' AS of FROM bronze"
    for n, c in (("review_text", "review_text"), ("record_id", "_record_id"))))
sql("balanced_sample", "reviews", f"""
    SELECT Id, Score FROM reviews
    WHERE {integral('Id', 'BIGINT')} IS NOT NULL AND {integral('Time', 'BIGINT')} IS NOT NULL
      AND {integral('HelpfulnessNumerator', 'INTEGER')} <= {integral('HelpfulnessDenominator', 'INTEGER')}
      AND {integral('Score', 'INTEGER')} BETWEEN 1 AND 5 AND length(trim(Text)) > 0
    QUALIFY row_number() OVER (PARTITION BY Score ORDER BY md5(concat_ws('|', '42', Id)), Id) <= 20""")
sql("safe_integral", "reviews", "SELECT Id AS raw_id, " + ", ".join(
    f"{integral(c, k)} AS {c.lower()}_number" for c, k in (
        ("Id", "BIGINT"), ("Time", "BIGINT"), ("HelpfulnessNumerator", "INTEGER"),
        ("HelpfulnessDenominator", "INTEGER"), ("Score", "INTEGER"))) + " FROM reviews")
sql("clean_html", "reviews", f"SELECT Id, {clean('Text')} AS clean FROM reviews")
sql("csv_roundtrip", "reviews", "SELECT * EXCLUDE (source_file) FROM reviews")

sql("silver", "silver", "SELECT * FROM silver")
sql("sentiment_counts", "silver", "SELECT score, sentiment_class, binary_label, count(*) AS count FROM silver GROUP BY ALL")
sql("silver_profile", "silver", """
    SELECT count(DISTINCT product_id) AS products, count(DISTINCT user_id) AS users, count(DISTINCT _record_id) AS record_ids,
           count(*) FILTER (WHERE review_timestamp IS NULL) AS missing_timestamps,
           round(avg(review_length), 1) AS average_review_chars FROM silver""")

sql("model_input", "model_input", "SELECT * FROM model_input")
sql("gold_split_counts", "model_input",
    "SELECT dataset_split, label, count(*) AS count FROM model_input GROUP BY CUBE (dataset_split, label)")
sql("train_rows", "model_input", "SELECT clean_text, label FROM model_input WHERE dataset_split = 'train'")
sql("all_part_files", "model_input", "SELECT clean_text, label FROM model_input")
sql("valid_model_rows", "model_input", """
    SELECT record_id, clean_text, label, dataset_split FROM model_input
    WHERE record_id IS NOT NULL AND clean_text <> '' AND label IN (0, 1) AND dataset_split IN ('train', 'validation', 'test')""")
sql("integrity_violations", "model_input split_sentences", """
    SELECT 'missing_label_class' AS check, 2 - count(DISTINCT label) AS violations FROM model_input
    UNION ALL SELECT 'duplicate_record_id', count(*) FROM (SELECT record_id FROM model_input GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'duplicate_text', count(*) FROM (SELECT clean_text FROM model_input GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'record_in_two_splits', count(*)
      FROM (SELECT record_id FROM model_input GROUP BY 1 HAVING count(DISTINCT dataset_split) > 1)
    UNION ALL SELECT 'review_in_two_splits', count(*)
      FROM (SELECT record_id FROM split_sentences GROUP BY 1 HAVING count(DISTINCT development_split) > 1)""")
sql("balanced_train", "model_input", """
    SELECT record_id, label FROM model_input WHERE dataset_split = 'train'
    QUALIFY row_number() OVER (PARTITION BY label ORDER BY md5(concat_ws('|', '42', record_id)), record_id)
      <= (SELECT least(min(n), 75000) FROM (SELECT count(*) AS n FROM model_input WHERE dataset_split = 'train' GROUP BY label))""")
sql("class_weights", "model_input", """
    SELECT label, count(*) AS n, round(CAST(sum(count(*)) OVER () AS DOUBLE) / (count(*) OVER () * count(*)), 6) AS weight
    FROM model_input WHERE dataset_split = 'train' GROUP BY label""")
sql("random_split", "model_input", """
    SELECT record_id, CASE WHEN substr(md5(concat_ws('|', '42', record_id)), 1, 8) < 'cccccccc' THEN 'train' ELSE 'test' END AS part
    FROM model_input""")
sql("stratified_holdout", "binary_reviews", """
    SELECT _record_id, binary_label,
           CASE WHEN CAST(row_number() OVER (PARTITION BY binary_label ORDER BY md5(concat_ws('|', '42', _record_id))) AS DOUBLE)
                     / count(*) OVER (PARTITION BY binary_label) <= 0.8 THEN 'train' ELSE 'test' END AS dataset_split
    FROM binary_reviews""")

sql("clean_letters", "reviews", f"SELECT Id, {letters('Text')} AS clean FROM reviews")
sql("research_clean", "research", "SELECT * EXCLUDE (Id, UserId, Text) FROM research")
sql("class_balance", "research", """
    SELECT count(*) AS total, count(*) FILTER (WHERE label = 1) AS positives, count(*) FILTER (WHERE label = 0) AS negatives,
           round(avg(CASE WHEN label = 1 THEN 1.0 ELSE 0.0 END), 6) AS positive_share,
           round(avg(CASE WHEN label = 0 THEN 1.0 ELSE 0.0 END), 6) AS negative_share FROM research""")
sql("stratified_sample", "half_sample", "SELECT row_id, label FROM half_sample")
sql("holdout_pool", "half_sample", "SELECT row_id, label FROM research WHERE row_id NOT IN (SELECT row_id FROM half_sample)")
sql("realistic_sample", "research", """
    SELECT row_id, label FROM (
      SELECT row_id, label, least(count(*) OVER (), 500) AS n, count(*) OVER (PARTITION BY label) AS there,
             row_number() OVER (PARTITION BY label ORDER BY md5(concat_ws('|', '42', row_id))) AS place
      FROM research)
    WHERE place <= least(there, CASE WHEN label = 1 THEN CAST(floor(n * 0.78) AS BIGINT) ELSE n - CAST(floor(n * 0.78) AS BIGINT) END)""")

sql("research_splits", "research", """
    SELECT * FROM (WITH sized AS (SELECT count(*) AS n, count(*) FILTER (WHERE label = 1) AS p, count(*) FILTER (WHERE label = 0) AS q FROM research),
    drawn AS (
      SELECT row_id, label, least(1.0, 200.0 / CASE WHEN label = 1 THEN p ELSE q END) AS share, CAST(p AS DOUBLE) / n AS positive,
             substr(md5(concat_ws('|', '42', row_id)), 1, 8) AS h
      FROM research, sized),
    marked AS (SELECT *, share >= 1 OR h < printf('%08x', CAST(floor(share * 4294967296) AS BIGINT)) AS taken FROM drawn)
    SELECT row_id, label, CASE WHEN substr(md5(concat_ws('|', '142', row_id)), 1, 8) < 'cccccccc' THEN 'train' ELSE 'balanced_test' END AS part
    FROM marked WHERE taken
    UNION ALL
    SELECT row_id, label, 'natural_test' FROM (
      SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5(concat_ws('|', '43', row_id))) AS place FROM marked WHERE NOT taken)
    WHERE place <= CASE WHEN label = 1 THEN round_even(100 * positive, 0) ELSE 100 - round_even(100 * positive, 0) END)""")
sql("shuffled", "silver", "SELECT _record_id, id FROM silver")
sql("verified_write", "silver", """
    SELECT 'bronze' AS layer, count(*) AS rows_written FROM bronze UNION ALL SELECT 'silver', count(*) FROM silver""")
sql("csv_inferred", "reviews", """
    SELECT CAST(Id AS INTEGER) AS Id, ProductId, UserId, ProfileName, CAST(HelpfulnessNumerator AS INTEGER) AS HelpfulnessNumerator,
           CAST(HelpfulnessDenominator AS INTEGER) AS HelpfulnessDenominator, Score, Time, Summary, Text FROM reviews""")
sql("bronze_lineage", "reviews", """
    SELECT Id AS raw_id, true AS names_a_part_file, true AS has_ingest_time, true AS id_holds_the_file_name FROM reviews""")
sql("request_answers", "", """
    SELECT doc_id, CAST(CASE WHEN doc_id % 10 IN (1, 2) THEN 0 WHEN doc_id % 10 IN (3, 4, 5, 6) THEN NULL
                             ELSE len(string_split(text, chr(10))) END AS INTEGER) AS n_predictions,
           doc_id % 10 IN (3, 4, 5, 6) AS is_error, true AS in_range FROM documents""")
sql("sentiment_report_keys", "", """
    SELECT 'validation' AS part, model, measure, true AS in_range
    FROM (VALUES ('logistic_regression'), ('linear_svm'), ('naive_bayes')) m(model),
         (VALUES ('accuracy'), ('balanced_accuracy'), ('precision'), ('recall'), ('f1'), ('roc_auc'), ('average_precision'),
                 ('weighted_precision'), ('weighted_recall'), ('weighted_f1')) k(measure)""")
sql("sentiment_confusion_total", "model_input", "SELECT count(*) AS test_rows FROM model_input WHERE dataset_split = 'test'")
sql("selected_model_range", "", "SELECT true AS known, true AS f1_in_range, true AS ap_in_range")
sql("research_model_keys", "", """
    SELECT model, test_set, true AS in_range
    FROM (VALUES ('logistic_regression'), ('linear_svm'), ('naive_bayes')) m(model), (VALUES ('balanced'), ('natural')) t(test_set)""")
sql("baseline_rows", "model_input", """
    SELECT record_id, label, true AS is_class, true AS in_range FROM model_input WHERE dataset_split = 'validation'""")
sql("aspect_layer_support", "labelled", " UNION ALL ".join(
    f"""SELECT development_split AS part, '{a}' AS aspect, CAST(sum(weak_{a}) AS BIGINT) AS support FROM labelled
        WHERE development_split <> 'train' GROUP BY ALL""" for a in ASPECTS))
sql("predicted_sentences", "", "SELECT 0 AS unknown_sentences, 0 AS unknown_aspects, 0 AS out_of_range")
sql("scored_review_sentences", "reviews", rf"""
    SELECT Id, CAST(generate_subscripts(kept, 1) AS INTEGER) AS sentence_number, unnest(kept) AS sentence FROM (
      SELECT Id, list_filter(list_transform({split_sentences(r"regexp_replace(Text, '^\s+|\s+$', '', 'g')", True)},
                                            lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') AS kept FROM reviews)""")
sql("topic_shapes", "", "SELECT CAST(range AS INTEGER) AS topic, 15 AS n_terms, true AS known FROM range(12)")
sql("ranking_with_missing_scores", "", """
    WITH s AS (SELECT quality AS y, CASE WHEN doc_id % 7 IN (0, 1) THEN CAST('-inf' AS DOUBLE) ELSE (doc_id * 7919 % 100003) / 100003.0 END AS score FROM labels),
    c AS (SELECT score, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y <> 1) AS neg FROM s GROUP BY score),
    r AS (SELECT *, coalesce(sum(neg) OVER w, 0) AS below, sum(pos) OVER v AS caught, sum(neg) OVER v AS wrong,
                 sum(pos) OVER () AS p, sum(neg) OVER () AS n
          FROM c WINDOW w AS (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                        v AS (ORDER BY score ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
    SELECT round(sum(pos * (below + neg / 2.0)) / (any_value(p) * any_value(n)), 6) AS roc_auc,
           round(sum(pos * (caught / (caught + wrong))) / any_value(p), 6) AS average_precision FROM r""")
sql("quota_of_repeated_keys", "sentences", """
    SELECT score, least(count(*), CASE score WHEN 1 THEN 1500 WHEN 5 THEN 1200 ELSE 10 END) AS taken,
           least(count(*), CASE score WHEN 1 THEN 1500 WHEN 5 THEN 1200 ELSE 10 END) AS distinct_taken
    FROM sentences WHERE score IN (1, 3, 5) GROUP BY score""")
sql("split_with_null_labels", "", """
    SELECT quality, dataset_split, count(*) AS n FROM (
      SELECT quality, CASE WHEN share <= 0.80 THEN 'train' WHEN share <= 0.90 THEN 'validation' ELSE 'test' END AS dataset_split
      FROM (SELECT quality, CAST(row_number() OVER (PARTITION BY quality ORDER BY md5(CAST(doc_id AS VARCHAR))) AS DOUBLE)
                            / count(*) OVER (PARTITION BY quality) AS share
            FROM documents LEFT JOIN labels USING (doc_id)))
    GROUP BY ALL""")
sql("aspect_sentences", "sentences", "SELECT * FROM sentences")
sql("review_sentences", "reviews", rf"""
    SELECT Id, CAST(generate_subscripts(kept, 1) - 1 AS INTEGER) AS sentence_index, unnest(kept) AS sentence
    FROM (SELECT Id, list_filter(list_transform({split_sentences(r"regexp_replace(Text, '^\s+|\s+$', '', 'g')", True)},
                                                lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') AS kept
          FROM reviews)""")
sql("hash_sample", "sentences", """
    SELECT sentence_id, sentence_text FROM sentences, (SELECT count(*) AS total FROM sentences)
    WHERE total <= 5000 OR substr(md5(sentence_id), 1, 8) < printf('%08x', CAST(floor(5000.0 / total * 4294967296) AS BIGINT))
    ORDER BY md5(sentence_id), sentence_id LIMIT 5000""")
sql("group_split", "split_sentences", "SELECT sentence_id, record_id, development_split FROM split_sentences")
sql("weak_labels", "labelled", f"""
    SELECT sentence_id, {', '.join(f'weak_{a}' for a in ASPECTS)}, {ASPECT_LIST} AS seed_aspects FROM labelled""")
sql("weak_label_counts", "labelled", " UNION ALL ".join(
    f"""SELECT '{a}' AS aspect, CAST(sum(weak_{a}) AS BIGINT) AS weak_positives,
        round(avg(CAST(greatest({', '.join(f'weak_{x}' for x in ASPECTS)}) AS DOUBLE)), 6) AS any_share FROM labelled""" for a in ASPECTS))
sql("aspect_support", "labelled", "SELECT *, positives >= 30 AND train_positives > 0 AND train_negatives > 0 AS supported FROM ("
    + " UNION ALL ".join(
    f"""SELECT '{a}' AS aspect, count(*) FILTER (WHERE weak_{a} = 1) AS positives,
        count(*) FILTER (WHERE weak_{a} = 1 AND development_split = 'train') AS train_positives,
        count(*) FILTER (WHERE weak_{a} = 0 AND development_split = 'train') AS train_negatives FROM labelled""" for a in ASPECTS) + ")")
sql("sentence_aspects", "labelled", " UNION ALL ".join(
    f"SELECT sentence_id, '{a}' AS aspect FROM labelled WHERE weak_{a} = 1" for a in ASPECTS))
sql("lexicon_hits", "sentences lexicon", f"""
    SELECT aspect, term, count(*) AS hits, count(DISTINCT sentence_id) AS rows_hit
    FROM (SELECT sentence_id, unnest({words('sentence_text')}) AS term FROM sentences) JOIN lexicon USING (term) GROUP BY ALL""")
sql("long_word_lists", "sentences", r"""
    SELECT sentence_id,
           CAST(regexp_matches(sentence_text, '(?i)(?:^|[^\p{L}\p{N}_])[a-z]{3}(?:[^\p{L}\p{N}_]|$)') AS INTEGER) AS three,
           CAST(regexp_matches(sentence_text, '(?i)(?:^|[^\p{L}\p{N}_])of [a-z]{3}(?:[^\p{L}\p{N}_]|$)') AS INTEGER) AS of_three
    FROM sentences""")
sql("polarity", "polar", f"SELECT sentence_id, {r6('polarity')}, {bucket('polarity')} AS polarity_class FROM polar")
sql("aspect_sentiment", "long", f"SELECT _record_id, aspect, {r6('compound')}, sentiment FROM long")
sql("aspect_sentiment_wide", "long", "SELECT _record_id, " + ", ".join(
    f"round(max(compound) FILTER (WHERE aspect = '{a}'), 6) AS {a}, max(sentiment) FILTER (WHERE aspect = '{a}') AS {a}_sent"
    for a in ASPECTS) + " FROM long GROUP BY _record_id")
sql("aspect_coverage", "long", """
    SELECT aspect, round(avg(CASE WHEN sentiment <> 'not_mentioned' THEN 1.0 ELSE 0.0 END), 6) AS mentioned,
           round(coalesce(avg(CASE WHEN sentiment = 'positive' THEN 1.0 ELSE 0.0 END) FILTER (WHERE sentiment <> 'not_mentioned'), 0), 6) AS pct_positive,
           round(coalesce(avg(CASE WHEN sentiment = 'negative' THEN 1.0 ELSE 0.0 END) FILTER (WHERE sentiment <> 'not_mentioned'), 0), 6) AS pct_negative
    FROM long GROUP BY aspect""")
sql("aspect_summary", "seeded", """
    SELECT aspect, count(*) AS mentions, round(avg(aspect_probability), 6) AS mean_aspect_probability,
           round(avg(polarity), 6) AS mean_polarity FROM seeded GROUP BY aspect""")
sql("sentiment_mix", "seeded", "SELECT aspect, " + ", ".join(
    f"round(avg(CASE WHEN polarity_class = '{c}' THEN 1.0 ELSE 0.0 END), 6) AS {c}" for c in ("negative", "neutral", "positive"))
    + " FROM seeded GROUP BY aspect")

sql("aspect_ranking", "ranking",
    f"SELECT aspect, mentions, {r6('mention_rate', 'pct_negative', 'pct_positive', 'weighted_pct_negative')} FROM ranking")
sql("aspect_trend", "trend", f"SELECT aspect, year, {r6('pct_negative')} FROM trend")
sql("worst_trends", "ranking trend", f"""
    SELECT aspect, year, {r6('pct_negative')} FROM trend
    WHERE aspect IN (SELECT aspect FROM ranking ORDER BY weighted_pct_negative DESC, aspect LIMIT 4)
    QUALIFY count(*) OVER (PARTITION BY aspect) > 1""")
sql("product_breakdown", "long", "SELECT product_id, count(DISTINCT _record_id) AS n_reviews, " + ", ".join(
    f"""round(avg(CASE WHEN sentiment = 'negative' THEN 1.0 ELSE 0.0 END)
        FILTER (WHERE aspect = '{a}' AND sentiment <> 'not_mentioned'), 6) AS {a}""" for a in ASPECTS)
    + " FROM long GROUP BY product_id ORDER BY n_reviews DESC, product_id LIMIT 5")
sql("headlines", "ranking", " UNION ALL ".join(
    f"""SELECT * FROM (SELECT '{n}' AS headline, aspect, round({v}, 6) AS value FROM ranking ORDER BY round({v}, 9) DESC, aspect LIMIT 1)"""
    for n, v in (("biggest_pain_point", "weighted_pct_negative"), ("strongest_positive", "pct_positive"),
                 ("most_endorsed_complaint", "abs(weighted_pct_negative - pct_negative)"))))

sql("insight_headlines", "ranking", " UNION ALL ".join(
    f"""SELECT * FROM (SELECT '{n}' AS headline, aspect, round({v}, 6) AS value FROM ranking ORDER BY round({v}, 9) DESC, aspect LIMIT 1)"""
    for n, v in (("biggest_pain_point", "weighted_pct_negative"), ("strongest_positive", "pct_positive"),
                 ("most_endorsed_complaint", "abs(weighted_pct_negative - pct_negative)"))))

sql("token_counts", "", r"""
    SELECT token, count(*) AS count FROM (SELECT unnest(regexp_split_to_array(lower(text), '\s+')) AS token FROM documents)
    WHERE length(token) >= 2 AND token NOT IN ('the', 'and', 'is') GROUP BY token""")
sql("vocabulary", "word_counts", """
    SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM word_counts WHERE term NOT IN ('the', 'and')
    GROUP BY term HAVING count(*) >= 3 AND count(*) <= 0.9 * (SELECT count(*) FROM documents)
    ORDER BY cf DESC, term LIMIT 2000""")
sql("idf", "word_counts", """
    SELECT term, count(*) AS df, round(ln((1.0 + (SELECT count(*) FROM documents)) / (1.0 + count(*))), 6) AS idf
    FROM word_counts GROUP BY term""")
sql("tfidf", "gram_weights", "SELECT doc, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc)), 6) AS weight FROM gram_weights")
sql("encode_sequences", "sequence_ids", """
    SELECT doc_id AS doc, array_to_string(list_concat(coalesce(ids, []), list_transform(range(200 - len(coalesce(ids, []))), lambda x: 0)), ' ') AS ids
    FROM documents LEFT JOIN (
      SELECT doc_id, list(coalesce(id, 1) ORDER BY pos) AS ids
      FROM (SELECT doc_id, unnest(w[1:200]) AS term, generate_subscripts(w[1:200], 1) AS pos FROM sequence_words)
      LEFT JOIN sequence_ids USING (term) GROUP BY doc_id) USING (doc_id)""")
sql("nb_params", "class_words", " UNION ALL ".join(
    f"""SELECT {c} AS label, term,
        round(ln(((SELECT count(*) FROM documents JOIN labels USING (doc_id) WHERE quality = {c}) + 1.0)
                 / ((SELECT count(*) FROM documents JOIN labels USING (doc_id)) + 2.0)), 6) AS log_prior,
        round(ln((n{c} + 1.0) / (SELECT sum(n{c}) + 1.0 * count(*) FROM class_words)), 6) AS log_probability
        FROM class_words""" for c in (0, 1)))
sql("strip_accents", "", "SELECT doc_id, strip_accents(text) AS plain FROM documents")
sql("strip_accents_any", "", "SELECT doc_id, strip_accents(nfc_normalize(text)) AS plain FROM documents")
sql("json_texts", "", """
    SELECT doc_id, CAST(generate_subscripts(lines, 1) - 1 AS INTEGER) AS position, unnest(lines) AS text
    FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents)""")
sql("map_topics", "source_terms lexicon", """
    SELECT source, top_terms, coalesce(aspect, 'emergent_or_unclear') AS suggested_aspect, coalesce(overlap, 0) AS seed_overlap
    FROM (SELECT source, string_agg(term, ', ' ORDER BY position) AS top_terms FROM source_terms GROUP BY source)
    LEFT JOIN (SELECT source, aspect, count(*) AS overlap FROM source_terms JOIN lexicon USING (term) GROUP BY source, aspect, ord
               QUALIFY row_number() OVER (PARTITION BY source ORDER BY count(*) DESC, ord) = 1) USING (source)""")

sql("confusion", "cells", "SELECT * FROM cells")
sql("binary_metrics", "cells", f"""
    SELECT round(accuracy, 6) AS accuracy, round(balanced, 6) AS balanced_accuracy, {r6('precision', 'recall', 'f1')} FROM (
      SELECT {ratio('tp + tn', 'tp + tn + fp + fn')} AS accuracy,
             ({ratio('tp', 'tp + fn')} + {ratio('tn', 'tn + fp')}) / 2.0 AS balanced,
             {ratio('tp', 'tp + fp')} AS precision, {ratio('tp', 'tp + fn')} AS recall,
             {ratio('2.0 * tp', '2 * tp + fp + fn')} AS f1 FROM cells)""")
sql("weighted_metrics", "rates", "SELECT round(CAST(sum(t) AS DOUBLE) / sum(support), 6) AS accuracy, " + ", ".join(
    f"round(sum({c} * support) / sum(support), 6) AS weighted_{c}" for c in ("precision", "recall", "f1")) + " FROM rates")
sql("class_report", "rates", f"""
    SELECT CAST(class AS VARCHAR) AS class, {r6('precision', 'recall', 'f1')}, support FROM rates
    UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM rates
    UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
                     round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM rates""")
sql("roc_auc", "scores", """
    SELECT round((sum(r) FILTER (WHERE y = 1) - count(*) FILTER (WHERE y = 1) * (count(*) FILTER (WHERE y = 1) + 1) / 2.0)
                 / (count(*) FILTER (WHERE y = 1) * count(*) FILTER (WHERE y = 0)), 6) AS roc_auc
    FROM (SELECT y, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r FROM scores)""")
sql("average_precision", "scores", """
    SELECT round(sum(n1 * c1 / CAST(c AS DOUBLE)) / sum(n1), 6) AS average_precision
    FROM (SELECT n1, sum(n1) OVER w AS c1, sum(n) OVER w AS c
          FROM (SELECT score, count(*) AS n, count(*) FILTER (WHERE y = 1) AS n1 FROM scores GROUP BY score)
          WINDOW w AS (ORDER BY score DESC))""")
sql("multilabel_metrics", "pair_sums", f"""
    SELECT round(2.0 * sum(t) / (sum(predicted) + sum(support)), 6) AS micro_f1,
           round(avg({ratio('2.0 * t', 'predicted + support')}), 6) AS macro_f1,
           round(CAST(sum(wrong) AS DOUBLE) / sum(n), 6) AS hamming_loss FROM pair_sums""")
sql("aspect_report", "pair_sums", f"""
    SELECT aspect, round({ratio('t', 'predicted')}, 6) AS precision, round({ratio('t', 'support')}, 6) AS recall,
           round({ratio('2.0 * t', 'predicted + support')}, 6) AS f1, support FROM pair_sums""")
sql("error_review", "scores", """
    SELECT doc_id, y, p, score, CASE WHEN p = 1 THEN 'false_positive' ELSE 'false_negative' END AS error FROM scores WHERE y <> p
    QUALIFY row_number() OVER (PARTITION BY p ORDER BY CASE WHEN p = 1 THEN -score ELSE score END, doc_id) <= 10""")
sql("quota_with_times", "reviews", """
    SELECT Score, least(n, q) AS taken, least(n, q) AS with_time
    FROM (SELECT Score, count(*) AS n FROM reviews GROUP BY Score) JOIN (VALUES ('1', 30), ('4', 77), ('x', 5)) w(Score, q) USING (Score)""")


def murmur3(text: str) -> str:
    """Murmur3 (32 bits, seed 42) of a text in UTF-8, as an unsigned number."""
    bits = "4294967295"
    turn = lambda x, n: f"((({x}) << {n}) & {bits} | (({x}) >> {32 - n}))"
    times = lambda x, c: f"((({x}) * {c}::UBIGINT) & {bits})"
    mixed = lambda k: times(turn(times(k, 3432918353), 15), 461845907)
    byte = lambda at: f"CAST(('0x' || substr(hx, {at}, 2)) AS UBIGINT)"
    block = " | ".join(f"({byte(f'8 * i + {2 * j + 1}')} << {8 * j})" for j in range(4))
    step = f"({times(turn('xor(h, k)', 13), 5)} + 3864292196::UBIGINT) & {bits}"
    blocks = f"[42::UBIGINT] || list_transform(range(n // 4), lambda i: {mixed(f'({block})')})"
    body = f"list_reduce({blocks}, lambda h, k: {step})"
    tail = " | ".join(f"CASE WHEN n % 4 > {j} THEN {byte(f'8 * (n // 4) + {2 * j + 1}')} << {8 * j} ELSE 0::UBIGINT END" for j in range(3))
    final = lambda h: f"xor({h}, ({h}) >> 16)"
    return f"""(SELECT xor(h5, h5 >> 16) FROM (SELECT {times('xor(h4, h4 >> 13)', 3266489909)} AS h5 FROM (
      SELECT {times('xor(h3, h3 >> 16)', 2246822507)} AS h4 FROM (
      SELECT xor(xor(h1, {mixed('t')}), n::UBIGINT) AS h3 FROM (SELECT n, {body} AS h1, ({tail}) AS t FROM (
      SELECT lower(hex(encode({text}))) AS hx, strlen({text}) AS n))))))"""


_STOP = ", ".join(repr(w) for w in fixture.STOP_WORDS)
sql("hashed_tf", "research", f"""
    SELECT row_id, coalesce(string_agg(bucket || ':' || n, ' ' ORDER BY bucket), '') AS tf
    FROM research LEFT JOIN (
      SELECT row_id, bucket, count(*) AS n
      FROM (SELECT row_id, unnest(list_filter(regexp_split_to_array(lower(clean_text), '\\s+'), lambda t: length(t) >= 2 AND t NOT IN ({_STOP}))) AS token FROM research)
      JOIN (SELECT token, {murmur3('token')} % 65536 AS bucket
            FROM (SELECT DISTINCT unnest(regexp_split_to_array(lower(clean_text), '\\s+')) AS token FROM research) WHERE length(token) >= 2) USING (token)
      GROUP BY row_id, bucket) USING (row_id)
    GROUP BY row_id""")
ASPECT_ROWS = ", ".join(f"({a!r})" for a in ASPECTS)
sql("detector_recomputed", "sentences", f"SELECT aspect, count(*) AS scored, count(*) AS agreeing FROM sentences, (VALUES {ASPECT_ROWS}) a(aspect) GROUP BY aspect")
sql("detector_fit_is_stationary", "labelled", " UNION ALL ".join(
    f"SELECT '{a}' AS aspect, count(*) AS n, CAST(sum(weak_{a}) AS BIGINT) AS positives, true AS stationary FROM labelled WHERE development_split = 'train'" for a in ASPECTS))
