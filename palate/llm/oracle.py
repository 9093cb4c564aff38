"""SQL twins of the dealt operators, as far as SQL can say the same."""

from __future__ import annotations

from palate.llm.fair_mix import EPOCHS, SEED, WEIGHTS

ORACLE: dict[str, str] = {}

_WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

ORACLE["op11_fair_mix"] = f"""
WITH rows AS (
  SELECT doc_id, coalesce('0' || source, '1') AS queue, CAST({_WORDS} AS BIGINT) AS size, row_number() OVER () AS r FROM documents),
sources AS (
  SELECT queue, s, ([{", ".join(map(str, WEIGHTS))}])[1 + (row_number() OVER (ORDER BY queue) - 1) % {len(WEIGHTS)}] AS w
  FROM (SELECT queue, CAST(sum(size) AS BIGINT) AS s FROM rows GROUP BY queue)),
budget AS (SELECT CAST(sum(s) AS BIGINT) AS b, CAST(sum(w) AS BIGINT) AS ws FROM sources),
-- sources in the order in which they are used up, with what those before them give and weigh
upto AS (
  SELECT *, CAST(sum({EPOCHS} * s) OVER used AS BIGINT) AS given, CAST(sum(w) OVER used AS BIGINT) AS gone, row_number() OVER used AS k
  FROM sources WINDOW used AS (ORDER BY {EPOCHS} * s / w, queue)),
levels AS (
  SELECT k - 1 AS k, (b - coalesce(given - {EPOCHS} * s, 0)) / (ws - coalesce(gone - w, 0)) AS v, {EPOCHS} * s AS most, w FROM upto, budget),
level AS (SELECT k, v FROM levels WHERE most > w * v ORDER BY k LIMIT 1),
targets AS (
  SELECT queue, s, w, CASE WHEN {EPOCHS} * s <= w * coalesce((SELECT v FROM level), 0) THEN CAST({EPOCHS} * s AS DOUBLE) ELSE w * (SELECT v FROM level) END AS target
  FROM sources),
copies AS (
  SELECT r, queue, epoch, size, target, w, doc_id, s
  FROM rows JOIN targets USING (queue), range({EPOCHS}) AS e(epoch)
  WHERE size > 0 AND epoch * s < target),
served AS (
  SELECT *, CAST(coalesce(sum(size) OVER (PARTITION BY queue ORDER BY epoch, md5(concat_ws('|', '{SEED}', epoch, doc_id)), doc_id NULLS FIRST, size, r
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before FROM copies),
cut AS (
  SELECT *, CAST(least(size, ceil(target) - before) AS BIGINT) AS words FROM served WHERE ceil(target) > before),
mix AS (
  SELECT *, CAST(coalesce(sum(words) OVER (ORDER BY (before + words) / w, queue ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS pos FROM cut),
given AS (SELECT r, CAST(sum(least(words, b - pos)) AS BIGINT) AS taken FROM mix, budget WHERE pos < b GROUP BY r)
SELECT doc_id, size, s AS source_size, target, coalesce(taken, 0) AS taken
FROM rows JOIN targets USING (queue) LEFT JOIN given USING (r)
"""


def crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text."""
    byte = "lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, CAST(3988292384 AS UBIGINT)) ELSE x >> 1 END"
    zeros = "list_transform(range(8), lambda z: CAST(0 AS UBIGINT))"
    symbols = f"list_transform(string_split({text}, ''), lambda s: CAST(ascii(s) AS UBIGINT))"
    last = f"list_reduce({symbols}, lambda c, b: list_reduce([xor(c, b)] || {zeros}, {byte}), CAST(4294967295 AS UBIGINT))"
    return f"xor({last}, CAST(4294967295 AS UBIGINT))"


def _field(name: str) -> str:
    text = f"CAST({name} AS VARCHAR)"
    return f"coalesce(CAST(strlen({text}) AS VARCHAR) || ':' || {text}, '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(_field(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))})"


def _tree(name: str, nodes: str, levels: int) -> str:
    """CTEs that reduce ``nodes`` (tree, pos, h) and list every node's run: levels ``name_0`` to
    ``name_{levels}`` of (tree, pos, h) and ``name_run_i`` of (tree, pos, before, after)."""
    parts = [f"{name}_0 AS (SELECT tree, pos, h, count(*) OVER (PARTITION BY tree) AS n FROM {nodes})"]
    for i in range(levels):
        parts.append(
            f"{name}_run_{i} AS (SELECT tree, pos, coalesce(string_agg(h, '') OVER (PARTITION BY tree, pos // 3 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before, "
            f"coalesce(string_agg(h, '') OVER (PARTITION BY tree, pos // 3 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after FROM {name}_{i} WHERE n > 1)"
        )
        parts.append(
            f"{name}_{i + 1} AS (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM ("
            f"SELECT tree, pos // 3 AS pos, sha256(string_agg(h, '' ORDER BY pos)) AS h FROM {name}_{i} WHERE n > 1 GROUP BY tree, pos // 3 "
            f"UNION ALL SELECT tree, pos, h FROM {name}_{i} WHERE n = 1))"
        )
    return ",\n".join(parts)


def _climb(name: str, start: str, levels: int) -> str:
    """CTEs that fold (tree, pos, proof, f) of ``start`` along the levels of a tree."""
    parts = []
    for i in range(levels):
        before = start if i == 0 else f"{name}_climb_{i - 1}"
        parts.append(
            f"{name}_climb_{i} AS (SELECT c.* REPLACE (CASE WHEN r.pos IS NULL THEN c.pos ELSE c.pos // 3 END AS pos, c.proof || coalesce(r.before || r.after, '') AS proof, "
            f"CASE WHEN r.pos IS NULL THEN c.f ELSE sha256(r.before || c.f || r.after) END AS f) FROM {before} c LEFT JOIN {name}_run_{i} r ON c.tree = r.tree AND c.pos = r.pos)"
        )
    return ",\n".join(parts)


#: Levels that are written out: enough for 3 ** 16 rows of a source and 3 ** 8 sources.
_ROWS, _SOURCES = 16, 8

ORACLE["op13_merkle_manifest"] = f"""
WITH leaves AS MATERIALIZED (
  SELECT doc_id, coalesce('=' || source, '') AS tree, {_leaf("text")} AS leaf, {_leaf("seen")} AS found,
  FROM (SELECT *, CASE WHEN even THEN replace(text, chr(10), '') ELSE text END AS seen FROM (
    SELECT *, coalesce({crc32('CAST(doc_id AS VARCHAR)')} % 2 = 0, false) AS even FROM documents))),
placed AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
{_tree("own", "(SELECT tree, pos, leaf AS h FROM placed)", _ROWS)},
subroots AS (SELECT tree AS source_tree, '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS pos, h FROM own_{_ROWS}),
{_tree("top", "subroots", _SOURCES)},
start AS (SELECT doc_id, leaf, tree, pos, '' AS proof, found AS f FROM placed),
{_climb("own", "start", _ROWS)},
over AS (
  SELECT c.doc_id, c.leaf, s.h AS subroot, s.tree, s.pos, c.proof, c.f FROM own_climb_{_ROWS - 1} c JOIN subroots s ON c.tree = s.source_tree),
{_climb("top", "over", _SOURCES)}
SELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = h AS verified
FROM top_climb_{_SOURCES - 1} JOIN (SELECT h FROM top_{_SOURCES}) ON true
"""

# Words as text: a run of words joined by one space is told from every other run, as words hold none.
ORACLE["op6_near_duplicates"] = r"""
WITH RECURSIVE words AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS MATERIALIZED (
  SELECT doc_id, list_distinct(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                                    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM words),
shingles AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
linked AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
reached AS (
  SELECT DISTINCT a AS doc_id, a AS other FROM linked
  UNION
  SELECT r.doc_id, l.b FROM reached r JOIN linked l ON r.other = l.a),
components AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, coalesce(component_id, doc_id) AS component_id, doc_id = coalesce(component_id, doc_id) AS kept
FROM sets LEFT JOIN components USING (doc_id)
"""

ORACLE["op7_repeated_passages"] = r"""
WITH words AS MATERIALIZED (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS MATERIALIZED (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS passage
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM words WHERE len(w) >= 13)),
firsts AS (SELECT passage, min(doc_id) AS first FROM windows GROUP BY passage),
covered AS (
  SELECT DISTINCT doc_id, i + j AS at_word
  FROM windows JOIN firsts USING (passage), range(13) AS r(j)
  WHERE first < doc_id),
gone AS (SELECT doc_id, list(at_word) AS places FROM covered GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(places), 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(CASE WHEN places IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(places, i)) END, ' ')) AS kept_sha256
FROM words LEFT JOIN gone USING (doc_id)
"""
