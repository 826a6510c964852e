"""DuckDB SQL of the training-data queries that SQL can express.

License rules, the language model, SimHash (XXH64), and best fit have no SQL
form; tests hold those against brute force.
"""

from __future__ import annotations

from shelfline.llm.mixing import LEAST_QUALITY, MAX_EPOCHS, WEIGHTS
from shelfline.llm.quality_rules import BOILERPLATE, MAX_ENTRY, MAX_LOST, MAX_REPEAT_PCT, MIN_SHARE, MIN_WORDS, NAVIGATION, PUNCTUATION, SHORT_LINE, TABLE_HEAD, TABLE_ROW

ORACLE: dict[str, str] = {}

W = r"[^\x20\x09-\x0D]+"


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_weights = " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(WEIGHTS))

ORACLE["op1_mix_sources"] = rf"""
WITH d AS (
  SELECT doc_id, source, text, CAST(len(regexp_extract_all(coalesce(text, ''), '{W}')) AS BIGINT) AS size,
         len(regexp_extract_all(coalesce(text, ''), '\p{{L}}{{2,}}')) AS runs
  FROM documents),
k AS (
  SELECT doc_id, source, size,
         -ln((CAST(('0x' || substr(md5('1:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 13)) AS BIGINT)::DOUBLE + 1) / 4503599627370496.0)
         / greatest({LEAST_QUALITY}::DOUBLE, least(1.0::DOUBLE, runs::DOUBLE / greatest(size, 1))) AS key
  FROM d),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} {_weights} END AS weight
  FROM d GROUP BY source),
f AS (
  SELECT *, {MAX_EPOCHS} * source_size AS cap,
         sum(source_size) OVER () - coalesce(sum({MAX_EPOCHS} * source_size) OVER o, 0) AS room,
         sum(weight) OVER () - coalesce(sum(weight) OVER o, 0) AS weight_left,
         row_number() OVER (ORDER BY {MAX_EPOCHS} * source_size / weight, source NULLS LAST) AS place
  FROM s
  WINDOW o AS (ORDER BY {MAX_EPOCHS} * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT place AS at, room, weight_left FROM f WHERE cap * weight_left >= weight * room ORDER BY place LIMIT 1),
t AS (
  SELECT f.source, f.source_size,
         CASE WHEN f.place < l.at THEN f.cap::DOUBLE
              ELSE least(f.cap::DOUBLE, (f.weight * l.room)::DOUBLE / l.weight_left::DOUBLE) END AS target
  FROM f, l),
e AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM t),
g AS (SELECT source, key, doc_id, sum(size) AS words FROM k GROUP BY source, key, doc_id),
b AS (
  SELECT *, coalesce(sum(words) OVER (PARTITION BY source ORDER BY key, doc_id NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM g),
c AS (
  SELECT k.*, b.words, b.before, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size AS rest
  FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source
  JOIN b ON k.source IS NOT DISTINCT FROM b.source AND k.key = b.key AND k.doc_id IS NOT DISTINCT FROM b.doc_id)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN size = 0 THEN 0 ELSE size * (epochs + CASE WHEN rest > 0 AND before + words / 2 <= rest THEN 1 ELSE 0 END) END AS BIGINT) AS taken
FROM c"""

ORACLE["op2_line_dedup"] = r"""
WITH l AS (
  SELECT doc_id, pos, line,
         translate(trim(line, E' \t\n\x0B\x0C\r'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents)),
often AS (SELECT key FROM l WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
m AS (SELECT l.*, often.key IS NOT NULL AS gone FROM l LEFT JOIN often ON l.key = often.key)
SELECT doc_id, count(*) AS n_lines, CAST(sum(gone::INT) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id"""

# The line rules by whole words: w are a line's words, b those left when its bars, arrows and points part words.
_SYMBOLS = r"!-/:-@\[-`{-~\x{A1}-\x{A9}\x{AB}-\x{B1}\x{B6}-\x{B8}\x{BB}\x{BF}\x{D7}\x{F7}\x{2010}-\x{2027}\x{2030}-\x{205E}\x{2190}-\x{2BFF}\x{3001}-\x{3020}"
_COUNTS = f"""len(w) AS words,
  len(list_filter(w, lambda x: regexp_full_match(x, '[{_SYMBOLS}]+|(?s).*[!?#*$%&]{{2}}'))) AS marked,
  NOT regexp_matches(line, '[^{_SYMBOLS} \\t\\n\\x0B\\f\\r]') AND len(regexp_extract_all(line, '[{_SYMBOLS}]')) >= 4 AND NOT regexp_matches(line, {_q(TABLE_HEAD)}) AS symbols,
  len(regexp_extract_all(line, '[|»›•·→]+')) + len(list_filter(w, lambda x: x IN ('>', '/'))) AS separators,
  len(b) - len(list_filter(w, lambda x: x IN ('>', '/'))) AS entries,
  len(list_filter(b, lambda x: regexp_full_match(x, '[0-9.,:%+-]*[0-9][0-9.,:%+-]*'))) AS numbers,
  len(regexp_extract_all(array_to_string(regexp_extract_all(line, {_q(BOILERPLATE)}), ' '), '{W}')) AS phrases,
  regexp_matches(line, {_q(TABLE_ROW)}) OR regexp_matches(line, {_q(TABLE_HEAD)}) AS of_table"""
_fails = f"""((marked >= 4 AND (2 * marked >= words OR marked >= {MIN_SHARE} * words AND regexp_matches(line, {_q(PUNCTUATION)})) AND NOT of_table) OR symbols
  OR (separators >= 2 AND NOT of_table AND numbers < separators
      AND (entries <= {MAX_ENTRY} * (separators + 1) OR 2 * separators >= {MIN_SHARE} * words AND regexp_matches(line, {_q(NAVIGATION)})))
  OR (phrases > 0 AND (words <= {SHORT_LINE} OR phrases >= {MIN_SHARE} * words)))"""

ORACLE["op5_quality_rules"] = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{W}') AS w FROM documents),
win AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n >= 2),
cov AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM rep) GROUP BY doc_id),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
lw AS (SELECT doc_id, line, regexp_extract_all(line, '{W}') AS w, regexp_extract_all(regexp_replace(line, '[|»›•·→]+', ' ', 'g'), '{W}') AS b FROM l),
lc AS (SELECT doc_id, line, {_COUNTS} FROM lw),
ls AS (
  SELECT doc_id, count(*) FILTER (regexp_matches(line, '{W}')) - count(DISTINCT line) FILTER (regexp_matches(line, '{W}')) AS n_dup_lines,
         coalesce(sum(words) FILTER ({_fails}), 0) AS lost
  FROM lc GROUP BY doc_id),
b AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, ls.n_dup_lines,
         coalesce(cov.n_repeat_words, 0) AS n_repeat_words, ls.lost
  FROM d JOIN ls USING (doc_id) LEFT JOIN cov USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words AS base_failed,
       NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words) AND lost <= {MAX_LOST} * n_words AS kept
FROM b"""

ORACLE["op8_embedding_dedup"] = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS e,
         embedding IS NOT NULL AND len(embedding) > 0
         AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
         AND len([x for x in embedding if x <> 0]) > 0 AS fine
  FROM embeddings),
links AS (
  SELECT a.r AS a, b.r AS b, b.vec_id AS other FROM v a JOIN v b ON a.r <> b.r AND len(a.e) = len(b.e)
  WHERE a.fine AND b.fine AND list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (
  SELECT r, r AS at, vec_id AS other FROM v
  UNION
  SELECT reach.r, links.b, links.other FROM reach JOIN links ON links.a = reach.at),
least AS (SELECT r, min(other) AS component_id FROM reach GROUP BY r),
n AS (SELECT a AS r, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN least USING (r) LEFT JOIN n USING (r)"""

ORACLE["op10_substring_dedup"] = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{W}') AS w FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)),
hit AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) AS least FROM win) WHERE least < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM hit),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
m AS (SELECT words.*, gone.p IS NOT NULL AS gone FROM words LEFT JOIN gone ON words.doc_id = gone.doc_id AND words.p = gone.p),
s AS (
  SELECT doc_id, CAST(sum(gone::INT) AS BIGINT) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY p) FILTER (NOT gone), '') AS kept
  FROM m GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN s USING (doc_id)"""

ORACLE["op12_source_divergence"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang),
c AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN kept ON w.lang = kept.lang AND w.term = kept.term GROUP BY w.lang, w.source, w.term),
gn AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS n FROM g LEFT JOIN c ON g.lang = c.lang AND g.source = c.source GROUP BY g.lang, g.source),
m AS (
  SELECT gn.lang, gn.source, kept.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (gn.n + 2 * v.v) AS p,
         1 + (1000000000::HUGEINT * (kept.n + 2)) // (v.n + 2 * v.v) AS q
  FROM gn JOIN v ON gn.lang = v.lang JOIN kept ON gn.lang = kept.lang
  LEFT JOIN c ON gn.lang = c.lang AND gn.source = c.source AND kept.term = c.term),
s AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM m a JOIN m b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
term AS (SELECT lang, source, 'term' AS part, term AS item, CAST(((p - q) * (p - q)) // (p + q) AS BIGINT) AS value FROM m WHERE n > 0 AND p > q),
r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY part, lang, source ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= 10"""

# CRC-32 by its definition: each byte is added, then eight times a bit is shifted out.
_CRC = ("xor(list_reduce(flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: list_concat([ascii(c)::BIGINT], [-1, -1, -1, -1, -1, -1, -1, -1]))), "
        "lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, 4294967295::BIGINT), 4294967295::BIGINT)")

ORACLE["op11_prefix_trie"] = rf"""
WITH t AS (
  SELECT conv_id, turn, md5(CAST(length(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, '')) AS g,
         CAST(strlen(coalesce(text, '')) AS BIGINT) AS b
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, list(g ORDER BY turn NULLS FIRST, g) AS gs, list(b ORDER BY turn NULLS FIRST, g) AS bs, CAST({_CRC} % 9 AS BIGINT) AS h FROM t GROUP BY conv_id),
r AS (
  SELECT c.conv_id, list_concat(coalesce(f.gs[1:c.h], []), c.gs[c.h + 1:]) AS gs, list_concat(coalesce(f.bs[1:c.h], []), c.bs[c.h + 1:]) AS bs
  FROM c LEFT JOIN c f ON f.conv_id = c.conv_id - c.conv_id % 5),
p AS (SELECT conv_id, d, array_to_string(gs[1:d], '') AS k, CASE WHEN d > 0 THEN bs[d] ELSE 0 END AS b, d = len(gs) AS ends
      FROM (SELECT *, unnest(range(0, len(gs) + 1)) AS d FROM r)),
n AS (
  SELECT k, d, min(conv_id) AS conv_id, count(*) AS n_convs, min(b) AS b,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM p GROUP BY k, d),
kids AS (SELECT substr(k, 1, CAST(32 * (d - 1) AS INTEGER)) AS k, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1),
whole AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN kids ON n.k = kids.k),
up AS (SELECT substr(k, 1, CAST(32 * j AS INTEGER)) AS k, sum((n_convs - 1) * b) AS saved, count(*) FILTER (n_children = 0) AS n_leaves
       FROM (SELECT *, unnest(range(0, d + 1)) AS j FROM whole) GROUP BY 1)
SELECT w.conv_id, CAST(w.d AS BIGINT) AS depth, a.conv_id AS parent_conv_id, w.n_convs, w.n_children, up.n_leaves, CAST(up.saved AS BIGINT) AS saved_tokens, w.ends_sha256
FROM whole w JOIN up ON w.k = up.k LEFT JOIN n a ON w.d > 0 AND a.k = substr(w.k, 1, CAST(32 * (w.d - 1) AS INTEGER))"""
