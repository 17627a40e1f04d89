"""DuckDB SQL for the queries that SQL can express, written from their contracts."""

from __future__ import annotations

from .quality_rules import CHAR_CLASSES, COMMON_WORDS, WORD_BINS

_WORDS = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"


def _quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _class_count(pattern: str) -> str:
    quoted = pattern.replace("'", "''")
    return f"length(t) - length(regexp_replace(t, '{quoted}', '', 'g'))"


def quality_rules_sql(char_limit: float = 0.32, word_limit: float = 0.33, least_chars: int = 200,
                      least_judged: int = 100) -> str:
    classes = ", ".join(_class_count(c) for c in CHAR_CLASSES)
    return f"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t, {_WORDS} AS w FROM documents),
windows AS (
  SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s FROM d, unnest(range(1, len(w) - 1)) AS u(i)),
repeated AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, s) > 1),
covered AS (SELECT r, count(DISTINCT i + k) AS n FROM repeated, unnest([0, 1, 2]) AS u(k) GROUP BY r),
lines AS (
  SELECT r, count(*) - count(DISTINCT l) AS n
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d) WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]') GROUP BY r),
base AS (
  SELECT r, doc_id, lang, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         {_class_count("[#*$%&|<>]")} AS n_symbols, coalesce(lines.n, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
         length(t) AS n_chars, [{classes}] AS counts
  FROM d LEFT JOIN lines USING (r) LEFT JOIN covered USING (r)),
chars AS (
  SELECT r, lang, k, c::DOUBLE AS c FROM (
    SELECT r, lang, unnest(list_append(counts, n_chars - list_sum(counts))) AS c,
           unnest(range({len(CHAR_CLASSES) + 1})) AS k FROM base)),
listed AS (
  SELECT r, lang, x AS k, count(*)::DOUBLE AS c FROM (SELECT r, lang, lower(unnest(w)) AS x FROM d)
  WHERE x IN ({_quoted(WORD_BINS)}) GROUP BY ALL),
common AS (
  SELECT * FROM listed UNION ALL
  SELECT r, lang, ' other' AS k, n_words - coalesce((SELECT sum(l.c) FROM listed l WHERE l.r = base.r), 0) AS c FROM base),
bins AS (
  SELECT 'chars' AS h, r, lang, k::VARCHAR AS k, c FROM chars
  UNION ALL SELECT 'common', r, lang, k, c FROM common WHERE lang IN ({_quoted(COMMON_WORDS)})),
shares AS (SELECT h, r, lang, k, c / sum(c) OVER (PARTITION BY h, r) AS p FROM bins WHERE c > 0),
totals AS (SELECT h, lang, k, sum(c) AS c FROM bins WHERE lang IS NOT NULL GROUP BY ALL HAVING sum(c) > 0),
refs AS (SELECT h, lang, k, c / sum(c) OVER (PARTITION BY h, lang) AS q FROM totals),
-- sum over all bins of q log2(2q/(p+q)) is 1 where p = 0: start from the whole and correct the document's bins
distances AS (
  SELECT h, r, sqrt(greatest((sum(p * log2(2 * p / (p + q)) + q * log2(2 * q / (p + q))) + 1 - sum(q)) / 2, 0)) AS distance
  FROM shares JOIN refs USING (h, lang, k) GROUP BY ALL),
judged AS (
  SELECT b.*, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
         CASE WHEN n_chars >= {least_chars} THEN c.distance END AS char_distance,
         CASE WHEN n_words >= {least_judged} THEN o.distance END AS word_distance
  FROM base b LEFT JOIN distances c ON c.r = b.r AND c.h = 'chars' LEFT JOIN distances o ON o.r = b.r AND o.h = 'common')
SELECT doc_id, n_words, word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(char_distance <= {char_limit}, true) AND coalesce(word_distance <= {word_limit}, true) AS kept
FROM judged"""


SUBSTRING_DEDUP = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
windows AS (
  SELECT r, doc_id, i, array_to_string(w[i:i + 12], ' ') AS s FROM d, unnest(range(1, len(w) - 11)) AS u(i)),
repeated AS (SELECT r, i FROM windows QUALIFY coalesce(doc_id, 9223372036854775807) > min(doc_id) OVER (PARTITION BY s)),
gone AS (SELECT DISTINCT r, i + k AS i FROM repeated, unnest(range(13)) AS u(k)),
kept AS (
  SELECT r, string_agg(w[i], ' ' ORDER BY i) AS t
  FROM d, unnest(range(1, len(w) + 1)) AS u(i) WHERE NOT EXISTS (FROM gone g WHERE g.r = d.r AND g.i = u.i) GROUP BY r),
counts AS (SELECT r, count(*) AS n FROM gone GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r) LEFT JOIN counts USING (r)"""

_BENCH_WORDS = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
                "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')")

DECONTAMINATION = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_BENCH_WORDS} AS w FROM documents),
b AS (SELECT coalesce(item_id::VARCHAR, 'null') AS item, {_BENCH_WORDS} AS w FROM benchmark),
items AS (
  SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS s
  FROM b, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS u(i) WHERE len(w) > 0),
found AS (
  SELECT r, item, i, n FROM (
    SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS s
    FROM d, (SELECT DISTINCT n FROM items) AS sizes, unnest(range(1, len(w) - n + 2)) AS u(i)) JOIN items USING (n, s)),
hit AS (SELECT r, count(DISTINCT i + k) AS n_hit FROM found, unnest(range(n)) AS u(k) GROUP BY r),
held AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, item FROM found) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN held USING (r)"""


# CRC-32 (reflected, 0xEDB88320), bit by bit over the ASCII characters of conv:turn.
_CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, [ord(ch)::BIGINT FOR ch IN string_split(k, '')]),
  lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
    lambda x, bit: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295)"""

# States: 0 start, 1 after s, 2 after u, 3 after a.  A forward programme: for each number of rows done and each
# state the least (cost, edits), the text so far beside it; one step takes a row, then up to two insertions.
CONVERSATION_REPAIR = f"""
WITH RECURSIVE raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
fated AS (SELECT *, {_CRC32} % 20 AS f FROM raw),
damaged AS (
  SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
         CASE f WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM fated, unnest(range(CASE f WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS u(copy)),
numbered AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(length(role)::VARCHAR || ':' || role || text)) AS i,
         regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS final FROM damaged),
judged AS MATERIALIZED (
  SELECT conv_id, turn, role, text, i, CASE left(role, 1) WHEN 's' THEN 's' WHEN 'u' THEN 'u' WHEN 'a' THEN 'a' ELSE 'x' END AS c,
         CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN again > 1 THEN 'duplicate'
              WHEN final NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'fine' END AS fault
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS again FROM numbered)),
ids AS (SELECT DISTINCT conv_id FROM conversations),
after AS (  -- inserted rows, from a state
  SELECT * FROM (VALUES (0, '', [], 0), (0, 'I', ['user:'], 2), (0, 'II', ['user:', 'assistant:'], 3), (1, '', [], 1),
    (1, 'I', ['user:'], 2), (1, 'II', ['user:', 'assistant:'], 3), (2, '', [], 2), (2, 'I', ['assistant:'], 3),
    (3, '', [], 3), (3, 'I', ['user:'], 2)) AS t(s, edits, lines, s2)),
moves AS (  -- edits of one row; c null: any initial
  SELECT * FROM (VALUES (0, 'K', 's', 1, 0, NULL), (0, 'K', 'u', 2, 0, NULL), (1, 'K', 'u', 2, 0, NULL), (2, 'K', 'a', 3, 0, NULL),
    (3, 'K', 'u', 2, 0, NULL), (0, 'R', NULL, 2, 3, 'user'), (1, 'R', NULL, 2, 3, 'user'), (2, 'R', NULL, 3, 3, 'assistant'),
    (3, 'R', NULL, 2, 3, 'user')) AS t(s, edit, c, s2, cost, role)),
best AS (
  SELECT conv_id, 0::BIGINT AS i, a.s2 AS s, {{'cost': 3 * length(a.edits), 'edits': a.edits, 'lines': a.lines::VARCHAR[]}} AS b
  FROM ids, after a WHERE a.s = 0
  UNION ALL
  SELECT conv_id, i, s, min(b) FROM (
    SELECT t.conv_id, t.i, a.s2 AS s, {{'cost': t.cost + 3 * length(a.edits), 'edits': t.edits || a.edits, 'lines': t.lines || a.lines}} AS b
    FROM (
      SELECT p.conv_id, r.i, p.s, p.b.cost + 4 AS cost, p.b.edits || 'D' AS edits, p.b.lines AS lines
      FROM best p JOIN judged r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.i = p.i + 1
      UNION ALL
      SELECT p.conv_id, r.i, m.s2, p.b.cost + m.cost + CASE WHEN r.fault = 'truncated' THEN 3 ELSE 0 END, p.b.edits || m.edit,
             list_append(p.b.lines, coalesce(m.role, r.role) || ':' || r.text)
      FROM best p JOIN judged r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.i = p.i + 1
      JOIN moves m ON m.s = p.s AND (m.c IS NULL OR m.c = r.c) WHERE r.fault IN ('fine', 'truncated')) t
    JOIN after a ON a.s = t.s) GROUP BY ALL),
done AS (
  SELECT conv_id, min(b) AS b FROM (
    SELECT * FROM best WHERE s IN (0, 3) QUALIFY i = max(i) OVER (PARTITION BY conv_id)) GROUP BY conv_id),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
         count(*) FILTER (WHERE fault = 'truncated') AS truncated,
         count(*) FILTER (WHERE pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT *, lag(c) OVER (PARTITION BY conv_id ORDER BY i) || c AS pair FROM judged) GROUP BY conv_id)
SELECT d.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, d.b.cost::BIGINT AS cost, d.b.edits AS audit,
       sha256(coalesce(array_to_string(d.b.lines, chr(10)), '')) AS repaired_sha256
FROM done d LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM d.conv_id"""

_TERMS = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          "'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")

LEXICAL_SEARCH = f"""
WITH d AS MATERIALIZED (
  SELECT * FROM (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents) WHERE len(w) > 0),
collection AS (SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM d),
items AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
postings AS MATERIALIZED (
  SELECT term, r, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM items) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM postings GROUP BY term), collection),
lengths AS (SELECT r, doc_id, 100 - 50 + (50 * len(w) * n_docs) // n_terms AS m FROM d, collection),
scores AS (
  SELECT i.item_id, r, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM items i JOIN postings USING (term) JOIN weights USING (term) JOIN lengths USING (r) GROUP BY ALL),
ranked AS (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank
  FROM scores JOIN d USING (r) WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 50"""
