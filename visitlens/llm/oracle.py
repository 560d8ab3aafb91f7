"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

_SPACE = r"[\x20\x09-\x0D]"

EXACT_DEDUP = rf"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         regexp_replace(coalesce(text, ''), '{_SPACE}', '', 'g') AS norm
  FROM documents),
r AS (
  SELECT doc_id, sha256(norm) AS text_sha256, count(*) OVER (PARTITION BY norm) AS group_size,
         first_value(doc_id) OVER w AS keep_id, row_number() OVER w AS rn
  FROM n WINDOW w AS (PARTITION BY norm ORDER BY chars DESC, doc_id))
SELECT doc_id, keep_id, group_size, rn = 1 AS kept, text_sha256 FROM r"""

QUALITY_RULES = rf"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text,
         [x FOR x IN regexp_split_to_array(coalesce(text, ''), '{_SPACE}+') IF x <> ''] AS words
  FROM documents),
windows AS (
  SELECT doc_id, i, words[i:i + 4] AS five
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM w)),
twice AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, five) AS n FROM windows) WHERE n > 1),
cover AS (
  SELECT doc_id, sum(step) AS n_repeat_words FROM (
    SELECT doc_id, least(5, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 5)) AS step
    FROM twice) GROUP BY doc_id),
lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (
  SELECT w.doc_id, len(words) AS n_words, length(regexp_replace(text, '{_SPACE}', '', 'g')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         length(regexp_replace(text, '[^!]', '', 'g')) AS n_exclaim,
         length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_capitals,
         coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM w LEFT JOIN lines ON w.doc_id = lines.doc_id LEFT JOIN cover ON w.doc_id = cover.doc_id),
b AS (
  SELECT *, (CASE WHEN n_words < 10 THEN 1 ELSE 0 END)
    + (CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END)
    + (CASE WHEN 100 * n_symbols > 10 * word_chars THEN 4 ELSE 0 END)
    + (CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END)
    + (CASE WHEN word_chars < 2 * n_words OR word_chars > 15 * n_words THEN 16 ELSE 0 END)
    + (CASE WHEN 2 * n_exclaim > n_words THEN 32 ELSE 0 END)
    + (CASE WHEN 2 * n_capitals > word_chars THEN 64 ELSE 0 END) AS bits
  FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       bits = 0 AS kept, CAST(bits AS BIGINT) AS failed_bits FROM b"""

CHAT_FORMAT = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -1, i, CASE WHEN i = 0 THEN 'user' ELSE 'assistant' END, '<|im_end|><|im_start|>assistant ok'
  FROM range(2) r(i))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(24 + length(role) + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g'))) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SOURCE_DIVERGENCE = rf"""
WITH d AS (
  SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all({_LOWER}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
t AS (SELECT i, lang, source, unnest(terms) AS term FROM d),
kept AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT i) >= 30),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
cells AS (
  SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n
  FROM g JOIN kept USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
whole AS (SELECT lang, source, sum(n) AS total FROM cells GROUP BY lang, source),
p AS (
  SELECT lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 5)::HUGEINT) // (total + 5 * v)::HUGEINT AS p
  FROM cells JOIN whole USING (lang, source) JOIN v USING (lang)),
q AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(n) + 5)::HUGEINT) // (any_value(lang_total) + 5 * any_value(v))::HUGEINT AS q
  FROM cells JOIN (SELECT lang, sum(total) AS lang_total FROM whole GROUP BY lang) USING (lang) JOIN v USING (lang)
  GROUP BY lang, term),
pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(any_value(s.value), 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source AS one, y.source AS two, sum(abs(x.p - y.p)) AS value
             FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) s
    ON s.lang = a.lang AND s.one = a.source AND s.two = b.source
  GROUP BY a.lang, a.source, b.source),
term AS (
  SELECT p.lang, p.source, 'term' AS part, p.term AS item, p.p - q.q AS value
  FROM p JOIN q USING (lang, term) WHERE n > 0 AND p.p > q.q),
ranked AS (
  SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
         CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50"""

FILL_IN_MIDDLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units,
         sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
c AS (
  SELECT doc_id, text, units, len(units) AS n,
         CAST('0x' || h[1:8] AS UBIGINT) % (len(units) + 1) AS c1, CAST('0x' || h[9:16] AS UBIGINT) % (len(units) + 1) AS c2,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                   OR CAST('0x' || h[17:24] AS UBIGINT) % 100 >= 100 THEN 'plain'
              WHEN CAST('0x' || h[25:32] AS UBIGINT) % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM d),
s AS (
  SELECT doc_id, text, n, form, array_to_string(units[1:least(c1, c2)], '') AS prefix,
         array_to_string(units[least(c1, c2) + 1:greatest(c1, c2)], '') AS middle,
         array_to_string(units[greatest(c1, c2) + 1:n], '') AS suffix FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM s"""

_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS words FROM documents),
b AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id, {_WORDS} AS words FROM benchmark),
grams AS (
  SELECT DISTINCT item_id, size, array_to_string(words[i:i + size - 1], ' ') AS gram
  FROM (SELECT item_id, words, least(10, len(words)) AS size, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS i
        FROM b WHERE len(words) > 0)),
places AS (
  SELECT r, i, size, array_to_string(words[i:i + size - 1], ' ') AS gram
  FROM (SELECT r, words, size, unnest(range(1, len(words) - size + 2)) AS i
        FROM d, (SELECT DISTINCT size FROM grams))),
hits AS (SELECT r, i, places.size AS size, item_id FROM places JOIN grams USING (size, gram)),
covered AS (SELECT r, count(DISTINCT w) AS n_hit FROM (SELECT r, unnest(range(i, i + size)) AS w FROM hits) GROUP BY r),
items AS (SELECT r, list_sort(list(DISTINCT item_id)) AS items FROM hits GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered ON d.r = covered.r LEFT JOIN items ON d.r = items.r"""

NEAR_DEDUP = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, [x FOR x IN regexp_split_to_array({_LOWER}, '{_SPACE}+') IF x <> ''] AS words FROM documents),
s AS (
  SELECT DISTINCT doc_id, words[i] || CASE WHEN len(words) > 1 THEN ' ' || words[i + 1] ELSE '' END AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words), 2))) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
edges AS (SELECT a AS x, b AS y FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id, doc_id AS c FROM documents
  UNION
  SELECT edges.y, reach.c FROM reach JOIN edges ON edges.x = reach.doc_id),
component AS (SELECT doc_id, min(c) AS c FROM reach GROUP BY doc_id)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c AS component_id, w.doc_id = c AS kept
FROM w LEFT JOIN n ON n.doc_id = w.doc_id JOIN component ON component.doc_id = w.doc_id"""

ORACLES = {
    "op1_exact_dedup": EXACT_DEDUP,
    "op4_quality_rules": QUALITY_RULES,
    "op8_chat_format": CHAT_FORMAT,
    "op10_minhash_near_dedup": NEAR_DEDUP,
    "op11_source_divergence": SOURCE_DIVERGENCE,
    "op12_fill_in_middle": FILL_IN_MIDDLE,
    "op13_decontamination": DECONTAMINATION,
}
