"""DuckDB SQL for the training-data queries that SQL can express."""

from __future__ import annotations

from tasteflow.llm.quality_rules import ENDING, PHRASES, SPEECH, TEASER, Rules

_R = Rules()
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

SQL: dict[str, str] = {}


def _quoted(pattern: str) -> str:
    """Inside a SQL string literal."""
    return pattern.replace("'", "''")


SQL["op2_quality_rules"] = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, doc_id, text, {_WORDS.format('text')} AS ws FROM d),
wins AS (SELECT r, i, ws[i] || chr(1) || ws[i + 1] || chr(1) || ws[i + 2] AS win
         FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS n FROM wins) WHERE n > 1),
rep AS (SELECT r, count(*) AS n FROM (SELECT DISTINCT r, i + k AS p FROM twice, range(3) t(k)) GROUP BY r),
ls AS (SELECT r, k, line, len({_WORDS.format('line')}) AS n,
              length(line) - length(translate(line, '#*$%&|<>', '')) AS s,
              length(line) - length(replace(line, '|', '')) AS bars,
              length(line) - length(replace(line, '!', '')) AS shouts
       FROM (SELECT r, unnest(string_split(text, chr(10))) AS line,
                    generate_subscripts(string_split(text, chr(10)), 1) AS k FROM d)),
links AS (SELECT *, n > 0 AND n <= {_R.link_max_words} AND NOT regexp_matches(line, '{_quoted(ENDING)}') AS link FROM ls),
rows_ AS (SELECT *, sum(link::INT) OVER (PARTITION BY r ORDER BY k ROWS {_R.menu_lines - 1} PRECEDING) = {_R.menu_lines} AS ends
          FROM links),
menus AS (SELECT *, bool_or(ends) OVER (PARTITION BY r ORDER BY k ROWS BETWEEN CURRENT ROW
            AND {_R.menu_lines - 1} FOLLOWING) AS menu FROM rows_),
judged AS (SELECT r, line, n, n > 0 AND (menu OR s * 100 > n * {_R.line_symbols_pct}
              OR (bars > 0 AND bars * 100 >= n * {_R.line_bars_pct})
              OR (shouts >= 2 AND shouts * 100 >= n * {_R.line_shouts_pct})
              OR (n <= {_R.phrase_max_words} AND regexp_matches(lower(line), '{"|".join(PHRASES)}'))
              OR (n <= {_R.teaser_max_words} AND regexp_matches(line, '{_quoted(TEASER)}'))
              OR NOT regexp_matches(line, '{_quoted(SPEECH)}')) AS bad FROM menus),
sums AS (SELECT r, count(*) FILTER (n > 0) - count(DISTINCT line) FILTER (n > 0) AS dup,
                count(*) FILTER (bad) AS bad, coalesce(sum(n) FILTER (bad), 0) AS lost FROM judged GROUP BY r),
base AS (SELECT w.r, doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
                length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols,
                dup AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words, bad AS n_bad_lines, lost AS n_lost_words
         FROM w JOIN sums USING (r) LEFT JOIN rep USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {_R.min_words} OR n_repeat_words * 100 > n_words * {_R.max_repeat_pct} AS base_failed,
       n_bad_lines, n_lost_words::BIGINT AS n_lost_words,
       NOT (n_words < {_R.min_words} OR n_repeat_words * 100 > n_words * {_R.max_repeat_pct})
       AND n_lost_words * 100 <= n_words * {_R.max_lost_pct} AS kept
FROM base"""

SQL["op3_decontaminate"] = r"""
WITH norm(kind, r, id, ws) AS (
  SELECT 'd', row_number() OVER (), doc_id::VARCHAR,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM documents
  UNION ALL
  SELECT 'b', row_number() OVER (), coalesce(item_id::VARCHAR, ''),
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
items AS (SELECT id, ws, least(len(ws), 10) AS n FROM norm WHERE kind = 'b' AND len(ws) > 0),
wins AS (SELECT DISTINCT id, n, array_to_string(ws[i:i + n - 1], ' ') AS win
         FROM (SELECT id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM items)),
lens AS (SELECT DISTINCT n FROM wins),
grams AS (SELECT r, n, i, array_to_string(ws[i:i + n - 1], ' ') AS win
          FROM (SELECT r, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM norm, lens WHERE kind = 'd')),
hits AS (SELECT r, i, n, id FROM grams JOIN wins USING (n, win)),
covered AS (SELECT r, count(*) AS n_hit FROM
            (SELECT DISTINCT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, i, n FROM hits)) GROUP BY r),
found AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
          FROM (SELECT DISTINCT r, id FROM hits) GROUP BY r)
SELECT id::BIGINT AS doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM norm LEFT JOIN covered USING (r) LEFT JOIN found USING (r) WHERE kind = 'd'"""

SQL["op1_suffix_dedup"] = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
wins AS (SELECT r, doc_id, i, substr(x, 2 * i + 1, 100) AS s
         FROM (SELECT r, doc_id, x, unnest(range(0, len(x) // 2 - 49)) AS i FROM d)),
hit AS (SELECT r, i FROM (SELECT r, doc_id, i, min(doc_id) OVER (PARTITION BY s) AS m FROM wins) WHERE m < doc_id),
gone AS (SELECT DISTINCT r, i + k AS p FROM hit, range(50) t(k)),
runs AS (SELECT r, count(*) AS n, count(*) FILTER (before IS NULL OR before < p - 1) AS spans
         FROM (SELECT r, p, lag(p) OVER (PARTITION BY r ORDER BY p) AS before FROM gone) GROUP BY r),
chars AS (SELECT r, i, substr(x, 2 * i + 1, 2) AS b FROM (SELECT r, x, unnest(range(0, len(x) // 2)) AS i FROM d)),
kept AS (SELECT r, string_agg(b, '' ORDER BY i) AS x FROM chars ANTI JOIN gone ON chars.r = gone.r AND chars.i = gone.p
         GROUP BY r)
SELECT doc_id, len(d.x) // 2 AS n_bytes, coalesce(n, 0) AS n_removed, coalesce(spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept.x, ''))) AS kept_sha256
FROM d LEFT JOIN runs USING (r) LEFT JOIN kept USING (r)"""

SQL["op6_jaccard_join"] = rf"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
         {_WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS ws
  FROM documents),
sh AS (SELECT DISTINCT r, array_to_string(ws[i:i + 2], ' ') AS s
       FROM (SELECT r, ws, unnest(range(1, greatest(len(ws) - 1, 2))) AS i FROM d WHERE len(ws) > 0)),
size AS (SELECT r, count(*) AS n FROM sh GROUP BY r),
shared AS (SELECT a.r AS a, b.r AS b, count(*) AS n FROM sh a JOIN sh b ON a.s = b.s AND a.r < b.r GROUP BY a.r, b.r),
links AS (SELECT a, b FROM shared JOIN size x ON x.r = a JOIN size y ON y.r = b
          WHERE 100 * shared.n >= 90 * (x.n + y.n - shared.n)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(r, o) AS (SELECT r, r FROM d UNION SELECT reach.r, edges.b FROM reach JOIN edges ON edges.a = reach.o)
SELECT d.doc_id, coalesce(max(n), 0) AS n_shingles, coalesce(min(other.doc_id), d.doc_id) AS component_id
FROM d JOIN reach USING (r) JOIN d other ON other.r = reach.o LEFT JOIN size ON size.r = d.r
GROUP BY d.r, d.doc_id"""

_ROOT = ("-ln((('0x' || left(md5({node} || '/' || c), 13))::BIGINT + 0.5) / 4503599627370496.0) / {weight}")


def _child(node: str, weights: list[float]) -> str:
    """Index of the child with the lowest draw."""
    draws = ", ".join(f"{{'d': {_ROOT.format(node=node, weight=w).replace('|| c', f'|| {i}')}, 'i': {i}}}"
                      for i, w in enumerate(weights))
    return f"list_min([{draws}]).i"


SQL["op7_sharding"] = f"""
WITH crc_table AS (
  SELECT list(v ORDER BY b) AS t FROM (
    SELECT b, list_reduce(list_prepend(b, range(8)), lambda a, k:
             CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v
    FROM (SELECT unnest(range(256)) AS b))),
d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
sized AS (
  SELECT r, doc_id, strlen(text) + 1 AS size,
         xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(
             regexp_extract_all(hex(encode(text)), '..'), lambda x: ('0x' || x)::BIGINT)),
             lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) AS text_crc32,
         coalesce(doc_id::VARCHAR, '') AS key
  FROM d, crc_table),
regions AS (SELECT *, {_child('key', [8.0, 8.0])} AS g, {_child('key', [8.0, 8.0, 1.0])} AS grown_g FROM sized),
racks AS (SELECT *, {_child("key || '/' || g", [4.0, 4.0])} AS k,
                 {_child("key || '/' || grown_g", [4.0, 4.0])} AS grown_k FROM regions),
placed AS (SELECT *, g * 8 + k * 4 + {_child("key || '/' || g || '/' || k", [1.0] * 4)} AS shard,
                  CASE WHEN grown_g = 2 THEN 16
                       ELSE grown_g * 8 + grown_k * 4 + {_child("key || '/' || grown_g || '/' || grown_k", [1.0] * 4)}
                  END AS grown_shard FROM racks)
SELECT doc_id, size, text_crc32::BIGINT AS text_crc32, 'key' AS law, shard::INT AS shard,
       grown_shard::INT AS grown_shard,
       row_number() OVER (PARTITION BY shard ORDER BY
           ('0x' || left(md5(concat_ws('|', doc_id, size, text_crc32, shard)), 8))::BIGINT % 1024,
           doc_id NULLS FIRST, size, text_crc32) - 1 AS slot
FROM placed"""

SQL["op9_chat_format"] = """
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, x) AS k, x
  FROM (SELECT conv_id, turn, '<|im_start|>' || coalesce(role, 'user') || chr(10) || coalesce(text, '')
               || '<|im_end|>' || chr(10) AS x FROM conversations WHERE conv_id IS NOT NULL)),
upto AS (SELECT conv_id, k, string_agg(x, '') OVER (PARTITION BY conv_id ORDER BY k) AS txt,
                max(k) OVER (PARTITION BY conv_id) AS n FROM t),
whole AS (SELECT txt, n, min(conv_id) AS conv_id, count(*) AS n_logged FROM upto WHERE k = n GROUP BY txt, n)
SELECT conv_id, n AS n_turns, n_logged, txt AS rendered FROM whole
WHERE NOT EXISTS (SELECT 1 FROM upto u WHERE u.k < u.n AND u.k = whole.n AND u.txt = whole.txt)"""

_CRC_TABLE = """crc_table AS (
  SELECT list(v ORDER BY b) AS t FROM (
    SELECT b, list_reduce(list_prepend(b, range(8)), lambda a, k:
             CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v
    FROM (SELECT unnest(range(256)) AS b)))"""
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL["op11_spelling_variants"] = rf"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (SELECT doc_id, {_LOWER.format('run')} AS run, count(*) AS c
         FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents)
         WHERE length(run) >= 7 GROUP BY ALL),
coded AS (SELECT run, c, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(
            regexp_extract_all(hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)), '..'), lambda x: ('0x' || x)::BIGINT)),
            lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) AS h FROM runs, crc_table),
cut AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
                    ELSE run END AS w, c FROM coded),
words AS (SELECT w, sum(c)::BIGINT AS n FROM cut WHERE length(w) >= 7 GROUP BY w HAVING sum(c) >= 2),
holes AS (SELECT w, n, i, substr(w, 1, i - 1) AS x, substr(w, i + 1) AS y
          FROM (SELECT w, n, unnest(range(1, length(w) + 1)) AS i FROM words)),
shorter AS (SELECT DISTINCT w, n, x || y AS s FROM holes),
near AS (SELECT a.w, b.w AS o, b.n AS o_n FROM holes a JOIN holes b USING (i, x, y) WHERE a.w <> b.w
         UNION ALL SELECT s.w, t.w, t.n FROM shorter s JOIN words t ON t.w = s.s
         UNION ALL SELECT t.w, s.w, s.n FROM shorter s JOIN words t ON t.w = s.s),
placed AS (SELECT w, o, o_n, row_number() OVER (PARTITION BY w ORDER BY o_n DESC, o) AS k,
                  count(*) OVER (PARTITION BY w) AS n_near FROM near),
f AS (SELECT w, n, coalesce(n_near, 0) AS n_near, CASE WHEN o_n >= 10 * n THEN o END AS form,
             CASE WHEN o_n >= 10 * n THEN o_n END AS form_n
      FROM words LEFT JOIN (SELECT * FROM placed WHERE k = 1) USING (w)),
chain AS (SELECT w, form AS top FROM f WHERE form IS NOT NULL
          UNION ALL SELECT chain.w, f.form FROM chain JOIN f ON f.w = chain.top WHERE f.form IS NOT NULL),
ends AS (SELECT chain.w, top FROM chain JOIN f ON f.w = top WHERE f.form IS NULL)
SELECT f.w AS word, form, coalesce(top, f.w) AS root, n, n_near, form_n FROM f LEFT JOIN ends ON ends.w = f.w"""

SQL["op13_collocations"] = rf"""
WITH p AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws
  FROM (SELECT coalesce(lang, 'und') AS lang,
               unnest(regexp_split_to_array({_LOWER.format("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
size AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM p GROUP BY lang),
f1 AS (SELECT lang, x, count(*) AS f FROM (SELECT lang, unnest(ws) AS x FROM p) GROUP BY ALL),
f2 AS (SELECT lang, ws[i] AS x, ws[i + 1] AS y, count(*) AS f
       FROM (SELECT lang, ws, unnest(range(1, len(ws))) AS i FROM p) GROUP BY ALL),
f3 AS (SELECT lang, ws[i] AS x, ws[i + 1] AS y, ws[i + 2] AS z, count(*) AS f
       FROM (SELECT lang, ws, unnest(range(1, len(ws) - 1)) AS i FROM p) GROUP BY ALL HAVING count(*) >= 10),
cuts AS (
  SELECT c.lang, c.x || ' ' || c.y AS phrase, 1 AS k, c.f AS a, u.f AS l, v.f AS r
  FROM f2 c JOIN f1 u ON u.lang = c.lang AND u.x = c.x JOIN f1 v ON v.lang = c.lang AND v.x = c.y
  WHERE c.f >= 10 AND NOT EXISTS (SELECT 1 FROM f3 t WHERE t.lang = c.lang AND 100 * t.f >= 50 * c.f
                                  AND ((t.x = c.x AND t.y = c.y) OR (t.y = c.x AND t.z = c.y)))
  UNION ALL
  SELECT c.lang, c.x || ' ' || c.y || ' ' || c.z, 1, c.f, u.f, v.f
  FROM f3 c JOIN f1 u ON u.lang = c.lang AND u.x = c.x JOIN f2 v ON v.lang = c.lang AND v.x = c.y AND v.y = c.z
  UNION ALL
  SELECT c.lang, c.x || ' ' || c.y || ' ' || c.z, 2, c.f, u.f, v.f
  FROM f3 c JOIN f2 u ON u.lang = c.lang AND u.x = c.x AND u.y = c.y JOIN f1 v ON v.lang = c.lang AND v.x = c.z),
valued AS (SELECT *, ((1000000::HUGEINT * a * a) // (l::HUGEINT * r))::BIGINT AS score FROM cuts),
lowest AS (SELECT * FROM valued QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN size USING (lang) WHERE rank <= 2000"""
