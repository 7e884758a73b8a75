"""DuckDB queries for the operators that SQL can express, over the same tables."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP4 = f"""
WITH w AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS ws FROM documents),
b AS (SELECT item_id, {_WORDS} AS ws FROM benchmark WHERE item_id IS NOT NULL),
iw AS (SELECT DISTINCT item_id, least(len(ws), 13) AS n, array_to_string(ws[i:i + least(len(ws), 13) - 1], ' ') AS g
       FROM b, unnest(range(1, greatest(len(ws) - 13, 0) + 2)) AS t(i) WHERE len(ws) > 0),
sizes AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT rid, i, n, array_to_string(ws[i:i + n - 1], ' ') AS g FROM w, sizes, unnest(range(1, len(ws) - n + 2)) AS t(i)),
hits AS (SELECT DISTINCT rid, i, n, item_id FROM dw JOIN iw USING (n, g)),
hw AS (SELECT rid, count(DISTINCT p) AS n_hit FROM hits, unnest(range(i, i + n)) AS t(p) GROUP BY rid),
hi AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item_id::VARCHAR AS item FROM hits) GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM w LEFT JOIN hw USING (rid) LEFT JOIN hi USING (rid)
"""

OP5 = rf"""
WITH lines AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM (SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL)),
l AS (SELECT doc_id, text, i AS line, ls[i] AS t, (list_sum(list_transform(ls[:i - 1], lambda x: length(x) + 1)))::BIGINT AS before FROM lines, unnest(range(1, len(ls) + 1)) AS u(i)),
l2 AS (SELECT *, coalesce(before, 0) AS pos, string_split(regexp_replace(t, '([.!?]+)([\s\v])', '\1' || chr(1) || '\2', 'g'), chr(1)) AS ss FROM l),
s AS (SELECT doc_id, text, line, ss[j] AS t, pos + coalesce(list_sum(list_transform(ss[:j - 1], lambda x: length(x)))::BIGINT, 0) AS pos FROM l2, unnest(range(1, len(ss) + 1)) AS u(j) WHERE len(ss) > 1),
raw AS (SELECT doc_id, text, line, true AS whole, t, pos FROM l2 UNION ALL SELECT doc_id, text, line, false, ltrim(t, chr(9) || chr(11) || chr(12) || chr(13) || ' '), pos + length(t) - length(ltrim(t, chr(9) || chr(11) || chr(12) || chr(13) || ' ')) FROM s),
n AS (SELECT doc_id, text AS doc, line, whole, pos AS "start", pos + length(t) AS "end", {_WORDS.replace("coalesce(text, '')", "t")} AS ws FROM raw),
units AS (SELECT *, array_to_string(ws, ' ') AS norm FROM n WHERE len(ws) >= 8),
ranked AS (SELECT *, first_value(doc_id) OVER k AS kept_doc_id, first_value("start") OVER k AS kept_start, row_number() OVER k AS r FROM units WINDOW k AS (PARTITION BY norm ORDER BY doc_id, "start", whole DESC)),
again AS (SELECT * FROM ranked WHERE r > 1 AND NOT (doc_id = kept_doc_id AND "start" = kept_start)),
gone AS (SELECT DISTINCT doc_id, doc, line FROM again WHERE whole)
SELECT DISTINCT a.doc_id, a."start", a."end", len(a.ws)::BIGINT AS n_words, a.whole, a.kept_doc_id, a.kept_start
FROM again a LEFT JOIN gone g ON a.doc_id = g.doc_id AND a.doc = g.doc AND a.line = g.line WHERE a.whole OR g.line IS NULL
"""

OP9 = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + least(len(ws), 3) - 1], ' ') AS g FROM w, unnest(range(1, greatest(len(ws) - 3, 0) + 2)) AS t(i) WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
both_ AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM both_ JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT a, b FROM edges UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
low AS (SELECT a AS doc_id, min(b) AS b FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(w.doc_id, coalesce(low.b, w.doc_id)) AS component_id, w.doc_id = least(w.doc_id, coalesce(low.b, w.doc_id)) AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN low USING (doc_id)
"""

OP10 = r"""
WITH d AS (SELECT DISTINCT doc_id, text, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
l AS (SELECT doc_id, text, i, ls[i] AS t, len(ls) AS n, ('0x' || substr(md5(ls[i]), 1, 8))::BIGINT AS h FROM d, unnest(range(1, len(ls) + 1)) AS u(i)),
e AS (SELECT *, i = n OR (h + 31 * coalesce(lag(h) OVER doc, 0)) % 3 = 0 AS ends FROM l WINDOW doc AS (PARTITION BY doc_id, text ORDER BY i)),
c AS (SELECT *, coalesce(sum(ends::INT) OVER (PARTITION BY doc_id, text ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS chunk FROM e),
g AS (SELECT doc_id, text, chunk, min(i) AS first, count(*) AS n, string_agg(t, chr(10) ORDER BY i) AS body FROM c GROUP BY doc_id, text, chunk),
r AS (SELECT *, n >= 2 AND trim(body, ' ') <> '' AND row_number() OVER (PARTITION BY body, n >= 2 ORDER BY doc_id, first) > 1 AS gone FROM g),
t AS (SELECT doc_id, text, coalesce(string_agg(body, chr(10) ORDER BY first) FILTER (NOT gone), '') AS rest, sum(n)::BIGINT AS n_lines, coalesce(sum(n) FILTER (gone), 0)::BIGINT AS n_removed FROM r GROUP BY doc_id, text)
SELECT documents.doc_id, t.rest AS text, coalesce(t.n_lines, 0)::BIGINT AS n_lines, coalesce(t.n_removed, 0)::BIGINT AS n_removed
FROM documents LEFT JOIN t ON documents.doc_id IS NOT DISTINCT FROM t.doc_id AND documents.text = t.text
"""

_BLANK_WORDS = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

OP11 = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_BLANK_WORDS} AS ws FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + least(len(ws), 5) - 1], ' ') AS g FROM w, unnest(range(1, greatest(len(ws) - 5, 0) + 2)) AS t(i) WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
both_ AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM both_ JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 80 * (x.n + y.n - shared)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT a, b FROM edges UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
low AS (SELECT a AS doc_id, min(b) AS b FROM reach GROUP BY a),
degree AS (SELECT a AS doc_id, count(*) AS n_links FROM edges GROUP BY a)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(w.doc_id, coalesce(low.b, w.doc_id)) AS component_id, coalesce(n_links, 0)::BIGINT AS n_links
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN low USING (doc_id) LEFT JOIN degree USING (doc_id)
"""

OP13 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS part FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws, min(doc_id) OVER (PARTITION BY text) AS first_id FROM d),
f AS (SELECT doc_id, part, (len(ws) < 50)::INT + 2 * (100 * len(list_distinct(ws)) < 65 * len(ws))::INT
             + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text))::INT
             + 8 * regexp_matches(text, '[#$%&*|]')::INT + 16 * coalesce(doc_id > first_id, false)::INT AS mask FROM w),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic FROM f LEFT JOIN l USING (doc_id) GROUP BY part, mask),
c AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
o AS (SELECT v.c || w.c || x.c || y.c || z.c AS filter_order FROM c v, c w, c x, c y, c z
      WHERE v.c NOT IN (w.c, x.c, y.c, z.c) AND w.c NOT IN (x.c, y.c, z.c) AND x.c NOT IN (y.c, z.c) AND y.c <> z.c),
s AS (SELECT filter_order, step, filter_order[step] AS c, (1 << (ascii(filter_order[step]) - 65)) AS bit,
             list_sum(list_transform(range(1, step), lambda k: (1 << (ascii(filter_order[k]) - 65)))) AS sofar FROM o, range(1, 6) AS r(step)),
g AS (SELECT part, filter_order, step, c,
             coalesce(sum(n) FILTER (mask & (coalesce(sofar, 0)::BIGINT | bit) = 0), 0) AS kept,
             coalesce(sum(n) FILTER (mask & coalesce(sofar, 0)::BIGINT = 0 AND mask & bit <> 0), 0) AS removed,
             coalesce(sum(n) FILTER (mask & coalesce(sofar, 0)::BIGINT <> 0 AND mask & bit <> 0), 0) AS redundant,
             coalesce(sum(n) FILTER (mask = bit), 0) AS unique_fails,
             coalesce(sum(good) FILTER (mask & coalesce(sofar, 0)::BIGINT = 0 AND mask & bit <> 0), 0) AS good_lost,
             coalesce(sum(toxic) FILTER (mask & coalesce(sofar, 0)::BIGINT = 0 AND mask & bit <> 0), 0) AS toxic_lost
      FROM m, s GROUP BY part, filter_order, step, c)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
       good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, c))::BIGINT AS shapley
FROM g
"""

SQL = {"op4_decontamination": OP4, "op5_substring_dedup": OP5, "op9_minhash_near_dedup": OP9, "op10_line_dedup": OP10,
       "op11_ngram_jaccard": OP11, "op13_filter_audit": OP13}
