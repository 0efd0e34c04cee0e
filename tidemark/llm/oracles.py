"""DuckDB SQL for those queries of this package that SQL can express."""

SPACED, ALNUM = r"[^\x20\x09-\x0D]+", r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Components of links (a, b), a > b, over nodes: the smallest node that each reaches.
_COMPONENTS = """ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(node, other) AS (SELECT a, b FROM ways UNION SELECT r.node, e.b FROM reach r JOIN ways e ON r.other = e.a),
least AS (SELECT node, least(node, min(other)) AS component FROM reach GROUP BY node)"""

OP5 = r"""WITH RECURSIVE rows AS (SELECT conv_id, turn, role, text FROM conversations UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')) v(a, b, c, d)),
t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k FROM rows),
sized AS (SELECT *, length(role) + length(text) + 14 + length(regexp_replace(role || text, '[^\\<#:]', '', 'g')) AS n, max(k) OVER (PARTITION BY conv_id) AS last FROM t),
summed AS (SELECT *, sum(n) OVER (PARTITION BY conv_id ORDER BY k) AS upto FROM sized)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  length(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), ''))::BIGINT AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
  (sum(upto) FILTER (role = 'assistant' OR k = last))::BIGINT AS formatted_chars
FROM summed GROUP BY conv_id"""

OP8 = rf"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({LOWER}, '{SPACED}') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM w),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
links AS (SELECT p.doc_id AS a, q.doc_id AS b FROM e p JOIN e q ON p.x = q.x AND p.doc_id > q.doc_id GROUP BY 1, 2 HAVING 100 * count(*) >= 75 * (any_value(p.n) + any_value(q.n) - count(*))),
{_COMPONENTS}
SELECT doc_id, len(s)::BIGINT AS n_shingles, coalesce(component, doc_id) AS component_id FROM s LEFT JOIN least ON node = doc_id"""

OP9 = f"""WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0 AND len(list_filter(embedding, lambda y: y <> 0)) > 0),
n AS (SELECT vec_id, x, sqrt(list_inner_product(x, x)) AS norm FROM v),
links AS (SELECT p.vec_id AS a, q.vec_id AS b FROM n p JOIN n q ON p.vec_id > q.vec_id AND len(p.x) = len(q.x) WHERE list_inner_product(p.x, q.x) / (p.norm * q.norm) >= 0.9),
{_COMPONENTS}, degree AS (SELECT a AS node, count(*) AS d FROM ways GROUP BY a)
SELECT vec_id, coalesce(d, 0)::BIGINT AS n_links, coalesce(component, vec_id) AS component_id, vec_id = coalesce(component, vec_id) AS kept
FROM embeddings LEFT JOIN least ON least.node = vec_id LEFT JOIN degree ON degree.node = vec_id"""

OP10 = rf"""WITH i AS (SELECT item_id::VARCHAR AS item, regexp_extract_all({LOWER}, '{ALNUM}') AS w FROM benchmark WHERE item_id IS NOT NULL),
g AS (SELECT DISTINCT item, least(10, len(w)) AS n, unnest(list_transform(range(1, len(w) - least(10, len(w)) + 2), lambda k: array_to_string(w[k : k + least(10, len(w)) - 1], ' '))) AS gram FROM i WHERE len(w) > 0),
d AS (SELECT doc_id, regexp_extract_all({LOWER}, '{ALNUM}') AS w FROM documents),
sizes AS (SELECT DISTINCT n FROM g),
p AS (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS k, unnest(list_transform(range(1, len(w) - n + 2), lambda k: array_to_string(w[k : k + n - 1], ' '))) AS gram FROM d, sizes WHERE len(w) >= n),
hits AS (SELECT doc_id, p.n, k, item FROM p JOIN g ON p.gram = g.gram AND p.n = g.n),
words AS (SELECT doc_id, count(DISTINCT k + j) AS n_hit FROM hits, (SELECT unnest(range(10)) AS j) WHERE j < n GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item) AS n_items, array_to_string(list_sort(list_distinct(list(item))), ',') AS names FROM hits GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""

#: crc32 of the bytes x of an expression, by a table of 256 remainders.
_CRC_TABLE = "crc AS (SELECT list(list_reduce(range(8), lambda c, k: xor(c >> 1, (c & 1) * 3988292384), i) ORDER BY i) AS tab FROM (SELECT unnest(range(256)) AS i))"


def _crc32(text: str) -> str:
    codes = f"list_transform(range(1, octet_length(encode({text})) + 1), lambda k: ('0x' || hex(encode({text})[k:k]))::BIGINT)"
    return f"xor(list_reduce({codes}, lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)"


_RUN = r"[A-Za-z\x{C0}-\x{FF}]+"
OP11 = rf"""WITH RECURSIVE {_CRC_TABLE},
runs AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_RUN}')) AS run FROM documents),
each AS (SELECT doc_id, run, count(*) AS times FROM runs WHERE length(run) >= 7 GROUP BY ALL),
hashed AS (SELECT run, times, {_crc32("doc_id::VARCHAR || ':' || run")} AS h FROM each, crc),
cut AS (SELECT times, CASE WHEN h % 31 = 0 THEN left(run, (h % length(run))::BIGINT) || substr(run, (h % length(run) + 2)::BIGINT) ELSE run END AS word FROM hashed),
words AS (SELECT word, sum(times)::BIGINT AS n FROM cut WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2),
less AS (SELECT word, n, k, left(word, k) || substr(word, k + 2) AS d FROM (SELECT word, n, unnest(range(length(word))) AS k FROM words)),
pairs AS (SELECT a.word, b.word AS near, b.n AS near_n, a.n FROM less a JOIN less b USING (d, k) WHERE a.word <> b.word
  UNION SELECT a.word, b.word, b.n, a.n FROM less a JOIN words b ON a.d = b.word UNION SELECT b.word, a.word, a.n, b.n FROM less a JOIN words b ON a.d = b.word),
best AS (SELECT word, count(*) AS n_near, min((-near_n, near)) AS b, any_value(n) AS n FROM pairs GROUP BY word),
forms AS (SELECT word, n_near, CASE WHEN -b[1] >= 10 * n THEN b[2] END AS form, CASE WHEN -b[1] >= 10 * n THEN -b[1] END AS form_n FROM best),
chain(word, root, k) AS (SELECT word, word, 0 FROM words UNION ALL SELECT c.word, f.form, k + 1 FROM chain c JOIN forms f ON c.root = f.word WHERE f.form IS NOT NULL)
SELECT w.word, form, (SELECT root FROM (SELECT word AS x, arg_max(root, k) AS root FROM chain GROUP BY word) WHERE x = w.word) AS root, n, coalesce(n_near, 0)::BIGINT AS n_near, form_n::BIGINT AS form_n
FROM words w LEFT JOIN forms f ON f.word = w.word"""

OP13 = rf"""WITH {_CRC_TABLE},
h AS (SELECT doc_id, {_crc32("doc_id::VARCHAR")} AS h, regexp_extract_all(coalesce(text, ''), '{SPACED}') AS o FROM documents, crc),
a AS (SELECT doc_id, o, len(o) AS n, h % 10 = 0 AND len(o) > 0 AS planted, h // 10 % greatest(len(o), 1) AS a, h // 10 % 8 + 3 AS parts FROM h),
w AS (SELECT doc_id, n, CASE WHEN planted THEN list_transform(range(n), lambda i: o[CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // parts) END + 1]) ELSE o END AS w FROM a),
e AS (SELECT doc_id, n, unnest(w) AS word, unnest(range(n)) AS i FROM w),
same AS (SELECT x.doc_id, y.i - x.i AS p, x.i FROM e x JOIN e y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND (y.i - x.i) * 4 <= x.n),
island AS (SELECT doc_id, p, i, i - row_number() OVER (PARTITION BY doc_id, p ORDER BY i) AS g FROM same),
stretch AS (SELECT doc_id, p, min(i) AS start, count(*) + p AS length FROM island GROUP BY doc_id, p, g HAVING count(*) + p >= greatest(6, 4 * p)),
runs AS (SELECT doc_id, start, length, min(p) AS period FROM stretch GROUP BY ALL),
dropped AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM e ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id),
sums AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM runs GROUP BY doc_id),
first AS (SELECT r.* FROM runs r WHERE NOT EXISTS (FROM runs s WHERE s.doc_id = r.doc_id AND (s.length * r.period > r.length * s.period OR s.length * r.period = r.length * s.period AND (s.start, s.period) < (r.start, r.period))))
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start::BIGINT AS start, length::BIGINT AS length, period::BIGINT AS period, (1000 * length // period)::BIGINT AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM documents LEFT JOIN sums USING (doc_id) LEFT JOIN first USING (doc_id) LEFT JOIN kept USING (doc_id)"""

SQL = {"op5_prefix_targets": OP5, "op8_ngram_jaccard_join": OP8, "op9_int8_tiles": OP9, "op10_suffix_automaton": OP10, "op11_trie_variants": OP11, "op13_lpf_runs": OP13}
