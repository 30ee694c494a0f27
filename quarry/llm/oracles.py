"""DuckDB SQL for the queries that SQL can express on whole tables.

The others (op2, op3, op5, op8, op9, op12, pipeline) are tested against brute force,
round trips, a tokenizer library and held-out accuracy in ``tests/llm``.
"""

_LOWER = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# smallest node reachable over link(a, b), both directions
_REACH = """
reach(a, b) AS (
  SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a)"""

SQL: dict[str, str] = {
    "op1_chat": r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok'))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('<turn ' || role || '>') + 1 + length(text) + 9
                + (length(text) - length(replace(text, '<turn ', ''))) // 6
                + (length(text) - length(replace(text, '</turn>', ''))) // 7) AS BIGINT) AS formatted_chars
FROM said GROUP BY conv_id""",
    "op4_minhash": rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format('text')}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i+1] || ' ' || w[i+2])
                                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
both_ AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM s x JOIN s y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM both_ JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * i >= 85 * (p.n + q.n - i)),
{_REACH},
c AS (SELECT a, least(a, min(b)) AS c FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.c, d.doc_id) AS component_id, coalesce(c.c, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN c ON c.a = d.doc_id""",
    "op6_decontaminate": rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER.format('text')}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM documents),
t AS (SELECT item_id, regexp_extract_all({_LOWER.format('text')}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda i: array_to_string(w[i:i + 9], ' '))) AS s
  FROM t WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM win),
place AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM d, sizes WHERE len(w) >= n),
hit AS (
  SELECT DISTINCT doc_id, i, p.n, item_id FROM place p JOIN win ON win.n = p.n AND win.s = array_to_string(w[i:i + p.n - 1], ' ')),
word AS (SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hit) GROUP BY 1),
item AS (SELECT doc_id, count(*) AS n, string_agg(i, ',' ORDER BY i) AS s FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY 1)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(word.n, 0) AS n_hit, coalesce(item.n, 0) AS n_items, sha256(coalesce(item.s, '')) AS items_sha256,
       coalesce(word.n, 0) > 0 AS contaminated
FROM d LEFT JOIN word ON word.doc_id = d.doc_id LEFT JOIN item ON item.doc_id = d.doc_id""",
    "op7_embeddings": rf"""
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
u AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS n FROM v),
link AS (SELECT x.vec_id AS a, y.vec_id AS b FROM u x JOIN u y ON x.vec_id <> y.vec_id AND len(x.e) = len(y.e) AND list_dot_product(x.e, y.e) / (x.n * y.n) >= 0.9),
{_REACH},
c AS (SELECT a, least(a, min(b)) AS c FROM reach GROUP BY a),
k AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, coalesce(k.n, 0) AS n_links, coalesce(c.c, vec_id) AS component_id, coalesce(c.c, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN c ON c.a = vec_id LEFT JOIN k ON k.a = vec_id""",
    "op10_warc": """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT d, min(page_id) AS f FROM p WHERE n >= 100 GROUP BY d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, p.d AS payload_digest,
       CASE WHEN f.f IS DISTINCT FROM page_id AND f.f IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.f IS DISTINCT FROM page_id THEN f.f END AS refers_to
FROM p LEFT JOIN f ON p.d = f.d""",
    "op11_filter_audit": r"""
WITH RECURSIVE g AS (SELECT doc_id, bool_or(coalesce(quality, 0) = 1) AS good, bool_or(coalesce(toxic, 0) = 1) AS toxic FROM labels GROUP BY 1),
t AS (SELECT d.doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents d),
f AS (
  SELECT part, coalesce(g.good, false) AS good, coalesce(g.toxic, false) AS toxic,
    {'A': len(w) < 100, 'B': 100 * len(list_distinct(w)) < 80 * len(w),
     'C': 100 * (length(text) - length(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) > 10 * length(text),
     'D': regexp_matches(text, '[#$%&*|]'), 'E': coalesce(t.doc_id > min(t.doc_id) OVER (PARTITION BY text), false)} AS f
  FROM t LEFT JOIN g ON g.doc_id = t.doc_id),
bits AS (SELECT part, good, toxic, [f.A, f.B, f.C, f.D, f.E] AS b FROM f),
cell AS (SELECT part, b, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM bits GROUP BY 1, 2),
o AS (
  SELECT '' AS o UNION ALL
  SELECT o || l FROM o, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l) WHERE length(o) < 5 AND NOT contains(o, l)),
steps AS (
  SELECT o AS filter_order, step, ascii(substr(o, step, 1)) - 64 AS pos, list_transform(range(1, step), lambda i: ascii(substr(o, CAST(i AS INT), 1)) - 64) AS before
  FROM (SELECT o, unnest(range(1, 6)) AS step FROM o WHERE length(o) = 5)),
r AS (
  SELECT part, filter_order, CAST(step AS INT) AS step, s.pos,
    CAST(coalesce(sum(n) FILTER (NOT early AND NOT here), 0) AS BIGINT) AS kept,
    CAST(coalesce(sum(n) FILTER (NOT early AND here), 0) AS BIGINT) AS removed,
    CAST(coalesce(sum(n) FILTER (early AND here), 0) AS BIGINT) AS redundant,
    CAST(coalesce(sum(n) FILTER (here AND fails = 1), 0) AS BIGINT) AS unique_fails,
    CAST(coalesce(sum(good) FILTER (NOT early AND here), 0) AS BIGINT) AS good_lost,
    CAST(coalesce(sum(toxic) FILTER (NOT early AND here), 0) AS BIGINT) AS toxic_lost
  FROM (SELECT cell.*, steps.*, b[pos] AS here, len(list_filter(before, lambda i: b[i])) > 0 AS early, len(list_filter(b, lambda x: x)) AS fails FROM cell, steps) s
  GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, pos) AS BIGINT) AS shapley
FROM r""",
    "op13_prefix_trie": r"""
WITH own AS (
  SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS s
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY 1),
crc AS (  -- CRC-32 of the id's decimal digits, bit by bit
  SELECT conv_id, s, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, (x & 1) * 3988292384)))) % 9 AS h
  FROM own),
rebuilt AS (
  SELECT o.conv_id AS c, list_concat(coalesce(b.s[1:h], []), o.s[h + 1:]) AS s FROM crc o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 5),
place AS (SELECT c, d, s[1:d] AS p, len(s) = d AS ends FROM (SELECT c, s, unnest(range(0, len(s) + 1)) AS d FROM rebuilt)),
node AS (
  SELECT d, p, min(c) AS m, count(*) AS n, octet_length(encode(any_value(p)[d].t)) AS bytes,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '')) AS e
  FROM place GROUP BY d, p),
path AS (SELECT c, place.d, m FROM place JOIN node ON node.d = place.d AND node.p = place.p),
up AS (SELECT node.*, path.m AS parent FROM node LEFT JOIN path ON path.c = node.m AND path.d = node.d - 1),
kids AS (SELECT parent, d - 1 AS d, count(*) AS k FROM up WHERE parent IS NOT NULL GROUP BY 1, 2),
one AS (SELECT up.*, coalesce(k, 0) AS k FROM up LEFT JOIN kids ON kids.parent = up.m AND kids.d = up.d),
total AS (
  SELECT path.m, path.d, sum(CASE WHEN k = 0 THEN 1 ELSE 0 END) AS leaves, sum(coalesce((n - 1) * bytes, 0)) AS saved
  FROM one JOIN path ON path.c = one.m AND path.d <= one.d GROUP BY 1, 2)
SELECT one.m AS conv_id, CAST(one.d AS BIGINT) AS depth, parent AS parent_conv_id, n AS n_convs, k AS n_children, CAST(leaves AS BIGINT) AS n_leaves,
       CAST(saved AS BIGINT) AS saved_tokens, e AS ends_sha256
FROM one JOIN total ON total.m = one.m AND total.d = one.d""",
}
