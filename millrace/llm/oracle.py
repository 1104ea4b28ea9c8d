"""DuckDB SQL for the queries that SQL can express; the others are compared with plain Python in the tests."""

from __future__ import annotations

ASCII_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = rf"regexp_extract_all({ASCII_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE: dict[str, str] = {}

ORACLE["op1_decontamination"] = rf"""
WITH d AS (SELECT DISTINCT doc_id, text FROM documents),
dw AS (SELECT doc_id, text, {WORDS} AS w FROM d),
bw AS (SELECT DISTINCT coalesce(CAST(item_id AS varchar), '') AS item_id, {WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, len(w[i:i + 12]) AS n, array_to_string(w[i:i + 12], ' ') AS x
  FROM (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - 11))) AS i FROM bw WHERE len(w) > 0)
),
spot AS (SELECT doc_id, text, n, i, array_to_string(w[i:i + n - 1], ' ') AS x
       FROM (SELECT doc_id, text, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, (SELECT DISTINCT n FROM win))),
met AS (SELECT spot.doc_id, spot.text, win.item_id, spot.n, spot.i FROM spot JOIN win USING (n, x)),
hit AS (SELECT doc_id, text, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, text, unnest(range(i, i + n)) AS p FROM met) GROUP BY ALL),
items AS (SELECT doc_id, text, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
          FROM (SELECT DISTINCT doc_id, text, item_id FROM met) GROUP BY ALL)
SELECT dw.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw
LEFT JOIN hit ON dw.doc_id IS NOT DISTINCT FROM hit.doc_id AND dw.text IS NOT DISTINCT FROM hit.text
LEFT JOIN items ON dw.doc_id IS NOT DISTINCT FROM items.doc_id AND dw.text IS NOT DISTINCT FROM items.text
"""

ORACLE["op3_line_repeats"] = rf"""
WITH d AS (SELECT doc_id, text, regexp_extract_all(coalesce(text, ''), '[^\n.!?。！？]*[\n.!?。！？]+[ \t\r\n\f\v]*|[^\n.!?。！？]+') AS parts FROM documents),
p AS (
  SELECT doc_id, parts[i] AS part, i, CAST(coalesce(list_sum(list_transform(parts[1:i - 1], lambda x: length(x))), 0) AS bigint) AS start
  FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM d)
),
w AS (SELECT doc_id, start, start + length(part) AS stop, i,
             list_filter(regexp_split_to_array({ASCII_LOWER.replace("coalesce(text, '')", "part")}, '[ \t\r\n\f\v]+'), lambda q: q <> '') AS w FROM p),
u AS (SELECT doc_id, start, stop, len(w) AS words, array_to_string(w, ' ') AS x, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS nth FROM w WHERE len(w) > 0),
k AS (SELECT x, min({{'d': doc_id, 's': start}}) AS kept FROM u GROUP BY x HAVING count(*) > 1),
r AS (SELECT u.*, kept, nth - row_number() OVER (PARTITION BY doc_id ORDER BY nth) AS run FROM u JOIN k USING (x) WHERE NOT (doc_id = kept.d AND start = kept.s)),
s AS (SELECT doc_id, min(start) AS start, max(stop) AS stop, arg_min(kept, start) AS kept FROM r GROUP BY doc_id, run HAVING sum(words) >= 20),
c AS (SELECT doc_id, list({{'a': start, 'b': stop, 'k': kept}} ORDER BY start) AS c FROM s GROUP BY doc_id)
SELECT doc_id, coalesce(len(c), 0) AS n_removed,
       coalesce(array_to_string(list_transform(c, lambda x: x.a || ':' || x.b || ':' || x.k.d || ':' || x.k.s), ','), '') AS removed,
       CASE WHEN c IS NULL THEN text ELSE array_to_string(list_transform(range(0, len(c) + 1), lambda j: substring(text,
         CAST((CASE WHEN j = 0 THEN 0 ELSE c[j].b END) + 1 AS bigint),
         CAST((CASE WHEN j = len(c) THEN length(text) ELSE c[j + 1].a END) - (CASE WHEN j = 0 THEN 0 ELSE c[j].b END) AS bigint))), '') END AS text
FROM documents LEFT JOIN c USING (doc_id)
"""

ORACLE["op8_chat"] = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
),
e AS (
  SELECT *, length(replace(replace(replace(text, '\', '\0'), '<', '\1'), '[', '\2')) AS text_chars,
         length(replace(replace(replace(replace(role, '\', '\0'), '<', '\1'), '[', '\2'), chr(10), '\3')) AS role_chars FROM c
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS bigint) AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
       CAST(sum(text_chars + role_chars + length('<|im_start|>') + 1 + length('<|im_end|>') + 1) AS bigint) AS formatted_chars
FROM e GROUP BY conv_id
"""

ORACLE["op11_turn_trie"] = r"""
WITH tab AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, j: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS crc),
own AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
),
h AS (
  SELECT conv_id, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS varchar), ''), lambda c: CAST(ord(c) AS bigint))),
         lambda c, b: xor(tab.crc[(xor(c, b) & 255) + 1], c >> 8))) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM own), tab
),
turns AS (
  SELECT conv_id, 1 AS part, pos, role, text FROM own JOIN h USING (conv_id) WHERE pos >= h
  UNION ALL SELECT h.conv_id, 0, pos, role, text FROM h JOIN own ON own.conv_id = h.conv_id - h.conv_id % 5 WHERE pos < h
),
seq AS (
  SELECT h.conv_id, coalesce(list(md5(CAST(length(role) AS varchar) || ':' || role || text) ORDER BY part, pos) FILTER (text IS NOT NULL), []) AS ids,
         coalesce(list(strlen(text) ORDER BY part, pos) FILTER (text IS NOT NULL), []) AS sizes
  FROM h LEFT JOIN turns USING (conv_id) GROUP BY h.conv_id
),
pre AS (SELECT conv_id, ids, sizes, unnest(range(0, len(ids) + 1)) AS d FROM seq),
node AS (
  SELECT d AS depth, ids[1:d] AS p, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(any_value(sizes[d]), 0) AS size,
         sha256(coalesce(string_agg(CAST(conv_id AS varchar), ',' ORDER BY conv_id) FILTER (len(ids) = d), '')) AS ends_sha256
  FROM pre GROUP BY ALL
),
kids AS (SELECT depth - 1 AS depth, p[1:depth - 1] AS p, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY ALL),
full_ AS (SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN kids USING (depth, p)),
up AS (SELECT p, n_convs, size, n_children, unnest(range(0, depth + 1)) AS a FROM full_),
sub AS (SELECT a AS depth, p[1:a] AS p, CAST(count(*) FILTER (n_children = 0) AS bigint) AS n_leaves, CAST(sum((n_convs - 1) * size) AS bigint) AS saved_tokens FROM up GROUP BY ALL)
SELECT f.conv_id, f.depth, parent.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves, saved_tokens, f.ends_sha256
FROM full_ f JOIN sub USING (depth, p) LEFT JOIN node parent ON parent.depth = f.depth - 1 AND parent.p = f.p[1:f.depth - 1]
"""

ORACLE["op12_collocations"] = rf"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({ASCII_LOWER}, '[.,;:!?\x0A-\x0D]')) AS x FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(x, '[ \t]+'), lambda q: q <> '') AS w FROM t),
g AS (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS p
      FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w), (SELECT unnest(range(1, 5)) AS m) WHERE i + m - 1 <= len(w)),
f AS (SELECT lang, m, p, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT lang, m, p, f AS a, string_split(p, ' ') AS w FROM f WHERE m >= 2),
k AS (SELECT lang, m, p, a, w, unnest(range(1, m)) AS k FROM c),
s AS (SELECT k.lang, k.p, k.a, k.k, x.f AS l, y.f AS r, CAST(2000000 * CAST(k.a AS hugeint) // (x.f + y.f) AS bigint) AS score
      FROM k JOIN f x ON x.lang = k.lang AND x.p = array_to_string(k.w[1:k.k], ' ') JOIN f y ON y.lang = k.lang AND y.p = array_to_string(k.w[k.k + 1:], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
i AS (SELECT lang, array_to_string(w[i:i + size - 1], ' ') AS p, max(a) AS inside
      FROM (SELECT lang, w, a, size, unnest(range(1, m - size + 2)) AS i FROM c, (SELECT unnest(range(2, 4)) AS size) WHERE size < m) GROUP BY ALL),
n AS (SELECT lang, CAST(sum(len(w)) AS bigint) AS n FROM w GROUP BY lang)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, encode(b.p)) AS rank, b.p AS phrase, a, l, r, n, score
FROM b JOIN n USING (lang) LEFT JOIN i ON i.lang = b.lang AND i.p = b.p
WHERE inside IS NULL OR 100 * CAST(inside AS hugeint) < 80 * CAST(a AS hugeint)
QUALIFY rank <= 2000
"""
