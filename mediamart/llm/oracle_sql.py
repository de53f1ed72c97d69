"""DuckDB SQL of operators whose rows it can express: 1 (near duplicates), 11
(periodic runs), 13 (spelling variants). It takes every pair that shares a shingle,
six words or a deletion."""

from __future__ import annotations

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NEAR_SQL = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, array_to_string(w, ' ') AS words,
         CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
              ELSE list_distinct(list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' ')))
         END AS shingles
  FROM w
), d AS (
  SELECT doc_id, len(shingles) AS n_shingles, shingles,
         CASE WHEN words = '' THEN doc_id ELSE min(doc_id) OVER (PARTITION BY words) END AS class_id
  FROM s
), c AS (SELECT class_id, n_shingles, unnest(shingles) AS shingle FROM d WHERE doc_id = class_id),
p AS (
  SELECT a.class_id AS u, b.class_id AS v, any_value(a.n_shingles) AS n, any_value(b.n_shingles) AS m, count(*) AS shared
  FROM c a JOIN c b ON a.shingle = b.shingle AND a.class_id < b.class_id GROUP BY 1, 2
), l AS (SELECT u, v FROM p WHERE 100 * shared >= 85 * (n + m - shared)),
e AS (SELECT u, v FROM l UNION ALL SELECT v, u FROM l),
reach(node, reached) AS (
  SELECT DISTINCT u, u FROM e
  UNION
  SELECT reach.node, e.v FROM reach JOIN e ON reach.reached = e.u
), k AS (SELECT node, min(reached) AS component FROM reach GROUP BY 1)
SELECT d.doc_id, n_shingles::BIGINT AS n_shingles, class_id, coalesce(component, class_id) AS component_id,
       d.doc_id = coalesce(component, class_id) AS kept
FROM d LEFT JOIN k ON d.class_id = k.node
"""

# DuckDB has no crc32: its 256 steps a byte come from the polynomial.
STEPS = """t AS (
  SELECT list(list_reduce(generate_series(0, 7), lambda c, _: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, b)
              ORDER BY b) AS steps
  FROM generate_series(0, 255) AS g(b)
)"""
CRC = """xor(list_reduce(list_transform(generate_series(1, len(hexed), 2), lambda i: ('0x' || hexed[i:i + 1])::BIGINT),
                                 lambda crc, byte: xor(crc // 256, steps[xor(crc % 256, byte) + 1]), 4294967295), 4294967295)"""

SPELLING_SQL = f"""
WITH RECURSIVE {STEPS}, r AS (
  SELECT doc_id, run, count(*) AS c
  FROM (SELECT doc_id, unnest(regexp_extract_all({LOWER.format("text")}, '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents)
  WHERE length(run) >= 7 GROUP BY 1, 2
), b AS (SELECT run, c, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS hexed FROM r),
h AS (
  SELECT run, c, {CRC} AS h
  FROM b, t
), m AS (
  SELECT CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, c FROM h
), v AS (SELECT word, sum(c)::BIGINT AS n FROM m WHERE length(word) >= 7 GROUP BY 1 HAVING sum(c) >= 2),
x AS (
  SELECT word, i, left(word, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, unnest(generate_series(1, length(word))) AS i FROM v)
), near AS (
  SELECT a.word, b.word AS other FROM x a JOIN x b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT x.word, v.word FROM x JOIN v ON x.rest = v.word
  UNION SELECT v.word, x.word FROM x JOIN v ON x.rest = v.word
), best AS (
  SELECT near.word, count(*) AS n_near, arg_min(other, (-v.n, other)) AS form, max(v.n) AS form_n
  FROM near JOIN v ON near.other = v.word GROUP BY 1
), f AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 10 * v.n THEN form END AS form,
         CASE WHEN form_n >= 10 * v.n THEN form_n END AS form_n
  FROM v LEFT JOIN best ON v.word = best.word
), chain(word, reached, step) AS (
  SELECT word, word, 0 FROM f
  UNION ALL
  SELECT chain.word, f.form, step + 1 FROM chain JOIN f ON chain.reached = f.word WHERE f.form IS NOT NULL
), roots AS (SELECT word, arg_max(reached, step) AS root FROM chain GROUP BY 1)
SELECT f.word, form, root, n, n_near, form_n FROM f JOIN roots ON f.word = roots.word
"""

# A run of 12 words and two periods repeats six words in a row a period on.
RUNS_SQL = f"""
WITH {STEPS}, d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w, hex(encode(coalesce(doc_id::VARCHAR, ''))) AS hexed
  FROM documents
), h AS (
  SELECT doc_id, w, len(w) AS n,
         {CRC} AS h
  FROM d, t
), a AS (SELECT *, h // 10 AS g, CASE WHEN n > 0 THEN (h // 10) % n END AS a FROM h),
e AS (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
              THEN list_transform(generate_series(0, n - 1), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) ELSE w END AS w
  FROM (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a)
), k AS (
  SELECT doc_id, i, array_to_string(w[i + 1:i + 6], ' ') AS six
  FROM (SELECT doc_id, w, unnest(generate_series(0, n - 6)) AS i FROM e WHERE n >= 6)
), m AS (
  SELECT x.doc_id, x.i, y.i - x.i AS q FROM k x JOIN k y ON x.doc_id = y.doc_id AND x.six = y.six AND x.i < y.i
), g AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM m),
s AS (
  SELECT doc_id, q, min(i) AS s, count(*) + 5 + q AS l FROM g GROUP BY doc_id, q, island HAVING count(*) + 5 >= q AND count(*) + 5 + q >= 12
), r AS (
  SELECT * FROM s WHERE NOT EXISTS (
    SELECT 1 FROM s o WHERE o.doc_id = s.doc_id AND o.q < s.q AND o.s <= s.s AND o.s + o.l >= s.s + s.l)
), c AS (
  SELECT doc_id, count(*) AS n_runs, arg_max({{'s': s, 'l': l, 'q': q}}, (l, -s, -q)) AS top,
         string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS lines FROM r GROUP BY 1
), gone AS (SELECT DISTINCT doc_id, unnest(generate_series(s + q, s + l - 1)) AS i FROM r),
kept AS (
  SELECT u.doc_id, string_agg(word, ' ' ORDER BY u.i) AS text
  FROM (SELECT doc_id, unnest(w) AS word, unnest(generate_series(0, n - 1)) AS i FROM e WHERE n > 0) u
  ANTI JOIN gone ON u.doc_id = gone.doc_id AND u.i = gone.i GROUP BY 1
)
SELECT e.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, top.s::BIGINT AS "start", top.l::BIGINT AS length, top.q::BIGINT AS period,
       (1000 * top.l // top.q)::BIGINT AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
       sha256(coalesce(kept.text, '')) AS collapsed_sha256, n::BIGINT AS n_words
FROM e LEFT JOIN c ON e.doc_id = c.doc_id LEFT JOIN kept ON e.doc_id = kept.doc_id
"""
