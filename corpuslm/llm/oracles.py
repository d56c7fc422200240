"""DuckDB SQL for the queries that SQL can express on whole tables.  The SQL
works by another way than the operators: every window of every text is joined,
without hashes, prefixes or bands."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

ORACLES["op8_prefix_set_join"] = """
WITH low AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
             FROM documents),
     docs AS (SELECT row_number() OVER () AS r, doc_id,
                     regexp_extract_all(t, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM low),
     items AS (SELECT CAST(item_id AS VARCHAR) AS item,
                      regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
               FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
     starts AS (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM items WHERE len(w) > 0),
     windows AS (SELECT DISTINCT item, list_slice(w, i, i + 12) AS win FROM starts),
     sizes AS (SELECT DISTINCT len(win) AS n FROM windows),
     cells AS (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, sizes WHERE len(w) >= n),
     found AS (SELECT c.r, c.i, c.n, x.item FROM cells c JOIN windows x ON list_slice(c.w, c.i, c.i + c.n - 1) = x.win),
     hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM found) GROUP BY r),
     named AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
               FROM (SELECT DISTINCT r, item FROM found) GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(m.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(m.ids, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(d.w) AS contaminated
FROM docs d LEFT JOIN hit h USING (r) LEFT JOIN named m USING (r)
"""

# all pairs of texts that share a shingle, exact Jaccard of the shingle sets; classes by recursive reachability
ORACLES["op6_prob_minhash"] = """
WITH RECURSIVE
     texts AS (SELECT row_number() OVER () AS n, text FROM (SELECT DISTINCT text FROM documents WHERE text IS NOT NULL)),
     words AS (SELECT n, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM texts),
     cells AS (SELECT n, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0),
     sets AS (SELECT DISTINCT n, list_slice(w, i, i + 4) AS s FROM cells),
     sizes AS (SELECT n, count(*) AS size FROM sets GROUP BY n),
     shared AS (SELECT a.n AS a, b.n AS b, count(*) AS k FROM sets a JOIN sets b ON a.s = b.s AND a.n < b.n GROUP BY 1, 2),
     links AS (SELECT a, b FROM shared JOIN sizes x ON x.n = a JOIN sizes y ON y.n = b
               WHERE k >= 0.8 * (x.size + y.size - k)),
     edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
     reach(n, m) AS (SELECT n, n FROM texts UNION SELECT r.n, e.b FROM reach r JOIN edges e ON e.a = r.m),
     comp AS (SELECT n, min(m) AS c FROM reach GROUP BY n),
     rows AS (SELECT d.doc_id, c.c FROM documents d JOIN texts t ON t.text = d.text JOIN comp c ON c.n = t.n),
     named AS (SELECT c, min(doc_id) AS class_id FROM rows GROUP BY c),
     found AS (SELECT doc_id, class_id FROM rows JOIN named USING (c)
               UNION ALL SELECT doc_id, doc_id FROM documents WHERE text IS NULL)
SELECT doc_id, class_id, doc_id IS NOT DISTINCT FROM class_id AS is_first FROM found
"""

# whole conversations compared turn by turn, every prefix against every conversation
ORACLES["op1_snapshot_collapse"] = """
WITH conv AS (SELECT conv_id, list({'r': role, 'x': text} ORDER BY turn) AS t, count(*) AS n
              FROM conversations GROUP BY conv_id),
     kept AS (SELECT a.* FROM conv a WHERE NOT EXISTS (
                SELECT 1 FROM conv b WHERE b.n > a.n AND list_slice(b.t, 1, a.n) = a.t)),
     one AS (SELECT min(conv_id) AS conv_id, count(*) AS n_copies, t, n FROM kept GROUP BY t, n)
SELECT conv_id, CAST(0 AS BIGINT) AS part, CAST(n AS BIGINT) AS n_turns, CAST(n_copies AS BIGINT) AS n_copies,
       array_to_string(list_transform(t, lambda s: '<|im_start|>' || coalesce(s.r, '') || chr(10) || coalesce(s.x, '')
                                                   || '<|im_end|>' || chr(10)), '') AS text
FROM one
"""

# every anchor against every row, component by component
ORACLES["op13_strassen"] = """
WITH e AS MATERIALIZED (
       SELECT row_number() OVER () AS n, vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
              list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
       WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
         AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
     scored AS MATERIALIZED (
       SELECT a.n, a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, coalesce(CAST(list_sum(list_transform(
              list_zip(a.v, b.v), lambda z: z[1] * z[2])) AS BIGINT), 0) AS score
       FROM e a JOIN e b ON a.vec_id % 100 = 0 AND (a.label <> b.label OR a.vec_id <> b.vec_id)),
     pos AS (SELECT n, anchor_id, other AS positive_id, score AS positive_score,
                    row_number() OVER (PARTITION BY n ORDER BY score DESC, other) AS place FROM scored WHERE same),
     neg AS (SELECT p.*, s.other AS negative_id, s.score AS negative_score,
                    row_number() OVER (PARTITION BY p.n, p.place ORDER BY s.score DESC, s.other) AS rank
             FROM pos p JOIN scored s ON s.n = p.n AND NOT s.same AND 30 * p.positive_score <= 100 * s.score
                                         AND 100 * s.score <= 90 * p.positive_score
             WHERE p.place <= 5)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM neg WHERE rank <= 10
"""

# every prefix of every rebuilt conversation as a list of its turns
ORACLES["op12_prefix_trie"] = """
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL),
     own AS (SELECT conv_id, list({'r': r, 'x': x} ORDER BY turn NULLS FIRST, sha256(length(r) || ':' || r || x)) AS s
             FROM t GROUP BY conv_id),
     crc AS (SELECT conv_id, xor(4294967295, list_reduce(
               list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
               lambda a, b: list_reduce(list_prepend(xor(a, b), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])),
                                        lambda y, z: CASE WHEN y % 2 = 1 THEN xor(y >> 1, 3988292384) ELSE y >> 1 END))) % 9 AS h FROM own),
     seqs AS MATERIALIZED (
       SELECT a.conv_id, list_concat(coalesce(b.s, [])[1:c.h], a.s[c.h + 1:]) AS s
       FROM own a JOIN crc c USING (conv_id) LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 5),
     cut AS (SELECT conv_id, s, unnest(range(0, len(s) + 1)) AS depth FROM seqs),
     nodes AS MATERIALIZED (
       SELECT s[1:depth] AS k, depth, min(conv_id) AS conv_id, count(*) AS n,
              sha256(coalesce(array_to_string(list(conv_id ORDER BY conv_id) FILTER (WHERE len(s) = depth), ','), '')) AS ends
       FROM cut GROUP BY 1, 2),
     kids AS (SELECT k[1:depth - 1] AS k, depth - 1 AS depth, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1, 2),
     own_sums AS (SELECT a.k, a.depth, CASE WHEN c.n IS NULL THEN 1 ELSE 0 END AS leaf,
                         CASE WHEN a.depth = 0 THEN 0 ELSE (a.n - 1) * strlen(a.k[a.depth].x) END AS saved
                  FROM nodes a LEFT JOIN kids c ON c.k = a.k AND c.depth = a.depth),
     sums AS (SELECT k[1:d] AS k, d AS depth, sum(leaf) AS leaves, sum(saved) AS saved
              FROM (SELECT k, leaf, saved, unnest(range(0, depth + 1)) AS d FROM own_sums) GROUP BY 1, 2)
SELECT a.conv_id, a.depth, p.conv_id AS parent_conv_id, a.n AS n_convs, coalesce(c.n, 0) AS n_children,
       CAST(s.leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, a.ends AS ends_sha256
FROM nodes a JOIN sums s ON s.k = a.k AND s.depth = a.depth
     LEFT JOIN kids c ON c.k = a.k AND c.depth = a.depth
     LEFT JOIN nodes p ON a.depth > 0 AND p.depth = a.depth - 1 AND p.k = a.k[1:a.depth - 1]
"""
