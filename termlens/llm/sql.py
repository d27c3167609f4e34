"""DuckDB SQL for the queries that SQL can express, written from their contracts."""

OP1 = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS k
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w)),
own AS (SELECT k, min(doc_id) AS m FROM win GROUP BY k),
gone AS (SELECT DISTINCT doc_id, i + j AS p
         FROM (SELECT doc_id, i, unnest(range(0, 13)) AS j FROM win JOIN own USING (k) WHERE m < doc_id)),
word AS (SELECT doc_id, p, ws[p] AS word FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS p FROM w)),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
cut AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(cut.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.kept, '')) AS kept_sha256
FROM w LEFT JOIN cut USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

OP8 = """
WITH RECURSIVE v AS (
  SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS n
  FROM (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
        WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)),
link AS MATERIALIZED (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE a.n > 0 AND b.n > 0 AND list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.95),
reach AS (SELECT vec_id AS x, vec_id AS c FROM embeddings
          UNION SELECT l.y, r.c FROM reach r JOIN link l ON l.x = r.x),
least AS (SELECT x, min(c) AS c FROM reach GROUP BY x),
deg AS (SELECT x, count(*) AS n FROM link GROUP BY x)
SELECT e.vec_id, CAST(coalesce(deg.n, 0) AS BIGINT) AS n_links, least.c AS component_id, e.vec_id = least.c AS kept
FROM embeddings e JOIN least ON least.x = e.vec_id LEFT JOIN deg ON deg.x = e.vec_id
"""

_FOLD = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP12 = rf"""
WITH t AS (SELECT doc_id, regexp_extract_all({_FOLD.format('text')}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
d AS (SELECT doc_id, len(ts) AS n FROM t WHERE len(ts) > 0),
g AS (SELECT count(*) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM d),
p AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(ts) AS term FROM t) GROUP BY ALL),
f AS (SELECT term, count(*) AS df FROM p GROUP BY term),
q AS (SELECT item_id, term, count(*) AS c FROM (
        SELECT item_id, unnest(regexp_extract_all({_FOLD.format('text')}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w FROM f, g),
s AS (SELECT item_id, doc_id, CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * nn) // ll)))) AS BIGINT) AS score
      FROM q JOIN w USING (term) JOIN p USING (term) JOIN d USING (doc_id), g GROUP BY ALL)
SELECT item_id, rank, doc_id, score
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM s WHERE score > 0)
WHERE rank <= 10
"""

OP13 = rf"""
WITH w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_FOLD.format('text')}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
total AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (SELECT lang, m, array_to_string(ws[i:i + m - 1], ' ') AS phrase, count(*) AS f
      FROM (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w), (SELECT unnest(range(1, 6)) AS m)
      WHERE i + m - 1 <= len(ws) GROUP BY ALL),
c AS (SELECT * FROM g WHERE m >= 2 AND f >= 100),
cut AS (SELECT lang, phrase, f, k, array_to_string(ws[1:k], ' ') AS x, array_to_string(ws[k + 1:], ' ') AS y
        FROM (SELECT *, unnest(range(1, m)) AS k FROM (SELECT *, string_split(phrase, ' ') AS ws FROM c))),
s AS (SELECT cut.lang, cut.phrase, cut.f AS a, cut.k, x.f AS l, y.f AS r, n,
             CAST((1000::HUGEINT * cut.f * n) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
      FROM cut JOIN g x ON x.lang = cut.lang AND x.phrase = cut.x JOIN g y ON y.lang = cut.lang AND y.phrase = cut.y JOIN total ON total.lang = cut.lang),
one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS rn FROM s) WHERE rn = 1),
kept AS (SELECT * FROM one WHERE NOT EXISTS (
           SELECT 1 FROM c WHERE c.lang = one.lang AND len(c.phrase) > len(one.phrase) AND 100 * c.f >= 100 * one.a
           AND contains(' ' || c.phrase || ' ', ' ' || one.phrase || ' ')))
SELECT lang, rank, phrase, a, l, r, n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) WHERE rank <= 2000
"""

SQL = {"op1_substring": OP1, "op8_embeddings": OP8, "op12_search": OP12, "op13_collocations": OP13}
