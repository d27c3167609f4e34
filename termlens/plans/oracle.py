"""Equivalent DuckDB SQL for the registered queries (the correctness oracle).

The SQL is written independently of the Spark code: plain GROUP BY /
JOIN / window SQL over the driver's views.  Shared CTE fragments are
built here once.
"""

from __future__ import annotations

from termlens.functions.text import STOPWORDS

# The white space that separates words (29 code points), and what is deleted before the split.
SPACE = r"\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
NON_WORD_PATTERN = rf"[^\p{{L}}\p{{N}}_{SPACE}]"
SPLIT_PATTERN = rf"[{SPACE}]+"

def _quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


STOP_SQL = ", ".join(_quote(w) for w in STOPWORDS)


def terms_cte(name: str, table: str, id_expr: str, text_expr: str = "text") -> str:
    """CTE ``name(id, term)``: distinct non-stopword terms per row."""
    return f"""{name} AS (
  SELECT DISTINCT id, term FROM (
    SELECT {id_expr} AS id,
           unnest(string_split_regex(regexp_replace(lower({text_expr}), '{NON_WORD_PATTERN}', '', 'g'),
                                     '{SPLIT_PATTERN}')) AS term
    FROM {table}) t
  WHERE term <> '' AND term NOT IN ({STOP_SQL}))"""


def tokens_cte(name: str, table: str, id_expr: str, text_expr: str = "text") -> str:
    """CTE ``name(id, pos, term)``: all non-stopword tokens in order."""
    return f"""{name} AS (
  SELECT id, pos, term FROM (
    SELECT id, term, row_number() OVER (PARTITION BY id ORDER BY ord) AS pos FROM (
      SELECT {id_expr} AS id, unnest(toks) AS term, generate_subscripts(toks, 1) AS ord FROM (
        SELECT *, string_split_regex(regexp_replace(lower({text_expr}), '{NON_WORD_PATTERN}', '', 'g'),
                                     '{SPLIT_PATTERN}') AS toks FROM {table}) a) b
    WHERE term <> '' AND term NOT IN ({STOP_SQL})) c)"""


def doc_index_ctes(policy: str = "both") -> str:
    """CTEs dt(doc_id, term, w), n(n), df(term, df), kept(term, doc_id, w, df)."""
    cond = {
        "both": "df.df > 1 AND df.df < n.n",
        "universal": "df.df < n.n",
        "single": "df.df > 1",
        "none": "TRUE",
    }[policy]
    return f"""{terms_cte('dt0', 'documents', 'doc_id')},
dw AS (SELECT id AS doc_id, count(*) AS w FROM dt0 GROUP BY id),
dt AS (SELECT dt0.term, dt0.id AS doc_id, dw.w FROM dt0 JOIN dw ON dt0.id = dw.doc_id),
n AS (SELECT count(*) AS n FROM documents),
df AS (SELECT term, count(*) AS df FROM dt GROUP BY term),
kept AS (SELECT dt.term, dt.doc_id, dt.w, df.df FROM dt JOIN df USING (term), n WHERE {cond})"""


def idf_expr(df: str, n: str) -> str:
    """Normalised IDF with the same guards as the Spark expression."""
    return (f"CASE WHEN {n} <= 1 THEN 0.5 WHEN {df} = 0 OR {n} = 0 THEN 0.0 "
            f"ELSE ln({n}::DOUBLE / {df}::DOUBLE) / ln({n}::DOUBLE) END")


def r(x: str, digits: int) -> str:
    """floor(x * 10^k + 0.5) / 10^k, the engine-neutral rounding."""
    scale = float(10 ** digits)
    return f"(floor(({x})::DOUBLE * {scale} + 0.5) / {scale})"


def f1_sql(m: str, q: str, e: str) -> str:
    rec = f"(CASE WHEN {q} > 0 THEN {m}::DOUBLE / {q}::DOUBLE ELSE 0.0 END)"
    pre = f"(CASE WHEN {e} > 0 THEN {m}::DOUBLE / {e}::DOUBLE ELSE 0.0 END)"
    return f"(CASE WHEN {pre} + {rec} = 0 THEN 0.0 ELSE 2.0 * ({pre} * {rec}) / ({pre} + {rec}) END)"


def overlap_sql(m: str, q: str, e: str) -> str:
    return f"(CASE WHEN least({q}, {e}) = 0 THEN 0.0 ELSE {m}::DOUBLE / least({q}, {e})::DOUBLE END)"


def jaccard_sql(m: str, a: str, b: str) -> str:
    return f"(CASE WHEN {a} + {b} - {m} > 0 THEN {m}::DOUBLE / ({a} + {b} - {m})::DOUBLE ELSE 0.0 END)"


def jpii_ctes(policy: str = "both") -> str:
    """CTEs up to ``jp(query_id, doc_id, match_count, w_query, w_doc, similarity)``
    for the benchmark queries against the documents."""
    return f"""{doc_index_ctes(policy)},
{terms_cte('qt', 'benchmark', 'item_id')},
qw AS (SELECT id AS query_id, count(*) AS wq FROM qt GROUP BY id),
mm AS (SELECT qt.id AS query_id, kept.doc_id, kept.w, count(*) AS match_count
       FROM qt JOIN kept USING (term) GROUP BY qt.id, kept.doc_id, kept.w),
jp AS (SELECT mm.query_id, mm.doc_id, mm.match_count, qw.wq AS w_query, mm.w AS w_doc,
              {jaccard_sql('mm.match_count', 'qw.wq', 'mm.w')} AS similarity
       FROM mm JOIN qw USING (query_id))"""


def ranked_sql(src: str, ratio: float, version: int, k: int = 5) -> str:
    """Top-k per query of JPII rows in ``src`` with layer-1 ratio and v1/v3 keys."""
    ov = overlap_sql("match_count", "w_query", "w_doc")
    f = f1_sql("match_count", "w_query", "w_doc")
    if version == 3:
        keys = f"{r('similarity', 2)} DESC, {r('f1', 3)} DESC, overlap DESC, match_count DESC, doc_id"
    else:
        keys = f"{r('similarity', 4)} DESC, overlap DESC, match_count DESC, doc_id"
    return f"""SELECT query_id, rank, doc_id, jaccard, f1, overlap, match_count FROM (
  SELECT query_id, doc_id, similarity AS jaccard, f1, overlap, match_count,
         row_number() OVER (PARTITION BY query_id ORDER BY {keys}) AS rank
  FROM (SELECT *, {ov} AS overlap, {f} AS f1 FROM {src}
        WHERE match_count::DOUBLE >= w_query::DOUBLE * {ratio}) c) z
WHERE rank <= {k}"""


# ---------------------------------------------------------------------------
# Oracle SQL per registered query key.
SQL: dict[str, str] = {}

SQL["tokenize_terms"] = f"""WITH {terms_cte('dt0', 'documents', 'doc_id')}
SELECT id AS doc_id, term FROM dt0"""

SQL["doc_weights"] = f"""WITH {terms_cte('dt0', 'documents', 'doc_id')},
dw AS (SELECT id, count(*) AS w FROM dt0 GROUP BY id)
SELECT d.doc_id, coalesce(dw.w, 0)::BIGINT AS w FROM documents d LEFT JOIN dw ON d.doc_id = dw.id"""

SQL["jpii_scores"] = f"""WITH {jpii_ctes()}
SELECT * FROM jp"""

SQL["jpii_ranked_v3"] = f"""WITH {jpii_ctes()}
{ranked_sql('jp', 0.1, 3)}"""

for _p in ("both", "universal", "single"):
    SQL[f"index_postings_{_p}"] = f"""WITH {doc_index_ctes(_p)}
SELECT term, doc_id, w, df FROM kept"""

SQL["index_lines"] = f"""WITH {doc_index_ctes()}
SELECT term, chunk, term || chr(9) || string_agg(doc_id::VARCHAR || '@' || w::VARCHAR, chr(9) ORDER BY w DESC, doc_id) AS line
FROM (SELECT term, doc_id, w, CAST((row_number() OVER (PARTITION BY term ORDER BY w DESC, doc_id) - 1) // 200 AS INTEGER) AS chunk
      FROM kept) z GROUP BY term, chunk"""

SQL["index_stats"] = f"""WITH {doc_index_ctes()}
SELECT count(DISTINCT term) AS terms, count(*) AS postings,
       CASE WHEN count(DISTINCT term) > 0 THEN count(*)::DOUBLE / count(DISTINCT term) ELSE 0.0 END AS avg_docs_per_term
FROM kept"""

SQL["term_df"] = f"""WITH {doc_index_ctes()}
SELECT term, df FROM df"""

_NP = "np AS (SELECT count(DISTINCT doc_id) AS np FROM kept)"

SQL["term_idf"] = f"""WITH {doc_index_ctes()}, {_NP}
SELECT DISTINCT term, df, {r(idf_expr('df', 'np.np'), 6)} AS idf FROM kept, np"""

SQL["idf_band_terms"] = f"""WITH {doc_index_ctes()}, {_NP}
SELECT DISTINCT term, df FROM kept, np WHERE {idf_expr('df', 'np.np')} BETWEEN 0.3 AND 0.9"""

SQL["jpii_ranked_v1"] = f"""WITH {jpii_ctes()}
{ranked_sql('jp', 0.5, 1)}"""

_QSTATS = f"""{_NP},
qs AS (SELECT DISTINCT qt.id AS query_id, qt.term, k.df, {idf_expr('k.df', 'np.np')} AS idf
       FROM qt JOIN (SELECT DISTINCT term, df FROM kept) k USING (term), np)"""

SQL["query_term_stats"] = f"""WITH {jpii_ctes()}, {_QSTATS}
SELECT query_id, term, df, {r('idf', 6)} AS idf, idf BETWEEN 0.3 AND 0.95 AS kept FROM qs"""

SQL["jpii_idf_scores"] = f"""WITH {jpii_ctes()}, {_QSTATS},
qk AS (SELECT * FROM qs WHERE idf BETWEEN 0.3 AND 0.95),
qw2 AS (SELECT query_id, count(*) AS wq2 FROM qk GROUP BY query_id),
m2 AS (SELECT qk.query_id, kept.doc_id, kept.w, count(*) AS match_count
       FROM qk JOIN kept USING (term) GROUP BY 1, 2, 3)
SELECT m2.query_id, m2.doc_id, m2.match_count, qw2.wq2 AS w_query, m2.w AS w_doc,
       {jaccard_sql('m2.match_count', 'qw2.wq2', 'm2.w')} AS similarity
FROM m2 JOIN qw2 USING (query_id)"""

SQL["max_df_jpii"] = f"""WITH {jpii_ctes()},
m3 AS (SELECT qt.id AS query_id, kept.doc_id, kept.w, count(*) AS match_count
       FROM qt JOIN kept USING (term) WHERE kept.df <= 100 GROUP BY 1, 2, 3)
SELECT m3.query_id, m3.doc_id, m3.match_count, qw.wq AS w_query, m3.w AS w_doc,
       {jaccard_sql('m3.match_count', 'qw.wq', 'm3.w')} AS similarity
FROM m3 JOIN qw USING (query_id)"""

SQL["jpii_ranked_labels"] = f"""WITH {jpii_ctes()}, rk AS ({ranked_sql('jp', 0.1, 3)})
SELECT rk.*, l.quality, l.toxic FROM rk LEFT JOIN labels l USING (doc_id)"""


def pair_ctes(lo: float | None = 0.05, hi: float | None = 0.95, extra: str = "",
              with_index: bool = True) -> str:
    """CTEs up to ``pj(doc_a, doc_b, match_count, w_a, w_b, similarity)``
    (and ``pr`` with sum_min / sum_max); ``with_index=False`` when the
    index CTEs are already defined."""
    band = "TRUE" if lo is None else f"{idf_expr('df', 'np.np')} BETWEEN {lo} AND {hi}"
    head = f"{doc_index_ctes()}, " if with_index else ""
    return f"""{head}{_NP}{extra},
kb AS (SELECT kept.* FROM kept, np WHERE {band}),
pr AS (SELECT a.doc_id AS doc_a, b.doc_id AS doc_b, a.w AS w_a, b.w AS w_b, count(*) AS match_count,
              sum(least(a.w, b.w))::BIGINT AS sum_min, sum(greatest(a.w, b.w))::BIGINT AS sum_max
       FROM kb a JOIN kb b ON a.term = b.term AND a.doc_id < b.doc_id GROUP BY 1, 2, 3, 4),
pj AS (SELECT doc_a, doc_b, match_count, w_a, w_b, {jaccard_sql('match_count', 'w_a', 'w_b')} AS similarity FROM pr)"""


SQL["pairwise_jaccard"] = f"""WITH {pair_ctes()}
SELECT * FROM pj"""

SQL["pairwise_weighted"] = f"""WITH {pair_ctes()}
SELECT doc_a, doc_b, w_a, w_b, match_count, sum_min, sum_max,
       CASE WHEN sum_max > 0 THEN sum_min::DOUBLE / sum_max::DOUBLE ELSE 0.0 END AS similarity FROM pr"""

SQL["pairwise_weighted_t"] = f"""WITH {pair_ctes()}
SELECT doc_a, doc_b, w_a, w_b, match_count, sum_min, sum_max, sum_min::DOUBLE / sum_max::DOUBLE AS similarity
FROM pr WHERE sum_min::DOUBLE / sum_max::DOUBLE >= 0.98"""

SQL["weighted_tf_jaccard"] = f"""WITH {doc_index_ctes()}, {_NP},
{tokens_cte('tk', 'documents', 'doc_id')},
tf AS (SELECT id AS doc_id, term, count(*) AS tf FROM tk GROUP BY 1, 2),
kb AS (SELECT kept.*, tf.tf FROM kept JOIN tf USING (doc_id, term), np
       WHERE {idf_expr('kept.df', 'np.np')} BETWEEN 0.05 AND 0.95),
pr AS (SELECT a.doc_id AS doc_a, b.doc_id AS doc_b, a.w AS w_a, b.w AS w_b, count(*) AS match_count,
              sum(least(a.tf, b.tf))::BIGINT AS sum_min, sum(greatest(a.tf, b.tf))::BIGINT AS sum_max
       FROM kb a JOIN kb b ON a.term = b.term AND a.doc_id < b.doc_id GROUP BY 1, 2, 3, 4)
SELECT doc_a, doc_b, w_a, w_b, match_count, sum_min, sum_max,
       CASE WHEN sum_max > 0 THEN sum_min::DOUBLE / sum_max::DOUBLE ELSE 0.0 END AS similarity FROM pr"""

SQL["pairwise_top10"] = f"""WITH {pair_ctes()}
SELECT * FROM (SELECT row_number() OVER (ORDER BY similarity DESC, doc_a, doc_b) AS rank,
                      doc_a, doc_b, similarity, match_count FROM pj) z WHERE rank <= 10"""

SQL["pairwise_ranked"] = f"""WITH {pair_ctes()}
SELECT * FROM (
  SELECT row_number() OVER (ORDER BY {r('similarity', 2)} DESC, {r('f1', 3)} DESC, overlap DESC,
                            match_count DESC, doc_a, doc_b) AS rank,
         doc_a, doc_b, similarity AS jaccard, f1, overlap, match_count
  FROM (SELECT *, {overlap_sql('match_count', 'w_a', 'w_b')} AS overlap,
               {f1_sql('match_count', 'w_a', 'w_b')} AS f1
        FROM pj WHERE match_count::DOUBLE >= w_a::DOUBLE * 0.1) c) z WHERE rank <= 5"""

SQL["pairwise_threshold"] = f"""WITH {pair_ctes(None)}
SELECT * FROM pj WHERE similarity >= 0.5"""

SQL["near_duplicates"] = f"""WITH {pair_ctes(None)}
SELECT * FROM pj WHERE similarity >= 0.8"""

SQL["recommend_per_doc"] = f"""WITH {pair_ctes()},
both_sides AS (SELECT doc_a AS doc_id, doc_b AS other, similarity, match_count FROM pj
               UNION ALL SELECT doc_b, doc_a, similarity, match_count FROM pj)
SELECT doc_id, rank, other, similarity, match_count FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY similarity DESC, match_count DESC, other) AS rank
  FROM both_sides) z WHERE rank <= 5"""

SQL["index_text_roundtrip"] = f"""WITH {doc_index_ctes()}
SELECT term, doc_id, w FROM kept"""

SQL["index_merge_duplicates"] = f"""WITH {doc_index_ctes()}
SELECT term, doc_id, w, df FROM kept"""

SQL["similarity_tsv_roundtrip"] = f"""WITH {jpii_ctes()}
SELECT * FROM jp"""

SQL["pairwise_tsv_lines"] = f"""WITH {pair_ctes(None)}
SELECT CASE WHEN doc_a::VARCHAR <= doc_b::VARCHAR THEN doc_a::VARCHAR || '-' || doc_b::VARCHAR
            ELSE doc_b::VARCHAR || '-' || doc_a::VARCHAR END AS pair,
       match_count, w_a, w_b, similarity FROM pj WHERE similarity >= 0.5"""

SQL["cells_unpivot"] = f"""WITH {doc_index_ctes()}
SELECT term AS row_key, 'docs:' || doc_id::VARCHAR AS "column", w::VARCHAR AS value FROM kept"""

_ESC = "replace(replace(replace(text, chr(9), ' '), chr(10), ' '), chr(13), ' ')"

_HASH = f"""hq AS (SELECT item_id AS query_id, substr(md5(text), 1, 8) AS query_hash, {_ESC} AS query_text FROM benchmark),
hr AS (SELECT hq.query_hash || ':' || jp.doc_id::VARCHAR AS row_key, hq.query_hash, jp.doc_id,
              {r('jp.similarity', 6)} AS jaccard, jp.match_count AS shared_terms, hq.query_text
       FROM jp JOIN hq USING (query_id))"""

SQL["query_hash_scores"] = f"""WITH {jpii_ctes()}, {_HASH}
SELECT * FROM hr"""

SQL["query_hash_topk"] = f"""WITH {jpii_ctes()}, {_HASH}
SELECT query_hash, rank, doc_id, jaccard, shared_terms FROM (
  SELECT *, row_number() OVER (PARTITION BY query_hash ORDER BY jaccard DESC, row_key) AS rank
  FROM hr WHERE jaccard >= 0.1) z WHERE rank <= 10"""

SQL["escaped_query_text"] = f"""SELECT conv_id, turn, {_ESC} AS text FROM conversations"""

SQL["cells_parse"] = f"""WITH {jpii_ctes()}, {_HASH}
SELECT term AS row_key, 'docs' AS family, doc_id::VARCHAR AS qualifier, w::VARCHAR AS value FROM kept
UNION ALL SELECT row_key, 'score', 'jaccard', printf('%.6f', jaccard) FROM hr
UNION ALL SELECT row_key, 'score', 'shared_terms', shared_terms::VARCHAR FROM hr"""

SQL["cells_import_totals"] = f"""WITH {jpii_ctes()}, {_HASH}
SELECT (SELECT count(*) FROM kept) + 2 * (SELECT count(*) FROM hr) AS cells,
       (SELECT count(*) FROM conversations) AS invalid,
       (SELECT count(*) FROM (SELECT term FROM kept UNION SELECT row_key FROM hr)) AS row_keys,
       (SELECT count(DISTINCT term) FROM kept) + 2 * (SELECT count(*) FROM hr)
         + (SELECT count(*) FROM conversations) AS lines"""

SQL["cells_import"] = f"""WITH {jpii_ctes()}, {_HASH}
SELECT (SELECT count(*) FROM kept) + 2 * (SELECT count(*) FROM hr) AS stored,
       (SELECT count(*) FROM (SELECT term FROM kept UNION SELECT row_key FROM hr)) AS row_keys,
       (SELECT count(DISTINCT term) FROM kept) + 2 * (SELECT count(*) FROM hr) + (SELECT count(*) FROM conversations) AS lines,
       (SELECT count(*) FROM kept) + 2 * (SELECT count(*) FROM hr) AS cells,
       (SELECT count(*) FROM conversations) AS invalid"""

_STORE = f"""{jpii_ctes()}, {pair_ctes(None, with_index=False)},
st AS (SELECT 'jpii' AS mode, query_id AS doc_a, doc_id AS doc_b, match_count, w_query AS w_a, w_doc AS w_b, similarity FROM jp
       UNION ALL SELECT 'pairwise', doc_a, doc_b, match_count, w_a, w_b, similarity FROM pj WHERE similarity >= 0.5)"""

SQL["store_write_read"] = f"""WITH {_STORE}
SELECT * FROM st"""

SQL["store_backup"] = SQL["store_write_read"]

SQL["store_counts"] = f"""WITH {_STORE}
SELECT mode, count(*) AS pairs FROM st GROUP BY mode"""

SQL["stored_document_pairs"] = f"""WITH {_STORE},
pw AS (SELECT * FROM st WHERE mode = 'pairwise'),
top AS (SELECT d FROM (SELECT doc_a AS d FROM pw UNION ALL SELECT doc_b FROM pw) e GROUP BY d ORDER BY count(*) DESC, d LIMIT 1)
SELECT * FROM pw WHERE doc_a IN (SELECT d FROM top) OR doc_b IN (SELECT d FROM top)"""

SQL["pipeline_jpii_idf"] = f"""WITH {jpii_ctes()}, {_QSTATS},
qk AS (SELECT * FROM qs WHERE idf BETWEEN 0.3 AND 0.95),
qw2 AS (SELECT query_id, count(*) AS wq2 FROM qk GROUP BY query_id),
m2 AS (SELECT qk.query_id, kept.doc_id, kept.w, count(*) AS match_count
       FROM qk JOIN kept USING (term) GROUP BY 1, 2, 3)
SELECT 'jpii_idf' AS mode, m2.query_id AS doc_a, m2.doc_id AS doc_b, m2.match_count, qw2.wq2 AS w_a, m2.w AS w_b,
       {jaccard_sql('m2.match_count', 'qw2.wq2', 'm2.w')} AS similarity
FROM m2 JOIN qw2 USING (query_id)"""

SQL["pipeline_pairwise_idf"] = f"""WITH {pair_ctes(0.3, 0.95)}
SELECT 'pairwise_idf' AS mode, doc_a, doc_b, match_count, w_a, w_b, sum_min, sum_max, sum_min::DOUBLE / sum_max::DOUBLE AS similarity
FROM pr WHERE sum_min::DOUBLE / sum_max::DOUBLE >= 0.99"""

SQL["index_term_lookup"] = f"""WITH {doc_index_ctes()},
top AS (SELECT term FROM kept GROUP BY term, df ORDER BY df DESC, term LIMIT 1)
SELECT dt.term, dt.doc_id, dt.w, df.df FROM dt JOIN df USING (term) WHERE term IN (SELECT term FROM top)"""

SQL["index_prefix_scan"] = f"""WITH {doc_index_ctes()},
head AS (SELECT term FROM df WHERE starts_with(term, 'th') ORDER BY term LIMIT 50)
SELECT dt.term, dt.doc_id, dt.w, df.df FROM dt JOIN df USING (term) WHERE term IN (SELECT term FROM head)"""

SQL["results_of_document"] = f"""WITH {pair_ctes(None)},
nd AS (SELECT * FROM pj WHERE similarity >= 0.8),
top AS (SELECT d FROM (SELECT doc_a AS d FROM nd UNION ALL SELECT doc_b FROM nd) e GROUP BY d ORDER BY count(*) DESC, d LIMIT 1)
SELECT 'pairwise' AS mode, nd.* FROM nd WHERE doc_a IN (SELECT d FROM top) OR doc_b IN (SELECT d FROM top)"""

SQL["jpii_exclude_self"] = f"""WITH {jpii_ctes()}
SELECT * FROM jp WHERE query_id <> doc_id"""

SQL["jpii_from_store"] = SQL["jpii_scores"]

SQL["store_delete"] = f"""WITH {_STORE},
tox AS (SELECT doc_id FROM labels WHERE toxic = 1)
SELECT * FROM st WHERE mode = 'jpii'
   OR (doc_a NOT IN (SELECT doc_id FROM tox) AND doc_b NOT IN (SELECT doc_id FROM tox))"""

SQL["store_ranked_export"] = f"""WITH {_STORE},
sc AS (SELECT *, {overlap_sql('match_count', 'w_a', 'w_b')} AS overlap, {f1_sql('match_count', 'w_a', 'w_b')} AS f1
       FROM st WHERE mode = 'pairwise' AND w_a > 0 AND w_b > 0)
SELECT rank, doc_a, doc_b, similarity, f1, overlap, match_count, w_a, w_b,
       CASE WHEN similarity >= 0.7 THEN 'high' WHEN similarity >= 0.4 THEN 'medium' ELSE 'low' END AS band
FROM (SELECT *, row_number() OVER (ORDER BY {r('similarity', 2)} DESC, {r('f1', 3)} DESC, overlap DESC,
                                   match_count DESC, doc_a, doc_b) AS rank FROM sc) z WHERE rank <= 5"""

SQL["stored_query_topk"] = f"""WITH {_STORE}
SELECT * FROM (SELECT row_number() OVER (ORDER BY similarity DESC, doc_a, doc_b) AS rank,
                      doc_a, doc_b, similarity, match_count FROM st
               WHERE mode = 'pairwise' AND similarity >= 0.6) z WHERE rank <= 10"""

SQL["upsert_latest"] = """SELECT user_id, event_type, ts, event_id, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC NULLS LAST, event_id DESC) AS rn
  FROM events) z WHERE rn = 1"""

SQL["keep_versions"] = """SELECT user_id, event_type, ts, event_id, value, version FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC NULLS LAST, event_id DESC) AS version
  FROM events) z WHERE version <= 5"""

SQL["versions_stored"] = """SELECT user_id, event_type, ts, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC NULLS LAST, event_id DESC) AS version
  FROM events) z WHERE version <= 5"""

SQL["term_lookup"] = f"""WITH {doc_index_ctes()},
top AS (SELECT term FROM kept GROUP BY term ORDER BY count(*) DESC, term LIMIT 1)
SELECT term, doc_id, w FROM kept WHERE term IN (SELECT term FROM top)"""

SQL["term_multiget"] = f"""WITH {jpii_ctes()}
SELECT term, doc_id, w FROM kept WHERE term IN (SELECT term FROM qt)"""

SQL["term_prefix_scan"] = f"""WITH {doc_index_ctes()},
first AS (SELECT DISTINCT term FROM kept WHERE starts_with(term, 'a') ORDER BY term LIMIT 50)
SELECT term, doc_id, w FROM kept WHERE term IN (SELECT term FROM first)"""

SQL["term_doc_map"] = f"""WITH {doc_index_ctes()}
SELECT term, doc_id, w FROM kept"""

_WS = SPLIT_PATTERN
# Licence markers, and mis-encoded quotes and dashes with their replacements.
_BS = r"\*\*\* ?START OF (THE|THIS) PROJECT GUTENBERG EBOOK[^*]*\*\*\*"
_BE = r"\*\*\* ?END OF (THE|THIS) PROJECT GUTENBERG EBOOK[^*]*\*\*\*"

_RESIDUE = (("xe2x80x9c", " "), ("xe2x80x9d", " "), ("xe2x80x94", " "), ("xe2x80x99", "'"), ("xe2x80x98", "'"))


def _ws_norm(x: str) -> str:
    return f"trim(regexp_replace({x}, '{_WS}', ' ', 'g'), ' ')"


def clean_sql(x: str) -> str:
    s1 = f"(CASE WHEN regexp_matches({x}, '{_BS}') THEN regexp_replace({x}, '(?s)^.*?{_BS}', '') ELSE {x} END)"
    s2 = f"(CASE WHEN regexp_matches({s1}, '{_BE}') THEN regexp_replace({s1}, '(?s){_BE}.*$', '') ELSE {s1} END)"
    s3 = _ws_norm(s2)
    s4 = f"regexp_replace({s3}, '\\\\[nrt]?', '', 'g')"
    s5 = s4
    for bad, good in _RESIDUE:
        s5 = f"replace({s5}, '{bad}', '{good.replace(chr(39), chr(39) * 2)}')"
    return _ws_norm(s5)


SQL["text_clean"] = f"""SELECT doc_id, text FROM (SELECT doc_id, {clean_sql('text')} AS text FROM documents) z
WHERE length(text) > 0"""

_ANCHOR = '<a href="([^"]*)">([^<]*)</a>'

SQL["page_links"] = f"""SELECT page_id, anchor_text, href,
       CASE WHEN regexp_matches(href, '^https?://') THEN href
            ELSE regexp_extract(url, '^(https?://[^/?#]+)', 1) || href END AS url
FROM (SELECT page_id, url, unnest(regexp_extract_all(html, '{_ANCHOR}', 1)) AS href,
             unnest(regexp_extract_all(html, '{_ANCHOR}', 2)) AS anchor_text FROM pages) a"""

_META = """meta AS (SELECT (row_number() OVER (ORDER BY page_id) - 1) AS row_idx, page_id,
                 regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title, url AS link,
                 regexp_extract(html, '<html lang="([^"]*)"', 1) AS lang FROM pages),
fid AS (SELECT *, TRY_CAST(string_split(link, '/')[-1] AS INTEGER) AS book_id,
               printf('%05d.txt', row_idx + 1) AS file_id FROM meta)"""

SQL["metadata_slice"] = f"""WITH {_META}
SELECT row_idx, page_id, title, link, lang, book_id, file_id FROM fid WHERE row_idx >= 10 AND row_idx < 110"""

SQL["metadata_filemap"] = f"""WITH {_META}
SELECT file_id, page_id, title AS file_name FROM fid"""

SQL["corpus_wholetext"] = SQL["doc_weights"]

SQL["query_files"] = SQL["jpii_scores"]

SQL["corpus_sweep_metrics"] = f"""WITH {terms_cte('dt0', 'documents', 'doc_id')},
dw AS (SELECT id AS doc_id, count(*) AS w FROM dt0 GROUP BY id),
d AS (SELECT lang AS corpus, doc_id FROM documents),
n AS (SELECT lang AS corpus, count(*) AS books, sum(strlen(text))::BIGINT AS input_bytes
      FROM documents GROUP BY lang),
post AS (SELECT d.corpus, dt0.term, dt0.id AS doc_id FROM dt0 JOIN d ON dt0.id = d.doc_id),
dfs AS (SELECT corpus, term, count(*) AS df FROM post GROUP BY corpus, term),
kept AS (SELECT post.* FROM post JOIN dfs USING (corpus, term) JOIN n USING (corpus)
         WHERE dfs.df > 1 AND dfs.df < n.books),
idx AS (SELECT corpus, count(DISTINCT term) AS unique_words, count(*) AS postings FROM kept GROUP BY corpus),
{terms_cte('qt', 'benchmark', 'item_id')},
jp AS (SELECT corpus, count(*) AS jpii_pairs FROM (SELECT DISTINCT kept.corpus, qt.id, kept.doc_id
       FROM kept JOIN qt USING (term)) z GROUP BY corpus),
pw AS (SELECT corpus, count(*) AS pairwise_pairs FROM (SELECT DISTINCT a.corpus, a.doc_id AS da, b.doc_id AS db
       FROM kept a JOIN kept b ON a.corpus = b.corpus AND a.term = b.term AND a.doc_id < b.doc_id) z GROUP BY corpus)
SELECT n.corpus, n.books, n.input_bytes, coalesce(idx.unique_words, 0) AS unique_words,
       coalesce(idx.postings, 0) AS postings, coalesce(jp.jpii_pairs, 0) AS jpii_pairs,
       coalesce(pw.pairwise_pairs, 0) AS pairwise_pairs, (n.books * (n.books - 1) // 2)::BIGINT AS possible_pairs,
       CASE WHEN n.books * (n.books - 1) // 2 > 0
            THEN coalesce(pw.pairwise_pairs, 0)::DOUBLE / (n.books * (n.books - 1) // 2) ELSE 0.0 END AS coverage
FROM n LEFT JOIN idx USING (corpus) LEFT JOIN jp USING (corpus) LEFT JOIN pw USING (corpus)"""

SQL["size_sweep"] = f"""WITH {terms_cte('dt0', 'documents', 'doc_id')}, {terms_cte('qt', 'benchmark', 'item_id')},
total AS (SELECT count(*) AS n FROM documents),
sizes AS (SELECT DISTINCT greatest(1, n // d) AS size FROM total, (SELECT unnest([8, 4, 2, 1]) AS d)),
place AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS pos FROM documents),
modes AS (SELECT unnest(['both', 'universal', 'single', 'none']) AS mode),
df AS (SELECT size, term, count(*) AS df FROM dt0 JOIN place ON place.doc_id = dt0.id, sizes WHERE pos <= size GROUP BY ALL),
kept AS (SELECT size, mode, term, df FROM df, modes WHERE CASE mode WHEN 'both' THEN df > 1 AND df < size WHEN 'universal' THEN df < size
                                                          WHEN 'single' THEN df > 1 ELSE TRUE END),
words AS (SELECT size, mode, count(*) AS unique_words, CAST(sum(df) AS BIGINT) AS postings FROM kept GROUP BY ALL),
pairs AS (SELECT size, mode, count(*) AS jpii_pairs FROM (
            SELECT DISTINCT size, mode, qt.id AS q, dt0.id AS d FROM kept JOIN dt0 USING (term) JOIN place ON place.doc_id = dt0.id JOIN qt USING (term)
            WHERE pos <= size) GROUP BY ALL)
SELECT size, mode, size AS docs, coalesce(unique_words, 0) AS unique_words, coalesce(postings, 0) AS postings, coalesce(jpii_pairs, 0) AS jpii_pairs
FROM sizes CROSS JOIN modes LEFT JOIN words USING (size, mode) LEFT JOIN pairs USING (size, mode)"""

_RUNS = """runs AS (SELECT *, stage1_time + stage2_time AS total_time, books::DOUBLE / (stage1_time + stage2_time) AS throughput FROM (
  SELECT event_type AS mode, (10 * (1 + event_id % 5))::BIGINT AS books, (2 ** (user_id % 3))::BIGINT AS reducers,
         CASE WHEN event_id % 11 = 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status, count(*)::DOUBLE AS stage1_time,
         count(DISTINCT user_id)::DOUBLE AS stage2_time, sum(event_id)::BIGINT AS input_size, sum(user_id)::BIGINT AS index_size,
         count(*) * 512 AS jpii_size FROM events GROUP BY 1, 2, 3, 4) z),
ok AS (SELECT * FROM runs WHERE status = 'SUCCESS'), clicks AS (SELECT * FROM ok WHERE mode = 'click')"""

SQL["runs_summary"] = f"""WITH {_RUNS}
SELECT count(*) AS total_tests, {r('avg(total_time)', 6)} AS avg_time, {r('min(total_time)', 6)} AS min_time, {r('max(total_time)', 6)} AS max_time,
       {r('avg(throughput)', 6)} AS avg_throughput, {r('max(throughput)', 6)} AS max_throughput FROM ok"""

SQL["runs_optimal_reducers"] = f"""WITH {_RUNS}
SELECT books, reducers, {r('total_time', 6)} AS time, {r('throughput', 6)} AS throughput, {r('per', 6)} AS books_per_reducer FROM (
  SELECT *, row_number() OVER (PARTITION BY books ORDER BY total_time, reducers) AS rn, avg(books::DOUBLE / reducers) OVER (PARTITION BY books) AS per FROM clicks) z
WHERE rn = 1"""

SQL["runs_scaling"] = f"""WITH {_RUNS},
ends AS (SELECT reducers, arg_min(books, books) AS b0, arg_min(total_time, books) AS t0, arg_max(books, books) AS b1, arg_max(total_time, books) AS t1
         FROM clicks GROUP BY reducers HAVING count(*) >= 2),
e AS (SELECT reducers, CASE WHEN t1 / t0 > 0 THEN (b1::DOUBLE / b0) / (t1 / t0) ELSE 0.0 END AS eff FROM ends)
SELECT reducers, {r('eff', 6)} AS efficiency, CASE WHEN eff BETWEEN 0.9 AND 1.1 THEN 'linear' WHEN eff > 1.1 THEN 'sub-linear' ELSE 'super-linear' END AS type FROM e"""

SQL["runs_bottleneck"] = f"""WITH {_RUNS},
p AS (SELECT coalesce(avg(100 * stage1_time / total_time), 0.0) AS a, coalesce(avg(100 * stage2_time / total_time), 0.0) AS b FROM ok)
SELECT {r('a', 6)} AS stage1_pct, {r('b', 6)} AS stage2_pct,
       CASE WHEN a > b THEN 'Stage 1 (Inverted Index)' ELSE 'Stage 2 (JPII)' END AS bottleneck FROM p"""

SQL["runs_size_analysis"] = f"""WITH {_RUNS}
SELECT books, {r('avg(input_size) / 1048576.0', 6)} AS input_mb, {r('avg(index_size) / 1048576.0', 6)} AS index_mb, {r('avg(jpii_size) / 1024.0', 6)} AS jpii_kb,
       {r('max(throughput)', 6)} AS best_throughput,
       {r('CASE WHEN avg(input_size) > 0 THEN (avg(index_size) / 1048576.0) / (avg(input_size) / 1048576.0) ELSE 0.0 END', 6)} AS compression FROM ok GROUP BY books"""

SQL["runs_by_reducers_and_status"] = f"""WITH {_RUNS}
SELECT 'time' AS report, reducers::VARCHAR AS key, {r('avg(total_time)', 6)} AS value FROM ok GROUP BY reducers
UNION ALL SELECT 'status', status, {r('count(*)', 6)} FROM runs GROUP BY status
UNION ALL (SELECT 'fastest', reducers::VARCHAR, {r('total_time', 6)} FROM clicks WHERE books = 30 ORDER BY total_time, reducers LIMIT 1)"""

for _p, _cond in (("both", "df > 1 AND df < n"), ("universal", "df < n"), ("single", "df > 1")):
    SQL[f"pages_postings_{_p}"] = f"""WITH {terms_cte('pt', 'pages', 'page_id', 'html')},
n AS (SELECT count(*) AS n FROM pages), df AS (SELECT term, count(*) AS df FROM pt GROUP BY term), pw AS (SELECT id, count(*) AS w FROM pt GROUP BY id)
SELECT term, id AS page_id, w, df FROM pt JOIN df USING (term) JOIN pw USING (id), n WHERE {_cond}"""

SQL["incremental_index"] = SQL["index_postings_both"]

SQL["incremental_counts"] = f"""WITH {doc_index_ctes()}
SELECT term, doc_id, w, df FROM kept"""

SQL["estimated_documents"] = "SELECT count(*) AS n_docs, TRUE AS within FROM documents"

SQL["jpii_ranked_lines"] = f"""WITH {jpii_ctes()}, rk AS ({ranked_sql('jp', 0.1, 3)})
SELECT query_id, rank, rank::VARCHAR || chr(9) || doc_id::VARCHAR || chr(9) || printf('%.2f', {r('jaccard', 2)})
       || chr(9) || printf('%.3f', {r('f1', 3)}) || chr(9) || printf('%.3f', {r('overlap', 3)}) || chr(9)
       || match_count::VARCHAR AS line FROM rk"""

SQL["store_json_export"] = SQL["jpii_ranked_v3"]

SQL["jpii_scores_unpruned"] = f"""WITH {jpii_ctes('none')}
SELECT * FROM jp"""

SQL["pairwise_idf_band"] = f"""WITH {pair_ctes(0.5, 0.95)}
SELECT * FROM pj"""
