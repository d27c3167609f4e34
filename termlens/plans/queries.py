"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Keys follow SURVEY §7.3.  Every query reads the driver's tables (or data
Spark derives from them) in full.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termlens.functions import text as T
from termlens.operators import index as I
from termlens.operators import ranking as R
from termlens.operators import similarity as S
from termlens.operators.joins import reuse
from termlens.plans import search as P
from termlens.sources.tables import benchmark_queries, documents, table

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


# --- tokenizer and index -----------------------------------------------------

@register("tokenize_terms")
def tokenize_terms(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct (doc_id, term) of the corpus."""
    return I.postings(documents(spark, sf)).select("doc_id", "term")


@register("doc_weights")
def doc_weights(spark: SparkSession, sf: str) -> DataFrame:
    """T4: W per document (documents without terms have W = 0)."""
    return I.doc_terms(documents(spark, sf)).select("doc_id", "w")


# --- JPII ---------------------------------------------------------------------

@register("jpii_scores")
def jpii_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Every benchmark query against the whole corpus."""
    return P.jpii_scores(documents(spark, sf), benchmark_queries(spark, sf))


@register("jpii_ranked_v3")
def jpii_ranked_v3(spark: SparkSession, sf: str) -> DataFrame:
    """Top-5 documents per benchmark query."""
    return P.jpii_search(documents(spark, sf), benchmark_queries(spark, sf), version=3)


# --- index variants, statistics, IDF ----------------------------------------

def _pruned(spark: SparkSession, sf: str, policy: str) -> DataFrame:
    docs = documents(spark, sf)
    return I.prune(I.postings(docs), I.corpus_size(docs), policy)


def _term_idf(spark: SparkSession, sf: str) -> DataFrame:
    """(term, df, idf) of the indexed terms; postings are read for df and N' only."""
    docs = documents(spark, sf)
    post = reuse(I.postings(docs))
    kept = reuse(I.kept_terms(post, I.corpus_size(docs)))
    return I.with_idf(kept, I.count_indexed_docs(post, kept))


@register("index_postings_both")
def index_postings_both(spark: SparkSession, sf: str) -> DataFrame:
    """A3/F1: postings of terms with 1 < df < N."""
    return _pruned(spark, sf, "both").select("term", "doc_id", "w", "df")


@register("index_postings_universal")
def index_postings_universal(spark: SparkSession, sf: str) -> DataFrame:
    """postings of terms with df < N (singletons kept)."""
    return _pruned(spark, sf, "universal").select("term", "doc_id", "w", "df")


@register("index_postings_single")
def index_postings_single(spark: SparkSession, sf: str) -> DataFrame:
    """postings of terms with df > 1 (universal terms kept)."""
    return _pruned(spark, sf, "single").select("term", "doc_id", "w", "df")


@register("index_lines")
def index_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Text lines ``term<TAB>doc@W...`` with W desc, then id, in chunks of 200 postings of a term."""
    from termlens.sources.formats import index_text_lines
    return index_text_lines(I.nested_index(_pruned(spark, sf, "both"), chunk_docs=200))


@register("index_stats")
def index_stats(spark: SparkSession, sf: str) -> DataFrame:
    """A10: terms, postings and average documents per term of the pruned index."""
    return I.index_stats(_pruned(spark, sf, "both"))


@register("term_df")
def term_df(spark: SparkSession, sf: str) -> DataFrame:
    """A4: document frequency of every term (unpruned)."""
    return I.term_df(I.postings(documents(spark, sf)))


@register("term_idf")
def term_idf(spark: SparkSession, sf: str) -> DataFrame:
    """Normalised IDF per indexed term, N' = documents in the index.

    IDF is emitted rounded to 6 decimals (last-bit log differences between
    math libraries must not decide a comparison).
    """
    from termlens.functions.measures import round_half_up
    return _term_idf(spark, sf).select("term", "df", round_half_up("idf", 6).alias("idf"))


@register("idf_band_terms")
def idf_band_terms(spark: SparkSession, sf: str) -> DataFrame:
    """indexed terms whose IDF lies in [0.3, 0.9] (a band that removes terms here)."""
    return I.idf_band(_term_idf(spark, sf), 0.3, 0.9).select("term", "df")


# --- more JPII ----------------------------------------------------------------

@register("jpii_ranked_v1")
def jpii_ranked_v1(spark: SparkSession, sf: str) -> DataFrame:
    """Older ranking: m >= q/2, keys round(jaccard,4), overlap, m; top 5."""
    return P.jpii_search(documents(spark, sf), benchmark_queries(spark, sf), version=1)


@register("jpii_idf_scores")
def jpii_idf_scores(spark: SparkSession, sf: str) -> DataFrame:
    """P3 core/M3: JPII with query terms reduced to the IDF band [0.3, 0.95]."""
    docs = documents(spark, sf)
    return S.jpii_idf(reuse(I.postings(docs)), I.corpus_size(docs),
                      S.query_terms(benchmark_queries(spark, sf)), lo=0.3, hi=0.95)


@register("max_df_jpii")
def max_df_jpii(spark: SparkSession, sf: str) -> DataFrame:
    """JPII skipping terms present in more than 100 documents."""
    docs = documents(spark, sf)
    return S.jpii(I.postings(docs), I.corpus_size(docs),
                  S.query_terms(benchmark_queries(spark, sf)), max_df=100)


@register("query_term_stats")
def query_term_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Df, IDF (6 decimals) and band flag [0.3, 0.95] of each query term in the index."""
    from termlens.functions.measures import round_half_up
    docs = documents(spark, sf)
    st = S.query_term_stats(reuse(I.postings(docs)), I.corpus_size(docs),
                            S.query_terms(benchmark_queries(spark, sf)), 0.3, 0.95)
    return st.select("query_id", "term", "df", round_half_up("idf", 6).alias("idf"), "kept")


@register("jpii_ranked_labels")
def jpii_ranked_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Ranked top-5 with the document's labels joined on (left outer lookup)."""
    ranked = P.jpii_search(documents(spark, sf), benchmark_queries(spark, sf))
    labels = table(spark, sf, "labels").select("doc_id", "quality", "toxic")
    return ranked.join(labels, "doc_id", "left")


# --- pairwise -------------------------------------------------------------------

@register("pairwise_jaccard")
def pairwise_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    """P2 core/J2/A8/M2: all pairs sharing a kept term, IDF band [0.05, 0.95]."""
    return S.document_pairs(documents(spark, sf))


@register("pairwise_weighted")
def pairwise_weighted(spark: SparkSession, sf: str) -> DataFrame:
    """P4 core/A9/M4: sum(min W)/sum(max W) over shared kept terms, band [0.05, 0.95]."""
    return S.document_pairs_weighted(documents(spark, sf))


@register("pairwise_weighted_t")
def pairwise_weighted_t(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs with sum(min W)/sum(max W) >= 0.98 over shared kept terms, band [0.05, 0.95], by weight bands."""
    from termlens.operators.weighted import document_pairs_weighted_threshold
    return document_pairs_weighted_threshold(documents(spark, sf), 0.98, 0.05, 0.95)


@register("weighted_tf_jaccard")
def weighted_tf_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    """M4 with term-frequency weights: sum(min tf)/sum(max tf) over shared kept terms."""
    docs = documents(spark, sf)
    return S.pairwise_weighted(I.postings_tf(docs), I.corpus_size(docs), weight="tf")


@register("pairwise_top10")
def pairwise_top10(spark: SparkSession, sf: str) -> DataFrame:
    """The 10 most similar pairs (similarity desc, then pair ids)."""
    docs = documents(spark, sf)
    return P.top_pairs(docs, 10).select("rank", "doc_a", "doc_b", "similarity", "match_count")


@register("pairwise_ranked")
def pairwise_ranked(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs ranked like the e-book ranking (q = w_a), top 5."""
    return P.pairwise_search(documents(spark, sf))


@register("pairwise_threshold")
def pairwise_threshold(spark: SparkSession, sf: str) -> DataFrame:
    """F10 + prefix filter: all pairs with pruned Jaccard >= 0.5 (df pruning only)."""
    return S.document_pairs_threshold(documents(spark, sf), 0.5)


@register("near_duplicates")
def near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    """Near-duplicate pairs, pruned Jaccard >= 0.8."""
    return P.near_duplicates(documents(spark, sf), 0.8)


@register("recommend_per_doc")
def recommend_per_doc(spark: SparkSession, sf: str) -> DataFrame:
    """For every document its 5 most similar partners (a threshold of its own for each document)."""
    return P.best_partners(documents(spark, sf), 5)


# --- text formats ----------------------------------------------------------------

def _scratch(spark: SparkSession, name: str) -> str:
    from termlens.session import scratch_root
    return f"{scratch_root(spark, name)}/t"


@register("index_text_roundtrip")
def index_text_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Write index lines as text files, read the folder back, parse."""
    from termlens.sources import formats as FM
    path = _scratch(spark, "index-text")
    lines = FM.index_text_lines(I.nested_index(_pruned(spark, sf, "both")))
    lines.orderBy("term", "chunk").select(F.col("line").alias("value")).write.text(path)
    back = FM.merge_index_rows(FM.parse_index_lines(spark.read.text(path)))
    return back.select("term", F.col("doc_id").cast("bigint").alias("doc_id"), "w")


@register("index_merge_duplicates")
def index_merge_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    """Posting lists cut into 50-document chunks and repeated twice,
    parsed and merged back to one row per (term, doc); df recounted."""
    from termlens.sources import formats as FM
    lines = FM.index_text_lines(I.nested_index(_pruned(spark, sf, "both"), chunk_docs=50))
    twice = lines.select(F.col("line").alias("value")).unionAll(lines.select(F.col("line").alias("value")))
    merged = FM.merge_index_rows(FM.parse_index_lines(twice))
    df = merged.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return merged.join(df, "term").select("term", F.col("doc_id").cast("bigint").alias("doc_id"), "w", "df")


@register("similarity_tsv_roundtrip")
def similarity_tsv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """JPII rows -> TSV files sorted by pair (pair by weight)
    -> strict reader -> rows."""
    from termlens.sources import formats as FM
    path = _scratch(spark, "jpii-tsv")
    FM.jpii_tsv_lines(jpii_scores(spark, sf)).orderBy("value").write.text(path)
    back = FM.parse_jpii_tsv(spark.read.text(path))
    return back.select(F.col("query_id").cast("bigint").alias("query_id"),
                       F.col("doc_id").cast("bigint").alias("doc_id"),
                       "match_count", "w_query", "w_doc", "similarity")


@register("pairwise_tsv_lines")
def pairwise_tsv_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Pairwise TSV fields with the lexicographic pair label (t >= 0.5 pairs)."""
    from termlens.sources import formats as FM
    pairs = pairwise_threshold(spark, sf)
    return pairs.select(FM.pair_label_lexicographic("doc_a", "doc_b").alias("pair"),
                        "match_count", "w_a", "w_b", "similarity")


@register("cells_unpivot")
def cells_unpivot(spark: SparkSession, sf: str) -> DataFrame:
    """The pruned index as (row_key, family:qualifier, value) cells."""
    from termlens.sources import formats as FM
    return FM.index_cells(_pruned(spark, sf, "both"))


def _cell_input(spark: SparkSession, sf: str) -> DataFrame:
    from termlens.sources import formats as FM
    idx = FM.index_text_lines(I.nested_index(_pruned(spark, sf, "both"))).select(F.col("line").alias("value"))
    cells = FM.cell_lines(FM.score_cells(_hash_rows(spark, sf).select(
        "row_key", F.format_string("%.6f", "jaccard").alias("jaccard_txt"),
        F.col("shared_terms").cast("string").alias("shared_txt"))))
    foreign = table(spark, sf, "conversations").select(T.escape_tabs_newlines("text").alias("value"))
    return idx.unionByName(cells).unionByName(foreign)


@register("cells_parse")
def cells_parse(spark: SparkSession, sf: str) -> DataFrame:
    """Index lines, score cell lines and foreign text lines parsed to cells."""
    from termlens.sources import formats as FM
    c = FM.parse_cell_lines(_cell_input(spark, sf))
    return c.where("valid").select("row_key", "family", "qualifier", "value")


@register("cells_import_totals")
def cells_import_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Import totals: lines read, cells produced, invalid lines, row keys."""
    from termlens.sources import formats as FM
    lines = _cell_input(spark, sf)
    c = FM.parse_cell_lines(lines)
    n_lines = lines.select(F.count(F.lit(1)).alias("lines")).scalar()
    return c.agg(
        F.sum(F.when(F.col("valid"), 1).otherwise(0)).cast("bigint").alias("cells"),
        F.sum(F.when(F.col("valid"), 0).otherwise(1)).cast("bigint").alias("invalid"),
        F.countDistinct(F.when(F.col("valid"), F.col("row_key"))).alias("row_keys"),
    ).withColumn("lines", n_lines)


@register("cells_import")
def cells_import(spark: SparkSession, sf: str) -> DataFrame:
    """The same lines written as a cell table in one read; its totals, and the cells and row keys of the table."""
    from termlens.sources.imports import import_cells, read_cells
    path = _scratch(spark, "cells")
    totals = import_cells(_cell_input(spark, sf), path)
    table_rows = read_cells(path, spark).agg(F.count(F.lit(1)).alias("stored"), F.countDistinct("row_key").alias("row_keys"))
    return table_rows.select("stored", "row_keys", *[F.lit(totals[k]).cast("bigint").alias(k) for k in ("lines", "cells", "invalid")])


# --- query-hash scores (older keyed-store form) -------------------------------------

def _hash_rows(spark: SparkSession, sf: str) -> DataFrame:
    from termlens.functions.measures import round_half_up
    q = benchmark_queries(spark, sf)
    s = jpii_scores(spark, sf)
    qh = q.select("query_id", T.query_hash("text").alias("query_hash"),
                  T.escape_tabs_newlines("text").alias("query_text"))
    return s.join(qh, "query_id").select(
        F.concat("query_hash", F.lit(":"), F.col("doc_id").cast("string")).alias("row_key"),
        "query_hash", "doc_id", round_half_up("similarity", 6).alias("jaccard"),
        F.col("match_count").alias("shared_terms"), "query_text")


@register("query_hash_scores")
def query_hash_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Per query hash and document: Jaccard (6 decimals), shared terms, query text."""
    return _hash_rows(spark, sf)


@register("query_hash_topk")
def query_hash_topk(spark: SparkSession, sf: str) -> DataFrame:
    """K9: per query hash, the 10 best documents with Jaccard >= 0.1 (ties: row-key order)."""
    rows = _hash_rows(spark, sf).where(F.col("jaccard") >= 0.1)
    return R.top_k(rows, [F.desc("jaccard")], 10, group="query_hash", tie=("row_key",)).select(
        "query_hash", "rank", "doc_id", "jaccard", "shared_terms")


@register("escaped_query_text")
def escaped_query_text(spark: SparkSession, sf: str) -> DataFrame:
    """Conversation texts with tab/newline/CR replaced by spaces."""
    c = table(spark, sf, "conversations")
    return c.select("conv_id", "turn", T.escape_tabs_newlines("text").alias("text"))


# --- result store ---------------------------------------------------------------------

def _filled_store(spark: SparkSession, sf: str):
    from termlens.operators.store import ResultStore
    st = ResultStore(spark)
    jp = jpii_scores(spark, sf).select(F.col("query_id").alias("doc_a"), F.col("doc_id").alias("doc_b"),
                                       "match_count", F.col("w_query").alias("w_a"),
                                       F.col("w_doc").alias("w_b"), "similarity")
    st.write_similarity(jp, "jpii")
    st.write_similarity(pairwise_threshold(spark, sf), "pairwise")
    return st


_STORE_COLS = ["mode", "doc_a", "doc_b", "match_count", "w_a", "w_b", "similarity"]


@register("store_write_read")
def store_write_read(spark: SparkSession, sf: str) -> DataFrame:
    """JPII rows and t >= 0.5 pairs upserted into the similarity table, read back."""
    return _filled_store(spark, sf).similarity.read().select(*_STORE_COLS)


@register("store_counts")
def store_counts(spark: SparkSession, sf: str) -> DataFrame:
    """K4: per mode, distinct stored pairs."""
    s = _filled_store(spark, sf).similarity.read().select("mode", "doc_a", "doc_b").distinct()
    return s.groupBy("mode").agg(F.count(F.lit(1)).alias("pairs"))


@register("store_delete")
def store_delete(spark: SparkSession, sf: str) -> DataFrame:
    """Delete stored pairs that touch a document labelled toxic (either side)."""
    t = _filled_store(spark, sf).similarity
    cur = t.read().where(F.col("mode") == "pairwise")
    toxic = table(spark, sf, "labels").where("toxic = 1").select("doc_id")
    doomed = cur.join(toxic.withColumnRenamed("doc_id", "doc_a"), "doc_a", "left_semi").unionByName(
        cur.join(toxic.withColumnRenamed("doc_id", "doc_b"), "doc_b", "left_semi"))
    t.delete(doomed)
    return t.read().select(*_STORE_COLS)


@register("store_backup")
def store_backup(spark: SparkSession, sf: str) -> DataFrame:
    """The similarity table copied as plain Parquet and read by another table's upsert."""
    from termlens.operators.store import ResultStore
    dest = _scratch(spark, "backup")
    _filled_store(spark, sf).similarity.read().write.parquet(dest)
    copy = ResultStore(spark).similarity
    copy.upsert(spark.read.parquet(dest))
    return copy.read().select(*_STORE_COLS)


@register("stored_document_pairs")
def stored_document_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """K8: stored pairs that touch the most frequent document of the table, on either side, best first."""
    st = _filled_store(spark, sf)
    p = st.similarity.read().where("mode = 'pairwise'")
    ends = p.select(F.col("doc_a").alias("d")).unionAll(p.select(F.col("doc_b").alias("d")))
    top = ends.groupBy("d").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    return st.query_similarity("pairwise", document=top.d if top else -1).select(*_STORE_COLS)


@register("jpii_exclude_self")
def jpii_exclude_self(spark: SparkSession, sf: str) -> DataFrame:
    """JPII of the benchmark queries, a query's own document id left out."""
    docs = documents(spark, sf)
    return S.jpii(I.postings(docs), I.corpus_size(docs), S.query_terms(benchmark_queries(spark, sf)), exclude_self=True)


@register("jpii_from_store")
def jpii_from_store(spark: SparkSession, sf: str) -> DataFrame:
    """JPII on postings read back from the stored index; only N comes from the documents."""
    st = _postings_store(spark, sf)
    n = I.corpus_size(documents(spark, sf))
    return S.jpii(st.postings.read().select("term", "doc_id", "w"), n, S.query_terms(benchmark_queries(spark, sf)))


@register("store_ranked_export")
def store_ranked_export(spark: SparkSession, sf: str) -> DataFrame:
    """Rank stored pairs (top 5), export CSV, read it back."""
    from termlens.operators.store import export_ranked
    st = _filled_store(spark, sf)
    ranked = st.ranked("pairwise", 5).select("rank", "doc_a", "doc_b", "similarity", "f1", "overlap",
                                             "match_count", "w_a", "w_b", "band")
    path = _scratch(spark, "export")
    export_ranked(ranked, path)
    schema = ("rank bigint, doc_a bigint, doc_b bigint, similarity double, f1 double, overlap double, "
              "match_count bigint, w_a bigint, w_b bigint, band string")
    return spark.read.schema(schema).option("header", True).csv(path)


@register("stored_query_topk")
def stored_query_topk(spark: SparkSession, sf: str) -> DataFrame:
    """Stored pairwise rows with similarity >= 0.6, best 10."""
    st = _filled_store(spark, sf)
    return st.query_similarity("pairwise", threshold=0.6, limit=10).select(
        "rank", "doc_a", "doc_b", "similarity", "match_count")


# --- keyed upserts on events --------------------------------------------------------

def _events_two_batches(spark: SparkSession, sf: str):
    ev = table(spark, sf, "events").select("user_id", "event_type", "ts", "event_id", "value", "props")
    mid = ev.select(F.expr("timestamp_micros(CAST((unix_micros(CAST(min(ts) AS TIMESTAMP))"
                           " + unix_micros(CAST(max(ts) AS TIMESTAMP))) / 2 AS BIGINT))")
                    .alias("m")).scalar()
    early = F.coalesce(F.col("ts").cast("timestamp") < mid, F.lit(False))
    return ev.where(early), ev.where(~early)


@register("upsert_latest")
def upsert_latest(spark: SparkSession, sf: str) -> DataFrame:
    """Events arrive in two time batches; keep the latest row per
    (user_id, event_type) by (ts, event_id)."""
    from termlens.operators.store import KeyedTable
    first, second = _events_two_batches(spark, sf)
    t = KeyedTable(spark, _scratch(spark, "events"), first.schema, ["user_id", "event_type"], order=["ts", "event_id"])
    t.upsert(first)
    t.upsert(second)
    return t.read()


@register("keep_versions")
def keep_versions(spark: SparkSession, sf: str) -> DataFrame:
    """The 5 newest rows per (user_id, event_type), version 1 = newest."""
    from termlens.operators.store import keep_versions as kv
    ev = table(spark, sf, "events").select("user_id", "event_type", "ts", "event_id", "value")
    return kv(ev, ["user_id", "event_type"], ["ts", "event_id"], 5)


@register("versions_stored")
def versions_stored(spark: SparkSession, sf: str) -> DataFrame:
    """Events arrive in two time batches, one of them twice; the table keeps the 5 newest rows per (user_id, event_type)."""
    from termlens.operators.store import KeyedTable
    cols = ["user_id", "event_type", "ts", "event_id", "value"]
    first, second = (b.select(cols) for b in _events_two_batches(spark, sf))
    t = KeyedTable(spark, _scratch(spark, "versions"), first.schema, ["user_id", "event_type"], order=["ts", "event_id"], versions=5)
    t.upsert(first)
    t.upsert(second)
    t.upsert(second)
    return t.read()


# --- index lookups on the stored postings ----------------------------------------------

def _postings_store(spark: SparkSession, sf: str):
    from termlens.operators.store import ResultStore
    st = ResultStore(spark)
    st.write_postings(_pruned(spark, sf, "both").select("term", "doc_id", "w"))
    return st


@register("term_lookup")
def term_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """K5: postings of the indexed term with the highest df (ties: smallest term)."""
    st = _postings_store(spark, sf)
    top = (st.postings.read().groupBy("term").agg(F.count(F.lit(1)).alias("df"))
           .orderBy(F.desc("df"), "term").limit(1).collect()[0]["term"])
    return st.lookup_term(top).select("term", "doc_id", "w")


@register("term_multiget")
def term_multiget(spark: SparkSession, sf: str) -> DataFrame:
    """Stored postings of every benchmark query term (absent terms give nothing)."""
    st = _postings_store(spark, sf)
    qt = S.query_terms(benchmark_queries(spark, sf))
    return st.multiget_terms(qt).select("term", "doc_id", "w")


@register("term_prefix_scan")
def term_prefix_scan(spark: SparkSession, sf: str) -> DataFrame:
    """K6: postings of the first 50 stored terms that start with 'a'."""
    st = _postings_store(spark, sf)
    return st.scan_terms("a", 50).select("term", "doc_id", "w")


@register("term_doc_map")
def term_doc_map(spark: SparkSession, sf: str) -> DataFrame:
    """K7: term -> map(doc_id -> W) (posting lists chunked), flattened back to rows."""
    st = _postings_store(spark, sf)
    p = st.postings.read().select("term", "doc_id", "w")
    n = p.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    nested = I.nested_index(p.join(n, "term"))
    maps = nested.select("term", F.map_from_entries("postings").alias("docs"))
    return maps.select("term", F.explode("docs").alias("doc_id", "w"))


# --- stored index and result table ---------------------------------------------------------

def _index(spark: SparkSession, sf: str):
    from termlens.operators.stored import StoredIndex
    # a term in more than 500 documents is hot: both kinds of tables hold terms at every size
    return StoredIndex.create(documents(spark, sf), hot_docs=500)


@register("pipeline_jpii_idf")
def pipeline_jpii_idf(spark: SparkSession, sf: str) -> DataFrame:
    """Benchmark queries against the stored index, IDF band [0.3, 0.95], scores written to the result table and read back."""
    from termlens.operators.stored import ResultTable
    s = _index(spark, sf).jpii_idf(S.query_terms(benchmark_queries(spark, sf)), 0.3, 0.95)
    out = ResultTable(spark)
    out.write(s.select(F.col("query_id").alias("doc_a"), F.col("doc_id").alias("doc_b"), "match_count", F.col("w_query").alias("w_a"),
                       F.col("w_doc").alias("w_b"), "similarity"), "jpii_idf")
    return out.read("jpii_idf")


@register("pipeline_pairwise_idf")
def pipeline_pairwise_idf(spark: SparkSession, sf: str) -> DataFrame:
    """Weighted pairs of similarity >= 0.99 over the stored index, IDF band [0.3, 0.95], written to the result table and read back."""
    from termlens.operators.stored import ResultTable
    out = ResultTable(spark)
    out.write(_index(spark, sf).pairwise_weighted(0.3, 0.95, 0.99), "pairwise_idf", extra=("sum_min", "sum_max"))
    return out.read("pairwise_idf")


@register("index_term_lookup")
def index_term_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """K5: postings of the stored term with the most documents, read through buckets, Bloom filters and statistics."""
    ix = _index(spark, sf)
    top = ix._kept(ix.terms()).orderBy(F.desc("df"), "term").first()
    return ix.lookup(top.term if top else "").select("term", "doc_id", "w", "df")


@register("index_prefix_scan")
def index_prefix_scan(spark: SparkSession, sf: str) -> DataFrame:
    """K6: the postings of the first 50 stored terms that start with 'th', from the files that hold them."""
    return _index(spark, sf).scan("th", 50).select("term", "doc_id", "w", "df")


@register("results_of_document")
def results_of_document(spark: SparkSession, sf: str) -> DataFrame:
    """K8: stored near-duplicate pairs of the document that most pairs hold, found under that document."""
    from termlens.operators.stored import ResultTable
    out = ResultTable(spark)
    out.write(near_duplicates(spark, sf), "pairwise")
    top = out._all().where("mode = 'pairwise'").groupBy("doc").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "doc").first()
    return out.of_document("pairwise", top.doc if top else -1)


# --- corpus preparation and sources ------------------------------------------------------

@register("text_clean")
def text_clean(spark: SparkSession, sf: str) -> DataFrame:
    """Cleaned document texts (blank results dropped)."""
    from termlens.sources.corpus import clean_documents
    return clean_documents(documents(spark, sf).select("doc_id", "text"))


@register("page_links")
def page_links(spark: SparkSession, sf: str) -> DataFrame:
    """Every anchor of every page with its absolute URL."""
    from termlens.sources.corpus import page_links as links
    return links(table(spark, sf, "pages"))


@register("metadata_slice")
def metadata_slice(spark: SparkSession, sf: str) -> DataFrame:
    """Page metadata rows 10..109 in page_id order, with book and file ids."""
    from termlens.sources.corpus import page_metadata, row_slice, with_file_ids
    meta = row_slice(page_metadata(table(spark, sf, "pages")), ["page_id"], 10, 100)
    return with_file_ids(meta).select("row_idx", "page_id", "title", "link", "lang", "book_id", "file_id")


@register("metadata_filemap")
def metadata_filemap(spark: SparkSession, sf: str) -> DataFrame:
    """File map of all pages written as CSV, read back, joined to the metadata."""
    from termlens.sources.corpus import page_metadata, read_file_map, row_index, with_file_ids, write_file_map
    meta = with_file_ids(row_index(page_metadata(table(spark, sf, "pages")), ["page_id"]))
    path = _scratch(spark, "file-map")
    write_file_map(meta, path)
    fmap = read_file_map(spark, path)
    return meta.select("file_id", "page_id").join(fmap, "file_id", "left")


@register("corpus_wholetext")
def corpus_wholetext(spark: SparkSession, sf: str) -> DataFrame:
    """Documents written one file each, read back whole-text, W per document."""
    from termlens.sources.corpus import read_partitioned_corpus, write_corpus_files
    path = _scratch(spark, "corpus")
    write_corpus_files(documents(spark, sf), path)
    return I.doc_terms(read_partitioned_corpus(spark, path)).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "w")


@register("query_files")
def query_files(spark: SparkSession, sf: str) -> DataFrame:
    """S3: benchmark queries written one file each, read back as query files, scored (M1)."""
    from termlens.sources.corpus import read_partitioned_corpus, write_corpus_files
    path = _scratch(spark, "queries")
    write_corpus_files(benchmark_queries(spark, sf), path, id_col="query_id")
    q = read_partitioned_corpus(spark, path, "query_id")
    docs = documents(spark, sf)
    return S.jpii(I.postings(docs), I.corpus_size(docs), S.query_terms(q)).withColumn(
        "query_id", F.col("query_id").cast("bigint"))


# --- run metrics ------------------------------------------------------------------------

@register("corpus_sweep_metrics")
def corpus_sweep_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Per language corpus, index and result counts of a sweep run."""
    from termlens.operators.metrics import corpus_sweep
    return corpus_sweep(documents(spark, sf), S.query_terms(benchmark_queries(spark, sf)))


@register("size_sweep")
def size_sweep(spark: SparkSession, sf: str) -> DataFrame:
    """An eighth, a quarter, half and all of the documents (by id) under every pruning mode, in one pass."""
    from termlens.operators.metrics import size_sweep as sweep
    docs = documents(spark, sf)
    n = docs.count()
    sizes = sorted({max(1, n // d) for d in (8, 4, 2, 1)})
    return sweep(docs, S.query_terms(benchmark_queries(spark, sf)), sizes)


def _runs(spark: SparkSession, sf: str) -> DataFrame:
    """A run table derived from all events: a run per (mode, size, workers, status) with whole-number measures."""
    ev = table(spark, sf, "events").select(
        F.col("event_type").alias("mode"), (10 * (1 + F.col("event_id") % 5)).cast("bigint").alias("books"),
        F.pow(F.lit(2), F.col("user_id") % 3).cast("bigint").alias("reducers"),
        F.when(F.col("event_id") % 11 == 0, "FAILED").otherwise("SUCCESS").alias("status"), "user_id", "event_id")
    g = ev.groupBy("mode", "books", "reducers", "status").agg(
        F.count(F.lit(1)).cast("double").alias("stage1_time"), F.countDistinct("user_id").cast("double").alias("stage2_time"),
        F.sum("event_id").alias("input_size"), F.sum("user_id").alias("index_size"), (F.count(F.lit(1)) * 512).alias("jpii_size"),
        (F.countDistinct("user_id") * 3).alias("similarity_pairs"))
    total = F.col("stage1_time") + F.col("stage2_time")
    return g.withColumn("total_time", total).withColumn("throughput", F.col("books") / total)


def _short(df: DataFrame) -> DataFrame:
    """Doubles to 6 decimals: the order of a sum must not decide a comparison."""
    from termlens.functions.measures import round_half_up
    return df.select(*[round_half_up(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


@register("runs_summary")
def runs_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Successful runs: number, times and throughput."""
    from termlens.operators import metrics as X
    return _short(X.summary_stats(X.success_only(_runs(spark, sf))))


@register("runs_optimal_reducers")
def runs_optimal_reducers(spark: SparkSession, sf: str) -> DataFrame:
    """Per size of the successful "click" runs the number of workers with the least time."""
    from termlens.operators import metrics as X
    return _short(X.optimal_reducers(X.success_only(_runs(spark, sf)).where("mode = 'click'")))


@register("runs_scaling")
def runs_scaling(spark: SparkSession, sf: str) -> DataFrame:
    """Per number of workers how time grows with size ("click" runs)."""
    from termlens.operators import metrics as X
    return _short(X.scaling(X.success_only(_runs(spark, sf)).where("mode = 'click'")))


@register("runs_bottleneck")
def runs_bottleneck(spark: SparkSession, sf: str) -> DataFrame:
    """Mean shares of the stages and the longer one."""
    from termlens.operators import metrics as X
    return _short(X.bottleneck(X.success_only(_runs(spark, sf))))


@register("runs_size_analysis")
def runs_size_analysis(spark: SparkSession, sf: str) -> DataFrame:
    """Per size mean input, index and result sizes."""
    from termlens.operators import metrics as X
    return _short(X.size_analysis(X.success_only(_runs(spark, sf))))


@register("runs_by_reducers_and_status")
def runs_by_reducers_and_status(spark: SparkSession, sf: str) -> DataFrame:
    """Mean time per number of workers, runs per status, and the fastest run of size 30, as (report, key, value)."""
    from termlens.operators import metrics as X
    runs = _runs(spark, sf)
    ok = X.success_only(runs)
    time = X.time_by_reducers(ok).select(F.lit("time").alias("report"), F.col("reducers").cast("string").alias("key"), F.col("avg_total_time").alias("value"))
    status = X.runs_by_status(runs).select(F.lit("status").alias("report"), F.col("status").alias("key"), F.col("runs").cast("double").alias("value"))
    fast = X.fastest_run(ok.where("mode = 'click'"), 30).select(F.lit("fastest").alias("report"), F.col("reducers").cast("string").alias("key"), F.col("total_time").alias("value"))
    return _short(time.unionByName(status).unionByName(fast))


# --- pruning where universal terms exist -------------------------------------------------------

def _pages_index(spark: SparkSession, sf: str, policy: str) -> DataFrame:
    pages = table(spark, sf, "pages")
    post = I.postings(pages, "page_id", "html")
    return I.prune(post, I.corpus_size(pages), policy).select("term", F.col("doc_id").alias("page_id"), "w", "df")


@register("pages_postings_both")
def pages_postings_both(spark: SparkSession, sf: str) -> DataFrame:
    """F1 over the raw pages, where markup words occur on every page: 1 < df < N."""
    return _pages_index(spark, sf, "both")


@register("pages_postings_universal")
def pages_postings_universal(spark: SparkSession, sf: str) -> DataFrame:
    """F2 over the raw pages: df < N removes the markup words, words of one page stay."""
    return _pages_index(spark, sf, "universal")


@register("pages_postings_single")
def pages_postings_single(spark: SparkSession, sf: str) -> DataFrame:
    """F3 over the raw pages: df > 1, the markup words stay."""
    return _pages_index(spark, sf, "single")


# --- incremental index ------------------------------------------------------------------------

@register("incremental_index")
def incremental_index(spark: SparkSession, sf: str) -> DataFrame:
    """The English documents arrive first, then every document (English
    ones again, unchanged, as updates); the pruned index read from the
    maintained state equals a full rebuild."""
    from termlens.streaming.incremental import IndexState, apply_batch, index_postings
    docs = documents(spark, sf).select("doc_id", "text", "lang")
    st = IndexState(spark)
    apply_batch(st, docs.where(F.col("lang") == "en"))
    apply_batch(st, docs)
    return index_postings(st).select("term", "doc_id", "w", "df")


@register("incremental_counts")
def incremental_counts(spark: SparkSession, sf: str) -> DataFrame:
    """The same batches, the second one written twice; df and N from the batches' signed counts."""
    from termlens.streaming.incremental import IndexState, apply_batch, index_postings_by_counts
    docs = documents(spark, sf).select("doc_id", "text", "lang")
    st = IndexState(spark)
    apply_batch(st, docs.where(F.col("lang") == "en").withColumn("text", F.concat(F.lit("earlier draft "), "text")), batch_id=1)
    apply_batch(st, docs, batch_id=2)
    apply_batch(st, docs, batch_id=2)
    return index_postings_by_counts(st).select("term", "doc_id", "w", "df")


@register("estimated_documents")
def estimated_documents(spark: SparkSession, sf: str) -> DataFrame:
    """N from the sketches of two overlapping batches is within three standard errors of N from the counts."""
    from termlens.streaming.incremental import SKETCH_ERROR, IndexState, apply_batch, doc_count, estimated_docs
    docs = documents(spark, sf).select("doc_id", "text", "lang")
    st = IndexState(spark)
    apply_batch(st, docs.where(F.col("lang") == "en"))
    apply_batch(st, docs)
    both = spark.range(1).select(doc_count(st).alias("n_docs"), estimated_docs(st).alias("estimate"))
    return both.select("n_docs", (F.abs(F.col("estimate") - F.col("n_docs")) <= 3 * SKETCH_ERROR * F.col("n_docs") + 1).alias("within"))


@register("jpii_ranked_lines")
def jpii_ranked_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Ranked output lines ``rank  doc  jaccard(.2f)  f1(.3f)  overlap(.3f)  m``."""
    from termlens.functions.measures import fixed_decimals
    r = jpii_ranked_v3(spark, sf)
    line = F.concat_ws("\t", F.col("rank").cast("string"), F.col("doc_id").cast("string"),
                       fixed_decimals("jaccard", 2), fixed_decimals("f1", 3), fixed_decimals("overlap", 3),
                       F.col("match_count").cast("string"))
    return r.select("query_id", "rank", line.alias("line"))


@register("store_json_export")
def store_json_export(spark: SparkSession, sf: str) -> DataFrame:
    """S17 (JSON): stored JPII rows ranked per query (top 5), exported as JSON lines, read back."""
    from termlens.operators.store import export_ranked
    st = _filled_store(spark, sf)
    s = st.similarity.read().where(F.col("mode") == "jpii").select(
        F.col("doc_a").alias("query_id"), F.col("doc_b").alias("doc_id"), "match_count",
        F.col("w_a").alias("w_query"), F.col("w_b").alias("w_doc"), "similarity")
    ranked = R.rank_jpii(s)
    path = _scratch(spark, "json-export")
    export_ranked(ranked, path, fmt="json")
    schema = ("query_id bigint, rank bigint, doc_id bigint, jaccard double, f1 double, overlap double, "
              "match_count bigint")
    return spark.read.schema(schema).json(path)


@register("jpii_scores_unpruned")
def jpii_scores_unpruned(spark: SparkSession, sf: str) -> DataFrame:
    """J1/M1 with no df pruning (every shared term counts), as when scoring a
    stream of arriving documents against fixed queries."""
    docs = documents(spark, sf)
    return S.jpii(I.postings(docs), I.corpus_size(docs), S.query_terms(benchmark_queries(spark, sf)),
                  policy="none")


@register("pairwise_idf_band")
def pairwise_idf_band(spark: SparkSession, sf: str) -> DataFrame:
    """All pairs sharing a kept term whose IDF lies in [0.5, 0.95] (the benchmarked band)."""
    return S.document_pairs(documents(spark, sf), lo=0.5, hi=0.95)
