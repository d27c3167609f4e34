"""Inverted index.

The primary index is the flat ``postings(term, doc_id, w)`` table: one row
per distinct (document, term), W = the document's number of distinct
non-stopword terms.  It is produced map-side (explode, no shuffle).  The
document-frequency aggregate is partially aggregated before its exchange,
so a term present in a third of all documents costs one partial count per
input partition; pruning joins (term, df) back onto the postings, as a
broadcast when the kept-term set is checked (or measured by AQE) small,
otherwise as a shuffle join whose skewed partitions AQE splits.

Pruning is applied when the index is read, never baked into storage, so
adding documents (which changes df and N) needs no rewrite of old rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termlens.functions import text as T
from termlens.functions.measures import normalized_idf

# Terms that N' finds documents by before it looks at rarer ones (sent to every task as a list).
FREQUENT_TERMS = 100_000
POLICIES = ("both", "universal", "single", "none")


def doc_terms(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, terms array<string>, w bigint) — one row per document."""
    terms = F.coalesce(T.term_set(text_col), F.array().cast("array<string>"))
    return (
        docs.select(F.col(id_col).alias("doc_id"), terms.alias("terms"))
        .withColumn("w", T.term_weight("terms"))
    )


def postings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A1: unpruned postings (term, doc_id, w); empty documents give no row.

    ``explode_outer`` + null filter instead of ``explode``: Catalyst infers a
    ``size(terms) > 0`` filter from a plain explode and pushes it below any
    exchange that spreads the scan, which would run the tokenizer twice,
    the first time in the unspread scan task.
    """
    return doc_terms(docs, id_col, text_col).select(
        F.explode_outer("terms").alias("term"), "doc_id", "w"
    ).where(F.col("term").isNotNull())


def postings_tf(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Postings with the term frequency of each term in its document.

    (term, doc_id, w, tf).  The tokens are dealt out once by document; counting
    is an aggregate over the exploded tokens, keyed by (doc_id, term), and
    meets the weights there, so no posting is shuffled and no group exceeds one
    document's token count.
    """
    toks = docs.select(F.col(id_col).alias("doc_id"), T.tokens(text_col).alias("toks")).where(F.col("doc_id").isNotNull()).repartition("doc_id")
    w = toks.select("doc_id", F.size(F.array_distinct("toks")).cast("bigint").alias("w"))
    tf = (
        toks.select("doc_id", F.explode_outer("toks").alias("term")).where(F.col("term").isNotNull())
        .groupBy("doc_id", "term")
        .agg(F.count(F.lit(1)).alias("tf"))
    )
    return tf.join(w, "doc_id").select("term", "doc_id", "w", "tf")


def corpus_size(docs: DataFrame) -> Column:
    """A2: N = number of documents, empty ones included (scalar subquery)."""
    return docs.select(F.count(F.lit(1)).alias("n")).scalar()


def indexed_doc_count(pruned: DataFrame) -> Column:
    """A5: N' = distinct documents that keep at least one indexed term."""
    return pruned.select(F.countDistinct("doc_id").alias("n")).scalar()


def count_indexed_docs(post: DataFrame, kept: DataFrame, frequent_terms: int = FREQUENT_TERMS) -> Column:
    """A5: N' as above, from unpruned postings and the (term, df) of the kept terms.

    A document counts by any one kept term.  The ``frequent_terms`` most
    frequent ones are looked up in a broadcast list of that bounded size where
    the postings are; only postings of rarer terms are shuffled to the rest.
    Both frames are read twice, so they should be kept (``joins.reuse``).
    """
    frequent = F.broadcast(kept.orderBy(F.desc("df"), "term").limit(frequent_terms).select("term"))
    here = post.join(frequent, "term", "left_semi").select("doc_id")
    rare = post.join(frequent, "term", "left_anti").join(kept.hint("shuffle_hash"), "term", "left_semi").select("doc_id")
    return indexed_doc_count(here.unionByName(rare))


def term_df(post: DataFrame) -> DataFrame:
    """A4: (term, df) — partial count before the shuffle on term."""
    return post.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def keep_condition(df: Column, n: Column, policy: str = "both") -> Column:
    """F1 both: 1 < df < N; F2 universal: df < N; F3 single: df > 1."""
    if policy == "both":
        return (df > 1) & (df < n)
    if policy == "universal":
        return df < n
    if policy == "single":
        return df > 1
    if policy == "none":
        return F.lit(True)
    raise ValueError(f"unknown pruning policy {policy!r}; use one of {POLICIES}")


def kept_terms(post: DataFrame, n: Column, policy: str = "both", max_df: int | None = None) -> DataFrame:
    """F1-F3 (+F7): (term, df) of the terms that pruning keeps, without their postings."""
    cond = keep_condition(F.col("df"), n, policy)
    if max_df is not None:
        cond = cond & (F.col("df") <= F.lit(max_df))
    return term_df(post).where(cond)


def prune(post: DataFrame, n: Column, policy: str = "both",
          max_df: int | None = None, broadcast_terms: bool = False) -> DataFrame:
    """F1-F3 (+F7): postings of kept terms with their df.

    Output (term, doc_id, w, df, ...extra posting columns).  ``broadcast_terms``
    is set by callers whose term set is already size-checked (query terms);
    otherwise the (term, df) side is joined by shuffle, as the hashed side, so
    that the postings themselves are not sorted, and AQE may still turn it into
    a broadcast from the measured size of the aggregate.
    """
    kept = kept_terms(post, n, policy, max_df)
    return post.join(F.broadcast(kept) if broadcast_terms else kept.hint("shuffle_hash"), "term")


def with_idf(pruned: DataFrame, n_prime: Column | None = None) -> DataFrame:
    """Add ``idf`` = ln(N'/df)/ln(N') with N' = documents in the index."""
    if n_prime is None:
        n_prime = indexed_doc_count(pruned)
    return pruned.withColumn("idf", normalized_idf("df", n_prime))


def idf_band(pruned_idf: DataFrame, lo: float, hi: float) -> DataFrame:
    """keep postings whose term IDF is inside [lo, hi] (inclusive)."""
    return pruned_idf.where(F.col("idf").between(lo, hi))


def nested_index(pruned: DataFrame, chunk_docs: int = 10_000) -> DataFrame:
    """(term, df, chunk, postings array<struct<doc_id, w>>).

    Postings of a term are ordered by W descending, then id, and cut into
    chunks of ``chunk_docs`` by that position: chunk 0 holds the first, and the
    chunks of a term in order are its whole list, at every size.  A term of at
    most ``chunk_docs`` documents is one chunk and gathered as it is; positions
    in longer lists come from one distributed sort (``row_index``) of those
    terms only, so neither a task nor a group grows with a term.
    """
    from termlens.operators.joins import reuse
    from termlens.sources.corpus import row_index
    rows = reuse(pruned).select("term", "df", (-F.col("w")).alias("neg_w"), "doc_id", "w")
    short = rows.where(F.col("df") <= chunk_docs).withColumn("chunk", F.lit(0))
    long = rows.where(F.col("df") > chunk_docs)
    if long.limit(1).count() == 0:
        return _chunks(short)
    placed = row_index(long, ["term", "neg_w", "doc_id"])
    first = placed.groupBy("term").agg(F.min("row_idx").alias("first"))
    keyed = placed.join(first, "term").withColumn("chunk", ((F.col("row_idx") - F.col("first")) / chunk_docs).cast("int"))
    return _chunks(short).unionByName(_chunks(keyed.select(*short.columns)))


def _chunks(keyed: DataFrame) -> DataFrame:
    grouped = keyed.groupBy("term", "df", "chunk").agg(F.collect_list(F.struct("neg_w", "doc_id", "w")).alias("p"))
    return grouped.select(
        "term", "df", "chunk",
        F.transform(F.array_sort("p"), lambda s: F.struct(
            s["doc_id"].alias("doc_id"), s["w"].alias("w"))).alias("postings"),
    )


def index_stats(pruned: DataFrame) -> DataFrame:
    """A10: number of terms, postings and average documents per term."""
    return pruned.agg(
        F.countDistinct("term").alias("terms"),
        F.count(F.lit(1)).alias("postings"),
    ).withColumn(
        "avg_docs_per_term",
        F.when(F.col("terms") > 0, F.col("postings") / F.col("terms")).otherwise(F.lit(0.0)),
    )
