"""Similarity search.

JPII (query vs corpus) is batch-shaped: any number of queries, keyed by
``query_id``, are scored in one plan.  The query side is tiny and is
broadcast after a row-count check; the corpus postings are filtered to
query terms map-side, so only matching postings are ever shuffled, and the
only shuffle is the (query_id, doc_id) match count, which is partially
aggregated first.

Pairwise (all document pairs sharing a kept term) counts every two blocks of
documents against each other (see ``operators.blocks``).  ``pairwise_threshold`` adds exact prefix filtering
(AllPairs / PPJoin) so only pairs that can reach the threshold are formed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termlens.functions import text as T
from termlens.functions.measures import jaccard, normalized_idf, ratio
from termlens.operators import index as I
from termlens.operators.joins import BLOCK_DOCS, reuse, row_count_at_most, small_side, term_pairs

# Broadcast bound for query-term tables (rows).
QUERY_TERMS_MAX_ROWS = 5_000_000


def query_terms(queries: DataFrame, id_col: str = "query_id", text_col: str = "text") -> DataFrame:
    """(query_id, term, wq) with wq = all distinct query terms."""
    qt = queries.select(F.col(id_col).alias("query_id"), T.term_set(text_col).alias("terms"))
    return qt.select("query_id", F.explode("terms").alias("term"),
                     T.term_weight("terms").alias("wq"))


def _query_side(qt: DataFrame, max_rows: int) -> tuple[DataFrame, DataFrame, bool]:
    """Checked broadcast of the query terms and of their distinct term set.

    Returns (query terms, distinct terms, whether the term set is within the
    bound); anything keyed by one row per query term inherits that bound.
    """
    qt_b = small_side(qt, max_rows)
    terms = qt.select("term").distinct()
    small = row_count_at_most(terms, max_rows)
    return qt_b, (F.broadcast(terms) if small else terms), small





def jpii(post: DataFrame, n_docs: Column, qt: DataFrame, policy: str = "both",
         exclude_self: bool = False, max_df: int | None = None,
         max_rows: int = QUERY_TERMS_MAX_ROWS) -> DataFrame:
    """Pruned Jaccard of every query against the corpus.

    post     unpruned postings (term, doc_id, w)
    n_docs   N for df pruning (documents, empty ones included)
    qt       query terms (query_id, term, wq), wq = all distinct query terms
    Output: query_id, doc_id, match_count, w_query, w_doc, similarity.
    Only documents sharing at least one kept term appear.
    """
    qt_b, terms_b, small = _query_side(qt, max_rows)
    # postings of query terms only (broadcast semi-join, no shuffle).
    pq = reuse(post.join(terms_b, "term", "left_semi"))
    # df of those terms only; the kept set is bounded by the query terms.
    kept = I.prune(pq, n_docs, policy, max_df=max_df, broadcast_terms=small)
    m = kept.join(qt_b, "term")
    if exclude_self:  # F6
        m = m.where(F.col("doc_id") != F.col("query_id"))
    agg = m.groupBy("query_id", "doc_id", "w", "wq").agg(F.count(F.lit(1)).alias("match_count"))
    return agg.select(
        "query_id", "doc_id", "match_count",
        F.col("wq").alias("w_query"), F.col("w").alias("w_doc"),
        jaccard("match_count", "wq", "w").alias("similarity"),
    )


def jpii_idf(post: DataFrame, n_docs: Column, qt: DataFrame, lo: float, hi: float,
             policy: str = "both", max_df: int | None = None, exclude_self: bool = False,
             max_rows: int = QUERY_TERMS_MAX_ROWS) -> DataFrame:
    """P3 core (J4/A12/F4/F7/M3): JPII with the query reduced to IDF-band terms.

    N' (IDF) = documents present in the pruned index (exact, A5).
    wq' = number of query terms found in the index with IDF in [lo, hi];
    with ``max_df`` (only when asked for) terms of more documents still count
    in wq' but add no matches (F7);
    the document side keeps its full W.
    Output as ``jpii`` plus nothing else; see ``query_term_stats`` for A12.
    """
    # One row per (query, term found in the index): small, but it needs the
    # whole pruned index (for N'); keep it so the size checks below and the
    # main plan do not recompute that index.
    stats = reuse(query_term_stats(post, n_docs, qt, lo, hi, policy, max_rows=max_rows))
    kept_q = stats.where("kept").select("query_id", "term", "df")
    wq2 = kept_q.groupBy("query_id").agg(F.count(F.lit(1)).alias("wq2"))
    qk = kept_q.join(wq2, "query_id")
    if max_df is not None:
        qk = qk.where(F.col("df") <= F.lit(max_df))
    qk_b = small_side(qk, max_rows)
    terms_b = small_side(qk.select("term").distinct(), max_rows)
    pq = post.join(terms_b, "term", "left_semi")
    m = pq.join(qk_b, "term")
    if exclude_self:
        m = m.where(F.col("doc_id") != F.col("query_id"))
    agg = m.groupBy("query_id", "doc_id", "w", "wq2").agg(F.count(F.lit(1)).alias("match_count"))
    return agg.select(
        "query_id", "doc_id", "match_count",
        F.col("wq2").alias("w_query"), F.col("w").alias("w_doc"),
        jaccard("match_count", "wq2", "w").alias("similarity"),
    )


def query_term_stats(post: DataFrame, n_docs: Column, qt: DataFrame, lo: float = 0.05,
                     hi: float = 0.95, policy: str = "both",
                     max_rows: int = QUERY_TERMS_MAX_ROWS) -> DataFrame:
    """Per query term found in the index: df, idf, kept flag.

    Terms absent from the (pruned) index are absent here, as with a
    multi-get of missing row keys.  IDF uses N' = documents in the index.
    """
    kept = reuse(I.kept_terms(post, n_docs, policy))
    n_prime = I.count_indexed_docs(post, kept)
    _, terms_b, small = _query_side(qt.select("query_id", "term"), max_rows)
    tdf = kept.join(terms_b, "term", "left_semi")
    tdf = tdf.withColumn("idf", normalized_idf("df", n_prime))
    # tdf has at most one row per query term, so it is bounded by the check above.
    return (
        qt.select("query_id", "term").join(F.broadcast(tdf) if small else tdf, "term")
        .withColumn("kept", F.col("idf").between(lo, hi))
    )


def _copy_groups(doc_sets: DataFrame) -> DataFrame:
    """Members of exact-copy groups: (doc_id, gid, w, copies, n).

    ``doc_sets`` has one row per document: doc_id, w and ``ts``, its sorted
    kept-term set.  Documents with the same (w, ts) form a group whose id is
    its smallest doc_id; n is the number of kept terms they all share.  The
    group aggregate is partial before its shuffle and the join back is split
    by AQE when one group is very large.
    """
    # 128 hash bits of the set stand for it in the shuffles, not the set itself
    keyed = doc_sets.select("doc_id", "w", F.size("ts").cast("bigint").alias("n"), F.xxhash64("ts").alias("h1"),
                            F.xxhash64(F.lit(1), F.reverse("ts")).alias("h2"))
    key = ["w", "n", "h1", "h2"]
    groups = keyed.groupBy(*key).agg(F.min("doc_id").alias("gid"), F.count(F.lit(1)).alias("copies"))
    return reuse(keyed.join(groups, key).select("doc_id", "gid", "w", "copies", "n"))


def _expand_copies(rep_pairs: DataFrame, members: DataFrame, block_docs: int,
                   inside_ok: Column | None = None) -> DataFrame:
    """Expand pairs of group representatives to all member pairs and add the
    pairs inside each group.  Output: doc_a < doc_b, w_a, w_b, match_count.

    Inside a group every pair shares all n kept terms (m = n); those pairs
    come from the block-split self-join keyed by group, so a group holding a
    third of the corpus is spread over many tasks.  ``inside_ok`` (a
    condition on n and w) filters which groups contribute inside pairs.
    """
    ma = members.select(F.col("gid").alias("doc_a"), F.col("doc_id").alias("x"))
    mb = members.select(F.col("gid").alias("doc_b"), F.col("doc_id").alias("y"))
    ex = rep_pairs.join(ma, "doc_a").join(mb, "doc_b")
    x_first = F.col("x") < F.col("y")
    cross = ex.select(
        F.when(x_first, F.col("x")).otherwise(F.col("y")).alias("doc_a"),
        F.when(x_first, F.col("y")).otherwise(F.col("x")).alias("doc_b"),
        F.when(x_first, F.col("w_a")).otherwise(F.col("w_b")).alias("w_a"),
        F.when(x_first, F.col("w_b")).otherwise(F.col("w_a")).alias("w_b"),
        "match_count",
    )
    inside = members.where(F.col("copies") >= 2)
    if inside_ok is not None:
        inside = inside.where(inside_ok)
    mem = inside.select("gid", "doc_id", "w", F.col("copies").alias("df"), "n")
    within = term_pairs(mem, block_docs, extra=("n",), keys=("gid",)).select(
        "doc_a", "doc_b", "w_a", "w_b", F.col("n_a").alias("match_count"))
    return cross.unionByName(within)


def pairwise(post: DataFrame, n_docs: Column, policy: str = "both", lo: float | None = 0.05,
             hi: float | None = 0.95, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """P2 core (J2/A8/M2): pruned Jaccard of every document pair sharing a kept term.

    Terms are pruned by df (``policy``) and then by the IDF band [lo, hi]
    with N' = documents in the pruned index (pass lo=None to skip F4).  The
    band's default upper end 0.95 removes nothing until N' exceeds 2^20, then
    it removes every term of two documents: the rule of F4, not a saving.
    All pairs are quadratic in the documents; they are counted where two
    document blocks meet (``operators.blocks``), so only the result grows so.
    ``pairwise_threshold`` and ``search.pairwise_search`` give the similar ones
    without forming them.  The postings are gathered per document;
    ``document_pairs`` takes documents and leaves that shuffle out.
    Output: doc_a < doc_b, match_count, w_a, w_b, similarity.
    """
    return _jaccard_pairs(_gathered(post), n_docs, policy, lo, hi, block_docs)


def document_pairs(docs: DataFrame, policy: str = "both", lo: float | None = 0.05, hi: float | None = 0.95, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """``pairwise`` of documents."""
    return _jaccard_pairs(_merged_terms(docs), I.corpus_size(docs), policy, lo, hi, block_docs)


def _gathered(post: DataFrame, *values: str) -> DataFrame:
    """(doc_id, w, terms[, vals]): the postings of each document in one row."""
    if not values:
        return post.groupBy("doc_id", "w").agg(F.collect_list("term").alias("terms"))
    packed = post.groupBy("doc_id", "w").agg(F.collect_list(F.struct("term", F.col(values[0]).cast("bigint").alias("v"))).alias("p"))
    return packed.select("doc_id", "w", F.col("p.term").alias("terms"), F.col("p.v").alias("vals"))


def _merged_terms(docs: DataFrame) -> DataFrame:
    from termlens.operators.prefix import _merged, stored
    return _merged(stored(I.doc_terms(docs), "tokens"))  # texts are tokenised once


def _pair_counts(sets: DataFrame, n_docs: Column, policy: str, lo: float | None, hi: float | None, block_docs: int) -> DataFrame:
    from termlens.operators import blocks as B
    return B.pair_counts(*B.of_terms(sets, n_docs, policy, lo, hi, block_docs))


def _jaccard_pairs(sets: DataFrame, n_docs: Column, policy: str, lo: float | None, hi: float | None, block_docs: int) -> DataFrame:
    agg = _pair_counts(sets, n_docs, policy, lo, hi, block_docs)
    return agg.select("doc_a", "doc_b", "match_count", "w_a", "w_b",
                      jaccard("match_count", "w_a", "w_b").alias("similarity"))


def pairwise_weighted(post: DataFrame, n_docs: Column, policy: str = "both",
                      lo: float | None = 0.05, hi: float | None = 0.95,
                      weight: str = "w", block_docs: int = BLOCK_DOCS) -> DataFrame:
    """P4 core (A9/M4): sum(min weight) / sum(max weight) over shared kept terms.

    weight="w"   the reference's choice: the document's W for every term,
                 which reduces to min(W_a, W_b) / max(W_a, W_b);
    weight="tf"  the term frequency (needs a ``tf`` posting column), a real
                 weighted Jaccard over the shared terms.
    Output: doc_a, doc_b, match_count, w_a, w_b, sum_min, sum_max, similarity.
    """
    if weight == "w":
        return _weighted_pairs(_gathered(post), n_docs, policy, lo, hi, block_docs)
    from termlens.operators import blocks as B
    sums = B.pair_sums(B.of_terms(_gathered(post, weight), n_docs, policy, lo, hi, block_docs)[0])
    return sums.select("doc_a", "doc_b", "w_a", "w_b", "match_count", "sum_min", "sum_max").withColumn("similarity", ratio("sum_min", "sum_max"))


def document_pairs_weighted(docs: DataFrame, policy: str = "both", lo: float | None = 0.05, hi: float | None = 0.95,
                            block_docs: int = BLOCK_DOCS) -> DataFrame:
    """``pairwise_weighted`` of documents, with W as weight."""
    return _weighted_pairs(_merged_terms(docs), I.corpus_size(docs), policy, lo, hi, block_docs)


def _weighted_pairs(sets: DataFrame, n_docs: Column, policy: str, lo: float | None, hi: float | None, block_docs: int) -> DataFrame:
    # W is constant per document, so the sums are m * min(W) and m * max(W).
    agg = _pair_counts(sets, n_docs, policy, lo, hi, block_docs).select(
        "doc_a", "doc_b", "w_a", "w_b", "match_count",
        (F.col("match_count") * F.least("w_a", "w_b")).cast("bigint").alias("sum_min"),
        (F.col("match_count") * F.greatest("w_a", "w_b")).cast("bigint").alias("sum_max"))
    return agg.withColumn("similarity", ratio("sum_min", "sum_max"))


def _pair_terms(post: DataFrame, n_docs: Column, policy: str, lo: float | None,
                hi: float | None) -> DataFrame:
    pruned = I.prune(post, n_docs, policy)
    if lo is None and hi is None:
        return pruned
    with_idf = I.with_idf(pruned)
    return I.idf_band(with_idf, -1.0 if lo is None else lo, 2.0 if hi is None else hi)


def pairwise_threshold(post: DataFrame, n_docs: Column, t: float, policy: str = "both",
                       block_docs: int = BLOCK_DOCS, lo: float | None = None, hi: float | None = None) -> DataFrame:
    """All pairs with pruned Jaccard >= t (0 < t <= 1), exactly, from postings.

    The postings are gathered per document; ``document_pairs_threshold`` takes
    documents and leaves that shuffle out.  Output as ``pairwise``.
    """
    sets = post.groupBy("doc_id", "w").agg(F.collect_list("term").alias("terms"))
    return _threshold(sets, n_docs, t, policy, block_docs, lo, hi)


def document_pairs_threshold(docs: DataFrame, t: float, policy: str = "both",
                             block_docs: int = BLOCK_DOCS, lo: float | None = None, hi: float | None = None) -> DataFrame:
    """All pairs of documents with pruned Jaccard >= t (0 < t <= 1), exactly.

    Prefix filtering: terms are ordered globally, frequent ones last; document d
    with n_d terms and weight w_d keeps its first n_d - ceil(t * w_d) + 1 terms.
    sim >= t implies m >= t * max(w_a, w_b), so two qualifying documents share a
    prefix term; the prefix self-join therefore finds every result pair.
    Candidates also pass the length filter min(w) >= t * max(w), the positional
    filter (at the first term that a pair shares, neither document may have
    fewer terms left than the match count needs) and a signature filter: the
    parities of the terms' hashes differ in no more bits than the sets do.
    They are verified by exact set intersection over integer term ids (hashes
    proven collision-free on the vocabulary).  Exact copies (same W and terms)
    are joined once through one representative and expanded afterwards, so
    intermediate data stays proportional to the result even when one text has
    very many copies.  With ``lo``/``hi`` only terms in that IDF band count as
    matches (F4).  Output as ``pairwise``.
    """
    return _threshold(I.doc_terms(docs), I.corpus_size(docs), t, policy, block_docs, lo, hi)


def _threshold(sets: DataFrame, n_docs: Column, t: float, policy: str, block_docs: int, lo: float | None, hi: float | None) -> DataFrame:
    from termlens.operators.prefix import threshold_pairs
    if not 0.0 < t <= 1.0:
        raise ValueError("threshold t must be in (0, 1]")
    return threshold_pairs(sets, n_docs, t, policy, block_docs, lo, hi)
