"""End-to-end searches composed from the operators.

Each function takes DataFrames and returns a lazy DataFrame; nothing is
collected.  These take documents and tokenize them inside the plan; to run
many searches over one corpus, store the postings once
(``ResultStore.write_postings``) and call the operators of
``operators.similarity`` on the stored postings instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termlens.operators import index as I
from termlens.operators import ranking as R
from termlens.operators import similarity as S
from termlens.operators.joins import reuse


def jpii_search(docs: DataFrame, queries: DataFrame, k: int = 5, version: int = 3,
                policy: str = "both", exclude_self: bool = False) -> DataFrame:
    """Index -> query-term join -> match counts -> pruned Jaccard -> ranked top-k."""
    post = I.postings(docs)
    scores = S.jpii(post, I.corpus_size(docs), S.query_terms(queries), policy=policy,
                    exclude_self=exclude_self)
    return R.rank_jpii(scores, version=version, k=k)


def jpii_scores(docs: DataFrame, queries: DataFrame, policy: str = "both",
                exclude_self: bool = False) -> DataFrame:
    """J1/A7/M1 rows for every query and matching document."""
    return S.jpii(I.postings(docs), I.corpus_size(docs), S.query_terms(queries),
                  policy=policy, exclude_self=exclude_self)


def pairwise_search(docs: DataFrame, k: int = 5, lo: float | None = 0.05,
                    hi: float | None = 0.95) -> DataFrame:
    """Index -> IDF band -> Jaccard -> global top-k, without forming all pairs.

    The threshold join runs with falling thresholds until k ranked pairs lie
    above one: the first sort key is the rounded similarity, so pairs below a
    threshold cannot outrank k pairs that are half a rounding step above it.
    Only when the lowest threshold gives too few are all pairs scored.
    """
    for t in (0.9, 0.7, 0.5, 0.3):
        pairs = reuse(S.document_pairs_threshold(docs, t, lo=lo, hi=hi))
        sure = R.layer1_filter(pairs, 0.1, q="w_a").where(F.col("similarity") >= t + 0.005)
        if sure.limit(k).count() >= k:
            return R.rank_pairs(pairs, k)
        pairs.unpersist()
    return R.rank_pairs(S.document_pairs(docs, lo=lo, hi=hi), k)


def top_pairs(docs: DataFrame, k: int = 10, lo: float | None = 0.05, hi: float | None = 0.95) -> DataFrame:
    """The k pairs with the greatest similarity, then by ids; thresholds fall until k pairs reach one."""
    for t in (0.9, 0.7, 0.5, 0.3):
        pairs = reuse(S.document_pairs_threshold(docs, t, lo=lo, hi=hi))
        if pairs.limit(k).count() >= k:
            return R.top_by_similarity(pairs, k)
        pairs.unpersist()
    return R.top_by_similarity(S.document_pairs(docs, lo=lo, hi=hi), k)


def near_duplicates(docs: DataFrame, t: float = 0.8) -> DataFrame:
    """All pairs with pruned Jaccard >= t, via the exact prefix-filter join."""
    return S.document_pairs_threshold(docs, t)


def best_partners(docs: DataFrame, k: int = 5, lo: float | None = 0.05, hi: float | None = 0.95) -> DataFrame:
    """Each document's k best partners over kept terms in an IDF band, without forming all pairs."""
    from termlens.operators.neighbours import document_partners
    return document_partners(docs, k, lo, hi)


def recommend_per_doc(pairs: DataFrame, k: int = 5) -> DataFrame:
    """Best k partners per document from scored pairs (either side).

    Each pair is seen from both ends (two rows) and a top-k window per
    document keeps k rows; the partial group limit runs before the shuffle.
    """
    both = pairs.select(F.col("doc_a").alias("doc_id"), F.col("doc_b").alias("other"),
                        "similarity", "match_count").unionByName(
        pairs.select(F.col("doc_b").alias("doc_id"), F.col("doc_a").alias("other"),
                     "similarity", "match_count"))
    return R.top_k(both, [F.desc("similarity"), F.desc("match_count")], k,
                   group="doc_id", tie=("other",))
