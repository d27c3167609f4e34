"""Ranking of similarity results.

Top-k is ``row_number() over (partition by query_id order by ...) <= k``.
Spark plans this with a partial WindowGroupLimit before the shuffle, so each
input partition forwards at most k rows per query: one query that matches
the whole corpus never lands in a single task.  Full ties are broken by
document id so results are deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termlens.functions.measures import f1, overlap, round_half_up

TOP_K = 5
MAX_GROUP_K = 1000  # Spark's bound for its partial group limit


def layer1_filter(df: DataFrame, ratio: float = 0.1, m: str = "match_count",
                  q: str = "w_query") -> DataFrame:
    """F8 (ratio 1/10) / F9 (ratio 1/2): keep candidates with m >= q * ratio."""
    return df.where(F.col(m).cast("double") >= F.col(q).cast("double") * F.lit(ratio))


def with_scores(df: DataFrame, m: str = "match_count", q: str = "w_query",
                e: str = "w_doc") -> DataFrame:
    """M5/M6: add ``overlap`` and ``f1`` computed from m, q and e."""
    return df.withColumn("overlap", overlap(m, q, e)).withColumn("f1", f1(m, q, e))


def rank_v3_keys(sim: str = "similarity") -> list[Column]:
    """W4 sort keys: round(jaccard, 2), round(f1, 3), overlap, m — all desc."""
    return [
        F.desc(round_half_up(sim, 2)), F.desc(round_half_up("f1", 3)),
        F.desc("overlap"), F.desc("match_count"),
    ]


def rank_v1_keys(sim: str = "similarity") -> list[Column]:
    """W5 sort keys: round(jaccard, 4), overlap, m — all desc; no F1."""
    return [F.desc(round_half_up(sim, 4)), F.desc("overlap"), F.desc("match_count")]


def top_k(df: DataFrame, keys: list[Column], k: int = TOP_K, group: str | None = "query_id",
          tie: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Keep the best k rows per ``group`` (or overall) and number them 1..k.

    Overall, the k rows are taken first (each task sends its own best k) and
    only they are numbered.  Per group Spark keeps k rows per task and group
    before the shuffle up to k = 1000; a larger k is refused, because then all
    rows of a group would meet in one task.
    """
    order = [*keys, *[F.asc(c) for c in tie]]
    if group is None:
        first = df.orderBy(*order).limit(k)
        return first.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    if k > MAX_GROUP_K:
        raise ValueError(f"k per group must be at most {MAX_GROUP_K}")
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w).cast("bigint")).where(F.col("rank") <= k)


def rank_jpii(scores: DataFrame, version: int = 3, k: int = TOP_K,
              ratio: float | None = None) -> DataFrame:
    """P1 ranking stage over JPII rows (query_id, doc_id, match_count, w_query, w_doc, similarity).

    version 3: F8 (m >= q/10), keys of W4.   version 1: F9 (m >= q/2), keys of W5.
    Output: query_id, rank, doc_id, jaccard, f1, overlap, match_count.
    """
    if ratio is None:
        ratio = 0.1 if version == 3 else 0.5
    cand = with_scores(layer1_filter(scores, ratio))
    keys = rank_v3_keys() if version == 3 else rank_v1_keys()
    ranked = top_k(cand, keys, k)
    return ranked.select("query_id", "rank", "doc_id", F.col("similarity").alias("jaccard"),
                         "f1", "overlap", "match_count")


def rank_pairs(pairs: DataFrame, k: int = TOP_K) -> DataFrame:
    """P2 ranking: one global top-k over pairs, q = w_a and e = w_b (v3 keys)."""
    cand = with_scores(layer1_filter(pairs, 0.1, q="w_a"), q="w_a", e="w_b")
    ranked = top_k(cand, rank_v3_keys(), k, group=None, tie=("doc_a", "doc_b"))
    return ranked.select("rank", "doc_a", "doc_b", F.col("similarity").alias("jaccard"),
                         "f1", "overlap", "match_count")


def top_by_similarity(df: DataFrame, k: int, group: str | None = None,
                      tie: tuple[str, ...] = ("doc_a", "doc_b"),
                      threshold: float = 0.0) -> DataFrame:
    """Similarity >= threshold, sorted desc, first k (per group)."""
    cand = df.where(F.col("similarity") >= F.lit(threshold))
    return top_k(cand, [F.desc("similarity")], k, group=group, tie=tie)
