"""Join helpers shared by the operators.

* ``small_side``: broadcast a side only after its row count is checked
  against a bound; above the bound the plain join is kept (sort-merge or
  shuffle-hash, with AQE free to re-plan from measured sizes).
* ``term_pairs``: all unordered document pairs that share a term, with hot
  terms split into document blocks so no task receives more than about
  ``block_docs`` x ``block_docs`` pairs of one term.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Default bound for sides we broadcast after a check (rows).
BROADCAST_MAX_ROWS = 2_000_000
# Default documents per block of a hot term in the pair self-join.
BLOCK_DOCS = 2048


def row_count_at_most(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows (reads at most max_rows+1)."""
    return df.limit(max_rows + 1).count() <= max_rows


def small_side(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast when its checked row count is within bound."""
    return F.broadcast(df) if row_count_at_most(df, max_rows) else df


def reuse(df: DataFrame) -> DataFrame:
    """Keep an intermediate that two plan branches read (df counting and the
    join that consumes the counts), so the tokenizer above it runs once.

    MEMORY_AND_DISK: blocks that do not fit spill to local disk; blocks of a
    lost executor are recomputed from lineage for those partitions only.
    """
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def term_pairs(postings: DataFrame, block_docs: int = BLOCK_DOCS,
               extra: tuple[str, ...] = (), keys: tuple[str, ...] = ("term",)) -> DataFrame:
    """Self-join of postings on term emitting each unordered pair once.

    Input columns: ``keys`` (default: term), doc_id, w, df, plus ``extra``
    per-posting columns; df is the number of postings of the key.
    Output: keys, doc_a, doc_b, w_a, w_b and ``<extra>_a``/``<extra>_b``,
    with doc_a < doc_b.

    A term with df documents is cut into nb = ceil(df / block_docs) blocks
    by a hash of doc_id.  Block pair (i, j) with i <= j is one join key, so
    a hot term is spread over nb*(nb+1)/2 tasks instead of one.  The left
    side is copied to blocks j >= i, the right side to blocks i <= j; for
    i < j every pair is emitted once in either order and canonicalised,
    for i == j the usual doc_a < doc_b test applies.  Terms with df <=
    block_docs have nb = 1 and are not copied at all.
    """
    nb = F.greatest(F.lit(1), F.ceil(F.col("df") / F.lit(block_docs))).cast("int")
    cols = [*keys, "doc_id", "w", *extra]
    base = postings.select(*cols, nb.alias("_nb")).withColumn(
        "_blk", F.pmod(F.xxhash64("doc_id"), F.col("_nb")).cast("int"))

    left = base.select(
        *keys,
        F.col("_blk").alias("_bi"),
        F.explode(F.sequence(F.col("_blk"), F.col("_nb") - 1)).alias("_bj"),
        F.col("doc_id").alias("_l_doc"), F.col("w").alias("_l_w"),
        *[F.col(c).alias(f"_l_{c}") for c in extra],
    )
    right = base.select(
        *keys,
        F.explode(F.sequence(F.lit(0), F.col("_blk"))).alias("_bi"),
        F.col("_blk").alias("_bj"),
        F.col("doc_id").alias("_r_doc"), F.col("w").alias("_r_w"),
        *[F.col(c).alias(f"_r_{c}") for c in extra],
    )
    j = left.join(right, [*keys, "_bi", "_bj"]).where(
        (F.col("_bi") < F.col("_bj")) | (F.col("_l_doc") < F.col("_r_doc"))
    )
    l_first = F.col("_l_doc") < F.col("_r_doc")

    def pick(a: str, b: str):
        return F.when(l_first, F.col(a)).otherwise(F.col(b))

    return j.select(
        *keys,
        pick("_l_doc", "_r_doc").alias("doc_a"),
        pick("_r_doc", "_l_doc").alias("doc_b"),
        pick("_l_w", "_r_w").alias("w_a"),
        pick("_r_w", "_l_w").alias("w_b"),
        *[pick(f"_l_{c}", f"_r_{c}").alias(f"{c}_a") for c in extra],
        *[pick(f"_r_{c}", f"_l_{c}").alias(f"{c}_b") for c in extra],
    )
