"""Prefix-filter join over whole term sets (P8, F10), for ``similarity.pairwise_threshold``.

A document's terms stay in one row from the tokenizer to the verification: no
posting is shuffled to find its df.  That is possible because pruning changes
little that matters to a pair: a shared term has df > 1 by itself, so only terms
above the upper bounds (df = N, IDF below the band) have to be left out, and
those are few.  Terms are 64-bit hashes, proven free of collisions on the
vocabulary; a document's terms are sorted by (df, hash), where the df of the
``ORDER_TERMS`` most frequent terms is known to every task and all others count
as rarer than these.  Any order that is the same for all documents is exact; a
coarse one costs a few candidates only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from termlens.functions.measures import jaccard, normalized_idf
from termlens.operators import index as I
from termlens.operators.joins import reuse, row_count_at_most, small_side, term_pairs
from termlens.session import scratch_root

# Terms whose df is sent to every task to order by, and terms to leave out at most that way.
ORDER_TERMS = 100_000
# Longs of a document's parity signature, and signatures that are sent to every task at most.
SIGNATURE_LONGS = 16
SIGNATURE_MAX_ROWS = 600_000
# Documents of more terms have a second, wider one.
WIDE_TERMS, WIDE_LONGS, WIDE_MAX_ROWS = 384, 64, 150_000


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back."""
    path = f"{scratch_root(df.sparkSession, name)}/t"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def indexed_docs(sets: DataFrame, dfs: DataFrame, n_docs: Column, policy: str) -> Column:
    """A5 without the pruned index: N' = documents that keep a term (scalar subquery).

    A document is out only if each of its terms is of it alone or in every
    document, so its number of such terms is compared with W.
    """
    gone = {"both": ~I.keep_condition(F.col("df"), n_docs, "both"), "universal": F.col("df") >= n_docs,
            "single": F.col("df") <= 1, "none": F.lit(False)}[policy]
    lost = dfs.where(gone)
    alone = lost.where(F.col("df") == 1).groupBy(F.col("doc").alias("doc_id")).agg(F.count(F.lit(1)).alias("alone"))
    everywhere = F.coalesce(lost.where(F.col("df") > 1).select(F.count(F.lit(1)).alias("n")).scalar(), F.lit(0))
    held = sets.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.sum(F.size("terms")).alias("held"), F.count(F.lit(1)).alias("rows"))
    kept = F.col("held") - F.col("rows") * everywhere - F.coalesce(F.col("alone"), F.lit(0))
    return held.join(alone, "doc_id", "left").where(kept > 0).select(F.count(F.lit(1)).alias("n")).scalar()


def _merged(sets: DataFrame) -> DataFrame:
    """Rows of one (doc_id, w) as one row with all their terms; other rows are not shuffled."""
    if sets.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count() == 0:  # reads the ids only
        return sets
    again = sets.groupBy("doc_id", "w").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if again.limit(1).count() == 0:
        return sets
    again = small_side(again.select(F.col("doc_id").alias("_d"), F.col("w").alias("_w")))
    same = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("w") == F.col("_w"))
    return sets.join(again, same, "left_anti").unionByName(
        sets.join(again, same, "left_semi").groupBy("doc_id", "w").agg(F.flatten(F.collect_list("terms")).alias("terms")))


def _ordered(sets: DataFrame, order: dict[int, int], drop: list[int], seed: int) -> DataFrame:
    """(doc_id, w, ts, sig, wide): term hashes without ``drop``, sorted by (df in ``order``, hash), and their parity bits."""
    known = np.array(sorted(order), dtype=np.int64)
    rank = np.array([order[h] for h in known.tolist()], dtype=np.int64)
    gone = np.array(sorted(drop), dtype=np.int64)
    shared = sets.sparkSession.sparkContext.broadcast((known, rank, gone))

    def parity(h: np.ndarray, doc: np.ndarray, rows: int, longs: int) -> np.ndarray:
        """The longs of ``rows`` signatures, one after the other."""
        bits = 64 * longs
        place = (h.view(np.uint64) >> np.uint64(64 - bits.bit_length() + 1)).astype(np.int64)
        odd = np.bincount(doc * bits + place, minlength=rows * bits) & 1
        return np.packbits(odd.astype(np.uint8)).view(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rank, gone = shared.value
        for b in batches:
            hs = b.column(2)
            h = hs.flatten().to_numpy(zero_copy_only=False)
            doc = np.repeat(np.arange(len(b)), hs.value_lengths().to_numpy(zero_copy_only=False))
            if len(gone):
                keep = gone[np.minimum(np.searchsorted(gone, h), len(gone) - 1)] != h
                h, doc = h[keep], doc[keep]
            df = np.zeros(len(h), dtype=np.int64)
            if len(known):
                at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                df = np.where(known[at] == h, rank[at], 0)
            by = np.lexsort((h, df, doc))
            h, doc = h[by], doc[by]
            ends = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(b)))]).astype(np.int32)
            # merged rows may hold a term twice, which must not cancel out
            once = np.ones(len(h), dtype=bool)
            once[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
            sig = parity(h[once], doc[once], len(b), SIGNATURE_LONGS)
            large = np.diff(ends) > WIDE_TERMS
            number = np.cumsum(large) - 1
            here = once & large[doc]
            wide = parity(h[here], number[doc[here]], int(large.sum()), WIDE_LONGS)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.ListArray.from_arrays(pa.array(ends), pa.array(h)),
                 pa.ListArray.from_arrays(pa.array(np.arange(0, len(sig) + 1, SIGNATURE_LONGS, dtype=np.int32)), pa.array(sig)),
                 pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(large) * WIDE_LONGS]).astype(np.int32)), pa.array(wide))],
                names=["doc_id", "w", "ts", "sig", "wide"])

    ids = sets.select("doc_id", "w", F.transform("terms", lambda x: F.xxhash64(x, F.lit(seed))).alias("hs"))
    fields = [StructField("doc_id", ids.schema["doc_id"].dataType), StructField("w", LongType()),
              StructField("ts", ArrayType(LongType())), StructField("sig", ArrayType(LongType())), StructField("wide", ArrayType(LongType()))]
    return ids.mapInArrow(run, StructType(fields))


def free_seed(terms: DataFrame) -> int:
    """The seed that gives every one of the distinct ``terms`` (term, ...) an ``xxhash64`` of its own."""
    seed = 0
    while True:  # another seed in the case that two terms have the same hash
        c = terms.agg(F.count(F.lit(1)).alias("terms"), F.countDistinct(F.xxhash64("term", F.lit(seed))).alias("ids")).first()
        if c["terms"] == c["ids"]:
            return seed
        seed += 1


def vocabulary(sets: DataFrame, n_docs: Column, policy: str, lo: float | None, hi: float | None) -> tuple[DataFrame, DataFrame, int, list[int]]:
    """(sets, (term, df, doc) of all terms, seed, drop): the seed that gives every term an ``xxhash64`` of its own, and the ids of
    the terms of several documents that are pruned; where these are too many for a list they are taken from ``sets``."""
    post = sets.select(F.explode_outer("terms").alias("term"), "doc_id").where(F.col("term").isNotNull())
    dfs = stored(post.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.min("doc_id").alias("doc")), "terms")
    seed = free_seed(dfs)
    cond = I.keep_condition(F.col("df"), n_docs, policy)
    if lo is not None or hi is not None:
        idf = normalized_idf("df", indexed_docs(sets, dfs, n_docs, policy))
        cond = cond & idf.between(-1.0 if lo is None else lo, 2.0 if hi is None else hi)
    out = dfs.where((F.col("df") > 1) & ~F.coalesce(cond, F.lit(False)))
    drop = []
    if row_count_at_most(out, ORDER_TERMS):
        drop = [r.tid for r in out.select(F.xxhash64("term", F.lit(seed)).alias("tid")).collect()]
    else:  # too many to send to every task: the postings meet their terms by a join
        each = [c for c in ("terms", "vals") if c in sets.columns]
        rows = sets.select("doc_id", "w", F.inline(F.arrays_zip(*each))).withColumnRenamed("terms", "term").join(dfs.where(cond).select("term"), "term")
        packed = rows.groupBy("doc_id", "w").agg(F.collect_list(F.struct("term", *each[1:])).alias("p"))
        sets = packed.select("doc_id", "w", F.col("p.term").alias("terms"), *[F.col(f"p.{c}") for c in each[1:]])
    return sets, dfs, seed, drop


def term_arrays(sets: DataFrame, n_docs: Column, policy: str, lo: float | None, hi: float | None) -> tuple[DataFrame, DataFrame]:
    """Stored (doc_id, w, ts, sig, wide) of ``sets`` (doc_id, w, terms), and (tid, df) of the most frequent terms."""
    sets, dfs, seed, drop = vocabulary(sets, n_docs, policy, lo, hi)
    tid = F.xxhash64("term", F.lit(seed)).alias("tid")
    top = dfs.where(F.col("df") > 1).orderBy(F.desc("df"), "term").limit(ORDER_TERMS).select(tid, "df").collect()  # a fixed number at most
    arrays = stored(_ordered(_merged(sets), {r.tid: r.df for r in top}, drop, seed), "sets")
    return arrays, dfs.select(tid, "df")


def _alike(pairs: DataFrame, docs: DataFrame, t: float) -> DataFrame:
    """Pairs whose signatures differ in few enough bits.

    A bit is the parity of a document's terms that fall on it, so two documents
    differ in at least as many terms as bits; at similarity t they differ in at
    most (1 - t) / (1 + t) * (w_a + w_b) terms that count, next to the terms that were left out.
    """
    bits = [F.col("sig")[i] for i in range(SIGNATURE_LONGS)]
    side = docs.select("doc_id", (F.col("w") - F.size("ts")).alias("out"), *[b.alias(f"s{i}") for i, b in enumerate(bits)])
    few = row_count_at_most(side, SIGNATURE_MAX_ROWS)
    if not few:
        pairs = pairs.distinct()
    for e in "ab":
        own = side.select(F.col("doc_id").alias(f"doc_{e}"), F.col("out").alias(f"out_{e}"), *[F.col(f"s{i}").alias(f"s{i}{e}") for i in range(SIGNATURE_LONGS)])
        pairs = pairs.join(F.broadcast(own) if few else own, f"doc_{e}")
    diff = F.bit_count(F.col("s0a").bitwiseXOR(F.col("s0b")))
    for i in range(1, SIGNATURE_LONGS):
        diff = diff + F.bit_count(F.col(f"s{i}a").bitwiseXOR(F.col(f"s{i}b")))
    most = F.lit((1 - t) / (1 + t)) * (F.col("w_a") + F.col("w_b")) - F.col("out_a") - F.col("out_b") + F.lit(1e-6)
    pairs = pairs.where(diff <= most).select("doc_a", "doc_b", "w_a", "w_b", most.alias("most")).distinct()

    # the same with the wider signatures of large documents
    large = docs.where(F.size("wide") > 0)
    few = row_count_at_most(large, WIDE_MAX_ROWS)
    for e in "ab":
        own = large.select(F.col("doc_id").alias(f"doc_{e}"), F.col("wide").alias(f"wide_{e}"))
        pairs = pairs.join(F.broadcast(own) if few else own, f"doc_{e}", "left")
    diff = F.aggregate(F.zip_with("wide_a", "wide_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    return pairs.where(F.coalesce(diff <= F.col("most"), F.lit(True))).select("doc_a", "doc_b", "w_a", "w_b").distinct()


def candidates(docs: DataFrame, frequent: DataFrame, t: float, block_docs: int) -> DataFrame:
    """(doc_a, doc_b, w_a, w_b): pairs that share a prefix term and pass the length, positional and signature filters.

    Each prefix row is shuffled once: both sides of the join read the same
    exchange.  Only terms in more than ``block_docs`` prefixes go through the
    block-split join.
    """
    need = F.ceil(F.lit(t) * F.col("w") - F.lit(1e-9)).cast("int")
    plen = F.size("ts") - need + 1
    prefix = (docs.where(plen > 0)
              .select("doc_id", F.col("w").cast("int").alias("w"), F.size("ts").alias("size"), F.posexplode(F.slice("ts", F.lit(1), plen)).alias("pos", "tid"))
              .select("tid", "doc_id", "w", (F.col("size") - F.col("pos")).alias("rest")))
    enough = F.least("rest_a", "rest_b") >= F.lit(t / (1 + t)) * (F.col("w_a") + F.col("w_b")) - F.lit(1e-6)
    near = (F.least("w_a", "w_b") >= F.lit(t) * F.greatest("w_a", "w_b") - F.lit(1e-9)) & enough
    pair = ["doc_a", "doc_b", "w_a", "w_b"]
    maybe = small_side(frequent.where(F.col("df") > block_docs).select("tid"))
    hot = reuse(prefix.join(maybe, "tid", "left_semi").groupBy("tid").agg(F.count(F.lit(1)).alias("df")).where(F.col("df") > block_docs))
    many = hot.limit(1).count() > 0
    cold = prefix.join(small_side(hot.select("tid")), "tid", "left_anti") if many else prefix
    a, b = (cold.select("tid", F.col("doc_id").alias(f"doc_{e}"), F.col("w").alias(f"w_{e}"), F.col("rest").alias(f"rest_{e}")) for e in "ab")
    pairs = a.hint("merge").join(b, "tid").where((F.col("doc_a") < F.col("doc_b")) & near).select(*pair)
    if many:
        pairs = pairs.unionByName(term_pairs(prefix.join(small_side(hot), "tid"), block_docs, extra=("rest",), keys=("tid",)).where(near).select(*pair))
    return _alike(pairs, docs, t)


def threshold_pairs(sets: DataFrame, n_docs: Column, t: float, policy: str, block_docs: int,
                    lo: float | None, hi: float | None) -> DataFrame:
    """``similarity.pairwise_threshold`` over ``sets`` (doc_id, w, terms)."""
    from termlens.operators.similarity import _copy_groups, _expand_copies
    docs, frequent = term_arrays(sets, n_docs, policy, lo, hi)
    members = _copy_groups(docs.select("doc_id", "w", "ts"))
    reps = members.where(F.col("doc_id") == F.col("gid")).select("doc_id")
    copies = members.where(F.col("doc_id") != F.col("gid")).select("doc_id").distinct().join(reps, "doc_id", "left_anti")
    rdocs = docs.where("doc_id IS NOT NULL").join(small_side(copies), "doc_id", "left_anti")
    cand = stored(candidates(rdocs, frequent, t, block_docs), "candidates")
    # only documents of a candidate pair are shuffled with their terms
    held = cand.select(F.explode(F.array("doc_a", "doc_b")).alias("doc_id")).distinct()
    rsets = rdocs.join(small_side(held), "doc_id", "left_semi").select("doc_id", "ts")
    # verification is work per candidate, not per byte: at least a task per core
    cand = cand.repartition(sets.sparkSession.sparkContext.defaultParallelism)
    ver = (
        cand.join(rsets.select(F.col("doc_id").alias("doc_a"), F.col("ts").alias("ts_a")), "doc_a")
        .join(rsets.select(F.col("doc_id").alias("doc_b"), F.col("ts").alias("ts_b")), "doc_b")
        .select("doc_a", "doc_b", F.col("w_a").cast("bigint").alias("w_a"), F.col("w_b").cast("bigint").alias("w_b"),
                F.size(F.array_intersect("ts_a", "ts_b")).cast("bigint").alias("match_count"))
        .where(jaccard("match_count", "w_a", "w_b") >= F.lit(t))
    )
    ver = _expand_copies(ver, members, block_docs, jaccard("n", "w", "w") >= F.lit(t))
    out = ver.select("doc_a", "doc_b", "match_count", "w_a", "w_b",
                     jaccard("match_count", "w_a", "w_b").alias("similarity"))
    return out.where(F.col("similarity") >= F.lit(t))
