"""Result store: keyed Parquet tables.

A ``KeyedTable`` is one Parquet folder that Spark itself partitions and
commits: by the table's own partition columns and by a hash bucket of its
key.  An upsert reads and rewrites only the partitions that its rows fall
into (dynamic partition overwrite); a job that fails leaves the table as it
was, and running it again gives the same rows.  Schema, keys and partitioning
belong to the table's definition, so a table opened later behaves alike.

Keyed semantics are DataFrame operations:
  upsert      = union(touched old rows, new rows), then the latest row per key
  versions    = the ``v`` latest rows per key (W9)
  delete      = an upsert of rows marked as removed, which readers leave out (K12)
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from termlens.functions.measures import f1, overlap, score_band
from termlens.operators.ranking import rank_v3_keys, top_k
from termlens.session import scratch_root

POSTINGS_SCHEMA = "term string, doc_id bigint, w bigint, computed_at timestamp"
SIMILARITY_SCHEMA = ("mode string, doc_a bigint, doc_b bigint, match_count bigint, w_a bigint, "
                     "w_b bigint, similarity double, computed_at timestamp")


# --- keyed-row helpers (pure DataFrame functions) ----------------------------

def latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """S15/W9 with v=1: the row with the greatest ``order`` tuple per key.

    ``max(struct(order..., rest...))`` is a partial aggregate: every map task
    keeps one candidate per key before the shuffle, so a key holding a third
    of all rows still sends one row per task.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c) for c in order + rest])
    return df.groupBy(*keys).agg(F.max(packed).alias("_m")).select(*keys, *[F.col(f"_m.{c}").alias(c) for c in order + rest])


def keep_versions(df: DataFrame, keys: list[str], order: list[str], versions: int) -> DataFrame:
    """The ``versions`` newest rows per key (newest first by ``order``).

    ``row_number() <= v`` is planned with a partial WindowGroupLimit, so each
    task forwards at most v rows per key to the shuffle.
    """
    w_order = [F.desc(c) for c in order]
    w = Window.partitionBy(*keys).orderBy(*w_order)
    return (df.withColumn("version", F.row_number().over(w).cast("bigint"))
            .where(F.col("version") <= versions))


def delete_keys(df: DataFrame, doomed: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``df`` whose key is not in ``doomed`` (left anti join)."""
    return df.join(doomed.select(*keys).distinct(), keys, "left_anti")


def stamp(df: DataFrame) -> DataFrame:
    """Computed-at timestamp of the write."""
    return df.withColumn("computed_at", F.current_timestamp())


# --- keyed tables ----------------------------------------------------------------

class KeyedTable:
    """Rows of ``schema`` at ``path``: per ``keys`` the ``versions`` rows (W9; default one) of the greatest ``order``.

    ``partition_by`` columns become folders; inside them rows go to
    ``buckets`` folders by the hash of ``bucket_by`` (default: the keys).
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: Sequence[str],
                 order: Sequence[str] = ("computed_at",), partition_by: Sequence[str] = (),
                 bucket_by: Sequence[str] | None = None, buckets: int = 8, versions: int = 1):
        self.spark, self.path = spark, path.rstrip("/")
        self.keys, self.order = list(keys), list(order)
        self.versions = versions
        if not set(partition_by) <= set(keys):
            raise ValueError("partition columns must be part of the key")
        self.parts, self.bucket_by, self.buckets = list(partition_by), list(bucket_by or keys), buckets
        self.schema = spark.createDataFrame([], schema).schema
        self.columns = self.schema.names
        self._stored = spark.createDataFrame([], schema).withColumn("removed", F.lit(False)).withColumn("bucket", F.lit(0)).schema

    def _all(self) -> DataFrame:
        # an append without rows makes the folder of a table that was never written
        self.spark.createDataFrame([], self._stored).write.mode("append").partitionBy(*self.parts, "bucket").parquet(self.path)
        return self.spark.read.schema(self._stored).parquet(self.path)

    def read(self) -> DataFrame:
        """The current rows (F12-style filters are left to the caller)."""
        return self._all().where(~F.col("removed")).select(*self.columns)

    def _merge(self, rows: DataFrame) -> None:
        """Upsert stored-form rows; only the partitions they fall into are read and written."""
        delta_path = f"{scratch_root(self.spark, 'delta')}/t"
        rows = rows.withColumn("bucket", F.pmod(F.xxhash64(*self.bucket_by), F.lit(self.buckets)).cast("int"))
        rows.select(*self._stored.names).write.parquet(delta_path)
        delta = self.spark.read.schema(self._stored).parquet(delta_path)
        places = [*self.parts, "bucket"]
        touched = delta.select(*places).distinct().collect()  # partitions of the table: a bounded number
        if not touched:
            return
        at = F.lit(False)
        for t in touched:
            here = F.lit(True)
            for c in places:
                here = here & F.col(c).eqNullSafe(F.lit(t[c]))
            at = at | here
        merged = self._all().where(at).unionByName(delta)
        if self.versions == 1:
            out = latest(merged, [*self.keys, "bucket"], [*self.order, "removed"])
        else:  # a repeated row is one version; each task sends at most ``versions`` rows of a key to the merge
            out = keep_versions(merged.distinct(), [*self.keys, "bucket"], self.order, self.versions)
        # rows of one place are written by as many tasks as their size asks for
        (out.select(*self._stored.names).hint("rebalance", *places).sortWithinPartitions(*places, *self.bucket_by)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*places).parquet(self.path))

    def upsert(self, rows: DataFrame) -> None:
        """New rows replace older rows of their key."""
        self._merge(rows.select(*self.columns).withColumn("removed", F.lit(False)))

    def delete(self, doomed: DataFrame) -> None:
        """Remove the rows whose key is in ``doomed`` (marked as removed now)."""
        if self.order != ["computed_at"] or self.versions > 1:
            raise ValueError("delete needs a table of one version, ordered by computed_at")
        gone = doomed.select(*self.keys).distinct().withColumn("computed_at", F.current_timestamp()).withColumn("removed", F.lit(True))
        for f in self.schema:
            if f.name not in gone.columns:
                gone = gone.withColumn(f.name, F.lit(None).cast(f.dataType))
        self._merge(gone)

    def row_count(self) -> int:
        """K4: number of distinct row keys."""
        return self.read().select(*self.keys).distinct().count()


class ResultStore:
    """The tables of one run under ``root`` (default: a fresh folder in the cluster's shared folder)."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        root = (root or scratch_root(spark, "store")).rstrip("/")
        self.spark, self.root = spark, root
        self.similarity = KeyedTable(spark, f"{root}/similarity", SIMILARITY_SCHEMA, ["mode", "doc_a", "doc_b"], partition_by=["mode"])
        self.postings = KeyedTable(spark, f"{root}/postings", POSTINGS_SCHEMA, ["term", "doc_id"], bucket_by=["term"])

    def write_postings(self, post: DataFrame) -> None:
        """Index rows keyed by (term, doc_id), newest computed_at wins."""
        self.postings.upsert(stamp(post.select("term", "doc_id", "w")))

    def write_similarity(self, rows: DataFrame, mode: str) -> None:
        """Similarity rows keyed by (mode, doc_a, doc_b) with timestamp and mode."""
        self.similarity.upsert(stamp(rows.select("doc_a", "doc_b", "match_count", "w_a", "w_b", "similarity")
                                     .withColumn("mode", F.lit(mode))))

    # -- K5-K7 lookups on the index --
    def lookup_term(self, term: str) -> DataFrame:
        """K5: postings of one term (filter pushed to the Parquet scan)."""
        return self.postings.read().where(F.col("term") == F.lit(term))

    def multiget_terms(self, terms: DataFrame) -> DataFrame:
        """Postings of many terms; missing terms are simply absent."""
        from termlens.operators.joins import small_side
        return self.postings.read().join(small_side(terms.select("term").distinct()), "term", "left_semi")

    def scan_terms(self, prefix: str = "", limit: int = 100) -> DataFrame:
        """K6: postings of the first ``limit`` terms (in term order) with ``prefix``."""
        p = self.postings.read().where(F.col("term").startswith(prefix))
        first = p.select("term").distinct().orderBy("term").limit(limit)
        return p.join(first, "term", "left_semi")

    def all_terms(self) -> DataFrame:
        """K7: every distinct term."""
        return self.postings.read().select("term").distinct()

    # -- K8-K10 result queries --
    def query_similarity(self, mode: str, document: int | None = None, threshold: float = 0.0,
                         limit: int | None = None) -> DataFrame:
        """Rows of ``mode`` (optionally touching ``document`` on either
        side) with similarity >= threshold, best first; with ``limit`` the
        best so many, numbered (0 gives none)."""
        s = self.similarity.read().where(F.col("mode") == mode)
        if document is not None:
            s = s.where((F.col("doc_a") == document) | (F.col("doc_b") == document))
        s = s.where(F.col("similarity") >= threshold)
        if limit is not None:
            return top_k(s, [F.desc("similarity")], limit, group=None, tie=("doc_a", "doc_b"))
        return s.orderBy(F.desc("similarity"), "doc_a", "doc_b")

    def ranked(self, mode: str, k: int = 5) -> DataFrame:
        """Rank stored rows (F12, M5, M6, W4): best k by v3 keys.

        The stored w_a / w_b are the real weights of the two documents;
        rows with a zero weight are skipped (F12).
        """
        s = self.similarity.read().where((F.col("mode") == mode) & (F.col("w_a") > 0) & (F.col("w_b") > 0))
        s = s.withColumn("overlap", overlap("match_count", "w_a", "w_b")).withColumn(
            "f1", f1("match_count", "w_a", "w_b"))
        r = top_k(s, rank_v3_keys(), k, group=None, tie=("doc_a", "doc_b"))
        return r.withColumn("band", score_band("similarity"))


def export_ranked(ranked: DataFrame, path: str, fmt: str = "csv") -> None:
    """Write ranked rows as CSV with a header, or as JSON lines."""
    if fmt == "csv":
        ranked.write.mode("errorifexists").option("header", True).csv(path)
    else:
        ranked.write.mode("errorifexists").json(path)
