"""Incremental index maintenance (K13), batch and Structured Streaming.

State is four folders of delta partitions, one of each per batch:
  postings/batch=<n>  (term, doc_id, w)   unpruned postings of the batch's documents
  counts/batch=<n>    (term, delta)       by how much the batch changes each term's df
  totals/batch=<n>    (docs, sketch)      by how much it changes N, and a sketch of its ids
  docs/batch=<n>      (doc_id, w)         the documents themselves, written last

A document's current rows are those of its newest batch in ``docs``; readers
join postings to that.  A batch therefore writes only its own rows, and
postings whose ``docs`` partition was never written (a failure between the two
writes) are not seen.  Writing a batch again overwrites its own partitions
only.  Pruning (df, N) is applied when the index is read, because a new
document changes df and N for terms it does not even contain.

``index_postings`` counts df over all current postings; ``index_postings_by_counts``
sums the batches' small signed counts instead.  A batch that changes documents
counts -1 for each term of their rows of before and +1 for each new one.  N is the
sum of the batches' changes (``doc_count``), or an estimate from the united
sketches (``estimated_docs``, A6), which a repeated id does not move.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from termlens.operators import index as I
from termlens.operators.joins import reuse, small_side
from termlens.operators.store import KeyedTable, stamp
from termlens.session import scratch_root

DOCS_SCHEMA = "doc_id bigint, w bigint, batch bigint"
POSTINGS_SCHEMA = "term string, doc_id bigint, w bigint, batch bigint"
COUNTS_SCHEMA = "term string, delta bigint, batch bigint"
TOTALS_SCHEMA = "docs bigint, sketch binary, batch bigint"
SKETCH_LG_K = 14  # 2^14 registers: a standard error of about 0.8 %
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_LG_K / 2)
_SCHEMAS = {"docs": DOCS_SCHEMA, "postings": POSTINGS_SCHEMA, "counts": COUNTS_SCHEMA, "totals": TOTALS_SCHEMA}
SCORES_SCHEMA = ("query_id bigint, doc_id bigint, match_count bigint, w_query bigint, w_doc bigint, "
                 "similarity double, computed_at timestamp")


class IndexState:
    """The delta folders of one index under ``root``."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark, self.root = spark, (root or scratch_root(spark, "index")).rstrip("/")

    def read(self, table: str) -> DataFrame:
        schema = _SCHEMAS[table]
        path = f"{self.root}/{table}"
        # an append without rows makes the folder of a table that was never written
        self.spark.createDataFrame([], schema).write.mode("append").partitionBy("batch").parquet(path)
        return self.spark.read.schema(schema).parquet(path)

    def write(self, table: str, rows: DataFrame, batch: int) -> None:
        (rows.withColumn("batch", F.lit(batch).cast("bigint")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{self.root}/{table}"))

    def scores(self) -> KeyedTable:
        return KeyedTable(self.spark, f"{self.root}/scores", SCORES_SCHEMA, ["query_id", "doc_id"])


def apply_batch(state: IndexState, batch: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                batch_id: int | None = None) -> None:
    """Add a batch of new or changed documents; their postings replace earlier ones.

    If a batch repeats an id, the row with the greatest text counts.
    ``batch_id`` (default: one more than the last) must grow from batch to
    batch; a retry passes the same one.
    """
    if batch_id is None:
        batch_id = (state.read("docs").agg(F.max("batch")).first()[0] or 0) + 1
    one = batch.groupBy(id_col).agg(F.max(text_col).alias(text_col))
    terms = reuse(I.doc_terms(one, id_col, text_col))
    post = terms.select(F.explode_outer("terms").alias("term"), "doc_id", "w").where(F.col("term").isNotNull())
    state.write("postings", post, batch_id)
    # what the batch changes: the rows that its documents had before it, and their new ones
    ids = small_side(terms.select("doc_id"))
    before = state.read("docs").where(F.col("batch") < batch_id).join(ids, "doc_id", "left_semi").groupBy("doc_id").agg(F.max("batch").alias("batch"))
    before = reuse(before)
    old = state.read("postings").where(F.col("batch") < batch_id).join(small_side(before), ["doc_id", "batch"]).select("term", F.lit(-1).cast("bigint").alias("delta"))
    new = state.read("postings").where(F.col("batch") == batch_id).select("term", F.lit(1).cast("bigint").alias("delta"))
    delta = old.unionByName(new).groupBy("term").agg(F.sum("delta").alias("delta")).where("delta <> 0")
    state.write("counts", delta, batch_id)
    known = before.select(F.count(F.lit(1)).alias("n")).scalar()
    total = terms.agg((F.count(F.lit(1)) - known).alias("docs"), F.hll_sketch_agg("doc_id", F.lit(SKETCH_LG_K)).alias("sketch"))
    state.write("totals", total, batch_id)
    state.write("docs", terms.select("doc_id", "w"), batch_id)
    before.unpersist()
    terms.unpersist()


def current_docs(state: IndexState) -> DataFrame:
    """(doc_id, batch): each document's newest batch."""
    return state.read("docs").groupBy("doc_id").agg(F.max("batch").alias("batch"))


def index_postings(state: IndexState, policy: str = "both") -> DataFrame:
    """Pruned postings of the current state; N = documents in the registry."""
    docs = current_docs(state)
    post = state.read("postings").join(docs, ["doc_id", "batch"]).select("term", "doc_id", "w")
    return I.prune(post, I.corpus_size(docs), policy)


def _of_written_batches(state: IndexState, table: str) -> DataFrame:
    """Rows of the batches whose ``docs`` partition was written (a batch without documents changes nothing)."""
    return state.read(table).join(F.broadcast(state.read("docs").select("batch").distinct()), "batch", "left_semi")  # a row per batch


def doc_count(state: IndexState):
    """A2: N, the sum of what each batch changed (scalar subquery)."""
    return _of_written_batches(state, "totals").select(F.coalesce(F.sum("docs"), F.lit(0)).alias("n")).scalar()


def estimated_docs(state: IndexState):
    """N estimated from the batches' sketches, within a standard error of ``SKETCH_ERROR`` (scalar subquery)."""
    united = _of_written_batches(state, "totals").select(F.hll_union_agg("sketch").alias("s"))
    return united.select(F.coalesce(F.hll_sketch_estimate("s"), F.lit(0)).alias("n")).scalar()


def term_counts(state: IndexState) -> DataFrame:
    """A4: (term, df) from the signed counts of all batches."""
    return _of_written_batches(state, "counts").groupBy("term").agg(F.sum("delta").alias("df")).where("df > 0")


def index_postings_by_counts(state: IndexState, policy: str = "both") -> DataFrame:
    """``index_postings`` with df and N from the batches' counts; postings are read once and not counted."""
    kept = term_counts(state).where(I.keep_condition(F.col("df"), doc_count(state), policy))
    post = state.read("postings").join(current_docs(state), ["doc_id", "batch"]).select("term", "doc_id", "w")
    return post.join(kept, "term")


def start_stream(spark: SparkSession, source_dir: str, state: IndexState, schema: str,
                 checkpoint: str | None = None, max_files_per_trigger: int = 1,
                 id_col: str = "doc_id", text_col: str = "text") -> StreamingQuery:
    """Stream Parquet files of documents from ``source_dir`` into the index.

    Each micro-batch runs ``apply_batch`` through ``foreachBatch`` under its
    epoch as batch number; progress is tracked in ``checkpoint`` (default:
    under the shared checkpoint folder), so a restarted query resumes after
    the last committed batch and repeats an unfinished one under its number.
    """
    ckpt = checkpoint or scratch_root(spark, "stream-ckpt", keep=True)
    src = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
           .parquet(source_dir))

    def _each(batch: DataFrame, epoch: int) -> None:
        apply_batch(state, batch, id_col, text_col, batch_id=epoch + 1)

    return src.writeStream.foreachBatch(_each).option("checkpointLocation", ckpt).start()


def score_batch(state: IndexState, batch: DataFrame, query_terms: DataFrame,
                id_col: str = "doc_id", text_col: str = "text") -> None:
    """Score one batch of arriving documents against fixed queries (J1 + M1).

    df and N move while documents arrive, so no df pruning is applied: m
    counts every shared term.  Rows are upserted into the ``scores`` table
    keyed by (query_id, doc_id), newest wins, so a retried batch (or a
    re-sent document) replaces its earlier rows instead of adding to them.
    """
    from termlens.operators.similarity import jpii
    post = I.postings(batch, id_col, text_col)
    n = F.lit(0)  # unused by the "none" policy
    s = stamp(jpii(post, n, query_terms, policy="none"))
    state.scores().upsert(s)


def start_scoring_stream(spark: SparkSession, source_dir: str, state: IndexState, schema: str,
                         query_terms: DataFrame, checkpoint: str | None = None,
                         max_files_per_trigger: int = 1) -> StreamingQuery:
    """Stream document files and keep their scores against ``query_terms``."""
    ckpt = checkpoint or scratch_root(spark, "score-ckpt", keep=True)
    src = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
           .parquet(source_dir))

    def _each(batch: DataFrame, _epoch: int) -> None:
        score_batch(state, batch, query_terms)

    return src.writeStream.foreachBatch(_each).option("checkpointLocation", ckpt).start()
