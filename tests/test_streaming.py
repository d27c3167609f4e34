"""Incremental index: batch upserts and the Structured Streaming driver."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.parquet as pq

from termlens.operators import index as I
from termlens.streaming.incremental import IndexState, apply_batch, index_postings, start_stream


def _full(spark, rows):
    d = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(tuple(r) for r in I.prune(I.postings(d), I.corpus_size(d), "both")
                  .select("term", "doc_id", "w", "df").collect())


def test_batch_upsert_replaces_changed_document(spark, tmp_path):
    st = IndexState(spark, str(tmp_path / "s"))
    b1 = [(1, "red fox jumps"), (2, "red dog sleeps"), (3, "blue cat")]
    apply_batch(st, spark.createDataFrame(b1, "doc_id long, text string"))
    b2 = [(3, "blue fox sleeps"), (4, "red cat"), (5, "")]
    apply_batch(st, spark.createDataFrame(b2, "doc_id long, text string"))
    apply_batch(st, spark.createDataFrame(b2, "doc_id long, text string"), batch_id=2)  # retried batch
    final = [(1, "red fox jumps"), (2, "red dog sleeps"), (3, "blue fox sleeps"), (4, "red cat"), (5, "")]
    got = sorted(tuple(r) for r in index_postings(st).select("term", "doc_id", "w", "df").collect())
    assert got == _full(spark, final)


def test_stream_of_files(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    batches = [[(1, "red fox jumps"), (2, "red dog sleeps")], [(3, "blue fox"), (4, "red cat sleeps")]]
    for i, b in enumerate(batches):
        t = pa.table({"doc_id": [r[0] for r in b], "text": [r[1] for r in b]})
        pq.write_table(t, str(src / f"part-{i}.parquet"))
    st = IndexState(spark, str(tmp_path / "s"))
    q = start_stream(spark, str(src), st, "doc_id long, text string", checkpoint=str(tmp_path / "ck"))
    q.processAllAvailable()
    q.stop()
    got = sorted(tuple(r) for r in index_postings(st).select("term", "doc_id", "w", "df").collect())
    assert got == _full(spark, batches[0] + batches[1])


def test_scoring_stream_matches_batch_scores(spark, tmp_path):
    from termlens.operators import similarity as S
    from termlens.streaming.incremental import start_scoring_stream
    src = tmp_path / "docs"
    src.mkdir()
    batches = [[(1, "red fox jumps"), (2, "blue dog sleeps")], [(3, "red dog"), (1, "red fox jumps")]]
    for i, b in enumerate(batches):
        pq.write_table(pa.table({"doc_id": [r[0] for r in b], "text": [r[1] for r in b]}),
                       str(src / f"part-{i}.parquet"))
    qt = S.query_terms(spark.createDataFrame([(10, "red dog"), (11, "fox")], "query_id long, text string"))
    st = IndexState(spark, str(tmp_path / "s"))
    q = start_scoring_stream(spark, str(src), st, "doc_id long, text string", qt, checkpoint=str(tmp_path / "ck"))
    q.processAllAvailable()
    q.stop()
    got = sorted((r.query_id, r.doc_id, r.match_count, r.similarity) for r in st.scores().read().collect())
    assert got == [(10, 1, 1, 1 / 4), (10, 2, 1, 1 / 4), (10, 3, 2, 1.0), (11, 1, 1, 1 / 3)]


def test_batch_with_repeated_ids_equals_a_rebuild(spark, tmp_path):
    st = IndexState(spark, str(tmp_path / "s"))
    rows = [(1, "red fox"), (1, "red dog"), (2, "red cat"), (2, "red cat"), (3, "fox dog")]
    apply_batch(st, spark.createDataFrame(rows, "doc_id long, text string"))
    got = sorted(tuple(r) for r in index_postings(st).select("term", "doc_id", "w", "df").collect())
    assert got == _full(spark, [(1, "red fox"), (2, "red cat"), (3, "fox dog")])


def test_batch_writes_only_its_rows_and_recovers(spark, tmp_path):
    st = IndexState(spark, str(tmp_path / "s"))
    apply_batch(st, spark.createDataFrame([(1, "red fox"), (2, "red dog"), (3, "fox")], "doc_id long, text string"))
    old = {p: p.stat().st_mtime_ns for p in (tmp_path / "s").rglob("batch=1/*.parquet")}
    full = sorted(tuple(r) for r in index_postings(st).collect())
    two = spark.createDataFrame([(2, "blue fox")], "doc_id long, text string")
    st.write("postings", I.postings(two), 2)  # the job ended between the two writes
    assert sorted(tuple(r) for r in index_postings(st).collect()) == full
    apply_batch(st, two, batch_id=2)
    assert {p: p.stat().st_mtime_ns for p in (tmp_path / "s").rglob("batch=1/*.parquet")} == old
    got = sorted(tuple(r) for r in index_postings(st).select("term", "doc_id", "w", "df").collect())
    assert got == _full(spark, [(1, "red fox"), (2, "blue fox"), (3, "fox")])
