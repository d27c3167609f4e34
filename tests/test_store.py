"""Result store, keyed upserts and versions."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from termlens.operators.store import KeyedTable, ResultStore, keep_versions, latest


def _rows(spark, rows):
    return spark.createDataFrame(rows, "k long, ts timestamp, seq long, v string")


def test_latest_and_versions(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [(1, t, 1, "a"), (1, t + dt.timedelta(1), 2, "b"), (1, t + dt.timedelta(1), 3, "c"),
            (2, t, 4, "d")]
    df = _rows(spark, rows)
    got = {r.k: r.v for r in latest(df, ["k"], ["ts", "seq"]).collect()}
    assert got == {1: "c", 2: "d"}
    kv = keep_versions(df, ["k"], ["ts", "seq"], 2).collect()
    assert sorted((r.k, r.version, r.v) for r in kv) == [(1, 1, "c"), (1, 2, "b"), (2, 1, "d")]


PAIRS = "doc_a long, doc_b long, match_count long, w_a long, w_b long, similarity double"


def _store(spark, path, rows=((1, 2, 3, 4, 5, 0.5), (1, 3, 1, 4, 4, 1 / 7))):
    st = ResultStore(spark, str(path))
    st.write_similarity(spark.createDataFrame(list(rows), PAIRS), "pairwise")
    return st


def test_upsert_delete_and_reopen(spark, tmp_path):
    st = _store(spark, tmp_path / "s")
    st.write_similarity(spark.createDataFrame([(1, 2, 3, 4, 5, 0.9)], PAIRS), "pairwise")
    st.write_similarity(spark.createDataFrame([(1, 2, 3, 4, 5, 0.1)], PAIRS), "jpii")
    again = ResultStore(spark, str(tmp_path / "s"))  # nothing is kept in the object
    cur = {(r.mode, r.doc_a, r.doc_b): r.similarity for r in again.similarity.read().collect()}
    assert cur == {("pairwise", 1, 2): 0.9, ("pairwise", 1, 3): 1 / 7, ("jpii", 1, 2): 0.1}
    assert again.similarity.row_count() == 3
    again.similarity.delete(again.similarity.read().where("doc_b = 3"))
    assert sorted(p.name for p in (tmp_path / "s" / "similarity").iterdir() if p.name.startswith("mode=")) == ["mode=jpii", "mode=pairwise"]
    assert {(r.mode, r.doc_b) for r in st.similarity.read().collect()} == {("pairwise", 2), ("jpii", 2)}
    again.similarity.delete(again.similarity.read())
    assert st.similarity.read().count() == 0  # an emptied table can be read
    st.write_similarity(spark.createDataFrame([(1, 3, 1, 4, 4, 0.7)], PAIRS), "pairwise")
    assert [r.similarity for r in again.similarity.read().collect()] == [0.7]
    assert ResultStore(spark, str(tmp_path / "new")).similarity.read().count() == 0


def test_upsert_touches_only_its_partitions(spark, tmp_path):
    st = _store(spark, tmp_path / "s")
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "s" / "similarity" / "mode=pairwise").rglob("*.parquet")}
    st.write_similarity(spark.createDataFrame([(9, 8, 1, 1, 1, 1.0)], PAIRS), "jpii")
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "s" / "similarity" / "mode=pairwise").rglob("*.parquet")}
    assert before == after and before


def test_write_after_a_failed_write(spark, tmp_path):
    st = _store(spark, tmp_path / "s")
    bad = spark.createDataFrame([(5, 6, 1, 1, 1, 1.0)], PAIRS).withColumn("similarity", F.raise_error(F.lit("broken")).cast("double"))
    with pytest.raises(Exception, match="broken"):
        st.write_similarity(bad, "pairwise")
    assert st.similarity.read().count() == 2
    st.write_similarity(spark.createDataFrame([(5, 6, 1, 1, 1, 1.0)], PAIRS), "pairwise")
    assert st.similarity.read().count() == 3


def test_query_similarity_order_and_limits(spark, tmp_path):
    rows = [(i, i + 1, 1, 2, 2, (i * 7 % 20) / 20) for i in range(20)]
    st = _store(spark, tmp_path / "s", rows)
    got = [(r.similarity, r.doc_a) for r in st.query_similarity("pairwise", threshold=0.3).collect()]
    assert got == sorted(((s, a) for a, _, _, _, _, s in rows if s >= 0.3), key=lambda x: (-x[0], x[1]))
    assert st.query_similarity("pairwise", limit=0).count() == 0
    assert [r["rank"] for r in st.query_similarity("pairwise", limit=3).orderBy("rank").collect()] == [1, 2, 3]
    assert {(r.doc_a, r.doc_b) for r in st.query_similarity("pairwise", document=3).collect()} == {(3, 4), (2, 3)}


def test_ranked_skips_zero_weights(spark, tmp_path):
    st = _store(spark, tmp_path / "s", [(1, 2, 3, 4, 5, 0.5), (1, 3, 1, 0, 4, 0.9), (2, 3, 1, 4, 0, 0.8)])
    assert [(r.doc_a, r.doc_b) for r in st.ranked("pairwise").collect()] == [(1, 2)]


def test_keys_must_hold_the_partition_columns(spark, tmp_path):
    with pytest.raises(ValueError):
        KeyedTable(spark, str(tmp_path / "t"), "a long, b long, computed_at timestamp", ["a"], partition_by=["b"])


def test_postings_lookups(spark, tmp_path):
    st = ResultStore(spark, str(tmp_path / "idx"))
    p = spark.createDataFrame([("apple", 1, 3), ("apple", 2, 4), ("avocado", 2, 4), ("bean", 1, 3)],
                              "term string, doc_id long, w long")
    st.write_postings(p)
    assert st.lookup_term("apple").count() == 2
    assert [r.term for r in st.scan_terms("a", 1).select("term").distinct().collect()] == ["apple"]
    q = spark.createDataFrame([("bean",), ("zebra",)], "term string")
    assert [r.term for r in st.multiget_terms(q).collect()] == ["bean"]
    assert sorted(r.term for r in st.all_terms().collect()) == ["apple", "avocado", "bean"]


def test_a_large_bucket_is_written_by_several_tasks(spark, tmp_path):
    """One term holds most rows: its bucket is cut into files of the advised size, with every row once."""
    st = ResultStore(spark, str(tmp_path / "s"))
    rows = spark.range(60_000).selectExpr("if(id % 10 = 0, concat('t', id), 'hot') as term", "id as doc_id", "id % 7 as w")
    small = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "65536", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16384"}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        st.write_postings(rows)
    finally:
        for k in small:
            spark.conf.unset(k)
    got = st.postings.read().select("term", "doc_id", "w")
    assert got.count() == 60_000 and got.exceptAll(rows).count() == 0
    files = [r.n for r in got.where("term = 'hot'").groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
    assert len(files) > 2 and max(files) < 30_000
