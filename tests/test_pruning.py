"""Pruning and N' at size: postings are not sorted for the join, N' and the sweep's masks do not shuffle all postings."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from termlens.functions import text as T
from termlens.operators import index as I
from termlens.operators import metrics as X
from termlens.operators import similarity as S
from termlens.operators.stored import StoredIndex

# "common" is in most documents, every other word in one or two; 7 occurs twice, one id is null, 9 and 10 keep no term
DOCS = [(1, "common alpha beta"), (2, "common beta gamma"), (3, "common delta"), (4, "rare1 epsilon"), (5, "rare1 zeta"),
        (6, "common"), (7, "common eta"), (7, "theta rare2"), (None, "common rare2"), (8, None), (9, "lonely"), (10, "")]


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id long, text string")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_pruning_does_not_sort_the_postings(docs, no_broadcast):
    pruned = I.prune(I.postings(docs), I.corpus_size(docs))
    assert "SortMergeJoin" not in plan(pruned)
    rows = sorted((r.term, r.doc_id or 0, r.df) for r in pruned.collect())
    df = {}
    for _, text in DOCS:
        for t in set((text or "").split()):
            df[t] = df.get(t, 0) + 1
    want = sorted((t, d or 0, df[t]) for d, text in DOCS for t in set((text or "").split()) if 1 < df[t] < len(DOCS))
    assert rows == want


@pytest.mark.parametrize("frequent", [0, 1, 2, 100])
def test_indexed_documents_without_pruned_postings(spark, docs, frequent):
    post, n = I.postings(docs), I.corpus_size(docs)
    kept = I.kept_terms(post, n)
    got = spark.range(1).select(I.count_indexed_docs(post, kept, frequent).alias("n")).first().n
    assert got == I.prune(post, n).select("doc_id").where("doc_id is not null").distinct().count() == 7


def test_query_term_stats_reads_each_term_once(spark, docs):
    q = spark.createDataFrame([(1, "common rare1 lonely absent")], "query_id long, text string")
    post, n = I.postings(docs), I.corpus_size(docs)
    got = {r.term: (r.df, r.kept) for r in S.query_term_stats(post, n, S.query_terms(q), 0.0, 1.0).collect()}
    assert got == {"common": (6, True), "rare1": (2, True)}


def test_sweep_masks_of_the_query_terms_are_broadcast(spark, docs, no_broadcast):
    q = spark.createDataFrame([(1, "common rare1"), (2, "absent")], "query_id long, text string")
    known = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    out = X.size_sweep(known, S.query_terms(q), [2, 8])
    # the joins left to sort are those of a few rows per size and mode, and of documents with their size
    assert all("bit_or" not in part for part in plan(out).split("SortMergeJoin [term")[1:])
    assert "SortMergeJoin [term" not in plan(out)
    rows = {(r["size"], r["mode"]): r["jpii_pairs"] for r in out.collect()}
    assert rows[(8, "none")] >= rows[(2, "none")] == 2


def test_stored_index_holds_every_posting_with_its_df(spark, docs):
    ix = StoredIndex.create(docs.where("doc_id is not null"), buckets=2, hot_docs=2)
    got = {(r.term, r.doc_id, r.df) for r in ix.postings().collect()}
    assert ("common", 1, 5) in got and ("rare1", 4, 2) in got and len(got) == 18


@pytest.mark.parametrize("text", ["Don't -- stopée, naïve 中文。١٢ a_b c d", "\U0001f600x\U00010400y ́z", "...", ""])
def test_deleted_runs_are_the_deleted_characters(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    one = F.regexp_replace(F.lower("t"), T.NON_WORD_PATTERN, "")
    r = df.select(one.alias("a"), T.normalize_for_terms("t").alias("b")).first()
    assert r.a == r.b
