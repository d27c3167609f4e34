"""Threshold join over whole term sets: against brute force, and what it leaves out."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from termlens.operators import index as I
from termlens.operators import prefix as X
from termlens.operators import similarity as S


def long_docs(n: int = 24, words: int = 700):
    """Documents of more terms than ``WIDE_TERMS``: each third is a near copy of the one before; "all" is in every one."""
    rnd, rows = random.Random(5), []
    for i in range(n):
        ws = [f"v{rnd.randint(0, 4000)}" for _ in range(words)]
        if i % 3 == 2:
            ws = rows[-1][1].split()[: words * 4 // 5] + ws[: words // 5]
        rows.append((i, " ".join(ws + ["all"])))
    return rows


@pytest.mark.parametrize("bound", [None, 0])
def test_wide_signatures_lose_no_pair(spark, monkeypatch, bound):
    if bound is not None:  # the paths without broadcasts
        monkeypatch.setattr(X, "SIGNATURE_MAX_ROWS", bound)
        monkeypatch.setattr(X, "WIDE_MAX_ROWS", bound)
        monkeypatch.setattr(X, "ORDER_TERMS", bound)
    rows = long_docs()
    got = {(r.doc_a, r.doc_b): r.match_count for r in S.document_pairs_threshold(spark.createDataFrame(rows, "doc_id long, text string"), 0.5).collect()}
    sets = {i: set(t.split()) for i, t in rows}
    want = {}
    for a in sets:
        for b in sets:
            m = len(sets[a] & sets[b]) - 1  # "all" is a universal term
            if a < b and m / (len(sets[a]) + len(sets[b]) - m) >= 0.5:
                want[(a, b)] = m
    assert got == want and len(want) >= 8


@pytest.mark.parametrize("policy", I.POLICIES)
def test_documents_in_the_index_without_the_index(spark, policy):
    docs = spark.createDataFrame([(1, "u alpha beta"), (2, "u beta"), (3, "u lone"), (4, "u"), (4, "u gamma"), (None, "u beta")], "doc_id long, text string")
    sets = I.doc_terms(docs)
    dfs = sets.select(F.explode("terms").alias("term"), "doc_id").groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.min("doc_id").alias("doc"))
    n = I.corpus_size(docs)
    got = spark.range(1).select(X.indexed_docs(sets, dfs, n, policy).alias("n")).first().n
    want = I.prune(I.postings(docs), n, policy).select(F.countDistinct("doc_id").alias("n")).first().n
    assert got == want


def test_no_posting_is_shuffled_for_its_df(spark):
    """The prefix rows are exchanged once for both sides of their join."""
    docs = spark.createDataFrame(long_docs(), "doc_id long, text string")
    arrays, frequent = X.term_arrays(I.doc_terms(docs), I.corpus_size(docs), "both", None, None)
    cand = X.candidates(arrays, frequent, 0.5, 2048)
    cand.collect()
    assert "ReusedExchange" in cand._jdf.queryExecution().executedPlan().toString()
