"""Document block products against brute force; no pair and no posting is shuffled to count pairs."""

from __future__ import annotations

import random
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from termlens.operators import blocks as B
from termlens.operators import index as I
from termlens.operators import similarity as S
from termlens.operators import weighted as WT
from termlens.operators.metrics import corpus_sweep


def texts(seed: int, n: int = 60) -> list[tuple[str, str]]:
    r = random.Random(seed)
    return [(f"d{i:03}", " ".join(f"w{int(r.expovariate(0.08))}" for _ in range(r.randint(0, 40)))) for i in range(n)]


def kept(rows, times: int = 1):
    counts = [(i, Counter(t.split())) for i, t in rows]
    df = Counter(w for _, c in counts for w in c for _ in range(times))
    return [(i, c, {w: k for w, k in c.items() if 1 < df[w] < times * len(rows)}) for i, c in counts]


def plan(df) -> str:
    return df._jdf.queryExecution().sparkPlan().toString()


@pytest.mark.parametrize("dense", [0, 3, 1024])
def test_pairs_equal_brute_force_and_nothing_is_shuffled(spark, monkeypatch, dense):
    monkeypatch.setattr(B, "DENSE_TERMS", dense)
    monkeypatch.setattr(B, "STEP", 50)
    monkeypatch.setattr(B, "ROWS", 16)
    rows = texts(1)
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    got = S.document_pairs(docs, lo=None, hi=None, block_docs=9)
    want = set()
    for (a, ca, x), (b, cb, y) in combinations(kept(rows), 2):
        if m := len(x.keys() & y.keys()):
            want.add((a, b, m, len(ca), len(cb), m / (len(ca) + len(cb) - m)))
    found = [tuple(r) for r in got.collect()]
    assert set(found) == want and len(found) == len(want)
    assert "CartesianProduct" in plan(got) and "Exchange" not in got._jdf.queryExecution().executedPlan().toString()


def test_term_frequencies(spark):
    rows = texts(2) + [("many", "w1 " * 300 + "w2")]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    got = S.pairwise_weighted(I.postings_tf(docs), I.corpus_size(docs), lo=None, hi=None, weight="tf", block_docs=9)
    want = set()
    for (a, _, x), (b, _, y) in combinations(sorted(kept(rows), key=lambda r: r[0]), 2):
        if both := x.keys() & y.keys():
            want.add((a, b, len(both), sum(min(x[w], y[w]) for w in both), sum(max(x[w], y[w]) for w in both)))
    assert {tuple(r) for r in got.select("doc_a", "doc_b", "match_count", "sum_min", "sum_max").collect()} == want
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()


def test_repeated_rows_count_as_often_as_they_occur(spark):
    rows = texts(3, 20) + [("copy", texts(3, 20)[4][1])]
    docs = spark.createDataFrame(rows * 2 + [(None, "w1 w2")], "doc_id string, text string")
    got = {(r.doc_a, r.doc_b): r.match_count for r in S.document_pairs(docs, policy="none", lo=None, hi=None, block_docs=4).collect()}
    sets = {i: set(t.split()) for i, t in rows}
    want = {}
    for a, b in combinations(sorted(sets), 2):
        if m := len(sets[a] & sets[b]):
            want[a, b] = 2 * m if sets[a] == sets[b] else 4 * m
    assert got == want


def test_weight_bands_and_corpora(spark):
    rows = texts(4)
    docs = spark.createDataFrame([(*r, "ab"[k % 2]) for k, r in enumerate(rows)], "doc_id string, text string, lang string")
    got = WT.document_pairs_weighted_threshold(docs, 0.9, None, None, block_docs=5)
    whole = S.document_pairs_weighted(docs, lo=None, hi=None).where(F.least("w_a", "w_b") / F.greatest("w_a", "w_b") >= 0.9)
    assert {tuple(r) for r in got.select(*whole.columns).collect()} == {tuple(r) for r in whole.collect()}
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    sweep = {r.corpus: r.pairwise_pairs for r in corpus_sweep(docs, S.query_terms(docs.limit(2), "doc_id")).collect()}
    again = {r.corpus: r.pairwise_pairs for r in corpus_sweep(docs.unionByName(docs), S.query_terms(docs.limit(2), "doc_id"), policy="none").collect()}
    for k, lang in enumerate("ab"):
        assert again[lang] == sum(1 for (_, x), (_, y) in combinations(rows[k::2], 2) if set(x.split()) & set(y.split()))
        assert sweep[lang] == sum(1 for (_, _, x), (_, _, y) in combinations(kept(rows[k::2]), 2) if x.keys() & y.keys())
