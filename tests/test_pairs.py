"""Pair generation against brute force: blocked self-join, threshold join."""

from __future__ import annotations

import itertools
import random

import pytest

from termlens.operators import index as I
from termlens.operators import similarity as S
from termlens.operators.joins import term_pairs

VOCAB = ["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta", "theta", "iota", "kappa", "lam", "mu"]


def corpus(seed: int, n: int = 40):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        k = rnd.randint(0, 9)
        words = [rnd.choice(VOCAB[: rnd.randint(3, len(VOCAB))]) for _ in range(k)]
        rows.append((i, " ".join(words)))
    # a few exact duplicates and a hot term present almost everywhere
    rows += [(n + j, rows[j][1]) for j in range(5)]
    return rows


def brute(rows, lo_df=True):
    sets = {i: {w for w in t.split()} for i, t in rows}
    n = len(rows)
    df = {}
    for s in sets.values():
        for w in s:
            df[w] = df.get(w, 0) + 1
    kept = {w for w, c in df.items() if 1 < c < n} if lo_df else set(df)
    out = {}
    for a, b in itertools.combinations(sorted(sets), 2):
        m = len(sets[a] & sets[b] & kept)
        if m:
            wa, wb = len(sets[a]), len(sets[b])
            out[(a, b)] = (m, m / (wa + wb - m))
    return out


@pytest.mark.parametrize("block", [1, 2, 3, 2048])
def test_blocked_self_join_equals_brute_force(spark, block):
    rows = corpus(7)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = I.prune(I.postings(docs), I.corpus_size(docs), "both")
    pairs = term_pairs(kept, block_docs=block)
    got = {}
    for r in pairs.groupBy("doc_a", "doc_b").count().collect():
        got[(r.doc_a, r.doc_b)] = r["count"]
    want = {k: v[0] for k, v in brute(rows).items()}
    assert got == want


@pytest.mark.parametrize("seed,t", [(1, 0.3), (2, 0.5), (3, 0.8), (4, 1.0)])
def test_threshold_join_equals_brute_force(spark, seed, t):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_a, r.doc_b): (r.match_count, r.similarity)
           for r in S.pairwise_threshold(I.postings(docs), I.corpus_size(docs), t, block_docs=3).collect()}
    want = {k: v for k, v in brute(rows).items() if v[1] >= t}
    assert got == want


def test_pairwise_bounds_and_symmetry(spark):
    rows = corpus(11)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    res = S.pairwise(I.postings(docs), I.corpus_size(docs), lo=None).collect()
    for r in res:
        assert r.doc_a < r.doc_b
        assert 0.0 < r.similarity <= 1.0
        assert r.match_count <= min(r.w_a, r.w_b)


def test_threshold_join_with_a_huge_copy_group(spark):
    rows = corpus(5, 30)
    rows += [(1000 + i, "alpha beta gamma delta eps") for i in range(30)]  # half the corpus: copies
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_a, r.doc_b): (r.match_count, r.similarity)
           for r in S.pairwise_threshold(I.postings(docs), I.corpus_size(docs), 0.5, block_docs=4).collect()}
    want = {k: v for k, v in brute(rows).items() if v[1] >= 0.5}
    assert got == want
    assert sum(1 for a, b in got if a >= 1000 and b >= 1000) == 30 * 29 // 2


def test_pairwise_with_a_huge_copy_group(spark):
    rows = corpus(6, 30)
    rows += [(2000 + i, "alpha beta zeta") for i in range(30)]  # half the corpus: copies
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    post, n = I.postings(docs), I.corpus_size(docs)
    got = {(r.doc_a, r.doc_b): (r.match_count, r.similarity)
           for r in S.pairwise(post, n, lo=None, block_docs=4).collect()}
    assert got == brute(rows)
    weighted = {(r.doc_a, r.doc_b): (r.sum_min, r.sum_max)
                for r in S.pairwise_weighted(post, n, lo=None, block_docs=4).collect()}
    sets = {i: set(t.split()) for i, t in rows}
    for (a, b), (m, _) in got.items():
        wa, wb = len(sets[a]), len(sets[b])
        assert weighted[(a, b)] == (m * min(wa, wb), m * max(wa, wb))
    assert set(weighted) == set(got)
