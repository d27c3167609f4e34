"""Hand-checked golden corpus (FIXTURES.md section 4)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from termlens.operators import index as I
from termlens.operators import ranking as R
from termlens.operators import similarity as S
from termlens.plans import search as P
from termlens.sources.formats import index_text_lines


def test_terms_and_weights(golden):
    docs, _ = golden
    got = {r.doc_id: (sorted(r.terms), r.w) for r in I.doc_terms(docs).collect()}
    assert got["00001.txt"] == (sorted(["bison", "hunters", "trap", "snow"]), 4)
    assert got["00002.txt"] == (sorted(["trap", "lines", "deep", "snow", "dont", "lose"]), 6)
    assert got["00003.txt"] == (sorted(["bison", "herds", "deep", "rivers"]), 4)
    assert got["00004.txt"] == ([], 0)
    assert got["00005.txt"] == (sorted(["snow", "snow_melt", "rivers"]), 3)


def test_df_and_index_lines(golden):
    docs, _ = golden
    post = I.postings(docs)
    dfs = {r.term: r.df for r in I.term_df(post).collect()}
    assert (dfs["bison"], dfs["deep"], dfs["rivers"], dfs["snow"], dfs["trap"]) == (2, 2, 2, 3, 2)
    pruned = I.prune(post, I.corpus_size(docs), "both")
    lines = {r.term: r.line for r in index_text_lines(I.nested_index(pruned)).collect()}
    assert lines == {
        "bison": "bison\t00001.txt@4\t00003.txt@4",
        "deep": "deep\t00002.txt@6\t00003.txt@4",
        "rivers": "rivers\t00003.txt@4\t00005.txt@3",
        "snow": "snow\t00002.txt@6\t00001.txt@4\t00005.txt@3",
        "trap": "trap\t00002.txt@6\t00001.txt@4",
    }


def test_idf(golden):
    docs, _ = golden
    pruned = I.with_idf(I.prune(I.postings(docs), I.corpus_size(docs), "both"))
    idf = {r.term: r.idf for r in pruned.select("term", "idf").distinct().collect()}
    assert idf["bison"] == 0.5
    assert math.isclose(idf["snow"], math.log(4 / 3) / math.log(4), rel_tol=1e-12)
    kept = {r.term for r in I.idf_band(pruned, 0.3, 0.95).select("term").distinct().collect()}
    assert kept == {"bison", "deep", "rivers", "trap"}


def test_jpii_m1_and_ranking(golden):
    docs, q = golden
    s = S.jpii(I.postings(docs), I.corpus_size(docs), S.query_terms(q))
    got = {r.doc_id: (r.match_count, r.w_query, r.similarity) for r in s.collect()}
    assert got == {"00001.txt": (1, 4, 1 / 7), "00002.txt": (2, 4, 2 / 8),
                   "00003.txt": (2, 4, 2 / 6), "00005.txt": (2, 4, 2 / 5)}
    ranked = R.rank_jpii(s).orderBy("rank").collect()
    assert [r.doc_id for r in ranked] == ["00005.txt", "00003.txt", "00002.txt", "00001.txt"]
    f1 = {r.doc_id: r.f1 for r in ranked}
    ov = {r.doc_id: r.overlap for r in ranked}
    assert math.isclose(f1["00005.txt"], 4 / 7) and f1["00002.txt"] == 0.4 and f1["00001.txt"] == 0.25
    assert math.isclose(ov["00005.txt"], 2 / 3) and ov["00003.txt"] == 0.5
    v1 = R.rank_jpii(s, version=1).collect()
    assert {r.doc_id for r in v1} == {"00002.txt", "00003.txt", "00005.txt"}


def test_jpii_m3(golden):
    docs, q = golden
    s = S.jpii_idf(I.postings(docs), I.corpus_size(docs), S.query_terms(q), lo=0.05, hi=0.95)
    got = {r.doc_id: (r.w_query, r.similarity) for r in s.collect()}
    assert got == {"00001.txt": (3, 1 / 6), "00002.txt": (3, 2 / 7),
                   "00003.txt": (3, 2 / 5), "00005.txt": (3, 2 / 4)}


def test_pairwise_m2_m4(golden):
    docs, _ = golden
    post, n = I.postings(docs), I.corpus_size(docs)
    pj = {(r.doc_a[:5], r.doc_b[:5]): (r.match_count, r.similarity) for r in S.pairwise(post, n).collect()}
    assert pj == {("00001", "00002"): (2, 2 / 8), ("00001", "00003"): (1, 1 / 7),
                  ("00001", "00005"): (1, 1 / 6), ("00002", "00003"): (1, 1 / 9),
                  ("00002", "00005"): (1, 1 / 8), ("00003", "00005"): (1, 1 / 6)}
    pw = {(r.doc_a[:5], r.doc_b[:5]): (r.sum_min, r.sum_max)
          for r in S.pairwise_weighted(post, n).collect()}
    assert pw[("00001", "00002")] == (8, 12) and pw[("00001", "00003")] == (4, 4)
    assert pw[("00002", "00003")] == (4, 6) and pw[("00002", "00005")] == (3, 6)
    tight = {(r.doc_a[:5], r.doc_b[:5]): r.match_count for r in S.pairwise(post, n, lo=0.3).collect()}
    assert tight[("00001", "00002")] == 1 and ("00001", "00005") not in tight and ("00002", "00005") not in tight


def test_search_plan_end_to_end(golden):
    docs, q = golden
    top = P.jpii_search(docs, q, k=2).orderBy("rank").collect()
    assert [(r.rank, r.doc_id) for r in top] == [(1, "00005.txt"), (2, "00003.txt")]


def test_n_counts_empty_documents(golden):
    docs, _ = golden
    assert docs.select(I.corpus_size(docs).alias("n")).first().n == 5
    pruned = I.prune(I.postings(docs), I.corpus_size(docs), "both")
    assert pruned.select(I.indexed_doc_count(pruned).alias("n")).first().n == 4
    assert pruned.where(F.col("doc_id") == "00004.txt").count() == 0


def test_index_lines_have_one_form_at_every_chunk_size(golden):
    docs, _ = golden
    pruned = I.prune(I.postings(docs), I.corpus_size(docs), "both")
    whole = {r.term: r.line.split("\t")[1:] for r in index_text_lines(I.nested_index(pruned)).collect()}
    for size in (1, 2):
        parts = sorted((r.term, r.chunk, r.line.split("\t")[1:]) for r in index_text_lines(I.nested_index(pruned, chunk_docs=size)).collect())
        joined = {}
        for term, _, entries in parts:
            assert len(entries) <= size
            joined.setdefault(term, []).extend(entries)
        assert joined == whole
