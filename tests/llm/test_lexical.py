"""Block-Max MaxScore against a plain scorer."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from termlens.llm import lexical

PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return PATTERN.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, k=10):
    """Rows by scoring every document for every item."""
    tfs = [(i, Counter(terms(t))) for i, t in docs]
    n = sum(1 for _, c in tfs if c)
    total = sum(sum(c.values()) for _, c in tfs)
    df = Counter(t for _, c in tfs for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in tfs:
            m = 25 + 75 * sum(c.values()) * n // total if total else 25
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
                    for t in terms(text) if c[t])
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k], 1)]
    return out


def rows(df):
    return sorted(map(tuple, df.collect()), key=lambda r: (str(r[0]), r[1]))


def by_item(want):
    return sorted(want, key=lambda r: (str(r[0]), r[1]))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 1 << 34), max_size=40))
def test_packing(values):
    body, at = lexical.pack(np.array(values, dtype=np.int64))
    assert lexical.unpack(body).tolist() == values and len(at) == len(values)


def corpus(seed, n, vocabulary, longest):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)]
    weights = [1 / (i + 1) for i in range(vocabulary)]
    return [(i, " ".join(r.choices(words, weights, k=r.randint(0, longest)))) for i in range(n)], words, r


@pytest.mark.parametrize("shard_bytes", [1 << 12, 1 << 30])
def test_search_equals_the_plain_scorer(spark, shard_bytes):
    docs, words, r = corpus(3, 900, 120, 40)
    docs += [(i + 900, docs[0][1]) for i in range(30)]  # ties by the dozen
    items = [(q, " ".join(r.choices(words, k=r.randint(1, 12)))) for q in range(25)] + [(98, "w0 w0 W0 w1"), (99, "absent"), (100, None), (101, "")]
    index = lexical.build(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), shard_bytes=shard_bytes)
    got = lexical.search(index, spark.createDataFrame(items, "item_id long, text string"))
    assert rows(got) == by_item(plain(docs, items))
    sliced = lexical.search(index, spark.createDataFrame(items, "item_id long, text string"), query_bytes=300)
    assert rows(sliced) == rows(got)


def test_blocks_are_rejected_before_decompression():
    docs, _, _ = corpus(5, 6000, 300, 60)
    docs = [(i, t + (" rare rare rare" if i % 100 == 7 and i < 1500 else "")) for i, t in docs]
    shard = lexical._Shard()
    for i, t in docs:
        shard.add(i, t)
    held = {}
    lengths = np.array(shard.lengths)
    n, total = int((lengths > 0).sum()), int(lengths.sum())

    def mass_of(x):
        return 25 + (75 * x * n) // total

    for batch in list(shard.rows(0))[1:]:
        for term, size, head, body in lexical.rows_of([batch], "term", "n_docs", "head", "body"):
            held[term] = lexical.Postings(size, head, body, mass_of(lengths), mass_of)
    weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * p.n + 1))) for t, p in held.items()}
    query = ["rare", "w0", "w1", "w2"]
    best = lexical.best_of([(weight[t], held[t]) for t in query], np.arange(len(docs)), 10)
    assert [(1, r, i, s) for r, (i, s) in enumerate(zip(best.ids.tolist(), best.scores.tolist(), strict=True), 1)] == plain(docs, [(1, " ".join(query))])
    opened = {t: held[t].have.mean() for t in query}
    assert opened["rare"] == 1 and all(opened[t] < 0.5 for t in query[1:]), opened


def test_edges(spark):
    docs = [(None, "alpha beta"), (1, None), (2, ""), (3, "Alpha-BETA_gamma ÀLPHA é9"), (3, "alpha beta"), (3, "alpha beta"), (4, "x" * 3_000_000 + " alpha"),
            (5, "word " * 500_000)]
    items = [("a", "alpha"), ("a", "alpha"), ("a", "gamma alpha"), (None, "àlpha É9 ÀLPHA"), ("b", "x" * 3_000_000)]
    index = lexical.build(spark.createDataFrame([(*d, i, "s") for i, d in enumerate(docs)], "doc_id long, text string, shard int, term string"))
    table = spark.createDataFrame([(*q, 7) for q in items], "item_id string, text string, query int")
    want = by_item(r for q in dict.fromkeys(items) for r in plain(docs, [q]))
    assert sorted(rows(lexical.search(index, table)), key=str) == sorted(want, key=str)
    assert lexical.search(index, table.limit(0)).count() == 0
    empty = lexical.build(spark.createDataFrame([], "doc_id long, text string"))
    assert lexical.search(empty, table).count() == 0
    blank = lexical.build(spark.createDataFrame([(1, None)], "doc_id long, text string"))
    assert lexical.search(blank, table).count() == 0


def test_query(spark, tmp_path):
    from termlens.llm.queries import op12_search

    docs, words, r = corpus(9, 200, 60, 30)
    items = [(q, " ".join(r.choices(words, k=6))) for q in range(8)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = op12_search(spark, str(tmp_path))
    assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert rows(got) == by_item(plain(docs, items))
