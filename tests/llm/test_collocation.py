"""Phrase collocations against counts of every n-gram."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from termlens.llm import collocation


def plain(docs, min_count, top):
    grams, total = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            ws = re.findall("[^ \t]+", piece)
            total[lang] += len(ws)
            for m in range(1, 6):
                grams[lang].update(tuple(ws[i:i + m]) for i in range(len(ws) - m + 1))
    out = []
    for lang, g in grams.items():
        cand = {p: a for p, a in g.items() if len(p) > 1 and a >= min_count}
        part = Counter()
        for p, a in cand.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    part[p[i:i + m]] = max(part[p[i:i + m]], a)
        rows = []
        for p, a in cand.items():
            if 100 * part[p] >= 100 * a:
                continue
            s, _, left, right = min((1000 * a * total[lang] // (g[p[:k]] * g[p[k:]]), k, g[p[:k]], g[p[k:]]) for k in range(1, len(p)))
            rows.append((-s, -a, " ".join(p).encode(), left, right))
        out += [(lang, r, x[2].decode(), -x[1], x[3], x[4], total[lang], -x[0]) for r, x in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)


def texts(seed, n, vocabulary):
    r = random.Random(seed)
    words = [f"W{i}" if i % 5 else f"é{i}" for i in range(vocabulary)]
    weights = [1 / (i + 2) for i in range(vocabulary)]
    phrases = [r.choices(words, k=r.randint(2, 7)) for _ in range(12)]
    for _ in range(n):
        out = []
        for _ in range(r.randint(0, 25)):
            out += r.choice(phrases) if r.random() < 0.2 else r.choices(words, weights, k=r.randint(1, 4))
            if r.random() < 0.3:
                out.append(r.choice([".", ",", "\n", " ! ", "\t"]))
        yield r.choice(["en", "fr", None, "und", ""]), " ".join(out)


@pytest.mark.parametrize("min_count,top", [(3, 2000), (8, 7)])
def test_equals_plain_counts(spark, min_count, top):
    docs = [*texts(1, 700, 900), *texts(2, 300, 12)]
    df = spark.createDataFrame([(i, *d, "x") for i, d in enumerate(docs)], "doc_id long, lang string, text string, n string").repartition(3)
    got = sorted(map(tuple, collocation.collocations(df, min_count, top).collect()))
    want = plain(docs, min_count, top)
    assert len(want) > 20 and got == want


def test_hot_pairs_are_dealt_out_and_stay_whole(spark):
    docs = [("en", "of the " * 3), ("en", "of the w1 of the. of the")] * 40 + [("en", f"of the x{i} of the y{i}") for i in range(300)]
    df = spark.createDataFrame(docs, "lang string, text string")
    assert sorted(map(tuple, collocation.collocations(df, 5, 50).collect())) == plain(docs, 5, 50)
    words = collocation.word_counts(df)
    table = collocation._table(words, "0:")
    assert len(table) == words.count()
    by_hash = {h: v for v, h in enumerate(table.tolist(), 1)}
    hot = [by_hash[r.h] for r in words.where("n > 100").select(collocation._hash(words["word"], "0:").alias("h")).collect()]
    w = collocation.windows(df, "0:", table, hot).where("deal <> 0")
    assert w.select("w1", "w2", "deal").distinct().count() > w.select("w1", "w2").distinct().count()
    assert w.where("w4 IS NOT NULL OR w5 IS NOT NULL").count() == 0


def test_words_outside_the_table_travel_as_hashes(spark):
    df = spark.createDataFrame(list(texts(4, 200, 60)), "lang string, text string")
    words = collocation.word_counts(df)
    every = collocation._table(words, "0:")
    for table in (every, every[::3], every[:0]):
        w = collocation._unpacked(collocation.windows(df, "0:", table, []))
        got = Counter({r[0]: r[1] for r in w.groupBy("w1").sum("n").collect()})
        value = {h: v for v, h in enumerate(table.tolist(), 1)}
        want = Counter()
        for r in words.select("n", collocation._hash(words["word"], "0:").alias("h")).collect():
            want[value.get(r.h, r.h)] += r.n
        assert got == want
        tails = [Counter({r[0]: r[1] for r in w.where(f"{c} <> 0").groupBy(c).sum("n").collect()}) for c in ("w3", "w5")]
        assert all(set(t) <= set(want) and all(t[k] <= want[k] for k in t) for t in tails) and sum(tails[0].values()) > 100


def test_distinct_rows_by_packed_and_plain_keys():
    r = np.random.default_rng(0)
    cols = [r.integers(0, 3, 500).astype(np.int32) for _ in range(5)]
    want = Counter(zip(*(c.tolist() for c in cols), strict=True))
    for names in (3, (1 << 21) + 1):
        at, n = collocation._distinct(cols, names)
        assert dict(zip(zip(*(c[at].tolist() for c in cols), strict=True), n.tolist(), strict=True)) == want
    at, n = collocation._distinct([c[:0] for c in cols], 3)
    assert len(at) == len(n) == 0


def test_long_texts_are_cut_at_the_ends_of_pieces():
    text = "a b c d e f. " * 200_000
    parts = list(collocation._segments(text))
    assert "".join(parts) == text and len(parts) > 1 and all(p.endswith(".") for p in parts[:-1])
    whole = "a b c " * 400_000
    assert list(collocation._segments(whole)) == [whole]


def test_edges(spark):
    schema = "lang string, text string, w1 int, p string, word string"
    long = "alpha beta " * 250_000
    docs = [(None, None), ("en", ""), (None, "a b"), (None, "A\tB"), ("und", "a  b! a b"), ("en", "..!!\n"), ("fr", long), ("fr", "x" * 2_000_000)]
    df = spark.createDataFrame([(*d, 1, "p", "w") for d in docs], schema)
    assert sorted(map(tuple, collocation.collocations(df, 2).collect())) == plain(docs, 2, 2000)
    assert collocation.collocations(df.limit(0)).count() == 0
    assert collocation.collocations(spark.createDataFrame([("en", None)], "lang string, text string")).count() == 0


def test_query_counts_every_row(spark, tmp_path):
    from termlens.llm.queries import op13_collocations

    docs = [("en", "deep learning models, deep learning. other deep words")] * 60 + [("en", "deep sea")] * 99 + [(None, "un deux")] * 100
    spark.createDataFrame(docs, "lang string, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = op13_collocations(spark, str(tmp_path))
    assert [t for _, t in got.dtypes] == ["string", "bigint", "string"] + ["bigint"] * 5
    assert sorted(map(tuple, got.collect())) == plain(docs, 100, 2000)
