"""Decontamination: SVD against numpy, subsequences against the table method, planted leaks and clean documents."""

from __future__ import annotations

import random

import numpy as np

from termlens.llm import decontam as D


def test_randomised_svd(spark):
    r = np.random.default_rng(0)
    a = r.normal(size=(60, 8)) @ np.diag([9, 7, 5, 3, 2, 1, .5, .2]) @ r.normal(size=(8, 40))
    a[r.random(a.shape) < 0.5] = 0
    rows = spark.createDataFrame([(np.flatnonzero(x).tolist(), x[np.flatnonzero(x)].tolist()) for x in a], "cols array<int>, vals array<double>")
    full = D.randomised_svd(rows.repartition(3), 40, 40)
    assert np.allclose(a @ full @ full.T, a, atol=1e-6)
    lead = D.randomised_svd(rows, 40, 6, steps=6)
    s = np.linalg.svd(a, compute_uv=False)
    assert np.linalg.norm(a - a @ lead @ lead.T) <= 1.05 * np.sqrt((s[6:] ** 2).sum())


def test_common_subsequence():
    r = random.Random(1)
    for _ in range(100):
        a, b = ([r.randrange(6) for _ in range(r.randrange(0, 30))] for _ in range(2))
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        assert D.common_subsequence(np.array(a, np.int64), np.array(b, np.int64)) == t[-1][-1]


def corpus():
    r = random.Random(2)
    vocab = ["".join(r.choice(["th", "er", "on", "an", "ing", "st"]) for _ in range(r.randint(1, 5))) for _ in range(900)]
    sent = lambda n: [vocab[min(899, int(r.expovariate(0.01)))] for _ in range(n)]
    items = [(k, " ".join(sent(r.randint(20, 60)))) for k in range(30)]
    docs, want = [], set()
    for d in range(200):
        w = sent(r.randint(0, 300))
        if d % 5 == 0:
            k = r.randrange(30)
            leak = items[k][1].upper().split() if d % 10 else items[k][1].split()
            if d % 15 == 0:  # a reworded copy: some words changed, some left out
                rare = set(sorted(leak, key=lambda x: -len(x))[:len(leak) // 2])
                leak = [x if x in rare or r.random() > 0.35 else r.choice(["and", "so", ""]) for x in leak]
            at = r.randrange(len(w) + 1)
            w[at:at] = leak
            want.add((d, k, d % 15 == 0))
        docs.append((d, " ".join(w)))
    return docs, items, want


def test_planted_leaks(spark):
    docs, items, want = corpus()
    extra = [(None, items[3][1]), (900, None), (901, ""), (902, items[4][1]), (902, items[4][1]), (903, items[0][1] + " " + items[1][1]),
             (904, "the " * 20000 + items[5][1] + " a" * 9000)]
    df = spark.createDataFrame([(*x, 1) for x in docs + extra], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([(*x, "q") for x in items] + [(77, None, "q"), (78, " . ", "q")], "item_id long, text string, doc_id string")
    got = [(r.doc_id, r.item_id) for r in D.search(df, bench).collect()]
    exact = {(d, k) for d, k, reworded in want if not reworded}
    loose = {(d, k) for d, k, reworded in want if reworded}
    assert exact <= set(got) and len(loose & set(got)) >= 0.8 * len(loose)
    assert got.count((902, 4)) == 2 and {(None, 3), (903, 0), (903, 1), (904, 5)} <= set(got)
    assert not [x for x in got if x[0] is not None and x[0] < 200 and x not in exact | loose]
    empty = df.limit(0)
    assert D.search(empty, bench).count() == 0 and D.search(df, bench.limit(0)).count() == 0
    blocks = [(r.doc_id, r.item_id) for r in D.search(df, bench, block_items=12).collect()]
    assert exact <= set(blocks) and blocks.count((902, 4)) == 2 and not set(blocks) - set(got) - loose


def test_short_items(spark):
    """Items of every length below a passage's, word for word inside longer texts."""
    r = random.Random(5)
    vocab = [f"{r.choice('bcdfgklmnprst')}{r.choice('aeiou')}{k}" for k in range(1500)]
    sent = lambda n: [vocab[min(1499, int(r.expovariate(0.004)))] for _ in range(n)]
    items, docs, want = [], [], set()
    for n in range(1, 17):
        for _ in range(12):
            k = len(items)
            words = sent(n)
            items.append((k, " ".join(words)))
            text = sent(200)
            at = r.randrange(201)
            docs.append((k, " ".join(text[:at] + words + text[at:])))
            want.add((k, k))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(x.doc_id, x.item_id) for x in D.search(df, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert want <= got
    for d, k in got - want:  # the rest are there in full, up to a fifth of the words, close together
        w, text = items[k][1].split(), docs[d][1].split()
        size = len(w) + len(w) // 4
        ids = {x: i for i, x in enumerate(dict.fromkeys(w + text))}
        a, b = (np.array([ids[x] for x in ws]) for ws in (w, text))
        assert len(w) <= D.SHORT and any(D.common_subsequence(a, b[s:s + size]) >= 0.8 * len(w) for s in range(len(b) - size + 1))
