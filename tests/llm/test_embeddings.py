"""Embedding near-duplicates against brute force in double precision."""

from __future__ import annotations

import numpy as np

from termlens.llm import embeddings

from .test_simhash import brute_components


def brute(rows, thr=0.95):
    def ok(v):
        return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    def link(i, j):
        a, b = rows[i][1], rows[j][1]
        if not ok(a) or not ok(b) or len(a) != len(b):
            return False
        a, b = np.array(a, float), np.array(b, float)
        a, b = a / np.abs(a).max(), b / np.abs(b).max()
        return bool(a @ b / np.sqrt((a @ a) * (b @ b)) >= thr)

    n = range(len(rows))
    deg = [sum(i != j and link(i, j) for j in n) for i in n]
    comp = brute_components(list(n), link)
    least = {}
    for i in n:
        if rows[i][0] is not None:
            least[comp[i]] = min(rows[i][0], least.get(comp[i], rows[i][0]))
    return sorted(str((rows[i][0], deg[i], least.get(comp[i]), rows[i][0] is not None and rows[i][0] == least[comp[i]])) for i in n)


def test_against_brute_force(spark):
    rng = np.random.default_rng(0)
    rows = []
    for _ in range(8):
        base = rng.normal(size=24)
        rows += [(len(rows) + k, (rng.uniform(0.1, 9) * (base + rng.normal(size=24) * rng.choice([0.02, 0.2, 0.24]))).tolist()) for k in range(12)]
    rows += [(len(rows) + 100 + k, rng.normal(size=24).tolist()) for k in range(40)]
    rows += [(500, None), (501, []), (502, [0.0] * 24), (503, [1.0] * 23 + [float("nan")]), (504, [None] + [1.0] * 23),
             (505, [float("inf")] * 24), (506, rows[0][1][:12]), (507, rows[0][1][:12]), (3, rows[3][1]), (None, rows[3][1]),
             (None, [5.0] + [-1.0] * 23), (508, [x * 1e-200 for x in rows[0][1]]), (509, [x * 1e200 for x in rows[0][1]])]
    df = spark.createDataFrame([(*r, 7) for r in rows], "vec_id long, embedding array<double>, row int")
    for stripe, lead in ((4096, 16), (9, 3)):
        got = [tuple(r) for r in embeddings.near_duplicates(df, stripe_rows=stripe, lead=lead).collect()]
        assert sorted(map(str, got)) == brute(rows)
    assert embeddings.near_duplicates(df.limit(0)).count() == 0
    assert [tuple(r) for r in embeddings.near_duplicates(df.where("vec_id = 500")).collect()] == [(500, 0, 500, True)]
