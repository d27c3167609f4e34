"""Substring dedup against a brute-force version."""

from __future__ import annotations

import hashlib
import random

import numpy as np

from termlens.llm import substring


def brute(rows, window=13):
    starts = {}
    for d, t in rows:
        w = (t or "").encode().split()
        for i in range(len(w) - window + 1):
            if d is not None:
                k = tuple(w[i:i + window])
                starts[k] = min(d, starts.get(k, d))
    out = []
    for d, t in rows:
        w = (t or "").encode().split()
        gone = set()
        for i in range(len(w) - window + 1):
            if d is not None and starts[tuple(w[i:i + window])] < d:
                gone |= set(range(i, i + window))
        out.append((d, len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return out


def corpus(seed, n=60):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(300)}é"
    passages = [[word() for _ in range(rng.randrange(11, 40))] for _ in range(6)]
    rows = []
    for d in rng.sample(range(1000), n):
        w = []
        for _ in range(rng.randrange(0, 5)):
            w += [word() for _ in range(rng.randrange(0, 9))] + rng.choice(passages)[rng.randrange(0, 3):]
        rows.append((d, rng.choice([" ", "\n", "\t "]).join(w)))
    rows += [(2000, rows[0][1]), (2001, None), (2002, ""), (2003, "only a few words"), (rows[3][0], rows[3][1]),
             (None, rows[1][1]), (None, rows[1][1]), (5000, "same " * 80), (4999, "same " * 40)]
    return rows


def test_cover_has_every_difference():
    for p in range(1, 14):
        c = substring.difference_cover(p)
        assert {(a - b) % p for a in c for b in c} == set(range(p))
    assert len(substring.difference_cover(7)) == 3


def test_against_brute_force(spark):
    for seed, window, period in ((1, 13, 7), (2, 13, 13), (3, 5, 3)):
        rows = corpus(seed)
        df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, block int")
        got = [tuple(r) for r in substring.dedup(df, window, period, block_bytes=500).collect()]
        assert sorted(map(str, got)) == sorted(map(str, brute(rows, window)))
    assert substring.dedup(df.limit(0)).count() == 0


def test_word_hashes(monkeypatch):
    rng = random.Random(9)
    monkeypatch.setattr(substring, "_PART", 50)
    by_hash = {}
    for _ in range(300):
        words = ["".join(rng.choice("abé\u3000") for _ in range(rng.choice([1, 2, 3, 70, 130]))).encode() for _ in range(rng.randrange(0, 12))]
        text = rng.choice([b"", b"\n "]) + rng.choice([b" ", b"\t\r", b"\x0b"]).join(words) + rng.choice([b"", b"  "])
        h = substring.word_hashes(text).tolist()
        assert len(h) == len(words)
        for w, x in zip(words, h, strict=True):
            assert by_hash.setdefault(x, w) == w
    assert len(set(by_hash.values())) == len(by_hash)


def test_pairs_found_with_equal_first_halves():
    rng = random.Random(10)
    draw = lambda n, t: np.array([rng.randrange(5) for _ in range(n)], t)
    for n, m in ((0, 5), (5, 0), (40, 12), (200, 9)):
        x, y, a, b = draw(n, np.uint64), draw(n, np.uint32), draw(m, np.uint64), draw(m, np.uint32)
        got = substring._pairs_found(x, lambda at, y=y: y[at], a, b)
        assert got.tolist() == [p in set(zip(a.tolist(), b.tolist(), strict=True)) for p in zip(x.tolist(), y.tolist(), strict=True)]


def test_null_ids_and_repeated_rows(spark):
    rows = corpus(6, 15)
    rows += [(None, rows[0][1])] * 40 + [(rows[1][0], rows[2][1])] * 5
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in substring.dedup(df, block_bytes=400).collect()]
    assert sorted(map(str, got)) == sorted(map(str, brute(rows)))


def test_digests(spark, tmp_path):
    from termlens.llm.queries import op1_substring

    rows = corpus(4, 20)
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = [tuple(r) for r in op1_substring(spark, str(tmp_path)).collect()]
    assert sorted(map(str, got)) == sorted(str((*r[:3], hashlib.sha256(r[3].encode()).hexdigest())) for r in brute(rows))
