"""SimHash fingerprints, links and components against brute force."""

from __future__ import annotations

import random

import xxhash

from termlens.llm import simhash
from termlens.llm.graph import components


def brute_components(nodes, linked):
    left = {n: n for n in nodes}

    def top(x):
        while left[x] != x:
            x = left[x]
        return x

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                x, y = sorted((top(a), top(b)))
                left[y] = x
    return {n: top(n) for n in nodes}


def brute_fp(text, k=3):
    table = {c: chr(c + 32) for c in range(65, 91)}
    w = (text or "").translate(table).encode().split()
    if not w:
        return 0
    sh = [b" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] or [b" ".join(w)]
    hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_fingerprints():
    rng = random.Random(1)
    texts = [None, "", " \t", "One", "one TWO", "É É é", "a b c", "a b c a b c a b c"]
    texts += [" ".join(rng.choice(["ab", "Cd", "e,"]) for _ in range(n)) for n in (5, 70, 400)]
    for t in texts:
        assert simhash.fingerprint(t) == brute_fp(t)


def check_links(spark, fps, t, bucket):
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    got = {}
    for r in components(simhash.link_edges(df, t, bucket)).collect():
        got[r.node % (1 << 64)] = r.component % (1 << 64)
    want = brute_components(sorted(fps), lambda a, b: bin(a ^ b).count("1") <= t)
    groups = lambda m: {frozenset(x for x in fps if m.get(x, x) == c) for c in {m.get(x, x) for x in fps}}
    assert groups(got) == groups(want)


def test_links_match_brute_force(spark):
    rng = random.Random(2)
    fps = set()
    for _ in range(12):
        base = rng.getrandbits(64)
        for _ in range(12):
            x = base
            for _ in range(rng.randint(0, 4)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    fps |= {0, (1 << 64) - 1, 1, 3, 1 << 63}
    for t, bucket in ((2, 32), (2, 1), (3, 2), (1, 4)):
        check_links(spark, sorted(fps), t, bucket)


def test_chain_of_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 50)] + [(5, 5)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(1, 61)) and all(got[1000 + i] == 1000 for i in range(1, 50))
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates(spark):
    rng = random.Random(3)
    base = [f"w{rng.randrange(500)}" for _ in range(300)]
    rows = [(10, " ".join(base)), (4, " ".join(base).upper()), (7, " ".join([*base[:-1], "changed"])), (1, None), (2, " "), (3, "short"),
            (3, "short"), (None, "short"), (None, "alone here"), (20, " ".join(f"x{rng.random()}" for _ in range(300)))]
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, fp int")
    out = simhash.near_duplicates(df).collect()
    assert len(out) == len(rows)
    fp = {r: brute_fp(r[1]) for r in rows}
    comp = brute_components(sorted(set(fp.values())), lambda a, b: bin(a ^ b).count("1") <= 2)
    least = {}
    for d, t in rows:
        c = comp[fp[d, t]]
        if d is not None:
            least[c] = min(d, least.get(c, d))
    assert sorted(map(str, ((r.doc_id, r.fp % (1 << 64), r.component_id) for r in out))) == sorted(
        map(str, ((d, fp[d, t], least.get(comp[fp[d, t]])) for d, t in rows)))
    assert simhash.near_duplicates(df.limit(0)).count() == 0
