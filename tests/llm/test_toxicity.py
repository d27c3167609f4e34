"""Deobfuscation and scores: lattice search against all readings, held-out accuracy, edge cases."""

from __future__ import annotations

import itertools
import random
import zlib

import pytest
from pyspark.sql import functions as F

from termlens.llm import toxicity as T
from termlens.llm.queries import op2_toxicity

LEET = str.maketrans("oieat", "0134@")


def char_model(words):
    tri = {}
    for w in words:
        s = "\x02\x02" + w + "\x03"
        for k in range(2, len(s)):
            tri[s[k - 2:k + 1]] = tri.get(s[k - 2:k + 1], 0) + 1
    return T._from_trigrams(tri)


MODEL = char_model(["idiot", "moron", "trash", "the", "then", "other", "pathetic", "loser"] * 3)


def test_viterbi_finds_the_likeliest_reading():
    for token in ("1d10t", "m0r0n", "tr@sh", "iiidi.o.t", "l0s3r!!", "$$he"):
        best = -1e9
        for path in itertools.product(*T.lattice(token)):
            read, s, c = "", 0.0, "\x02\x02"
            for letters, cost in path:
                s += cost
                for x in letters:
                    s += MODEL.logp(c, x)
                    c = c[1] + x
                read += letters
            best = max(best, s + MODEL.logp(c, "\x03"))
        read = T.viterbi(token, MODEL)
        assert any("".join(x for x, _ in p) == read for p in itertools.product(*T.lattice(token)))
        # the state is the last two letters, so the search is exact
        s2 = max(sum(c for _, c in p) + sum(MODEL.logp(("\x02\x02" + r)[k:k + 2], r[k]) for k in range(len(r)))
                 + MODEL.logp(("\x02\x02" + r)[-2:], "\x03")
                 for p in itertools.product(*T.lattice(token)) for r in ["".join(x for x, _ in p)] if r == read)
        assert abs(s2 - best) < 1e-9


def test_readings():
    r = T.Restorer(MODEL)
    for raw, want in (("1d10t", "idiot"), ("i.d.i.o.t", "idiot"), ("idiooooot", "idiot"), ("m0r0n,", "moron"), ("tr@sh", "trash"),
                      ("the", "the"), ("then$$$", "then"), ("p4th3tic", "pathetic")):
        assert r.words(raw) == {want}
    assert r.words("the i d i o t then") == {"the", "idiot", "then"}
    assert r.words(None) == r.words("  ") == set()


def make(spark, n=400):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice(["the", "en", "or", "st", "an"]) for _ in range(rng.randint(1, 3)))
    rows = []
    for d in range(n):
        y = rng.random() < 0.3
        w = [word() for _ in range(rng.randint(5, 60))]
        if y:
            for _ in range(2):
                bad = rng.choice(["idiot", "moron", "trash"])
                w.insert(rng.randrange(len(w)), rng.choice([bad, bad.translate(LEET), bad.upper(), ".".join(bad)]))
        rows.append((d, " ".join(w), int(y)))
    return rows


def test_held_out_accuracy(spark, tmp_path):
    rows = make(spark)
    extra = [(900, None), (901, ""), (None, "idiot here"), (902, "the 1d10t " * 3000), (0, rows[0][1])]
    docs = spark.createDataFrame([(d, t, "x") for d, t, _ in rows] + [(*r, None) for r in extra], "doc_id long, text string, toxic string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(d, 1, y) for d, _, y in rows] + [(900, 0, None), (901, 0, 0), (None, 1, 1), (77777, 1, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    out = op2_toxicity(spark, str(tmp_path)).collect()
    assert len(out) == len(rows) + len(extra)
    y = {d: t for d, _, t in rows}
    for r in out:
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [r for r in out if r.held_out and r.doc_id in y]
    assert sum(r.predicted == y[r.doc_id] for r in held) >= 0.97 * len(held)
    by = {r.doc_id: r for r in out}
    assert by[902].predicted == 1 and by[None].predicted == 1 and by[900].score == by[901].score < 0.5


@pytest.mark.parametrize("labels", [[], [(1, 1), (2, 1)], [(1, 0)]])
def test_without_both_classes(spark, labels):
    df = spark.createDataFrame([(d, "some text", y) for d, y in labels], "doc_id long, text string, toxic int")
    m = T.fit(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    out = T.scores(spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string"), m).collect()
    assert len(out) == 2 and len({r.score for r in out}) == 1 and T.scores(df.limit(0), m).count() == 0


def test_learns_from_every_labelled_row(spark):
    """13,000 labelled rows; a word that only six toxic ones hold, whatever the hash of their ids, has a weight."""
    n = 13_000
    by_hash = [r.id for r in spark.range(n).orderBy(F.xxhash64("id", F.lit(11))).collect()]
    few = {**dict.fromkeys(by_hash[:6], "wretch"), **dict.fromkeys(by_hash[-6:], "knave")}
    docs = spark.createDataFrame([(d, "the " + few.get(d, "idiot" if d % 9 == 0 else "other") + " end") for d in range(n)], "doc_id long, text string")
    labels = spark.createDataFrame([(d, int(d in few or d % 9 == 0)) for d in range(n)], "doc_id long, toxic int")
    m = T.fit(docs, labels)
    score = m.scorer()
    assert m.weights["w:wretch"] > 0 and m.weights["w:knave"] > 0
    assert score("the knave") > 0.5 and score("the wretch") > 0.5 and score("an idiot") > 0.5 and score("the other") < 0.5


def test_scores_by_token_equal_scores_by_word(monkeypatch):
    """Features kept by raw token, also when the table of kept ones overflows, give the sum over the restored words."""
    monkeypatch.setattr(T, "_KEPT", 3)
    model = T.Model(MODEL, {"w:idiot": 0.7, "p:idio": 0.4, "w:stone": -0.3, "p:ston": 0.2, "w:a": 0.1}, -0.2)
    score = model.scorer()
    for text in ("1d10t idiot stone, (stone) a", "i d i o t aaa stones iddiot", "", None, "... a-b *stone*"):
        hit = {g for w in T.Restorer(MODEL).words(text) for g in T.grams(w) if g in model.weights}
        assert abs(score(text) - 1 / (1 + 2.718281828459045 ** -(model.bias + sum(model.weights[g] for g in hit)))) < 1e-12
