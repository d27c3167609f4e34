"""Secret scan: rules against a plain scan, gradients against differences, held-out recall, edge cases."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np

from termlens.llm import secrets as S
from termlens.llm.queries import op5_secrets


def plain(text):
    """The rules, character classes spelled out."""
    ci = lambda w: "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w)
    names = "|".join(map(ci, ("password", "passwd", "secret", "token"))) + "|" + ci("api") + "_?" + ci("key")
    out = [(m.start(), "assign", m.end()) for m in re.finditer(rf"({names})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text) if len(m[2]) >= 6]
    out += [(m.start(), "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out, key=lambda x: (x[0], ("assign", "access", "hex").index(x[1])))


def texts(n=300, seed=1):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(["the", "en", "or", "ß", "an"]) for _ in range(rng.randint(1, 3)))
    hexed = lambda k: "".join(rng.choice("0123456789abcdef") for _ in range(k))
    make = [lambda: f"password={hexed(18)}", lambda: "AKIA" + "".join(rng.choice("ABCDEFGHIJ234567") for _ in range(16)),
            lambda: f'Token = "{hexed(40)}"', lambda: f"{rng.randrange(255)}.144.{rng.randrange(255)}.{rng.randrange(255)}",
            lambda: str(rng.randrange(10**15, 10**16)), lambda: f"{word()}.{rng.randrange(99)}@mail{rng.randrange(9)}.example.com"]
    out = []
    for _ in range(n):
        w = [word() for _ in range(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 3)):
            w.insert(rng.randrange(len(w) + 1), rng.choice(make)())
        out.append(" ".join(w))
    return [*out, None, "", "ſecret=abcdefgh toKen: x", "password='12345", "API_KEY:abcdef passwdapikey=token=secret=abcdef", "AKIAAKIA" * 9,
            "f" * 50_000, "é" * 30 + "apikey=\"zzzzzz\"" + "0" * 24]


def test_gradients():
    r = np.random.default_rng(0)
    net, x, y = S.Net(), r.integers(0, 128, (7, S.WIDTH)), r.integers(0, 2, 7).astype(float)

    def loss():
        z = net._forward(x)[-1]
        return (np.logaddexp(0, z) - y * z).mean()

    for k, g in net._gradients(x, y).items():
        flat = net.p[k].reshape(-1)
        for i in np.argsort(-np.abs(g.reshape(-1)))[:4]:
            flat[i] += 1e-5
            up = loss()
            flat[i] -= 2e-5
            down = loss()
            flat[i] += 1e-5
            assert abs((up - down) / 2e-5 - g.reshape(-1)[i]) < 1e-4


def test_query(spark, tmp_path):
    rows = list(enumerate(texts())) + [(3, texts()[3])]
    spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, spans int").write.parquet(str(tmp_path / "documents.parquet"))
    got = op5_secrets(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    by = dict(rows)
    for r in got:
        want = plain(by[r.doc_id] or "")
        line = ",".join(f"{k}:{s}:{e}" for s, k, e in want)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == x for _, k, _ in want) for x in ("assign", "access", "hex"))
        assert [x for x in r.spans.split(",") if x and not x.startswith("net")] == [x for x in line.split(",") if x]


def test_network_on_held_out_findings(spark):
    df = spark.createDataFrame(list(enumerate(texts(900))), "doc_id long, text string")
    net = S.fit(df, sample=400)
    f = [i for t in texts(300, seed=9) for i in S.findings(t or "")]
    x, y = np.array([np.frombuffer(a, np.uint8) for a, _ in f], dtype=np.int64), np.array([b for _, b in f])
    p = net.probabilities(x)
    assert (p[y == 1] >= net.threshold).mean() >= 0.95 and (p[y == 0] >= net.threshold).mean() <= 0.03
    leaks = S.scan(spark.createDataFrame([(1, "the or 0641917ea4e9feb9cda83 en"), (2, None)], "doc_id long, text string"), net).collect()
    assert [s.kind for s in leaks[0].spans] == ["net"] and leaks[1].spans == []
    out = S.redact(spark.createDataFrame([(1, "an password=abcdef123456789 or"), (2, None), (3, "an or")], "doc_id long, text string"), net)
    assert [r.text for r in out.orderBy("doc_id").collect()] == ["an [SECRET] or", None, "an or"]


def test_every_finding_counts(spark):
    """More findings than ``sample`` change the model, and the threshold keeps 98 % of all held-back secrets."""
    rows = list(enumerate(t for t in texts(600, seed=4) if t))
    by_hash = sorted({(y, S.xxhash.xxh3_64_intdigest(x) >> 1) for _, t in rows for x, y in S.findings(t)})
    least = {h for k in (0, 1) for h in [h for y, h in by_hash if y == k][:30]}
    few = [r for r in rows if any(S.xxhash.xxh3_64_intdigest(x) >> 1 in least for x, _ in S.findings(r[1]))]
    assert len(few) < len(rows) / 2
    whole, part = (S.fit(spark.createDataFrame(r, "doc_id long, text string"), sample=30) for r in (rows, few))
    assert not np.allclose(whole.p["w"], part.p["w"])
    held = {x for _, t in rows for x, y in S.findings(t) if y == 1 and (S.xxhash.xxh3_64_intdigest(x) >> 1) % 5 == 0}
    p = whole.probabilities(np.array([np.frombuffer(x, np.uint8) for x in held], dtype=np.int64))
    assert 0.98 <= (p >= whole.threshold - 1e-9).mean() < 1 and len(held) > 60


def test_without_findings(spark):
    df = spark.createDataFrame([(1, "no findings"), (2, None)], "doc_id long, text string")
    assert S.fit(df) is None and S.scan(df.limit(0), None).count() == 0


def test_every_run_is_a_candidate():
    """Short and digitless runs, and what a rule's span leaves of a run."""
    for run in ("QwErTyUiOpAsDfGhJkLzXcVb", "x9Kd2Lm0Qz"):
        assert S.candidates(f"the {run} en") == [(4, 4 + len(run))]
    text = "an key_live_" + "0af3" * 8 + "Qz7Kp2 or"
    assert [text[s:e] for s, e in S.candidates(text, S.base_spans(text))] == ["key_live_", "Qz7Kp2"]


def test_long_candidates_are_read_whole():
    class Finds(S.Net):
        def probabilities(self, x):
            return np.array([float(b"9Kd2Lm0Qz" in bytes(r.astype(np.uint8))) for r in x])

    for n in (0, 20, 33, 60, 150, 291):
        run = "a/" * (n // 2) + "9Kd2Lm0Qz" + "/b" * ((300 - n) // 2)
        assert S.all_spans(f"the {run} en", Finds()) == [(4, 3, 4 + len(run))]


def test_threshold_is_the_recall_quantile():
    class Low(S.Net):
        def logits(self, x):
            return x[:, 0] / 100 * self.scale + self.offset

    x, y = np.zeros((1000, S.WIDTH)), np.zeros(1000)
    x[:, 0], y[::10] = np.arange(1000) % 97, 1
    net = Low()
    net.calibrate(x, y, 0.98)
    p = net.probabilities(x[y == 1])
    assert net.threshold < 0.5 and (p >= net.threshold).mean() >= 0.98


def test_tables_equal_the_convolution():
    r = np.random.default_rng(1)
    net, x = S.Net(), r.integers(0, 128, (300, S.WIDTH))
    for k, size in enumerate((1, 8, 15, 16, 17, 33, 48)):  # padding behind short candidates
        x[k::10, S.BEFORE + size:S.BEFORE + S.HEAD + S.TAIL] = 0
    x[::3, :S.BEFORE] = 0
    x[::7, -S.AFTER:] = 0
    assert np.allclose(net.logits(x), net._forward(x)[-1], atol=1e-4)
    assert net.logits(x[:0]).shape == (0,)


def test_windows_of_a_text_at_once():
    r = random.Random(8)
    for n in (0, 1, 5, 60, 400):
        text = "".join(r.choice("aZ9/=. \n\t\x7fé中×\U0001f600١") for _ in range(n))
        spans = sorted((s, min(n, s + r.choice([0, 1, 8, 31, 32, 33, 47, 48]))) for s in (r.randrange(n + 1) for _ in range(40)))
        got = S.windows(S.characters(text), *np.array(spans).T)
        assert [bytes(x) for x in got.astype(np.uint8)] == [S.window(text, s, e) for s, e in spans]
