"""The pipeline's stages against brute force, on a small corpus with planted cases."""

from __future__ import annotations

import random

import pytest

import corpus_pipeline as P
from termlens.llm import bpe, secrets

from .test_simhash import brute_components, brute_fp
from .test_toxicity import make


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("corpus")
    rng = random.Random(4)
    rows = [(d, t) for d, t, _ in make(spark, 250)]
    toxic = {d for d, _, y in make(spark, 250) if y}
    items = [(k, " ".join(f"q{rng.randrange(900)}" for _ in range(30))) for k in range(8)]
    word = lambda: f"v{rng.randrange(3000)}"
    for d in range(300, 330):
        rows.append((d, " ".join(word() for _ in range(120))))
    rows += [(400 + k, rows[250 + k][1]) for k in range(10)]  # exact copies
    rows += [(420 + k, rows[262 + k][1].upper()) for k in range(5)]
    rows += [(440 + k, rows[270 + k][1] + " " + items[k][1] + " " + word()) for k in range(6)]
    rows += [(460 + k, f"{word()} {word()} password=a9ce335683f9772ddc{k} " + " ".join(word() for _ in range(40))) for k in range(8)]
    rows += [(500, None), (501, ""), (502, "x" * 30000), (None, "no id"), (503, rows[255][1]), (503, rows[255][1])]
    full = [(d, t, "en", "s", len(t or "")) for d, t in rows]
    spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(path / "documents.parquet"))
    spark.createDataFrame([(d, 1, int(d in toxic)) for d in range(250)], "doc_id long, quality int, toxic int").write.parquet(str(path / "labels.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(path / "benchmark.parquet"))
    return str(path), dict(rows), toxic, full


def test_stages(spark, folder):
    path, text, toxic, full = folder
    docs = P.read(spark, path, "documents")
    kept = {}
    for name, stage in P.STAGES:
        docs = P.written(stage(spark, docs, path), "test_stage")
        kept[name] = docs.collect()
        if name != "bpe":
            assert tuple(docs.columns) == P.COLUMNS
    ids = {k: [r.doc_id for r in v] for k, v in kept.items()}

    gone = {d for d, *_ in full} - set(ids["toxicity"])
    assert len(gone ^ toxic) <= 3 and not gone - set(range(250))

    before = [(r.doc_id, r.text) for r in kept["toxicity"]]
    fp = {(d, t): brute_fp(t) for d, t in before}
    comp = brute_components(sorted(set(fp.values())), lambda a, b: bin(a ^ b).count("1") <= 2)
    least = {}
    for d, t in before:
        if d is not None:
            c = comp[fp[d, t]]
            least[c] = min(d, least.get(c, d))
    assert sorted(map(str, ids["simhash"])) == sorted(map(str, [*least.values(), None]))

    assert set(ids["simhash"]) - set(ids["decontamination"]) == {d for d in range(440, 446) if d in ids["simhash"]}

    assert ids["secrets"] and sorted(map(str, ids["secrets"])) == sorted(map(str, ids["decontamination"]))
    for r in kept["secrets"]:
        assert not secrets.base_spans(r.text or "") and r.n_chars == (None if r.text is None else len(r.text))
        if not secrets.candidates(text[r.doc_id] or "") and not secrets.base_spans(text[r.doc_id] or ""):
            assert r.text == text[r.doc_id]

    enc = bpe.encoder(bpe.vocabulary_path())
    after = {r.doc_id: r.text for r in kept["secrets"]}
    for r in kept["bpe"]:
        assert r.ids == enc.encode(after[r.doc_id]).tolist() and r.n_tokens == len(r.ids)


def test_run_gives_the_last_stage(spark, folder):
    out = P.run(spark, folder[0])
    assert out.columns == ["doc_id", "lang", "source", "n_tokens", "ids"] and out.count() > 50
