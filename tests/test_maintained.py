"""One-read import, signed df counts and sketches per batch, stored versions, and the sweep over sizes and modes."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from termlens.operators import index as I
from termlens.operators import similarity as S
from termlens.operators.metrics import size_sweep
from termlens.operators.store import KeyedTable
from termlens.sources.imports import import_cells, read_cells
from termlens.streaming import incremental as INC

LINES = ["fox\td1@3\td2@5", "snow\td1@3", "q1:d1\tscore:jaccard\t0.5", "q1:d1\tscore:shared_terms\t4", "no tabs here", "a\tb\tc", "", "x\tscore:jaccard\t1\t2"]


def test_import_writes_and_counts_in_one_read(spark, tmp_path):
    path = str(tmp_path / "cells")
    lines = spark.createDataFrame([(x,) for x in LINES], "value string").repartition(3)
    want = {"lines": 8, "cells": 5, "invalid": 4}
    assert import_cells(lines, path) == want
    cells = read_cells(path, spark)
    assert cells.count() == 5 and {(r.row_key, r.family, r.qualifier, r.value) for r in cells.collect()} == {
        ("fox", "docs", "d1", "3"), ("fox", "docs", "d2", "5"), ("snow", "docs", "d1", "3"), ("q1:d1", "score", "jaccard", "0.5"), ("q1:d1", "score", "shared_terms", "4")}
    assert import_cells(lines, path) == want and read_cells(path, spark).count() == 5  # again: the same table
    assert import_cells(lines.where("value like 'fox%'"), path)["cells"] == 2 and read_cells(path, spark).where("family = 'score'").count() == 2
    assert import_cells(lines.limit(0), str(tmp_path / "none")) == {"lines": 0, "cells": 0, "invalid": 0}


def _rebuilt(spark, rows, policy="both"):
    d = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(map(tuple, I.prune(I.postings(d), I.corpus_size(d), policy).select("term", "doc_id", "w", "df").collect()))


def test_counts_follow_updates_and_repeated_batches(spark, tmp_path):
    r = random.Random(2)
    st, now = INC.IndexState(spark, str(tmp_path / "s")), {}
    for batch in range(1, 5):
        rows = {r.randint(0, 25): " ".join(r.choices(["red", "blue", "fox", "dog", "cat", "owl", f"b{batch}"], k=r.randint(0, 5))) for _ in range(12)}
        for _ in range(1 + batch % 2):  # every second batch is written twice
            INC.apply_batch(st, spark.createDataFrame(list(rows.items()), "doc_id long, text string"), batch_id=batch)
        now.update(rows)
        if batch in (2, 4):
            for policy in ("both", "universal"):
                got = INC.index_postings_by_counts(st, policy).select("term", "doc_id", "w", "df").collect()
                assert sorted(map(tuple, got)) == _rebuilt(spark, list(now.items()), policy)
    n = spark.range(1).select(INC.doc_count(st), INC.estimated_docs(st)).first()
    assert n[0] == len(now) and abs(n[1] - len(now)) <= 1
    # a batch whose documents were never written is not seen
    st.write("counts", spark.createDataFrame([("ghost", 5), ("red", 9)], "term string, delta long"), 9)
    assert sorted(map(tuple, INC.index_postings_by_counts(st).select("term", "doc_id", "w", "df").collect())) == _rebuilt(spark, list(now.items()))


def test_sketches_of_batches_unite(spark, tmp_path):
    st = INC.IndexState(spark, str(tmp_path / "s"))
    for batch, (a, b) in enumerate([(0, 4000), (2000, 9000), (0, 9000)], 1):
        INC.apply_batch(st, spark.range(a, b).select(F.col("id").alias("doc_id"), F.lit("one two").alias("text")), batch_id=batch)
    n = spark.range(1).select(INC.doc_count(st), INC.estimated_docs(st)).first()
    assert n[0] == 9000 and 0 < abs(n[1] - 9000) + 1 <= 3 * INC.SKETCH_ERROR * 9000
    empty = spark.range(1).select(INC.estimated_docs(INC.IndexState(spark, str(tmp_path / "e"))), INC.doc_count(INC.IndexState(spark, str(tmp_path / "e")))).first()
    assert tuple(empty) == (0, 0)


def test_versions_survive_upserts(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path / "v"), "k string, at long, v long", ["k"], order=["at"], versions=5)
    rows = [("hot" if i % 3 else f"k{i % 7}", i, i * 2) for i in range(90)]
    for part in (rows[:50], rows[50:], rows[40:]):  # the last one brings rows again
        t.upsert(spark.createDataFrame(part, "k string, at long, v long"))
    want = sorted(x for k in {x[0] for x in rows} for x in sorted((x for x in rows if x[0] == k), key=lambda x: -x[1])[:5])
    assert sorted(map(tuple, t.read().collect())) == want
    with pytest.raises(ValueError):
        t.delete(spark.createDataFrame([("hot",)], "k string"))


def test_sweep_equals_separate_runs(spark):
    r = random.Random(5)
    words = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join(["every", *r.choices(words, [1 / (j + 1) for j in range(40)], k=r.randint(0, 9))])) for i in range(60)]
    docs = spark.createDataFrame([(i + 100, t if i != 33 else "") for i, t in rows], "doc_id long, text string").repartition(4)
    qt = S.query_terms(spark.createDataFrame([(1, "w0 w3 every"), (2, "w9 w20"), (3, "nothing")], "query_id long, text string"))
    sizes = [1, 10, 40, 60]
    got = {(x["size"], x["mode"]): tuple(x)[2:] for x in size_sweep(docs, qt, sizes).collect()}
    assert len(got) == 16
    for n in sizes:
        part = docs.where(F.col("doc_id") < 100 + n)
        for mode in ("both", "universal", "single", "none"):
            kept = I.prune(I.postings(part), I.corpus_size(part), mode)
            pairs = S.jpii(I.postings(part), I.corpus_size(part), qt, policy=mode).count()
            assert got[n, mode] == (n, kept.select("term").distinct().count(), kept.count(), pairs)
    with pytest.raises(ValueError):
        size_sweep(docs, qt, [5, 5])
