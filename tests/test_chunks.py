"""Posting lists in chunks: short lists are gathered without the distributed sort; entries are cut without patterns."""

from __future__ import annotations

import pytest

from termlens.operators import index as I
from termlens.sources import corpus, formats


def rows_of(df):
    return {(r.term, r.chunk): [(p.doc_id, p.w) for p in r.postings] for r in df.collect()}


def test_short_and_long_lists_make_the_same_chunks(spark):
    rows = [("often", d, d % 3 + 1, 7) for d in range(7)] + [("rare", d, d, 3) for d in range(3)]
    post = spark.createDataFrame(rows, "term string, doc_id long, w long, df long")
    got = rows_of(I.nested_index(post, chunk_docs=3))
    want = sorted(((d, d % 3 + 1) for d in range(7)), key=lambda p: (-p[1], p[0]))
    assert got == {("often", 0): want[:3], ("often", 1): want[3:6], ("often", 2): want[6:], ("rare", 0): [(2, 2), (1, 1), (0, 0)]}


def test_short_lists_are_not_sorted_as_a_whole(spark, monkeypatch):
    def refuse(*args):
        raise AssertionError("row_index was called")

    monkeypatch.setattr(corpus, "row_index", refuse)
    post = spark.createDataFrame([("a", 1, 2, 2), ("a", 2, 5, 2)], "term string, doc_id long, w long, df long")
    assert rows_of(I.nested_index(post, chunk_docs=2)) == {("a", 0): [(2, 5), (1, 2)]}


@pytest.mark.parametrize("entry", ["7@3", "a@b@3", "@3", "x@", "@", "é@ 4", "7@3\r", "7 @3", "a\r@b@3", "q@v\u0085w", "q@v\n"])
def test_entries_are_cut_as_by_the_patterns(spark, entry):
    from pyspark.sql import functions as F
    line = spark.createDataFrame([(f"t\t{entry}",)], "value string")
    by = line.select(F.element_at(F.split("value", "\t"), 2).alias("e"))

    def group(pattern):
        return [tuple(r) for r in by.select(F.regexp_extract("e", pattern, 1), F.regexp_extract("e", pattern, 2)).collect()]

    doc, w = group(r"^(.*)@([^@]*)$")[0]
    want = spark.createDataFrame([(w,)], "w string").select(F.col("w").try_cast("bigint").alias("w")).first().w
    assert [tuple(r) for r in formats.parse_index_lines(line).select("doc_id", "w").collect()] == ([] if want is None else [(doc, want)])
    assert [tuple(r) for r in formats.parse_cell_lines(line).select("qualifier", "value").collect()] == group(r"^([^@]*)@(.*)$")


def test_a_line_is_split_once_not_once_per_entry(spark):
    lines = spark.range(2).selectExpr("concat('t', id, '\t7@3\t8@2') AS value")

    def plan(df):
        return df._jdf.queryExecution().optimizedPlan().toString().splitlines()

    index = plan(formats.parse_index_lines(lines))
    at = next(i for i, line in enumerate(index) if "Generate" in line)
    assert not any("split(" in line for line in index[:at + 1]) and any("split(" in line for line in index[at + 1:])
    cells = plan(formats.parse_cell_lines(lines))
    assert not any("split(" in line for line in cells if "Generate" in line)
