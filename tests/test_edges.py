"""Edge cases: tiny corpora, empty queries, rounding ties, ids with '-'/'@'."""

from __future__ import annotations

from pyspark.sql import functions as F

from termlens.functions.measures import f1, overlap, round_half_up
from termlens.operators import index as I
from termlens.operators import similarity as S
from termlens.sources import formats as FM


def _docs(spark, rows, id_type="string"):
    return spark.createDataFrame(rows, f"doc_id {id_type}, text string")


def test_single_document(spark):
    d = _docs(spark, [("a", "one two three")])
    assert I.prune(I.postings(d), I.corpus_size(d), "both").count() == 0
    q = spark.createDataFrame([("q", "one two")], "query_id string, text string")
    assert S.jpii(I.postings(d), I.corpus_size(d), S.query_terms(q)).count() == 0


def test_two_documents_give_empty_index(spark):
    d = _docs(spark, [("a", "shared alone"), ("b", "shared other")])
    assert I.prune(I.postings(d), I.corpus_size(d), "both").count() == 0
    assert I.prune(I.postings(d), I.corpus_size(d), "single").count() == 2


def test_stopword_only_and_unindexed_queries(spark):
    d = _docs(spark, [("a", "red fox"), ("b", "red dog"), ("c", "blue cat")])
    q = spark.createDataFrame([("q1", "the and of"), ("q2", "zebra")], "query_id string, text string")
    assert S.jpii(I.postings(d), I.corpus_size(d), S.query_terms(q)).count() == 0


def test_identical_documents_and_punctuation_only(spark):
    d = _docs(spark, [("a", "red fox"), ("b", "red fox"), ("c", "!!! ..."), ("d", "blue fox cat")])
    res = {(r.doc_a, r.doc_b): r.similarity for r in S.pairwise(I.postings(d), I.corpus_size(d), lo=None).collect()}
    # 'red' has df 2 of N=4 and is kept; 'fox' has df 3 < 4 and is kept as well.
    assert res[("a", "b")] == 1.0
    assert all("c" not in k for k in res)


def test_exclude_self_when_query_is_a_document(spark):
    d = _docs(spark, [("a", "red fox"), ("b", "red dog"), ("c", "fox cat")])
    q = d.withColumnRenamed("doc_id", "query_id")
    res = S.jpii(I.postings(d), I.corpus_size(d), S.query_terms(q), exclude_self=True).collect()
    assert all(r.query_id != r.doc_id for r in res) and res


def test_rounding_ties(spark):
    df = spark.createDataFrame([(0.125,), (0.375,), (0.285,), (0.615,)], "x double")
    got = [r.r for r in df.select(round_half_up("x", 2).alias("r")).collect()]
    # floor(x*100 + 0.5)/100 on the binary values: 0.285 is stored just below
    # the tie (-> 0.28); 0.615*100 rounds to exactly 61.5 (-> 0.62).
    assert got == [0.13, 0.38, 0.28, 0.62]


def test_overlap_and_f1_zero_guards(spark):
    df = spark.createDataFrame([(0, 0, 5), (0, 3, 4), (2, 4, 4)], "m long, q long, e long")
    got = df.select(overlap("m", "q", "e").alias("o"), f1("m", "q", "e").alias("f")).collect()
    assert [(r.o, r.f) for r in got] == [(0.0, 0.0), (0.0, 0.0), (0.5, 0.5)]


def test_index_reader_drops_malformed_and_keeps_odd_ids(spark):
    lines = spark.createDataFrame(
        [("t1\tdoc-1@x@3\tnoat\tbad@w\tz@4",), ("lonely",), ("t2\ta@1",)], "value string")
    got = sorted((r.term, r.doc_id, r.w) for r in FM.parse_index_lines(lines).collect())
    assert got == [("t1", "doc-1@x", 3), ("t1", "z", 4), ("t2", "a", 1)]


def test_duplicate_posting_rows_merge(spark):
    lines = spark.createDataFrame([("t\ta@2\tb@3",), ("t\ta@2",), ("t\tc@1",)], "value string")
    merged = FM.merge_index_rows(FM.parse_index_lines(lines))
    assert sorted((r.doc_id, r.w) for r in merged.collect()) == [("a", 2), ("b", 3), ("c", 1)]


def test_tsv_roundtrip_with_hyphen_free_ids(spark):
    s = spark.createDataFrame([(7, 11, 2, 4, 6, 0.25), (8, 12, 1, 9, 3, 1 / 11)],
                              "query_id long, doc_id long, match_count long, w_query long, w_doc long, similarity double")
    back = FM.parse_jpii_tsv(FM.jpii_tsv_lines(s))
    got = sorted((int(r.query_id), int(r.doc_id), r.match_count, r.similarity) for r in back.collect())
    assert got == [(7, 11, 2, 0.25), (8, 12, 1, 1 / 11)]
    labels = [r.value.split("\t")[0] for r in FM.jpii_tsv_lines(s).collect()]
    # The heavier side first (doc 11 has W 6 > 4), the query first otherwise.
    assert sorted(labels) == ["11-q7", "q8-12"]


def test_cell_parser(spark):
    lines = spark.createDataFrame([("t\ta@1\tb@2",), ("k\tscore:x\t0.5",), ("bad line",), ("k\tnocolon\t1",)],
                                  "value string")
    cells = FM.parse_cell_lines(lines).collect()
    valid = sorted((c.row_key, c.family, c.qualifier, c.value) for c in cells if c.valid)
    assert valid == [("k", "score", "x", "0.5"), ("t", "docs", "a", "1"), ("t", "docs", "b", "2")]
    assert sum(1 for c in cells if not c.valid) == 2


def test_tf_postings(spark):
    d = _docs(spark, [("a", "red red fox"), ("b", "red dog")])
    tf = {(r.term, r.doc_id): (r.tf, r.w) for r in I.postings_tf(d).collect()}
    assert tf[("red", "a")] == (2, 2) and tf[("fox", "a")] == (1, 2) and tf[("dog", "b")] == (1, 2)
    assert d.select(F.lit(1)).count() == 2


def test_corpus_directory_ids_are_file_names(spark, tmp_path):
    from termlens.sources.corpus import read_corpus_dir, read_query_files
    d = tmp_path / "books"
    d.mkdir()
    (d / "00001.txt").write_text("The bison, the trap\nand snow")
    (d / "00002.txt").write_text("")
    got = {r.doc_id: r.text for r in read_corpus_dir(spark, str(d)).collect()}
    assert set(got) == {"00001.txt", "00002.txt"} and got["00002.txt"] == ""
    w = {r.doc_id: r.w for r in I.doc_terms(read_corpus_dir(spark, str(d))).collect()}
    assert w == {"00001.txt": 3, "00002.txt": 0}
    assert [r.query_id for r in read_query_files(spark, str(d)).collect()].count("00001.txt") == 1


def test_corpus_directory_keeps_files_that_are_not_utf8(spark, tmp_path):
    from termlens.sources.corpus import read_corpus_dir
    d = tmp_path / "books"
    d.mkdir()
    (d / "latin.txt").write_bytes("caf\u00e9 noir".encode("latin-1"))
    (d / "utf.txt").write_text("caf\u00e9", encoding="utf-8")
    got = {r.doc_id: r.text for r in read_corpus_dir(spark, str(d)).collect()}
    assert got == {"latin.txt": "caf\ufffd noir", "utf.txt": "caf\u00e9"}


def test_tsv_sides_with_any_ids(spark):
    from termlens.sources import formats as FM
    rows = [("query.txt", "00001-a.txt", 2, 3, 9, 0.2), ("q1", "q2.txt", 1, 5, 4, 0.5), ("a-b%2D", "c\td", 1, 2, 2, 1 / 3)]
    schema = "query_id string, doc_id string, match_count long, w_query long, w_doc long, similarity double"
    df = spark.createDataFrame(rows, schema)
    back = FM.parse_jpii_tsv(FM.jpii_tsv_lines(df)).collect()
    assert sorted(tuple(r) for r in back) == sorted(rows)
    bad = spark.createDataFrame([("no fields",), ("a-b\t1\t2\tx\t0.5",), ("qa-b\t1\t2\t3\t0.5",), ("nodash\t1\t2\t3\t0.5",)], "value string")
    assert [tuple(r) for r in FM.parse_jpii_tsv(bad).collect()] == [("a", "b", 1, 2, 3, 0.5)]


def test_page_links_on_ordinary_html(spark):
    from termlens.sources.corpus import page_links
    html = """<p><a href="/a">A</a> <A class='x' HREF='b.txt'>B <i>b</i></A><a title="x>y" href=//cdn.x/z>C</a> <a name="n">no</a>
<a href="http://o.org/p" rel="q">D</a><a href="?x=1">E</a><a href="#top">F</a><a href="mailto:m@x">Plain Text UTF-8</a>"""
    df = spark.createDataFrame([(1, "https://h.org/dir/page?k=2#f", html), (2, "https://h.org", '<a href="y.txt">Y</a>')], "page_id long, url string, html string")
    got = [(r.page_id, r.anchor_text, r.url) for r in page_links(df).collect()]
    assert got == [(1, "A", "https://h.org/a"), (1, "B b", "https://h.org/dir/b.txt"), (1, "C", "https://cdn.x/z"), (1, "D", "http://o.org/p"),
                   (1, "E", "https://h.org/dir/page?x=1"), (1, "F", "https://h.org/dir/page?k=2#top"), (1, "Plain Text UTF-8", "mailto:m@x"),
                   (2, "Y", "https://h.org/y.txt")]
    assert page_links(df, "Plain Text UTF-8").count() == 1


def test_cleaners_on_hand_made_texts(spark):
    from termlens.functions import text as T
    d = _docs(spark, [("esc", "a\\nb \\ttab\\"), ("res", "itxe2x80x99s xe2x80x9cgoodxe2x80x9d"), ("blank", " \n\t ")])
    from termlens.sources.corpus import clean_documents
    got = {r.doc_id: r.text for r in clean_documents(d).collect()}
    assert set(got) == {"esc", "res"}
    assert "\\" not in got["esc"] and "'" in got["res"] and "xe2" not in got["res"]
    assert T is not None


def test_universal_terms_are_pruned(spark):
    d = _docs(spark, [("a", "all red"), ("b", "all red blue"), ("c", "all green")])
    n = I.corpus_size(d)
    kept = {p: {r.term for r in I.prune(I.postings(d), n, p).collect()} for p in ("both", "universal", "single", "none")}
    everything = {r.term for r in I.postings(d).collect()}
    assert kept["none"] == everything
    df = {t: sum(t in x.split() for x in ("all red", "all red blue", "all green")) for t in everything}
    assert kept["universal"] == {t for t in everything if df[t] < 3} and kept["single"] == {t for t in everything if df[t] > 1}
    assert kept["both"] == {t for t in everything if 1 < df[t] < 3}
