"""Tokenizer parity with a plain-Python model of the reference tokenizer."""

from __future__ import annotations

import re

import pyarrow.parquet as pq
from hypothesis import given, settings
from hypothesis import strategies as st

from termlens.functions.text import STOPWORDS
from termlens.operators import index as I
from tests.conftest import SF_SMALL

_STOP = frozenset(STOPWORDS)
_NON_WORD = re.compile(r"[^\w\s]")


def python_terms(text: str) -> set[str]:
    """The reference rule: lowercase, delete [^\\w\\s], split, drop stopwords."""
    out: set[str] = set()
    for line in text.split("\n"):
        out.update(w for w in _NON_WORD.sub("", line.lower()).split() if w not in _STOP)
    return out


def test_stopword_list_is_fixed():
    assert len(STOPWORDS) == 179 and len(set(STOPWORDS)) == 179
    assert sum("'" in w for w in STOPWORDS) == 26


def test_apostrophe_stopwords_never_match(spark):
    df = spark.createDataFrame([(1, "I don't know, you're right; don't stop")], "doc_id int, text string")
    terms = set(I.doc_terms(df).first().terms)
    assert terms == {"dont", "know", "youre", "right", "stop"}


def test_unicode_tokens(spark):
    df = spark.createDataFrame([(1, "naïve ½ x² café — Ünïcode_wörd")], "doc_id int, text string")
    assert set(I.doc_terms(df).first().terms) == python_terms("naïve ½ x² café — Ünïcode_wörd")


def test_corpus_parity_with_python_model(spark):
    docs = pq.read_table(f"{SF_SMALL}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    sdf = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = {r.doc_id: set(r.terms) for r in I.doc_terms(sdf).collect()}
    for d in docs:
        assert got[d["doc_id"]] == python_terms(d["text"] or ""), d["doc_id"]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("aAbB é_-'.,!½²\t\n  xyzTHE and of")),
                        max_size=60), min_size=1, max_size=5))
def test_random_texts(spark, texts):
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    got = {r.doc_id: set(r.terms) for r in I.doc_terms(df).collect()}
    for i, t in rows:
        assert got[i] == python_terms(t)
