"""Forced-boundary BPE and token files against the tokenizers library."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from termlens.llm import bpe, tokenfiles
from termlens.llm.common import scratch

TEXTS = [None, "", "  a  b \n\n c  ", "<|endoftext|> x<|endoftext|>", "don't we'll I'M \x1c!\x1c a\x85b\xa0 c", "!'s ?'re ''d",
         "日本語 テスト  mixed １２３ ²½ x", "aaaa" * 5000, "\t\tfoo\r\n bar  ", " 𠀀𐍈 é", "a　　b 　 c", "1234abc__def", "  x", "the the the"]


@pytest.fixture(scope="module")
def lib():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe.vocabulary_path())
    t.no_truncation()
    t.no_padding()
    return t


def test_texts(lib):
    e = bpe.ForcedCutBPE(bpe.vocabulary_path())
    for t in TEXTS:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        assert e.encode(t).tolist() == ids
        assert e.decode(ids) == lib.decode(ids, skip_special_tokens=False) == (t or "")


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list(" \n\t'sdtmlrevaE,.!?-19é\xa0　日²★𐍈")), max_size=30))
def test_random_texts(lib, text):
    assert bpe.encoder(bpe.vocabulary_path()).encode(text).tolist() == lib.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*" \n\t\r'sdtmlrevaE,.!?-19é\xa0\x1c　日²★𐍈<|>", "<|endoftext|>", "  ", " the", "n't"]), max_size=30).map("".join), max_size=4))
def test_texts_encoded_together(lib, texts):
    got = bpe.encoder(bpe.vocabulary_path()).encode_texts([None, *texts])
    assert [x.tolist() for x in got] == [[], *(lib.encode(t, add_special_tokens=False).ids for t in texts)]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 50256), max_size=20))
def test_decoding_of_any_ids(lib, ids):
    assert bpe.encoder(bpe.vocabulary_path()).decode(ids) == lib.decode(ids, skip_special_tokens=False)


def test_forced_pairs_occur_in_no_token():
    e = bpe.ForcedCutBPE(bpe.vocabulary_path())
    for raw in e.token_bytes[:50256]:
        assert e.fragments(raw) == [raw]


def test_dataframe_round_trip(spark, lib):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, ids string")
    out = bpe.decode(bpe.encode(df)).collect()
    assert {r.doc_id: r.decoded for r in out} == {i: t or "" for i, t in enumerate(TEXTS)}
    assert all(r.ids == lib.encode(r.text or "", add_special_tokens=False).ids for r in out)
    assert bpe.decode(bpe.encode(df.limit(0))).count() == 0


def test_token_files(spark, lib):
    rows = [(5, "b b"), (2, None), (9, "x" * 3000), (7, "the cat"), (7, "a dog"), (None, "first")]
    out = scratch(spark, "t") + "/t"
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, part int")
    tokenfiles.write_tokens(df, out)
    got = sorted(((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in tokenfiles.index(spark, out).collect()), key=lambda r: r[0])
    want, at = [], 0
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*lib.encode(t or "", add_special_tokens=False).ids, 0]
        want.append((at, d, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert got == want
    meta = tokenfiles.read_tokens(spark, out, ("doc_id", "n_tokens")).where("doc_id = 9")
    plan = meta._jdf.queryExecution().toString()
    assert "ids" not in plan.split("ReadSchema")[1] and "EqualTo(doc_id,9)" in plan
    tokenfiles.write_tokens(df.limit(0), out + "0")
    assert tokenfiles.index(spark, out + "0").count() == 0


def test_digest_query(spark, tmp_path, lib):
    from termlens.llm.queries import op3_bpe

    spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    for r in op3_bpe(spark, str(tmp_path)).collect():
        ids = lib.encode(TEXTS[r.doc_id] or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((TEXTS[r.doc_id] or "").encode()).hexdigest()
