"""Rank-file BPE (perfect hash and heap merges) against the tiktoken library."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from termlens.llm import rankbpe

TEXTS = [None, "", "  a  b \n\n c  ", "<|endoftext|> x", "don't we'll I'M 'tis rock'n'roll 's's", "a\x85b\xa0 c \x1c!", "!'s ?'re ''d '",
         "日本語 テスト  mixed １２３ ²½ x", "aaaa" * 5000, "\t\tfoo\r\n bar  ", " 𠀀𐍈 é", "a　　b 　 c", "1234abc__def", "  x", "the the the",
         " " * 300, "-" * 200 + "x", "'", "x'", "'s", "\n's", " 's", "ͰԀ"]


@pytest.fixture(scope="module")
def lib():
    import public_tokenizers as P
    import tiktoken

    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=rankbpe.coder(rankbpe.ranks_path()).ranks, special_tokens={})


def test_texts_alone_and_together(lib):
    e = rankbpe.coder(rankbpe.ranks_path())
    want = [lib.encode_ordinary(t or "") for t in TEXTS]
    assert [e.encode(t).tolist() for t in TEXTS] == want
    assert [x.tolist() for x in e.encode_texts([t or "" for t in TEXTS])] == want
    assert [e.decode(np.array(x, dtype=np.uint32)) for x in want] == [(t or "").encode() for t in TEXTS]


def test_every_character_has_the_library_s_class(lib):
    e = rankbpe.coder(rankbpe.ranks_path())
    chars = [chr(c) for c in [*range(0xD800), *range(0xE000, 0x110000)]]
    for glue in ("a{}a", "1{}", " {} !"):
        got = e.encode_texts([glue.format(c) for c in chars[::7]])
        assert [x.tolist() for x in got] == lib.encode_ordinary_batch([glue.format(c) for c in chars[::7]], num_threads=2)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list(" \n\t'sdtmlrevaE,.!?-19é\xa0　日²★𐍈")), max_size=30), max_size=4))
def test_random_texts(lib, texts):
    got = rankbpe.coder(rankbpe.ranks_path()).encode_texts(texts)
    assert [x.tolist() for x in got] == [lib.encode_ordinary(t) for t in texts]


def test_perfect_hash_is_minimal_and_rejects_strangers():
    e = rankbpe.coder(rankbpe.ranks_path())
    assert sorted(e.hash.entry.tolist()) == list(range(len(e.ranks)))
    keys = e.hash.keys
    strange = [k + b"\xff\xfe" for k in keys[:5000]] + [k[:-1] + b"~" for k in keys if len(k) > 20]
    words = keys + strange
    blob, size = b"".join(words), np.array([len(w) for w in words])
    end = np.cumsum(size)
    buf = np.frombuffer(blob + bytes(16), dtype=np.uint8)
    found = e.hash.find(rankbpe.Spans(buf, end - size, end), buf, end - size, end)
    assert found[:len(keys)].tolist() == list(range(len(keys)))
    for w, f in zip(strange, found[len(keys):].tolist(), strict=True):
        assert f == -1 if w not in e.ranks else keys[f] == w


def test_long_texts_are_cut_where_nothing_changes(lib):
    text = "word's  \n\n 12 don't!? " * 400
    for n in (5, 17, 100):
        parts = rankbpe.pieces(text, n)
        assert "".join(parts) == text and len(parts) > 10
        assert [i for p in parts for i in lib.encode_ordinary(p)] == lib.encode_ordinary(text)
    word = "qzxj" * 100_000
    e = rankbpe.coder(rankbpe.ranks_path())
    assert rankbpe.pieces(word) == [word] and e.decode(e.encode(word)) == word.encode()


def test_dataframe_round_trip(spark, lib):
    df = spark.createDataFrame([(i if i else None, t, "x", None) for i, t in enumerate(TEXTS)], "doc_id long, text string, ids string, decoded int")
    for packed in (False, True):
        rows = rankbpe.decode(rankbpe.encode(df, packed=packed)).collect()
        for r in rows:
            ids = np.frombuffer(r.ids, "<u4").tolist() if packed else r.ids
            assert ids == lib.encode_ordinary(r.text or "") and bytes(r.decoded) == (r.text or "").encode()
        assert len(rows) == len(TEXTS) and rows[0].__fields__ == ["doc_id", "text", "ids", "decoded"]
    assert rankbpe.decode(rankbpe.encode(df.limit(0))).count() == 0
    none = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert rankbpe.decode(none).first().decoded is None


def test_digest_query(spark, tmp_path, lib):
    from termlens.llm.queries import op11_bpe

    spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    for r in op11_bpe(spark, str(tmp_path)).collect():
        ids = np.array(lib.encode_ordinary(TEXTS[r.doc_id] or ""), dtype="<u4")
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((TEXTS[r.doc_id] or "").encode()).hexdigest()
