"""Byte-pair encoding and decoding with forced boundaries.

A byte pair that occurs inside no vocabulary token can never be merged over,
so the text may be cut there and the fragments encoded on their own; the
concatenated ids are the ids of the whole.  The library's pre-tokenizer runs
before the merges, so a text is first cut at those forced pairs that are also
ends of pre-tokens whatever stands around them (an ASCII letter or digit on
the left, or white space after anything else); each such fragment is
pre-tokenized alone, and its pre-tokens are cut at every other forced pair.

The texts of an Arrow batch are cut together, a run of about ``RUN_CHARS``
characters at a time, and each distinct fragment of a run is looked up once.  New
ones are merged as lines of one text by the merges' ranks, or, if they hold other
than Latin characters or are long, by the library's BPE model through their own
forced cuts, and are kept in a bounded table per Python worker.  Strings of added tokens ("<|endoftext|>") are found before all this, as
the library does.

Defined results: a null text encodes as an empty one (no ids, decoded ""); a
text of one enormous word is cut wherever the pair table allows and merged
piece by piece; repeated rows are encoded each; an empty table gives an empty
table; other columns are passed through untouched unless they are called like
the result columns, which replace them.  Decoding concatenates the bytes of
the ids and replaces malformed UTF-8, special tokens included.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import rows_of
from .rankbpe import Spans, _runs

# Unicode White_Space beyond ASCII, in the \s of the pre-tokenizer's pattern (fixed values).
_WIDE_SPACE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
# The pre-tokenizer's pattern (fixed value), and the fragments whose classes no Unicode version changes: ASCII and Latin letters.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_LINE = re.compile("[ ]?[!-~\u00c0-\u00ff\u0100-\u017f](?:[ -~\u00c0-\u00ff\u0100-\u017f]*[!-~\u00c0-\u00ff\u0100-\u017f])?")
_PACK = [struct.Struct(f"<{n}I").pack for n in range(33)]
CACHE_PIECES = 1_000_000  # fragments kept per Python worker
CACHE_BYTES = 40  # longer ones are not kept
RUN_CHARS = 1 << 20


def byte_chars() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {b: chr(b) for b in plain}
    table.update({b: chr(256 + k) for k, b in enumerate(sorted(set(range(256)) - set(plain)))})
    return [table[b] for b in range(256)]


class ForcedCutBPE:
    """Encoder and decoder over a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec["pre_tokenizer"] or {}
        if spec["model"]["type"] != "BPE" or pre.get("type") != "ByteLevel" or not pre.get("use_regex", True) \
                or pre.get("add_prefix_space") or spec["normalizer"] or spec["model"].get("ignore_merges"):
            raise ValueError("needs a byte-level BPE file without normalizer, prefix space or ignored merges")
        lib = Tokenizer.from_file(path)
        self._model, self._pre = lib.model, lib.pre_tokenizer
        self.chars = byte_chars()
        self._to_byte = {c: b for b, c in enumerate(self.chars)}
        vocab = spec["model"]["vocab"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError("added tokens with stripping or word rules are not supported")
        size = max([*vocab.values(), *self.added.values()]) + 1
        self.token_bytes = [b""] * size
        inside = np.zeros((256, 256), dtype=bool)
        for token, i in vocab.items():
            raw = bytes(self._to_byte[c] for c in token)
            self.token_bytes[i] = raw
            if len(raw) > 1:
                a = np.frombuffer(raw, dtype=np.uint8)
                inside[a[:-1], a[1:]] = True
        for token, i in self.added.items():
            self.token_bytes[i] = token.encode()
        self.inside = inside
        self._ranked(spec["model"]["merges"], vocab)
        self._joined = [bytes(row) for row in inside]  # joined[a][b]: 1 if the pair may be merged over
        space = np.zeros(256, dtype=bool)
        space[[*range(9, 14), 32]] = True
        alnum = np.array([b < 128 and chr(b).isalnum() for b in range(256)])
        free = ~inside & (alnum[:, None] | (space[None, :] & ~space[:, None]))
        self._cut = free.reshape(-1)  # by 256 * left + right
        self._cut_wide = (free & (np.arange(256) < 128)[:, None]).reshape(-1)
        self._split_added = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self._marks = tuple(self.added)
        self._cache: dict[bytes, bytes] = {}
        self._latin = {b: c for b, c in enumerate(self.chars)}

    def fragments(self, raw: bytes) -> list[bytes]:
        """``raw`` cut at every byte pair that occurs inside no token."""
        joined, out, at = self._joined, [], 0
        for k in range(1, len(raw)):
            if not joined[raw[k - 1]][raw[k]]:
                out.append(raw[at:k])
                at = k
        out.append(raw[at:])
        return out

    def _encode_fragment(self, frag: bytes) -> bytes:
        """Ids of one fragment, as little-endian unsigned 32-bit integers."""
        if frag.isalpha():  # one pre-token without forced pairs
            ids = [t.id for t in self._model.tokenize(frag.decode())]
        elif frag[0] == 32 and frag[1:].isalpha():
            ids = [t.id for t in self._model.tokenize(self.chars[32] + frag[1:].decode())]
        else:
            to_byte = self._to_byte
            ids = [i for p, _ in self._pre.pre_tokenize_str(frag.decode()) for i in self._merged(bytes([to_byte[c] for c in p]))]
        out = _PACK[len(ids)](*ids) if len(ids) < len(_PACK) else np.array(ids, dtype="<u4").tobytes()
        if len(frag) <= CACHE_BYTES:
            if len(self._cache) >= CACHE_PIECES:
                self._cache.clear()
            self._cache[frag] = out
        return out

    def _merged(self, raw: bytes) -> list[int]:
        merge, latin = self._model.tokenize, self._latin
        return [t.id for frag in self.fragments(raw) for t in merge(frag.decode("latin-1").translate(latin))]

    def encode(self, text: str | None) -> np.ndarray:
        """Token ids of a whole text."""
        if not text:
            return np.empty(0, dtype="<u4")
        if self._split_added and any(m in text for m in self._marks):
            parts = [np.array([self.added[s]], dtype="<u4") if s in self.added else self._plain(s)
                     for s in self._split_added.split(text) if s]
            return np.concatenate(parts)
        return self._plain(text)

    def _plain(self, text: str) -> np.ndarray:
        raw = text.encode()
        a = np.frombuffer(raw, dtype=np.uint8)
        pair = a[:-1].astype(np.uint16) << 8
        pair |= a[1:]
        cut = (self._cut_wide if _WIDE_SPACE.search(text) else self._cut)[pair]
        spaced = np.full(len(a) + int(np.count_nonzero(cut)), 0xFF, np.uint8)  # a byte that UTF-8 does not have, at each cut
        at = np.arange(len(a))
        at[1:] += np.cumsum(cut)
        spaced[at] = a
        frags = spaced.tobytes().split(b"\xff")
        found = list(map(self._cache.get, frags))
        if None in found:
            found = [x or self._cache.get(f) or self._encode_fragment(f) for f, x in zip(frags, found, strict=True)]
        return np.frombuffer(b"".join(found), dtype="<u4")

    def encode_texts(self, texts: list[str | None]) -> list[np.ndarray]:
        """Token ids of whole texts, whose fragments are looked up together."""
        out: list[np.ndarray] = [np.empty(0, dtype="<u4")] * len(texts)
        for wide in (False, True):
            which = [k for k, t in enumerate(texts) if t and bool(_WIDE_SPACE.search(t)) == wide and not any(m in t for m in self._marks)]
            if which:
                for k, ids in zip(which, self._together([texts[k].encode() for k in which], self._cut_wide if wide else self._cut), strict=True):
                    out[k] = ids
        for k, t in enumerate(texts):
            if t and any(m in t for m in self._marks):
                out[k] = self.encode(t)
        return out

    def _together(self, texts: list[bytes], table: np.ndarray) -> list[np.ndarray]:
        """Ids of non-empty texts without added tokens."""
        raw = b"".join(texts)
        a = np.frombuffer(raw, dtype=np.uint8)
        pair = a[:-1].astype(np.uint16) << 8
        pair |= a[1:]
        size = np.array([len(t) for t in texts], dtype=np.int64)
        text_at = np.cumsum(size) - size
        begins = np.zeros(len(a), dtype=bool)
        begins[1:] = table[pair]
        begins[text_at] = True
        at = np.flatnonzero(begins)
        end = np.append(at[1:], len(raw))
        one, same = Spans(np.frombuffer(raw + bytes(16), dtype=np.uint8), at, end).distinct(np.arange(len(at)))
        frags = [raw[b:e] for b, e in zip(at[one].tolist(), end[one].tolist(), strict=True)]
        own = list(map(self._cache.get, frags))
        self._fill(frags, own)
        n = np.array([len(x) for x in own], dtype=np.int64) >> 2
        count = n[same]
        done = np.cumsum(count)
        step = (np.cumsum(n) - n)[same] - (done - count)
        ids = np.frombuffer(b"".join(own), dtype="<u4")[np.repeat(step, count) + np.arange(int(done[-1]))]
        upto = np.append(0, done)
        first, last = np.searchsorted(at, text_at), np.searchsorted(at, text_at + size)
        return [ids[b:e] for b, e in zip(upto[first].tolist(), upto[last].tolist(), strict=True)]

    def _fill(self, frags: list[bytes], own: list[bytes | None]) -> None:
        """Ids of the fragments that the table does not have.

        Latin ones that begin and end with something other than white space (but for one leading blank) are merged as
        lines of one text: a line feed beside them is a forced cut, and its id ends a fragment's ids.
        """
        new = [k for k, x in enumerate(own) if x is None]
        lines = [k for k in new if len(frags[k]) <= CACHE_BYTES and _LINE.fullmatch(frags[k].decode())] if self._by_rank is not None else []
        if lines:
            ranks = np.array(self._by_rank.encode_ordinary(b"\n".join([frags[k] for k in lines]).decode()), dtype=np.int64)
            stop = np.append(np.flatnonzero(ranks == 10), len(ranks))  # a byte's rank is the byte
            if len(stop) != len(lines):
                raise ValueError("a line feed is not a token of its own")
            flat, at = self._id_of_rank[ranks].tobytes(), 0
            for k, end in zip(lines, stop.tolist(), strict=True):
                own[k] = flat[4 * at:4 * end]
                at = end + 1
            if len(self._cache) + len(lines) > CACHE_PIECES:
                self._cache.clear()
            self._cache.update((frags[k], own[k]) for k in lines)
        for k in new:
            if own[k] is None:
                own[k] = self._encode_fragment(frags[k])

    def _ranked(self, merges: list, vocab: dict[str, int]) -> None:
        """The merges as ranks of what they make, for an encoder that merges by rank; it is used only where that is the same.

        It is if every merge makes another token and every token's bytes merge to that token: then two neighbours that
        form a token by other than its own merge cannot both be there when its rank is due.
        """
        import tiktoken

        ranks = {bytes([b]): b for b in range(256)}
        ids = [vocab[c] for c in self.chars]
        pairs = [m if isinstance(m, (list, tuple)) else m.split(" ") for m in merges]
        for k, (x, y) in enumerate(pairs):
            ranks[bytes(self._to_byte[c] for c in x + y)] = 256 + k
            ids.append(vocab[x + y])
        whole = all(len(t := self._model.tokenize(x + y)) == 1 and t[0].id == vocab[x + y] for x, y in pairs)
        self._by_rank = None
        if whole and len(ranks) == len(ids):
            self._by_rank = tiktoken.Encoding("merges", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
            self._id_of_rank = np.array(ids, dtype="<u4")

    def decode(self, ids) -> str:
        return b"".join(map(self.token_bytes.__getitem__, ids)).decode("utf-8", errors="replace")


_held: dict[str, ForcedCutBPE] = {}


def encoder(path: str) -> ForcedCutBPE:
    """The worker's encoder for a vocabulary file (each machine holds the file under the same path)."""
    if path not in _held:
        _held[path] = ForcedCutBPE(path)
    return _held[path]


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def id_lists(parts: list[np.ndarray]) -> pa.ListArray:
    offsets = np.zeros(len(parts) + 1, dtype=np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    flat = np.concatenate(parts).astype(np.int32) if parts else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def with_ids(batches, path: str, text_col: str, ids_col: str, end_id: int | None = None) -> Iterator[pa.RecordBatch]:
    """Batches with the ids of each text added, a batch per run of texts."""
    enc = encoder(path)
    end = np.array([] if end_id is None else [end_id], dtype="<u4")
    for batch in batches:
        rest = batch.drop_columns([ids_col]) if ids_col in batch.schema.names else batch
        at = 0
        for texts in _runs(rows_of([batch], text_col), RUN_CHARS):
            parts = enc.encode_texts(texts)
            if len(end):
                parts = [np.concatenate([ids, end]) for ids in parts]
            piece = rest.slice(at, len(texts))
            at += len(texts)
            yield pa.RecordBatch.from_arrays([*piece.columns, id_lists(parts)], names=[*piece.schema.names, ids_col])


def encode(df: DataFrame, path: str | None = None, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``df`` with ``ids_col``: array<int>, the token ids of each whole text."""
    path = path or vocabulary_path()
    keep = df.drop(ids_col)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in keep.schema), f"`{ids_col}` array<int>"])

    def run(batches):
        yield from with_ids(batches, path, text_col, ids_col)

    return keep.mapInArrow(run, schema)


def decode(df: DataFrame, path: str | None = None, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``df`` with ``text_col``: the text that the ids stand for, special tokens included."""
    path = path or vocabulary_path()
    keep = df.drop(text_col)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in keep.schema), f"`{text_col}` string"])

    def run(batches):
        enc = encoder(path)
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index(ids_col))
            for at in range(0, batch.num_rows, 256):
                piece = batch.slice(at, 256)
                texts = [enc.decode(x.values.to_numpy(zero_copy_only=False).tolist()) if x.is_valid else None for x in ids.slice(at, 256)]
                yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(texts, pa.string())], names=[*piece.schema.names, text_col])

    return keep.mapInArrow(run, schema)
