"""Byte-level BPE by rank files: a minimal perfect hash first, a heap over linked bytes for the rest.

A text is cut into pre-tokens by the pattern of the rank files.  The pattern's
classes (letters, numbers, white space, rest) depend on one character each, so
the cuts of a whole Arrow batch are found with array operations on its code
points.  Tier one looks every pre-token up whole: a minimal perfect hash over
the vocabulary gives it one slot, and the bytes kept there decide whether the
pre-token is that entry, again for all pre-tokens of a piece at once.  Tier two
merges the pre-tokens that are no entry: their bytes are a linked list, and a
heap yields the adjacent pair of lowest rank, leftmost first, until no pair has
one.  Merged pre-tokens are kept in a bounded table per Python worker.

Memory: a text is taken in pieces of about ``PIECE_CHARS`` characters, cut only
in front of white space that follows something else, where a pre-token starts
whatever stands around.  A text without such a place is one piece.

Defined results: a null text encodes as an empty one (no ids, no bytes); a text
of one enormous word is one pre-token, merged by the heap in n log n; repeated
rows are encoded each; an empty table gives an empty table; other columns,
nulls and null ids included, are passed through, unless they are called like
the result column, which replaces them.  Ids that the vocabulary does not have
raise an error when decoded; a null list of ids decodes to null.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import rows_of

PIECE_CHARS = 1 << 21
CACHE_PIECES = 1_000_000  # merged pre-tokens kept per Python worker
CACHE_BYTES = 64  # longer ones are not kept

# Unicode White_Space (fixed values): what \s of the pre-token pattern matches.
WHITE_SPACE = (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680, 0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006,
               0x2007, 0x2008, 0x2009, 0x200A, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
_REST, _LETTER, _NUMBER, _SPACE = 0, 1, 2, 3
_MASK = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], dtype=np.uint64)  # the first k bytes of a word
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def classes() -> np.ndarray:
    """The class of every code point, by the Unicode version that the rank files' library knows.

    A vocabulary of the 256 bytes and a class as pattern make the library return just the characters of that class.
    """
    import tiktoken

    table = np.zeros(0x110000, dtype=np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, pattern in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+")):
        lib = tiktoken.Encoding(pattern, pat_str=pattern, mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
        table[np.frombuffer(lib.decode(lib.encode_ordinary(every)).encode("utf-32-le"), dtype="<u4")] = kind
    table[list(WHITE_SPACE)] = _SPACE
    return table


def starts(points: np.ndarray, table: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Which code points start a pre-token; ``first`` are the places where a text starts.

    The pattern says: a run of one class is a pre-token, with one U+0020 before it if there is one; of white space
    before something else the last character is not part of the run; an apostrophe at the start of a pre-token takes
    s, t, re, ve, m, ll or d with it.
    """
    n = len(points)
    kind = table[points]
    before = np.empty(n, dtype=np.uint8)
    before[0] = 255
    before[1:] = kind[:-1]
    before[first] = 255  # a text's first character follows nothing
    space = kind == _SPACE
    out = kind != before
    after_blank = np.zeros(n, dtype=bool)  # the U+0020 before is part of this run's pre-token
    after_blank[1:] = (points[:-1] == 0x20) & ~space[1:]
    after_blank[first] = False
    out &= ~after_blank
    follows = np.zeros(n, dtype=bool)  # something other than white space follows in the same text
    follows[:-1] = ~space[1:] & (before[1:] != 255)
    out |= space & follows
    for at in np.flatnonzero((points == 0x27) & out).tolist():
        tail = points[at + 1:at + 3].tolist()
        cut = np.searchsorted(first, at, side="right")
        room = (int(first[cut]) if cut < len(first) else n) - at - 1  # characters left in this text
        tail = tail[:room]
        size = 1 if tail[:1] in ([115], [116], [109], [100]) else 2 if tail in ([114, 101], [118, 101], [108, 108]) else 0
        if size:
            out[at + 1:at + 1 + size] = False
            if room > size:
                out[at + 1 + size] = True
    return out


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _M2
    h = (h ^ (h >> np.uint64(27))) * _M3
    return h ^ (h >> np.uint64(31))


class Spans:
    """Byte strings ``buf[at:end]`` as their first 16 bytes, their length and a hash of all bytes."""

    def __init__(self, buf: np.ndarray, at: np.ndarray, end: np.ndarray):
        """``buf`` has 16 spare bytes at its end."""
        words = np.ndarray((len(buf) - 7,), dtype="<u8", buffer=buf, strides=(1,))
        self.size = size = end - at
        self.low = words[at] & _MASK[np.minimum(size, 8)]
        self.high = np.where(size > 8, words[np.minimum(at + 8, len(words) - 1)] & _MASK[np.clip(size - 8, 0, 8)], np.uint64(0))
        h = _mix(self.low * _M1 + size.astype(np.uint64)) ^ (self.high * _M3)
        long = np.flatnonzero(size > 16)
        for k in long.tolist():  # rare: the rest of a long string, eight bytes at a time
            x = int(h[k])
            rest = buf[at[k] + 16:end[k]].tobytes()
            if len(rest) > 256:
                x ^= hash(rest) & 0xFFFFFFFFFFFFFFFF  # longer than any entry: never found, only told apart
            else:
                for b in range(0, len(rest), 8):
                    x = (x * 0x9E3779B97F4A7C15 + int.from_bytes(rest[b:b + 8], "little") + 1) & 0xFFFFFFFFFFFFFFFF
            h[k] = x
        self.hash = _mix(h)
        self.long = long

    def distinct(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One index for each distinct string of those at ``which`` (long ones may come more than once), and its number for each."""
        order = which[np.argsort(self.hash[which], kind="stable")]
        new = np.ones(len(order), dtype=bool)
        a, b = order[1:], order[:-1]
        new[1:] = (self.low[a] != self.low[b]) | (self.high[a] != self.high[b]) | (self.size[a] != self.size[b]) | (self.size[a] > 16)
        number = np.empty(len(self.size), dtype=np.int64)
        number[order] = np.cumsum(new) - 1
        return order[new], number[which]


class PerfectHash:
    """A minimal perfect hash over byte strings: n strings, n slots, one look-up each.

    Strings fall into buckets; bucket by bucket, the largest first, the first displacement is taken that sends all
    its strings to free slots.  A bucket of one string names its slot directly.
    """

    def __init__(self, keys: list[bytes]):
        self.n = n = len(keys)
        blob = b"".join(keys)
        size = np.array([len(k) for k in keys], dtype=np.int64)
        end = np.cumsum(size)
        spans = Spans(np.frombuffer(blob + bytes(16), dtype=np.uint8), end - size, end)
        if len(np.unique(spans.hash)) < n:
            raise ValueError("two vocabulary entries have one hash")
        self.n_buckets = n // 3 + 1
        bucket = (spans.hash % np.uint64(self.n_buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        held = np.bincount(bucket, minlength=self.n_buckets)
        begin = np.cumsum(held) - held
        self.shift = np.zeros(self.n_buckets, dtype=np.int64)
        slot_of = np.empty(n, dtype=np.int64)
        used = np.zeros(n, dtype=bool)
        tries = np.arange(64, dtype=np.uint64)[:, None]
        for b in np.argsort(-held, kind="stable").tolist():
            if held[b] < 2:
                break
            mine = order[begin[b]:begin[b] + held[b]]
            at = np.uint64(0)
            while True:
                place = self._place(spans.hash[mine][None, :], tries + at)
                good = ~used[place].any(axis=1)
                if held[b] > 1:
                    ordered = np.sort(place, axis=1)
                    good &= (ordered[:, 1:] != ordered[:, :-1]).all(axis=1)
                if good.any():
                    d = int(np.argmax(good))
                    self.shift[b] = int(at) + d
                    slot_of[mine] = place[d]
                    used[place[d]] = True
                    break
                at += np.uint64(64)
        free = iter(np.flatnonzero(~used).tolist())
        for b in np.flatnonzero(held == 1).tolist():
            slot = next(free)
            self.shift[b] = -1 - slot
            slot_of[order[begin[b]]] = slot
        self.entry = np.empty(n, dtype=np.int64)  # slot -> index in keys
        self.entry[slot_of] = np.arange(n)
        self.low, self.high, self.size = (np.empty(n, dtype=x.dtype) for x in (spans.low, spans.high, spans.size))
        self.low[slot_of], self.high[slot_of], self.size[slot_of] = spans.low, spans.high, spans.size
        self.keys = keys

    def _place(self, h: np.ndarray, d: np.ndarray) -> np.ndarray:
        return (_mix(h + (d + np.uint64(1)) * _M1) % np.uint64(self.n)).astype(np.int64)

    def find(self, s: Spans, buf: np.ndarray, at: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Index of each string ``buf[at:end]``, whose spans are ``s``, among the keys, -1 if it is none."""
        d = self.shift[(s.hash % np.uint64(self.n_buckets)).astype(np.int64)]
        slot = np.where(d < 0, -1 - d, self._place(s.hash, np.maximum(d, 0).astype(np.uint64)))
        hit = (self.low[slot] == s.low) & (self.high[slot] == s.high) & (self.size[slot] == s.size)
        out = np.where(hit, self.entry[slot], -1)
        for k in s.long[hit[s.long]].tolist():  # the first 16 bytes agree: compare the rest
            if self.keys[out[k]] != buf[at[k]:end[k]].tobytes():
                out[k] = -1
        return out


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token that is no entry: lowest-ranked adjacent pairs are merged first, leftmost first."""
    n = len(piece)
    after = list(range(1, n + 1))  # of the part that starts here: where it ends, and the next one starts
    before = list(range(-1, n - 1))
    heap = []
    get = ranks.get
    for i in range(n - 1):
        r = get(piece[i:i + 2])
        if r is not None:
            heap.append((r, i, i + 1, i + 2))
    heapq.heapify(heap)
    pop, push = heapq.heappop, heapq.heappush
    while heap:
        _, a, m, e = pop(heap)
        if after[a] != m or m >= n or after[m] != e:  # one of the two parts has grown or gone since
            continue
        after[a], after[m] = e, -1
        if e < n:
            before[e] = a
            r = get(piece[a:after[e]])
            if r is not None:
                push(heap, (r, a, e, after[e]))
        p = before[a]
        if p >= 0:
            r = get(piece[p:e])
            if r is not None:
                push(heap, (r, p, a, e))
    out, a = [], 0
    while a < n:
        out.append(ranks[piece[a:after[a]]])
        a = after[a]
    return out


class RankBPE:
    """Encoder and decoder over a rank file (base64 bytes and rank per line)."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, f))}
        missing = [b for b in range(256) if bytes([b]) not in self.ranks]
        if missing:
            raise ValueError(f"the rank file lacks the bytes {missing[:5]}")
        keys = list(self.ranks)
        self.hash = PerfectHash(keys)
        self.rank_of = np.array([self.ranks[k] for k in keys], dtype=np.uint32)
        self.table = classes()
        n = max(self.ranks.values()) + 1
        self.bytes_len = np.full(n, -1, dtype=np.int64)
        for k, r in self.ranks.items():
            self.bytes_len[r] = len(k)
        by_rank = sorted(keys, key=self.ranks.__getitem__)
        self.blob = np.frombuffer(b"".join(by_rank), dtype=np.uint8)
        width = np.maximum(self.bytes_len, 0)
        self.blob_at = np.cumsum(width) - width
        self._kept: dict[bytes, bytes] = {}

    def _merged(self, piece: bytes) -> bytes:
        out = np.array(merge(piece, self.ranks), dtype="<u4").tobytes()
        if len(piece) <= CACHE_BYTES:
            if len(self._kept) >= CACHE_PIECES:
                self._kept.clear()
            self._kept[piece] = out
        return out

    def encode_texts(self, texts: list[str]) -> list[np.ndarray]:
        """Ids (uint32) of each text; the texts are looked up together."""
        whole = "".join(texts)
        if not whole:
            return [np.empty(0, dtype="<u4") for _ in texts]
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        text_at = np.cumsum(lengths) - lengths
        points = np.frombuffer(whole.encode("utf-32-le"), dtype="<u4")
        raw = whole.encode()
        if len(raw) == len(points):
            byte_at = None
        else:
            width = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
            byte_at = np.cumsum(width) - width
        begin = np.flatnonzero(starts(points, self.table, np.unique(text_at[lengths > 0])))
        at = begin if byte_at is None else byte_at[begin]
        end = np.append(at[1:], len(raw))
        buf = np.frombuffer(raw + bytes(16), dtype=np.uint8)
        spans = Spans(buf, at, end)
        found = self.hash.find(spans, buf, at, end)
        miss = np.flatnonzero(found < 0)
        count = np.ones(len(at), dtype=np.int64)
        if len(miss):
            one, same = spans.distinct(miss)
            get, merged = self._kept.get, self._merged
            own = [get(p) or merged(p) for p in [raw[a:b] for a, b in zip(at[one].tolist(), end[one].tolist(), strict=True)]]
            own_size = np.array([len(p) for p in own], dtype=np.int64) >> 2
            count[miss] = own_size[same]
        done = np.cumsum(count)
        ids = np.empty(int(done[-1]), dtype="<u4")
        if len(miss):
            single = np.ones(len(ids), dtype=bool)
            size = count[miss]
            within = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
            spread = np.repeat(done[miss] - size, size) + within
            single[spread] = False
            ids[spread] = np.frombuffer(b"".join(own), dtype="<u4")[np.repeat((np.cumsum(own_size) - own_size)[same], size) + within]
            ids[single] = self.rank_of[found[found >= 0]]
        else:
            ids[:] = self.rank_of[found]
        upto = np.append(0, done)
        first = np.searchsorted(begin, text_at)  # a text's first pre-token starts where the text does
        last = np.searchsorted(begin, text_at + lengths)
        return [ids[a:b] for a, b in zip(upto[first].tolist(), upto[last].tolist(), strict=True)]

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of one whole text, piece by piece."""
        parts = [self.encode_texts([p])[0] for p in pieces(text or "")]
        return np.concatenate(parts) if len(parts) != 1 else parts[0]

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes that the ids stand for."""
        if not len(ids):
            return b""
        ids = np.asarray(ids, dtype=np.int64)
        size = self.bytes_len[ids]
        if (ids < 0).any() or (size < 0).any():
            raise ValueError("an id that the vocabulary does not have")
        step = self.blob_at[ids] - (np.cumsum(size) - size)
        return self.blob[np.arange(int(size.sum())) + np.repeat(step, size)].tobytes()


def pieces(text: str, n: int = PIECE_CHARS) -> list[str]:
    """``text`` in pieces of about ``n`` characters, each starting at white space that follows something else."""
    out, at = [], 0
    while len(text) - at > n:
        cut = at + n
        while cut < len(text) and not (text[cut] in " \n\t" and not text[cut - 1].isspace() and ord(text[cut - 1]) not in WHITE_SPACE):
            cut += 1
        out.append(text[at:cut])
        at = cut
    out.append(text[at:])
    return out


_held: dict[str, RankBPE] = {}


def coder(path: str) -> RankBPE:
    """The worker's coder for a rank file (each machine holds the file under the same path)."""
    if path not in _held:
        _held[path] = RankBPE(path)
    return _held[path]


def ranks_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def _schema(keep: DataFrame, name: str, kind: str) -> str:
    return ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in keep.schema), f"`{name}` {kind}"])


def _runs(texts: Iterator[tuple[str | None]], n: int) -> Iterator[list[str]]:
    """Lists of whole texts of about ``n`` characters together."""
    held, size = [], 0
    for (t,) in texts:
        held.append(t or "")
        size += len(held[-1])
        if size >= n:
            yield held
            held, size = [], 0
    if held:
        yield held


def encode(df: DataFrame, path: str | None = None, text_col: str = "text", ids_col: str = "ids", packed: bool = False) -> DataFrame:
    """``df`` with ``ids_col``, the ids of each whole text: array<int>, or ``packed`` as little-endian unsigned 32-bit integers."""
    path = path or ranks_path()
    keep = df.drop(ids_col)

    def run(batches):
        enc = coder(path)
        for batch in batches:
            at = 0
            for texts in _runs(rows_of([batch], text_col), PIECE_CHARS):
                ids = enc.encode_texts(texts) if sum(map(len, texts)) < 2 * PIECE_CHARS else [enc.encode(t) for t in texts]
                rows = batch.slice(at, len(texts))
                at += len(texts)
                if packed:
                    col = pa.array([x.tobytes() for x in ids], type=pa.binary())
                else:
                    offsets = np.zeros(len(ids) + 1, dtype=np.int32)
                    np.cumsum([len(x) for x in ids], out=offsets[1:])
                    col = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids).astype(np.int32)))
                others = [(n, rows.column(k)) for k, n in enumerate(rows.schema.names)]
                yield pa.RecordBatch.from_arrays([*(c for _, c in others), col], names=[*(n for n, _ in others), ids_col])

    return keep.mapInArrow(run, _schema(keep, ids_col, "binary" if packed else "array<int>"))


def decode(df: DataFrame, path: str | None = None, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """``df`` with ``bytes_col``, the bytes that the ids stand for; ids come as array<int> or packed, as ``encode`` gives them."""
    path = path or ranks_path()
    keep = df.drop(bytes_col)

    def run(batches):
        enc = coder(path)
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index(ids_col))
            for at in range(0, batch.num_rows, 256):
                rows, out = batch.slice(at, 256), []
                for x in ids.slice(at, 256):
                    if not x.is_valid:
                        out.append(None)
                    elif pa.types.is_binary(ids.type):
                        out.append(enc.decode(np.frombuffer(x.as_buffer(), dtype="<u4")))
                    else:
                        out.append(enc.decode(x.values.to_numpy(zero_copy_only=False)))
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(out, pa.binary())], names=[*rows.schema.names, bytes_col])

    return keep.mapInArrow(run, _schema(keep, bytes_col, "binary"))
