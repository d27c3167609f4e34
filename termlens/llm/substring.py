"""Substring dedup over windows of words, found through difference-cover anchors.

A window of ``window`` consecutive words is removed from a document if the
same words also start somewhere in a document with a smaller id.  Hashing and
exchanging every window would move several times the corpus.  Instead only
sub-windows ("anchors") that start at cover positions are hashed: positions
whose remainder modulo ``period`` is in a difference cover.  For any two
starts i and j there is a k < period for which i + k and j + k are both cover
positions, so every window that two documents share holds an anchor of
``window - period + 1`` words at the same place in both.  Steps, each over
blocks of documents (a hash of doc_id and text):

1. each block sends its distinct anchor hashes to hash buckets;
2. a bucket returns to each block those that another document has too;
3. windows over such anchors are extended to the full length, hashed (96
   bits) and sent to buckets with the smallest id that holds them;
4. a bucket returns to each block the windows (all 96 bits) that another
   block's smaller id owns; the block removes those, and those that one of its
   own documents with a smaller id holds.

Windows are compared by 96 bits made from 64-bit word hashes, not by their words.

Blocks and buckets grow in number with the corpus, not in size.  A window that
a third of all documents hold is one entry per block in its bucket.  The text
is shuffled once (the exchange is shared by steps 1, 3 and 4).

Defined results: a null text has no words; a text shorter than a window keeps
all its words; words are kept unchanged; repeated rows of one id do not remove
each other's words (only rows of equal id and text share a block for sure); a row
with a null id keeps all its words, removes nobody's and joins no block; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import emit, rows_of

U64 = np.uint64
_DEEP = 64  # longer words (in bytes) are hashed one by one
_PLACES = np.random.default_rng(11).integers(0, 1 << 64, _DEEP * 256, dtype=U64)  # a number for each byte at each place of a word
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_PART = 1 << 20


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of the words of a text: the sum of its bytes' numbers by their place in the word."""
    out, at = [], 0
    while at < len(text):
        end = min(len(text), at + _PART)
        while end < len(text) and not _SPACE[text[end]]:  # a part ends between words
            end += 1
        out.append(_part_hashes(text[at:end]))
        at = end
    return np.concatenate([np.empty(0, U64), *out])


def _part_hashes(text: bytes) -> np.ndarray:
    b = np.frombuffer(text, np.uint8)
    at = np.flatnonzero(~_SPACE[b])
    if not len(at):
        return np.empty(0, U64)
    first = np.flatnonzero(np.r_[True, np.diff(at) > 1])
    size = np.diff(np.r_[first, len(at)])
    place = np.arange(len(at)) - np.repeat(first, size)
    h = np.add.reduceat(_PLACES[(np.minimum(place, _DEEP - 1) << 8) | b[at]], first)
    for k in np.flatnonzero(size > _DEEP).tolist():
        s = int(at[first[k]])
        h[k] = xxhash.xxh3_64_intdigest(text[s:s + int(size[k])])
    return h


def difference_cover(period: int) -> list[int]:
    """A set of remainders whose pairwise differences give every remainder, grown greedily."""
    cover, have = [1 % period], {0}
    while len(have) < period:
        best = max((c for c in range(period) if c not in cover),
                   key=lambda c: (len({(c - x) % period for x in cover} | {(x - c) % period for x in cover} | have), -c))
        cover.append(best)
        have |= {(best - x) % period for x in cover} | {(x - best) % period for x in cover}
    return sorted(cover)


def _factors(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, n, dtype=U64) * U64(2) + U64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U64(32))) * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


def _window_hashes(w: np.ndarray, at: np.ndarray | None, length: int, seed: int) -> np.ndarray:
    """Hashes of the ``length``-word windows at the given starts (None: at all)."""
    n = len(w) - length + 1
    if n <= 0:
        return np.empty(0, U64)
    f = _factors(length, seed)
    out = np.zeros(n if at is None else len(at), U64)
    for j in range(length):
        out += (w[j:j + n] if at is None else w[at + j]) * f[j]
    return _mix(out)


class Windows:
    """Window and anchor arithmetic for one parameter set."""

    def __init__(self, window: int = 13, period: int = 7):
        if not 1 <= period <= window:
            raise ValueError("period must be between 1 and window")
        self.window, self.period, self.anchor = window, period, window - period + 1
        self.cover = np.zeros(period, bool)
        self.cover[difference_cover(period)] = True

    def anchors(self, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(starts, hashes with the lowest bit cleared) of a document's anchors."""
        at = np.arange(max(0, len(w) - self.anchor + 1))
        at = at[self.cover[at % self.period]]
        return at, _window_hashes(w, at, self.anchor, 1) & ~U64(1)

    def over(self, n_words: int, shared_at: np.ndarray) -> np.ndarray:
        """Starts of the windows that hold one of the anchors at ``shared_at``."""
        n = n_words - self.window + 1
        if n <= 0 or not len(shared_at):
            return np.empty(0, np.int64)
        mark = np.zeros(n_words + 1, np.int64)
        np.add.at(mark, np.maximum(shared_at - self.period + 1, 0), 1)
        np.add.at(mark, shared_at + 1, -1)
        return np.flatnonzero(np.cumsum(mark)[:n] > 0)

    def covered(self, n_words: int, starts: np.ndarray) -> np.ndarray:
        mark = np.zeros(n_words + 1, np.int64)
        mark[starts] += 1
        mark[starts + self.window] -= 1
        return np.cumsum(mark)[:n_words] > 0


def _docs(table: pa.Table):
    ids, text = table.column("doc_id"), table.column("text")
    for k in range(table.num_rows):
        yield ids[k].as_py(), (text[k].as_py() or "").encode()


def _found(x: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which of ``x`` are in the sorted ``among``."""
    if not len(among):
        return np.zeros(len(x), bool)
    k = np.searchsorted(among, x)
    return among[np.minimum(k, len(among) - 1)] == x


def _pairs_found(x: np.ndarray, second, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of the pairs (x, second) are among the pairs (a, b); ``second(positions)`` gives the second half where the first is found."""
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    out = _found(x, a)
    at = np.flatnonzero(out)
    y, k = second(at), np.searchsorted(a, x[at])
    out[at] = False
    while len(at):
        hit = b[k] == y
        out[at[hit]] = True
        more = ~hit & (k + 1 < len(a))
        more[more] = a[k[more] + 1] == x[at[more]]
        at, y, k = at[more], y[more], k[more] + 1
    return out


def _least(keys: tuple[np.ndarray, ...], ids: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Distinct keys (sorted by the first), and the smallest and largest id of each."""
    order = np.lexsort((ids, *keys[::-1]))
    keys, ids = tuple(k[order] for k in keys), ids[order]
    if not len(ids):
        return list(keys), ids, ids
    new = np.ones(len(ids), bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    at = np.flatnonzero(new)
    return [k[at] for k in keys], ids[at], ids[np.r_[at[1:], len(ids)] - 1]


def _bytes(parts: list[np.ndarray], dtype) -> np.ndarray:
    return np.concatenate([np.empty(0, dtype), *parts])


def _pieces(block: int, hashes: np.ndarray, n_buckets: int, columns: list[np.ndarray]) -> pa.Table:
    """One row for each hash bucket that the block has entries for."""
    bucket = ((hashes >> U64(24)) % U64(n_buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    have, at = np.unique(bucket[order], return_index=True)
    ends = np.r_[at[1:], len(order)]
    data = {"bucket": pa.array(have, pa.int64()), "block": pa.array([block] * len(have), pa.int64())}
    for k, col in enumerate(columns):
        col = col[order]
        data[f"c{k}"] = pa.array([col[s:e].tobytes() for s, e in zip(at, ends, strict=True)] if len(have) else [], pa.binary())
    return pa.table(data)


def _back(rows: list[tuple]) -> pa.Table:
    """(block, arrays...) -> a row for each block that has entries."""
    n = len(rows[0]) if rows else 2
    rows = [(b, *(x.tobytes() for x in xs)) for b, *xs in rows if len(xs[0])]
    cols = list(zip(*rows, strict=True)) if rows else [[]] * n
    return pa.table({"block": pa.array(cols[0], pa.int64()), **{f"h{k}": pa.array(x, pa.binary()) for k, x in enumerate(cols[1:])}})


def dedup(docs: DataFrame, window: int = 13, period: int = 7, block_bytes: int = 6 << 20, bucket_anchors: int = 1 << 20) -> DataFrame:
    """``docs(doc_id, text)`` -> (doc_id, n_words, n_removed, kept): the kept words joined by one space.

    ``block_bytes``: text in a block of documents; ``bucket_anchors``: about so many anchors in a bucket.
    """
    geo = Windows(window, period)
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n_blocks = max(64, -(-total // block_bytes))
    n_buckets = max(64, int(total / 6 * geo.cover.mean() / bucket_anchors) + 1)
    docs = docs.select(F.col("doc_id").cast("bigint"), "text")
    blocks = docs.where("doc_id is not null").withColumn(
        "block", F.pmod(F.xxhash64("doc_id", "text", F.lit(7)), F.lit(n_blocks)).cast("bigint"))
    result = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])

    def anchors(table: pa.Table) -> pa.Table:
        block, hs, ids = table.column("block")[0].as_py(), [], []
        for d, text in _docs(table):
            hs.append(geo.anchors(word_hashes(text))[1])
            ids.append(np.full(len(hs[-1]), d, np.int64))
        (h,), lo, hi = _least((_bytes(hs, U64),), _bytes(ids, np.int64))
        return _pieces(block, h, n_buckets, [h | (lo < hi).astype(U64)])

    def shared(table: pa.Table) -> pa.Table:
        of = table.column("block").to_pylist()
        parts = [np.frombuffer(x.as_py(), U64) for x in table.column("c0")]
        every = _bytes(parts, U64)
        keys, inverse, n = np.unique(every & ~U64(1), return_inverse=True, return_counts=True)
        many = n > 1
        many[inverse[(every & U64(1)) == 1]] = True
        hit, at, out = many[inverse], 0, []
        for b, p in zip(of, parts, strict=True):
            out.append((b, (p & ~U64(1))[hit[at:at + len(p)]]))
            at += len(p)
        return _back(out)

    def extended(_, left: pa.Table, right: pa.Table) -> pa.Table:
        k1, k2, ids, block = [], [], [], left.column("block")[0].as_py() if left.num_rows else 0
        among = np.sort(_bytes([np.frombuffer(x.as_py(), U64) for x in right.column("h0")], U64))
        for d, text in _docs(left) if len(among) else ():
            w = word_hashes(text)
            at, h = geo.anchors(w)
            starts = geo.over(len(w), at[_found(h, among)])
            k1.append(_window_hashes(w, starts, window, 2) if len(starts) else np.empty(0, U64))
            k2.append((_window_hashes(w, starts, window, 3) if len(starts) else np.empty(0, U64)).astype(np.uint32))
            ids.append(np.full(len(starts), d, np.int64))
        (a, b), lo, _hi = _least((_bytes(k1, U64), _bytes(k2, np.uint32)), _bytes(ids, np.int64))
        return _pieces(block, a, n_buckets, [a, b, lo])

    def owned_elsewhere(table: pa.Table) -> pa.Table:
        of = table.column("block").to_pylist()
        a, b, lo = ([np.frombuffer(x.as_py(), t) for x in table.column(c)] for c, t in (("c0", U64), ("c1", np.uint32), ("c2", np.int64)))
        k1, k2, ids = _bytes(a, U64), _bytes(b, np.uint32), _bytes(lo, np.int64)
        order = np.lexsort((ids, k2, k1))
        new = np.ones(len(order), bool)
        new[1:] = (k1[order][1:] != k1[order][:-1]) | (k2[order][1:] != k2[order][:-1])
        least = np.empty(len(order), np.int64)
        least[order] = ids[order][np.flatnonzero(new)][np.cumsum(new) - 1] if len(order) else ids
        gone, at, out = least < ids, 0, []
        for blk, p, q in zip(of, a, b, strict=True):
            here = gone[at:at + len(p)]
            out.append((blk, p[here], q[here]))
            at += len(p)
        return _back(out)

    def removed(_, left: pa.Table, right: pa.Table) -> pa.Table:
        words = [word_hashes(text) for _, text in _docs(left)]
        every = [_window_hashes(w, None, window, 2) for w in words]
        starts = np.cumsum([0] + [len(x) for x in every])
        k = _bytes(every, U64)

        def document(at):
            return np.searchsorted(starts, at, side="right") - 1

        def second(at):  # the other hash word of the windows at these (ascending) positions
            cuts = np.searchsorted(at, starts)
            return _bytes([_window_hashes(w, at[lo:hi] - s, window, 3).astype(np.uint32)
                           for w, s, lo, hi in zip(words, starts[:-1], cuts[:-1], cuts[1:], strict=True) if hi > lo], np.uint32)

        drop = _pairs_found(k, second, _bytes([np.frombuffer(x.as_py(), U64) for x in right.column("h0")], U64),
                            _bytes([np.frombuffer(x.as_py(), np.uint32) for x in right.column("h1")], np.uint32))
        order = np.argsort(k)  # windows that occur several times in the block: its smallest id keeps them
        same = k[order][1:] == k[order][:-1]
        at = np.sort(order[np.r_[False, same] | np.r_[same, False]]) if len(k) else order
        k1, k2, ids = k[at], second(at), left.column("doc_id").to_numpy()[document(at)] if len(at) else at
        (_, _), lo, _hi = _least((k1, k2), ids)
        order = np.lexsort((k2, k1))
        new = np.ones(len(at), bool)
        new[1:] = (k1[order][1:] != k1[order][:-1]) | (k2[order][1:] != k2[order][:-1])
        drop[at[order]] |= lo[np.cumsum(new) - 1] < ids[order]

        rows = []
        for (d, text), w, s, e in zip(_docs(left), words, starts[:-1], starts[1:], strict=True):
            gone = geo.covered(len(w), np.flatnonzero(drop[s:e]))
            kept = [x for x, o in zip(text.split(), gone.tolist(), strict=True) if not o] if gone.any() else text.split()
            rows.append((d, len(w), int(gone.sum()), b" ".join(kept).decode()))
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 4
        return pa.table([pa.array(c, f.type) for c, f in zip(cols, result, strict=True)], schema=result)

    def untouched(batches):
        def rows():
            for (text,) in rows_of(batches, "text"):
                words = (text or "").encode().split()
                yield None, len(words), 0, b" ".join(words).decode()

        yield from emit(rows(), result, 256, size=lambda r: len(r[3]))

    by_block = blocks.groupBy("block")
    sent = by_block.applyInArrow(anchors, "bucket bigint, block bigint, c0 binary")
    back = sent.groupBy("bucket").applyInArrow(shared, "block bigint, h0 binary")
    wide = by_block.cogroup(back.groupBy("block")).applyInArrow(extended, "bucket bigint, block bigint, c0 binary, c1 binary, c2 binary")
    gone = wide.groupBy("bucket").applyInArrow(owned_elsewhere, "block bigint, h0 binary, h1 binary")
    columns = "doc_id bigint, n_words bigint, n_removed bigint, kept string"
    return by_block.cogroup(gone.groupBy("block")).applyInArrow(removed, columns).unionAll(
        docs.where("doc_id is null").mapInArrow(untouched, columns))
