"""Ranked lexical search: Block-Max MaxScore over an index of shards.

``build`` writes an inverted index.  Each task cuts its documents into shards of
about ``shard_bytes`` of text; a shard has a posting list per term, in blocks of
128 documents (differences and term frequencies as variable-length bytes), and
for each block its last document, greatest term frequency and smallest document
length, so that block maxima can be worked out for any corpus statistics.
Nothing is shuffled to build it, and a hot term is one list per shard.

``search`` reads only the lists of the queries' terms.  Document frequencies are
summed over the shards, then every shard is searched for all queries: lists are
ordered by the bound of their whole list, and those whose bounds together stay
below the k-th best score so far are non-essential.  Documents come from the
essential lists only, window by window; a non-essential list is asked for a
document only if the score so far, the block's maximum and the bounds of the
lists below can still reach the k-th best, else the document is rejected and the
block is not decompressed.  The shards' best k are merged by a window per query.

Score (64-bit integers but for the logarithm): sum over a query's terms, repeats
included, of ``w * ((10^9 * tf) div (1000 * tf + 8 * m))`` with
``w = floor(1000 * ln((2N + 2) / (2 df + 1)))`` and ``m = 25 + (75 * n * N) div L``.

Defined results: null and empty texts hold no term, as documents they count
nowhere and as queries they find nothing; a text of any length is indexed whole,
1 MB at a time; every row is a document of its own, also if rows or ids repeat;
null ids are kept and rank after others of their score; identical query rows
count once, two texts under one item id are two queries, each with its ranks; an
empty table of documents or queries gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import rows_of, written

BLOCK = 128  # documents per block
SHARD_BYTES = 32 << 20
QUERY_BYTES = 4 << 20  # query texts per search job
_PIECE = 1 << 20
_WINDOWS = (256, 1024, 4096)  # documents per step: short ones first, to have a threshold early
_ID_LAST = np.iinfo(np.int64).max

# Lower-case A-Z; every other ASCII character but 0-9 and a-z separates terms.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))

INDEX = pa.schema([("shard", pa.int64()), ("term", pa.string()), ("n_docs", pa.int64()), ("n_terms", pa.int64()), ("head", pa.binary()),
                   ("body", pa.binary()), ("ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64()))])
INDEX_DDL = "shard long, term string, n_docs long, n_terms long, head binary, body binary, ids array<long>, lengths array<long>"


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text, in order."""
    return (text or "").encode().translate(_FOLD).split()


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Variable-length bytes (seven bits each, the last one below 128) of non-negative numbers, and where each number starts."""
    size = np.ones(len(values), dtype=np.int64)
    for bits in (7, 14, 21, 28):
        size += values >= (1 << bits)
    at = np.cumsum(size) - size
    out = np.empty(int(size.sum()), dtype=np.uint8)
    for k in range(5):
        has = np.flatnonzero(size > k)
        if not len(has):
            break
        out[at[has] + k] = ((values[has] >> (7 * k)) & 0x7F) | np.where(size[has] > k + 1, 0x80, 0)
    return out, at


def unpack(raw: np.ndarray) -> np.ndarray:
    """The numbers behind ``pack``'s bytes."""
    end = np.flatnonzero(raw < 128)
    if len(end) == len(raw):
        return raw.astype(np.int64)
    at = np.append(0, end[:-1] + 1)
    size = end - at + 1
    out = (raw[at] & 0x7F).astype(np.int64)
    for k in range(1, int(size.max())):
        has = np.flatnonzero(size > k)
        out[has] |= (raw[at[has] + k] & 0x7F).astype(np.int64) << (7 * k)
    return out


class _Shard:
    """Documents on their way into one shard of the index."""

    def __init__(self):
        self.number: defaultdict[bytes, int] = defaultdict()
        self.number.default_factory = self.number.__len__
        self.ids: list[int | None] = []
        self.lengths: list[int] = []
        self.words: list[np.ndarray] = []
        self.held = 0

    def add(self, doc_id: int | None, text: str | None) -> None:
        data = (text or "").encode().translate(_FOLD)
        at = n = 0
        while at < len(data):
            cut = len(data) if len(data) - at <= _PIECE else data.find(b" ", at + _PIECE)
            piece = data[at:cut if cut >= 0 else len(data)].split()
            self.words.append(np.fromiter(map(self.number.__getitem__, piece), dtype=np.int32, count=len(piece)))
            n += len(piece)
            at = cut if cut >= 0 else len(data)
        self.ids.append(doc_id)
        self.lengths.append(n)
        self.held += len(data) + 32

    def rows(self, shard: int):
        """The shard's documents as one row, its posting lists as further rows in the order of their terms."""
        lengths = np.array(self.lengths, dtype=np.int64)
        none = [None]
        yield pa.RecordBatch.from_arrays(
            [pa.array([shard]), pa.array(none, pa.string()), pa.array([int((lengths > 0).sum())], pa.int64()), pa.array([int(lengths.sum())], pa.int64()),
             pa.array(none, pa.binary()), pa.array(none, pa.binary()), pa.array([self.ids], pa.list_(pa.int64())),
             pa.array([self.lengths], pa.list_(pa.int64()))], schema=INDEX)
        if not self.number:
            return
        order = sorted(self.number)
        place = np.empty(len(order), dtype=np.int64)
        place[[self.number[t] for t in order]] = np.arange(len(order))
        doc = np.repeat(np.arange(len(lengths)), lengths)
        key, tf = np.unique((place[np.concatenate(self.words)] << 32) | doc, return_counts=True)
        self.words.clear()
        term, doc = key >> 32, key & 0xFFFFFFFF
        first = np.searchsorted(term, np.arange(len(order)))  # every term has a posting
        n_docs = np.diff(np.append(first, len(term)))
        within = np.arange(len(term)) - np.repeat(first, n_docs)
        gap = doc.copy()
        gap[1:] -= np.where(within[1:] == 0, 0, doc[:-1])
        body, at = pack(np.column_stack([gap, tf]).reshape(-1))
        at = np.append(at[::2], len(body))
        block = np.flatnonzero(within % BLOCK == 0)
        last = np.append(block[1:], len(term)) - 1
        n_blocks = -(-n_docs // BLOCK)
        head = np.column_stack([doc[last], np.maximum.reduceat(tf, block), np.minimum.reduceat(lengths[doc], block),
                                at[block] - np.repeat(at[first], n_blocks)]).astype("<i8")
        head_at = np.append(0, np.cumsum(n_blocks)) * head.itemsize * 4
        body_at = np.append(at[first], len(body))
        for a in range(0, len(order), 1 << 15):
            b = min(len(order), a + (1 << 15))

            def binary(data: np.ndarray, ends: np.ndarray, a=a, b=b):
                part = np.ascontiguousarray(data).view(np.uint8).reshape(-1)[ends[a]:ends[b]]
                return pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer((ends[a:b + 1] - ends[a]).astype("<i4").tobytes()), pa.py_buffer(part.tobytes())])

            n = b - a
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, shard)), pa.array([t.decode() for t in order[a:b]], pa.string()), pa.array(n_docs[a:b]), pa.nulls(n, pa.int64()),
                 binary(head, head_at), binary(body, body_at), pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.list_(pa.int64()))], schema=INDEX)


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The index of ``docs``, written: a row of documents and a row per term for every shard."""

    def run(batches):
        part, k, shard = TaskContext.get().partitionId(), 0, _Shard()
        for doc_id, text in rows_of(batches, id_col, text_col):
            shard.add(doc_id, text)
            if shard.held >= shard_bytes:
                yield from shard.rows((part << 32) | k)
                k, shard = k + 1, _Shard()
        if shard.ids:
            yield from shard.rows((part << 32) | k)

    return written(docs.select(F.col(id_col).cast("bigint").alias(id_col), text_col).mapInArrow(run, INDEX_DDL), "lexical")


class Postings:
    """One term's list in a shard; blocks are decompressed when first asked for."""

    def __init__(self, n: int, head: bytes, body: bytes, mass: np.ndarray, mass_of):
        self.n, self.mass = n, mass
        self.last, max_tf, min_length, at = np.frombuffer(head, dtype="<i8").reshape(-1, 4).T
        self.body = np.frombuffer(body, dtype=np.uint8)
        self.at = np.append(at, len(body))
        self.block_bound = impact(max_tf, mass_of(min_length))
        self.bound = int(self.block_bound.max())
        self.docs = np.empty(n, dtype=np.int64)
        self.impacts = np.empty(n, dtype=np.int64)
        self.have = np.zeros(len(self.last), dtype=bool)

    def open(self, blocks: np.ndarray) -> None:
        """Decompress those of ``blocks`` (ascending) that are not yet."""
        new = blocks[~self.have[blocks]]
        if not len(new):
            return
        self.have[new] = True
        for run in np.split(new, np.flatnonzero(np.diff(new) > 1) + 1):
            a, b = int(run[0]), int(run[-1]) + 1
            values = unpack(self.body[self.at[a]:self.at[b]])
            docs = np.cumsum(values[::2]) + (int(self.last[a - 1]) if a else 0)
            here = slice(a * BLOCK, min(b * BLOCK, self.n))
            self.docs[here] = docs
            self.impacts[here] = impact(values[1::2], self.mass[docs])

    def between(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents from ``low`` on and before ``high``, and their impacts."""
        a, b = np.searchsorted(self.last, [low, high - 1])
        b = min(int(b) + 1, len(self.last))
        if a >= b:
            return self.docs[:0], self.impacts[:0]
        self.open(np.arange(a, b))
        docs = self.docs[a * BLOCK:b * BLOCK]
        i, j = np.searchsorted(docs, [low, high])
        return docs[i:j], self.impacts[a * BLOCK:b * BLOCK][i:j]

    def at_docs(self, docs: np.ndarray, block: np.ndarray) -> np.ndarray:
        """Impacts at ``docs`` (0 where the list does not have one), which lie in ``block`` each or past the list's end."""
        out = np.zeros(len(docs), dtype=np.int64)
        inside = np.flatnonzero(block < len(self.last))
        if len(inside):
            blocks = np.unique(block[inside])
            self.open(blocks)
            index = (blocks[:, None] * BLOCK + np.arange(BLOCK)).reshape(-1)
            index = index[index < self.n]
            held = self.docs[index]
            at = np.searchsorted(held, docs[inside])  # inside a block the last document is not less
            same = held[at] == docs[inside]
            out[inside[same]] = self.impacts[index[at[same]]]
        return out


def impact(tf: np.ndarray, mass: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * mass)


class Best:
    """The k best (score, id) so far: greatest scores, then smallest ids."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids, self.bar = k, np.empty(0, np.int64), np.empty(0, np.int64), 1

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.append(self.scores, scores), np.append(self.ids, ids)
        keep = np.lexsort((ids, -scores))[:self.k]
        self.scores, self.ids = scores[keep], ids[keep]
        if len(keep) == self.k:
            self.bar = max(1, int(self.scores[-1]))  # lower scores cannot enter; equal ones can, by their id


def best_of(lists: list[tuple[int, Postings]], ids: np.ndarray, k: int) -> Best:
    """The k best documents of a shard for one query, whose terms weigh and list as given."""
    best = Best(k)
    lists = sorted(((w, p) for w, p in lists if w > 0), key=lambda x: x[0] * x[1].bound)
    upto = np.cumsum([w * p.bound for w, p in lists]).tolist()
    cut = low = step = 0  # lists before ``cut`` are non-essential
    while low < len(ids) and cut < len(lists):
        high = min(len(ids), low + _WINDOWS[min(step, len(_WINDOWS) - 1)])
        step += 1
        sums = np.zeros(high - low, dtype=np.int64)
        for w, p in lists[cut:]:
            docs, impacts = p.between(low, high)
            sums[docs - low] += w * impacts
        docs = np.flatnonzero(sums)
        scores = sums[docs]
        docs += low
        for j in range(cut - 1, -1, -1):
            w, p = lists[j]
            block = np.searchsorted(p.last, docs)
            most = np.where(block < len(p.last), w * p.block_bound[np.minimum(block, len(p.last) - 1)], 0)
            able = scores + most + (upto[j - 1] if j else 0) >= best.bar
            docs, scores, block = docs[able], scores[able], block[able]
            if not len(docs):
                break
            scores = scores + w * p.at_docs(docs, block)
        able = scores >= best.bar
        if able.any():
            best.add(scores[able], ids[docs[able]])
            while cut < len(lists) and upto[cut] < best.bar:
                cut += 1
        low = high
    return best


def search(index: DataFrame, queries: DataFrame, k: int = 10, item_col: str = "item_id", text_col: str = "text", query_bytes: int = QUERY_BYTES) -> DataFrame:
    """(item id, rank, doc_id, score): the ``k`` best documents of each query with a score above 0.

    Queries are taken in slices of about ``query_bytes`` of text, each one search of the index, so neither the driver
    nor a task holds more of them at once.
    """
    spark = index.sparkSession
    items = queries.select(F.col(item_col).alias("item"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).distinct()
    kind = items.schema["item"].dataType.simpleString()
    n, length = index.where("term is null").agg(F.sum("n_docs"), F.sum("n_terms")).first()
    size = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    schema = f"query long, item {kind}, doc_id long, score long"
    if not n or not size:
        found = [spark.createDataFrame([], schema)]
    else:
        n_slices = -(-size // query_bytes)
        slices = [items] if n_slices == 1 else [items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n_slices)) == s) for s in range(n_slices)]
        found = [f for s, part in enumerate(slices) if (f := _search(index, part, n, length, k, s, schema)) is not None] or [spark.createDataFrame([], schema)]
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(F.col("item").alias(item_col), "rank", "doc_id", "score")


def _search(index: DataFrame, items: DataFrame, n: int, length: int, k: int, number: int, schema: str) -> DataFrame | None:
    """The best ``k`` documents per query and shard for one slice of queries."""
    spark = index.sparkSession
    asked = [(q, r.item, Counter(t.decode() for t in terms_of(r.text))) for q, r in enumerate(items.collect())]
    terms = sorted(set().union(*(c for _, _, c in asked)))
    if not terms:
        return None
    wanted = F.broadcast(spark.createDataFrame([(t,) for t in terms], "term string"))  # at most one slice's bytes
    lists = index.where("term is not null").join(wanted, "term", "left_semi")
    weight = {r.term: math.floor(1000 * math.log((2 * n + 2) / (2 * r.df + 1))) for r in lists.groupBy("term").agg(F.sum("n_docs").alias("df")).collect()}
    plan = [(q | (number << 32), item, [(t, c * weight[t]) for t, c in counts.items() if weight.get(t, 0) > 0]) for q, item, counts in asked]
    out = pa.schema([("query", pa.int64()), ("item", _arrow(items)), ("doc_id", pa.int64()), ("score", pa.int64())])

    def mass_of(lengths: np.ndarray) -> np.ndarray:
        if 75 * n * int(lengths.max(initial=0)) < 1 << 63:
            return 25 + (75 * n * lengths) // length
        return np.array([25 + 75 * n * x // length for x in lengths.tolist()], dtype=np.int64)

    def run(lists: pa.Table, docs: pa.Table) -> pa.Table:
        ids = docs.column("ids").combine_chunks().flatten().fill_null(_ID_LAST).to_numpy(zero_copy_only=False)
        mass = mass_of(docs.column("lengths").combine_chunks().flatten().to_numpy(zero_copy_only=False))
        held = {}
        for batch in lists.to_batches():
            for term, size, head, body in rows_of([batch], "term", "n_docs", "head", "body"):
                held[term] = Postings(size, head, body, mass, mass_of)
        rows = []
        for query, item, weighted in plan:
            best = best_of([(w, held[t]) for t, w in weighted if t in held], ids, k)
            rows += [(query, item, None if i == _ID_LAST else i, s) for s, i in zip(best.scores.tolist(), best.ids.tolist(), strict=True)]
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 4
        return pa.Table.from_arrays([pa.array(c, type=f.type) for c, f in zip(cols, out, strict=True)], schema=out)

    lists = lists.select(F.col("shard").alias("part"), "term", "n_docs", "head", "body")
    shards = index.where("term is null").select(F.col("shard").alias("place"), "ids", "lengths")
    return lists.groupBy("part").cogroup(shards.groupBy("place")).applyInArrow(run, schema)


def _arrow(items: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(items.schema["item"].dataType)
