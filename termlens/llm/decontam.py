"""Benchmark decontamination: latent semantic retrieval, then subsequence and answer checks.

Words are lower-cased, stripped of edge signs and hashed to ``2 ** feature_bits``
features.  Document frequencies are counted over all documents and items.
Benchmark items are cut into half-overlapping passages; their TF-IDF rows form the
matrix (frequencies as their square roots) whose randomised SVD (random projection, power steps with QR, all
products summed over distributed rows) gives the latent space.  It spans the
whole row space while there are fewer passages than ``rank``; beyond that it
keeps the ``rank`` leading directions, and cosines are scaled so that a
passage's cosine with itself stays 1.

A document is read in passages of that length, every ``step`` words.  A passage whose weight on features
of the benchmark is too small for any cosine of ``min_cosine`` is passed over
(Cauchy-Schwarz); the others are projected, and the items
with a cosine of at least ``LATENT_SLACK * min_cosine`` (against the passage's
full norm) are candidates.  Items shorter than a passage are looked for in the same
way in narrower windows, the narrowest of ``WIDTHS`` that holds the item; those of at
most ``SHORT`` words count as contained if a stretch of their own length and a quarter covers ``verbatim`` of
their words in order.  For the others a candidate region is compared with the item's words by longest
common subsequence.  The item counts as contained if the subsequence covers
``verbatim`` of its words, or ``paraphrase`` of them while ``answer`` of its
answer is there too: its rarest quarter of words, the part that a rewording
has to keep.

The benchmark is the stated query set, searched in blocks of ``block_items``:
a block's items, passages and latent vectors are sent to all tasks.  Texts are
cut into words and hashed once; the packed features are written and read by
the count and by the search of every block.  Defined results: null and
empty texts contain nothing; items without words match nothing; repeated rows
and items are judged each; several items in one document give a row each; a
null doc_id gives rows with a null id; empty tables give no rows; very long
texts are read whole, passage by passage; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import emit, rows_of, written

_EDGE = ".,;:!?\"'()[]{}<>|*_%&#$…«»¿¡-"
_KNOWN = 400_000
FEATURE_BITS = 18
WIDTHS = (1, 2, 3, 4, 6, 8, 12)  # windows for items that are shorter than a passage
SHORT = 8  # items of at most so many words have to be there word for word
SVD_TASKS = 64  # a block of the benchmark is small; so are the sums of so many tasks
GROUP_WORDS = 1 << 17  # words searched at a time
LATENT_SLACK = 0.75  # cosines in the latent space scatter around the true ones


class _Features(dict):
    """word -> feature, kept in a bounded table."""

    def __init__(self, bits: int):
        super().__init__()
        self.mask = (1 << bits) - 1

    def __missing__(self, raw: str) -> int:
        if len(self) >= _KNOWN:
            self.clear()
        w = raw.strip(_EDGE)
        f = self[raw] = (xxhash.xxh3_64_intdigest(w, 17) & self.mask) if w else -1
        return f


_tables: dict[int, _Features] = {}


def feature_table(bits: int) -> _Features:
    """The worker's table."""
    return _tables.setdefault(bits, _Features(bits))


def features(text: str | None, table: _Features) -> np.ndarray:
    f = np.fromiter(map(table.__getitem__, (text or "").lower().split()), np.int64)
    return f[f >= 0]


def passages(n: int, length: int, step: int) -> list[tuple[int, int]]:
    """Overlapping spans that cover n words; the last one ends at the end."""
    if n <= length:
        return [(0, n)] if n else []
    return [(s, s + length) for s in [*range(0, n - length, step), n - length]]


def feature_rows(docs: DataFrame, bits: int = FEATURE_BITS) -> DataFrame:
    """(doc_id, f): the features of every whole text in order, as packed 32-bit integers; written once and read by all passes."""
    schema = pa.schema([("doc_id", pa.int64()), ("f", pa.binary())])

    def run(batches):
        table = feature_table(bits)
        yield from emit(((d, features(t, table).astype("<i4").tobytes()) for d, t in rows_of(batches, "doc_id", "text")),
                        schema, 4096, size=lambda r: len(r[1]))

    return written(docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "doc_id bigint, f binary"), "features", "lz4")


def document_frequencies(rows: DataFrame, bits: int = FEATURE_BITS) -> tuple[np.ndarray, int]:
    """(documents that hold each feature, documents), over all ``feature_rows``.

    A task sends a row for each feature it met, so at most ``2 ** bits``; their sums are a plain aggregate."""
    size = 1 << bits

    def run(batches):
        df, n = np.zeros(size, np.int64), 0
        for (f,) in rows_of(batches, "f"):
            df[np.unique(np.frombuffer(f, "<i4"))] += 1
            n += 1
        if n:
            held = np.flatnonzero(df)
            for at in range(0, len(held), 1 << 14):
                k = held[at:at + (1 << 14)]
                yield pa.RecordBatch.from_pydict({"k": pa.array(k.astype(np.int32)), "n": pa.array(df[k])})
            yield pa.RecordBatch.from_pydict({"k": pa.array([-1], pa.int32()), "n": pa.array([n])})

    sums = rows.select("f").mapInArrow(run, "k int, n bigint").groupBy("k").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size + 1, np.int64)  # the last place, -1, is the number of documents
    out[sums.column("k").to_numpy()] = sums.column("n").to_numpy()
    return out[:-1], int(out[-1])


def randomised_svd(rows: DataFrame, n_columns: int, rank: int, steps: int = 2, seed: int = 3) -> np.ndarray:
    """Leading right singular vectors (n_columns x rank) of the sparse matrix ``rows(cols array<int>, vals array<double>)``.

    Each pass sums A^T (A Q) over the rows' tasks; only the (n_columns x rank) sums reach the driver."""
    sc = rows.sparkSession.sparkContext

    def normal_product(q: np.ndarray) -> np.ndarray:
        shared = sc.broadcast(q)

        def run(batches):
            total, any_row = np.zeros_like(shared.value), False
            for cols, vals in rows_of(batches, "cols", "vals"):
                y = np.array(vals) @ shared.value[cols]
                total[cols] += np.outer(vals, y)
                any_row = True
            if any_row:
                for k in range(0, len(total), 512):
                    yield pa.RecordBatch.from_pydict({"k": pa.array([k]), "x": pa.array([total[k:k + 512].tobytes()], pa.binary())})

        def add(t: pa.Table) -> pa.Table:
            return pa.table({"k": [t.column("k")[0].as_py()], "x": pa.array([sum(np.frombuffer(x.as_py()) for x in t.column("x")).tobytes()], pa.binary())})

        out = np.zeros_like(q)
        for r in rows.mapInArrow(run, "k bigint, x binary").groupBy("k").applyInArrow(add, "k bigint, x binary").collect():
            out[r.k:r.k + 512] = np.frombuffer(bytes(r.x)).reshape(-1, q.shape[1])
        return out

    q = np.linalg.qr(normal_product(np.random.default_rng(seed).normal(size=(n_columns, rank))))[0]
    for _ in range(steps):
        q = np.linalg.qr(normal_product(q))[0]
    # rotate to singular directions and drop those without weight
    small = normal_product(q)
    w, u = np.linalg.eigh(q.T @ small)
    keep = w > 1e-9 * max(w.max(), 1e-12)
    return (q @ u[:, keep])[:, ::-1]


@dataclass
class Part:
    """The items that are looked for in windows of one width."""

    width: int
    step: int
    held: np.ndarray  # by feature: whether one of these items holds it
    latent: np.ndarray  # unit-passage vectors in the latent space
    owner: np.ndarray  # item of each passage


@dataclass
class Index:
    """What a task needs to search texts for the benchmark."""

    idf: np.ndarray  # by feature
    column: np.ndarray  # by feature: its row in ``axes``, -1 if no item holds it
    axes: np.ndarray
    parts: list[Part]
    items: list[np.ndarray]
    rare: list[np.ndarray]
    ids: list
    length: int
    min_cosine: float
    verbatim: float
    paraphrase: float
    answer: float


def _tfidf(f: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    u, n = np.unique(f, return_counts=True)
    v = np.sqrt(n) * idf[u]
    return u, v / max(float(np.sqrt(v @ v)), 1e-12)


def build(spark: SparkSession, items: list[tuple[object, str | None]], df: np.ndarray, n: int, length: int = 16, step: int = 5, rank: int = 128,
          min_cosine: float = 0.6, verbatim: float = 0.8, paraphrase: float = 0.5, answer: float = 0.75) -> Index:
    """Index of one block of benchmark ``items`` (id, text), by the document frequencies of ``n`` documents."""
    bits = (len(df) - 1).bit_length()
    idf = np.log((n + 1) / (df + 1.0)) + 0.1
    table = feature_table(bits)
    words = [features(text, table) for _, text in items]
    used = np.unique(np.concatenate([np.empty(0, np.int64), *words]))
    column = np.full(1 << bits, -1, np.int64)
    column[used] = np.arange(len(used))
    cut = [(k, *_tfidf(w[s:e], idf)) for k, w in enumerate(words) for s, e in passages(len(w), length, length // 2)]
    if cut:
        rows = spark.createDataFrame([(column[u].tolist(), v.tolist()) for _, u, v in cut], "cols array<int>, vals array<double>")
        tasks = max(1, min(spark.sparkContext.defaultParallelism, len(cut) // 64, SVD_TASKS))
        axes = randomised_svd(rows.repartition(tasks), len(used), min(rank, len(cut), len(used)))
        latent = np.array([v @ axes[column[u]] for _, u, v in cut])
        latent /= np.maximum((latent * latent).sum(axis=1, keepdims=True), 1e-4)  # a passage's cosine with itself is 1 at any rank
    else:
        axes, latent = np.zeros((0, 1)), np.zeros((0, 1))
    owner = np.array([k for k, _, _ in cut], np.int64)
    widths = [w for w in WIDTHS if w < length] + [length]
    place = np.searchsorted(widths[:-1], [len(w) for w in words])  # the narrowest window that holds the whole item
    parts = []
    for k, width in enumerate(widths):
        mine = np.isin(owner, np.flatnonzero(place == k))
        if mine.any():
            held = np.zeros(len(df), bool)
            held[np.concatenate([words[i] for i in np.unique(owner[mine])])] = True
            parts.append(Part(width, step if width == length else max(1, width // 4), held, latent[mine].astype(np.float32), owner[mine]))
    rare = []
    for w in words:
        u = np.unique(w)
        rare.append(u[np.argsort(-idf[u], kind="stable")[:max(1, len(u) // 4)]])
    return Index(idf, column, axes.astype(np.float32), parts, words, rare, [i for i, _ in items], length, min_cosine, verbatim, paraphrase, answer)


def common_subsequence(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence (bit-parallel over a)."""
    at: dict[int, int] = {}
    for k, x in enumerate(a.tolist()):
        at[x] = at.get(x, 0) | 1 << k
    full = (1 << len(a)) - 1
    row = full
    for x in b.tolist():
        m = at.get(x)
        if m is not None:
            u = row & m
            row = ((row + u) | (row - u)) & full
    return len(a) - row.bit_count()


class Searcher:
    """Searches the features of many texts at once: ``f`` in a row, ``bounds`` where each text starts and the last one ends."""

    def __init__(self, ix: Index):
        self.ix = ix
        self.weight = ix.idf ** 2

    def near(self, f: np.ndarray, bounds: np.ndarray, part: Part) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(text, start, words, norm) of the passages with enough weight on the part's features."""
        n = np.diff(bounds)
        count = np.where(n > 0, -(-np.maximum(n - part.width, 0) // part.step) + 1, 0)
        doc = np.repeat(np.arange(len(n)), count)
        k = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
        width = np.minimum(part.width, n)[doc]
        start = bounds[doc] + np.minimum(k * part.step, n[doc] - width)  # the last one ends at the end
        weight = self.weight[f]
        inside = np.concatenate([[0], np.cumsum(np.where(part.held[f], weight, 0))])
        every = np.concatenate([[0], np.cumsum(weight)])
        norm2 = every[start + width] - every[start]
        # no cosine can be larger than this share allows; the slack covers the rounding of long sums
        at = np.flatnonzero(inside[start + width] - inside[start] >= self.ix.min_cosine ** 2 * norm2 * (1 - 1e-4))
        return doc[at], start[at], width[at], np.sqrt(norm2[at]).astype(np.float32)

    def candidates(self, f: np.ndarray, bounds: np.ndarray, part: Part):
        """(text, item, start) of the passages near an item's passage."""
        ix = self.ix
        doc, start, width, norm = self.near(f, bounds, part)
        span = np.arange(part.width)
        for lo in range(0, len(start), 1024):
            s, w = start[lo:lo + 1024], width[lo:lo + 1024]
            rows = np.where(span < w[:, None], f[np.minimum(s[:, None] + span, len(f) - 1)], -1)  # -1: beyond a short text
            rows.sort(axis=1)
            new = np.ones(rows.shape, bool)
            new[:, 1:] = rows[:, 1:] != rows[:, :-1]
            at = np.flatnonzero(new)
            tf = np.diff(np.append(at, rows.size))
            first = rows.ravel()[at]
            known = (first >= 0) & part.held[first]
            first, of = first[known], at[known] // part.width
            v = (np.sqrt(tf[known]) * ix.idf[first]).astype(np.float32) / norm[lo:lo + 1024][of]
            x = np.zeros((len(s), ix.axes.shape[1]), np.float32)
            if len(v):
                edge = np.flatnonzero(np.r_[True, np.diff(of) > 0])
                x[of[edge]] = np.add.reduceat(v[:, None] * ix.axes[ix.column[first]], edge, axis=0)
            hit, passage = np.nonzero(x @ part.latent.T >= LATENT_SLACK * ix.min_cosine)
            yield from zip(doc[lo:lo + 1024][hit].tolist(), part.owner[passage].tolist(), s[hit].tolist(), strict=True)

    def found(self, f: np.ndarray, bounds: np.ndarray) -> list[tuple[int, object, float]]:
        """(text, item id, share of the item's words in order) of every item that a text contains."""
        ix, out = self.ix, []
        for part in ix.parts:
            by: dict[tuple[int, int], set[int]] = {}
            for doc, item, s in self.candidates(f, bounds, part):
                by.setdefault((doc, item), set()).add(s - int(bounds[doc]))
            judge = self._short_share if part.width <= SHORT else self._share
            for (doc, item), at in by.items():
                w, text = ix.items[item], f[bounds[doc]:bounds[doc + 1]]
                best = max(judge(w, text[lo:hi], ix.rare[item]) for lo, hi in _regions(sorted(at), len(w) + part.width, part.width, len(text)))
                if best:
                    out.append((doc, ix.ids[item], best))
        return out

    def _share(self, w: np.ndarray, region: np.ndarray, rare: np.ndarray) -> float:
        """The item's share in the region, 0 if it is not contained."""
        ix = self.ix
        share = common_subsequence(w, region) / len(w)
        tight = share >= ix.paraphrase and self._tight(w, region)
        return share if tight and (share >= ix.verbatim or np.isin(rare, region).mean() >= ix.answer) else 0.0

    def _short_share(self, w: np.ndarray, region: np.ndarray, rare: np.ndarray) -> float:
        """The same for an item shorter than a passage: word for word, in a stretch of its own length and a quarter."""
        size = min(len(region), len(w) + len(w) // 4)
        best = max(common_subsequence(w, region[s:s + size]) for s in range(len(region) - size + 1)) / len(w)
        return best if best >= self.ix.verbatim else 0.0

    def _tight(self, w: np.ndarray, region: np.ndarray) -> bool:
        """Whether a stretch of at most twice the item's length holds the subsequence; else words are strewn by chance."""
        size = 2 * len(w)
        if len(region) <= size:
            return True
        return any(common_subsequence(w, region[s:s + size]) >= self.ix.paraphrase * len(w) for s in passages_at(len(region), size, max(1, len(w) // 2)))


def passages_at(n: int, length: int, step: int) -> list[int]:
    return [s for s, _ in passages(n, length, step)]


def _regions(at: list[int], margin: int, width: int, n: int):
    """Stretches of a text of n words that hold the candidate passages ``at`` and the item's length around them."""
    k = 0
    while k < len(at):
        lo = max(0, at[k] - margin)
        while k + 1 < len(at) and at[k + 1] - lo <= 4 * margin:
            k += 1
        yield lo, min(n, at[k] + width + margin)
        k += 1


def contained(rows: DataFrame, index: Index) -> DataFrame:
    """``feature_rows`` -> (doc_id, item_id, share), a row for every item of the index that a document contains."""
    shared = rows.sparkSession.sparkContext.broadcast(index)
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("share", pa.float64())])

    def groups(batches):
        ids, texts, held = [], [], 0
        for d, f in rows_of(batches, "doc_id", "f"):
            ids.append(d)
            texts.append(np.frombuffer(f, "<i4"))
            held += len(texts[-1])
            if held >= GROUP_WORDS:
                yield ids, texts
                ids, texts, held = [], [], 0
        if ids:
            yield ids, texts

    def run(batches):
        search = Searcher(shared.value)

        def found():
            for ids, texts in groups(batches):
                bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
                for doc, item, share in search.found(np.concatenate(texts), bounds):
                    yield ids[doc], item, share

        yield from emit(found(), schema)

    return rows.mapInArrow(run, "doc_id bigint, item_id bigint, share double")


def search(docs: DataFrame, benchmark: DataFrame, id_col: str = "item_id", block_items: int = 20_000, **settings) -> DataFrame:
    """``docs(doc_id, text)`` against ``benchmark(id_col, text)`` -> (doc_id, item_id, share).

    The benchmark passes through the driver in blocks of ``block_items``; ``settings`` are those of ``build``."""
    spark = docs.sparkSession
    rows = feature_rows(docs)
    df, n = document_frequencies(rows)
    items = ((r.id, r.text) for r in benchmark.select(F.col(id_col).cast("bigint").alias("id"), "text").orderBy("id", "text").toLocalIterator())
    block = list(islice(items, block_items))
    out = contained(rows, build(spark, block, df, n, **settings))
    while block := list(islice(items, block_items)) if len(block) == block_items else []:
        # each block's rows are written before the next block's index is made
        out = written(out, "items_found").unionAll(written(contained(rows, build(spark, block, df, n, **settings)), "items_found"))
    return out
