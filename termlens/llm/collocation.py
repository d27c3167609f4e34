"""Phrase collocation mining by top-order marginalisation.

Every word occurrence opens one window: itself and the next four words of its
piece as lead columns, padded at the piece's end.  Only these longest windows
are counted; Spark's ROLLUP then sums them over successively shorter prefixes,
and the count of a phrase of k words is the sum over the windows that begin
with it.  No n-gram length is exploded on its own.

Windows leave a task counted.  A word travels as a 64-bit hash, whose being
different for all words of a language is proven first (else another salt is
taken), or, if it is one of at most 2^19 most frequent words, as its place in a
table of those; three such places fit one number.  Windows are dealt out by their
first two words.  There, sums over the first two, three and four words cut each
window behind its last frequent prefix, and only what is left is rolled up: a
phrase below ``min_count`` is in no candidate and in no part of one.  Windows that
begin with two words of more than 1/1024 of all words each are dealt out by
further words, so a hot pair is not one task's work; their pair sum is then only
known after the roll-up.

Scores are exact: products are decimals of 38 digits.

Defined results: null and empty texts have no words; a null language counts as
``und``; texts are read whole, about 1 MB at a time; repeated rows count each; an
empty table, or one without frequent phrases, gives no rows; ties are ordered by
count and phrase, a phrase comes once per language; further columns, whatever
their names, are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import rows_of, written

ORDER = 5  # words of the longest phrase
TABLE_BITS = 19  # the most frequent words get short numbers: fewer than 2^19 at every size of the vocabulary
HOT_SHARE = 1024  # a word is hot from 1/1024 of all words on, so there are at most so many
RANK_BUCKETS = 64
CHUNK_WORDS = 3 << 20  # words that a task holds before it counts their windows
_PIECE = 1 << 20
_ID_BITS = 21
_END = b"\xff"  # no byte of UTF-8: the end of a piece
_STOP = re.compile("[.,;:!?\x0a-\x0d]")
_FOLD = bytes(0xFF if b in b".,;:!?\x0a\x0b\x0c\x0d" else b + 32 if 65 <= b <= 90 else b for b in range(256))
W = [f"w{k}" for k in range(1, ORDER + 1)]


class _Words:
    """Word occurrences of one language on their way through a task, as numbers; 0 ends a piece."""

    def __init__(self):
        self.number: defaultdict[bytes, int] = defaultdict()
        self.number.default_factory = self.number.__len__
        assert self.number[_END] == 0
        self.parts: list[np.ndarray] = [np.zeros(1, dtype=np.int32)]

    def add(self, text: str) -> int:
        """Take a text's words in; returns how many numbers it took."""
        data = text.encode().translate(_FOLD)
        at = n = 0
        while at < len(data):
            cut = len(data) if len(data) - at <= _PIECE else data.find(b" ", at + _PIECE)
            piece = data[at:cut if cut >= 0 else len(data)].replace(_END, b" \xff ").split()
            self.parts.append(np.fromiter(map(self.number.__getitem__, piece), dtype=np.int32, count=len(piece)))
            n += len(piece)
            at = cut if cut >= 0 else len(data)
        self.parts.append(np.zeros(1, dtype=np.int32))
        return n + 1


def _segments(text: str):
    """A long text in pieces of about a million characters, each ending where a piece of the text ends."""
    at = 0
    while len(text) - at > _PIECE:
        end = _STOP.search(text, at + _PIECE)
        if not end:
            break
        yield text[at:end.end()]
        at = end.end()
    yield text[at:]


def _chunks(batches, lang_col: str, text_col: str):
    """Per language, the words of as many texts as a task may hold at once."""
    held: defaultdict[str, _Words] = defaultdict(_Words)
    size = 0
    for lang, text in rows_of(batches, lang_col, text_col):
        words = held["und" if lang is None else lang]
        for part in _segments(text or ""):
            size += words.add(part)
            if size >= CHUNK_WORDS:
                yield from held.items()
                held.clear()
                size, words = 0, held["und" if lang is None else lang]
    yield from held.items()


def word_counts(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, word, n): the occurrences of every word, written."""

    def run(batches):
        for lang, words in _chunks(batches, lang_col, text_col):
            n = np.bincount(np.concatenate(words.parts), minlength=len(words.number))[1:]
            names = [w.decode() for w in list(words.number)[1:]]
            for a in range(0, len(names), 1 << 16):
                part = names[a:a + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part), pa.string()), pa.array(part, pa.string()), pa.array(n[a:a + len(part)], pa.int64())],
                                                 names=["lang", "word", "n"])

    t = docs.select(lang_col, text_col).mapInArrow(run, "lang string, word string, n long")
    return written(t.groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")


def _hash(word: Column, salt: str) -> Column:
    return F.xxhash64(F.concat(F.lit(salt), word))


def _salt(words: DataFrame) -> str:
    """A salt under which no two words of a language share a hash, and none is a short number."""
    for k in range(100):
        salt = f"{k}:"
        same = words.select("lang", _hash(F.col("word"), salt).alias("h")).groupBy("lang", "h").agg(F.count(F.lit(1)).alias("n"))
        if not same.where((F.col("n") > 1) | F.col("h").between(0, 1 << TABLE_BITS)).limit(1).count():
            return salt
    raise ValueError("no salt separates the words")


def _table(words: DataFrame, salt: str) -> np.ndarray:
    """The hashes, ascending, of the most frequent words: those above a count that fewer than 2^TABLE_BITS words reach."""
    step = F.floor(F.log2("n") * 8).cast("int")
    sizes = words.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("step")).collect()  # a few hundred
    held, least = 0, None
    for r in sizes:
        held += r.words
        if held >= 1 << TABLE_BITS:
            break
        least = r.step
    if least is None:
        return np.empty(0, dtype=np.int64)
    return np.unique(words.where(step >= least).select(_hash(F.col("word"), salt).alias("h")).toArrow().column("h").to_numpy())


def _distinct(cols: list[np.ndarray], n_names: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of the distinct rows of ``cols``, in order, and how often each occurs."""
    keys = cols
    if n_names <= 1 << _ID_BITS:  # two numbers a row instead of five
        a, b, c, d, e = (x.astype(np.int64) for x in cols)
        keys = [a << (2 * _ID_BITS) | b << _ID_BITS | c, d << _ID_BITS | e]
    order = np.lexsort(keys[::-1])
    new = np.ones(len(order), dtype=bool)
    new[1:] = False
    for key in keys:
        key = key[order]
        new[1:] |= key[1:] != key[:-1]
    first = np.flatnonzero(new)
    return order[first], np.diff(np.append(first, len(order)))


def _short(h: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The hashes, those in ``table`` replaced by their places in it, from 1."""
    if not len(table):
        return h
    at = np.minimum(np.searchsorted(table, h), len(table) - 1)
    return np.where(table[at] == h, at + 1, h)


def _numbered(words: DataFrame, salt: str, table: np.ndarray) -> DataFrame:
    """(lang, word, h, f) with the numbers by which words travel."""
    sent = words.sparkSession.sparkContext.broadcast(table)

    def run(batches):
        for b in batches:
            yield b.set_column(2, "h", pa.array(_short(b.column("h").to_numpy(), sent.value)))

    return words.select("lang", "word", _hash(F.col("word"), salt).alias("h"), F.col("n").alias("f")).mapInArrow(run, "lang string, word string, h long, f long")


def windows(docs: DataFrame, salt: str, table: np.ndarray, hot: list[int], lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, w1, w2, w3, w4, w5, deal, n): counted windows, padded with 0; short tails are packed into w3, w4 and w5 being null.

    ``deal`` is 0 where the first two words are not both hot.  Else its last two bits say that the first three (1),
    four (2) or five (3) words determine it, the last of them being the first word that is not hot.
    """
    sent = docs.sparkSession.sparkContext.broadcast((table, np.array(sorted(hot), dtype=np.int64)))

    def run(batches):
        import xxhash

        short, hot_words = sent.value
        mark = salt.encode()
        for lang, words in _chunks(batches, lang_col, text_col):
            name = np.array([0, *(xxhash.xxh64_intdigest(mark + w, 42) for w in list(words.number)[1:])], dtype=np.uint64).view(np.int64)
            name = _short(name, short)
            seq = np.append(np.concatenate(words.parts), np.zeros(ORDER, dtype=np.int32))
            at = np.flatnonzero(seq)
            cols = [seq[at]]
            for k in range(1, ORDER):
                cols.append(np.where(cols[-1] > 0, seq[at + k], 0))
            rows, n = _distinct(cols, len(name))
            is_hot = np.isin(name, hot_words) & (name != 0)
            for a in range(0, len(n), 1 << 16):
                local = [c[rows[a:a + (1 << 16)]] for c in cols]
                w = [name[x] for x in local]
                deal = np.zeros(len(w[0]), dtype=np.int64)
                warm = is_hot[local[0]]
                for k in range(1, ORDER - 1):
                    warm = warm & is_hot[local[k]]
                    deal = np.where(warm, (((deal >> 2) * 1_000_003 + w[k + 1]) << 2) | k, deal)
                small = np.logical_and.reduce([(x >= 0) & (x <= 1 << TABLE_BITS) for x in w[2:]])
                packed = np.where(small, w[2] | w[3] << _ID_BITS | w[4] << (2 * _ID_BITS), w[2])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(deal), pa.string()), pa.array(w[0]), pa.array(w[1]), pa.array(packed), pa.array(w[3], mask=small),
                     pa.array(w[4], mask=small), pa.array(deal), pa.array(n[a:a + len(deal)])], names=["lang", *W, "deal", "n"])

    return docs.select(lang_col, text_col).mapInArrow(run, f"lang string, {', '.join(f'{w} long' for w in W)}, deal long, n long")


def _unpacked(counted: DataFrame) -> DataFrame:
    mask, packed = F.lit((1 << _ID_BITS) - 1), F.col("w4").isNull()

    def word(k: int) -> Column:
        return F.when(packed, F.shiftright("w3", (k - 3) * _ID_BITS).bitwiseAND(mask)).otherwise(F.col(f"w{k}")).alias(f"w{k}")

    return counted.select("lang", "w1", "w2", word(3), word(4), word(5), "deal", "n")


def prefixes(counted: DataFrame, min_count: int) -> DataFrame:
    """(lang, p, f): phrases of two to five words (``p``: their words' numbers) with at least ``min_count`` occurrences."""
    key = ["lang", "w1", "w2", "deal"]

    def over(*more: str) -> Column:
        return F.sum("n").over(Window.partitionBy(*key, *more))

    # one exchange and one sort serve all three sums; a sum over fewer words than ``deal`` depends on is not whole and
    # cuts nothing, the roll-up has the whole one
    t = _unpacked(counted.repartition(*key)).sortWithinPartitions(*key, "w3", "w4")
    depth = F.col("deal").bitwiseAND(F.lit(3))
    go2 = (F.col("s2") >= min_count) | (depth > 0)
    go3 = (F.col("s3") >= min_count) | (depth > 1)
    go4 = go3 & ((F.col("s4") >= min_count) | (depth > 2))
    t = t.withColumn("s2", over()).where((F.col("w2") != 0) & go2).withColumn("s3", over("w3")).withColumn("s4", over("w3", "w4"))
    cut = t.select("lang", "w1", "w2", F.when(go3, F.col("w3")).otherwise(0).alias("w3"), F.when(go4, F.col("w4")).otherwise(0).alias("w4"),
                   F.when(go4, F.col("w5")).otherwise(0).alias("w5"), "n")
    longest = cut.groupBy("lang", *W).agg(F.sum("n").alias("n"))
    summed = longest.rollup("lang", *W).agg(F.sum("n").alias("f"), F.grouping_id().alias("g"))
    size = F.when(F.col("g") == 0, 5).when(F.col("g") == 1, 4).when(F.col("g") == 3, 3).when(F.col("g") == 7, 2)
    found = summed.where(F.col("f") >= min_count).withColumn("m", size).where("m IS NOT NULL")
    found = found.withColumn("p", F.slice(F.array(*W), F.lit(1), F.col("m"))).where(F.element_at("p", -1) != 0)
    return found.select("lang", "p", "f")


def collocations(docs: DataFrame, min_count: int = 100, top: int = 2000, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases that are not just parts of longer ones."""
    words = word_counts(docs, lang_col, text_col)
    salt = _salt(words)
    total = words.groupBy("lang").agg(F.sum("n").alias("n"))
    table = _table(words, salt)
    frequent = written(_numbered(words.where(F.col("n") >= min_count), salt, table), "frequent")
    share = words.agg(F.sum("n")).first()[0] or 0
    hot = [r.h for r in frequent.where(F.col("f") * HOT_SHARE >= share).select("h").collect()]  # at most HOT_SHARE rows
    found = written(prefixes(windows(docs, salt, table, hot, lang_col, text_col), min_count), "phrases")

    counts = found.unionByName(frequent.select("lang", F.array("h").alias("p"), "f"))
    cuts = found.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("p") - 1)))
    cuts = cuts.select("lang", "p", F.col("f").alias("a"), "k", F.slice("p", F.lit(1), F.col("k")).alias("left"),
                       F.slice("p", F.col("k") + 1, F.size("p") - F.col("k")).alias("right"))
    cuts = cuts.join(counts.select("lang", F.col("p").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    cuts = cuts.join(counts.select("lang", F.col("p").alias("right"), F.col("f").alias("r")), ["lang", "right"]).join(total, "lang")
    score = F.expr("(1000 * CAST(a AS DECIMAL(19, 0)) * CAST(n AS DECIMAL(15, 0))) DIV (CAST(l AS DECIMAL(19, 0)) * CAST(r AS DECIMAL(19, 0)))")
    scored = cuts.withColumn("score", score).groupBy("lang", "p", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("c"))

    parts = found.where(F.size("p") > 2).select("lang", "f", F.explode(F.flatten(F.transform(
        F.sequence(F.lit(2), F.size("p") - 1),
        lambda m: F.transform(F.sequence(F.lit(1), F.size("p") - m + 1), lambda i: F.slice("p", i, m))))).alias("p"))
    covered = parts.groupBy("lang", "p").agg(F.max("f").alias("longer"))
    kept = scored.join(covered, ["lang", "p"], "left").where(F.coalesce(100 * F.col("longer") < 100 * F.col("a"), F.lit(True)))

    # the words behind the numbers, then the ranking: within buckets first, so no task ranks all of a language
    spelled = kept.select("lang", "p", F.posexplode("p").alias("at", "h")).join(frequent.select("lang", "h", "word"), ["lang", "h"])
    spelled = spelled.groupBy("lang", "p").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda s: s["word"]), " ").alias("phrase"))
    rows = kept.join(spelled, ["lang", "p"]).select("lang", "phrase", "a", F.col("c.l").alias("l"), F.col("c.r").alias("r"), "n", F.col("c.score").alias("score"))
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    bucket = F.pmod(F.xxhash64("phrase"), F.lit(RANK_BUCKETS))
    rows = rows.withColumn("bucket", bucket).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "bucket").orderBy(*best))).where(F.col("rank") <= top)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("bigint")).where(F.col("rank") <= top)
    return rows.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
