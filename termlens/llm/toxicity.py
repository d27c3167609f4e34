"""Toxicity: noisy-channel deobfuscation, then a linear score of the restored text.

Deobfuscation.  A writer's word may have been disguised: letters replaced by
look-alikes ("1d10t"), spaced or dotted ("i d i o t", "i.d.i.o.t") or
repeated ("idiooot").  A token that shows such signs becomes a lattice: each
character slot offers the letters it may stand for, or nothing where it may be
filler, at the cost of the channel; a run of three or more equal letters
offers one or two.  Runs of single-letter tokens are joined into one token
first.  A Viterbi search finds the path that is likeliest under a character
trigram model times the channel.  A token without such signs has one path only
and stays as it is.

Score.  The restored text's words, and their first four to six letters, are
presence features.  The most telling ones (by chi-square over all labelled
rows) get weights by L2-regularised logistic regression over all labelled
rows.  The character model is counted on the words of the same rows.

Only the text enters a score.  Defined results: null and empty texts get the
score of no feature; repeated rows the same score; without labelled rows of
both classes every score is the share of toxic ones (0.5 without any); null
labels and null ids do not take part in learning; an empty table gives an
empty table; very long texts are scored whole; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termlens.operators.joins import small_side

from .common import emit, rows_of, written

# What a sign or digit may stand for besides itself (fixed values).
LOOKALIKES = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
              "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l"}
_FILLER = "*._-~^'`#%&,;:"
_EDGE = ".,;:!?\"'()[]{}<>|%&#*$…«»¿¡-_"
_SIGNS = re.compile(r"(\w)\1\1|[^\W\d_][0-9@$!|+(<€£*._~^#%&-]+[^\W\d_]|[0-9@$!|+(<€£][^\W\d_]|[^\W\d_][0-9@$|+€£]")
_THRICE = re.compile(r"(\w)\1\1")
_MUST_LETTERS = re.compile(r"[^\W\d_]")
_SINGLES = re.compile(r"(?<!\S)[^\W_](?: [^\W_]){3,}(?!\S)")
_KEPT = 300_000  # restored tokens kept per Python worker
LOOKALIKE_COST, DROP_COST, FILLER_COST, KEEP_COST, REPEAT_COST = math.log(0.1), math.log(1e-4), math.log(0.3), math.log(1e-3), math.log(0.3)
_START, _END = "\x02", "\x03"


@dataclass
class CharModel:
    """Character trigrams with add-a-little smoothing backed off to bigrams and single characters."""

    tri: dict[str, float]
    bi: dict[str, float]
    uni: dict[str, float]

    def logp(self, context: str, char: str) -> float:
        p = self.tri.get(context + char)
        if p is None:
            p = self.bi.get(context[1] + char)
            if p is None:
                p = self.uni.get(char, -14.0) - 2
        return p


def lattice(token: str) -> list[list[tuple[str, float]]]:
    """The slots of a disguised token: (letters it may stand for, cost of the channel)."""
    slots, k = [], 0
    while k < len(token):
        c, run = token[k], 1
        while k + run < len(token) and token[k + run] == c:
            run += 1
        if c.isalpha():
            if run >= 3:
                slots.append([(c, REPEAT_COST), (c * 2, REPEAT_COST)])
            else:
                slots += [[(c, 0.0)]] * run
        else:
            like = [(x, LOOKALIKE_COST) for x in LOOKALIKES.get(c, "")]
            edge = not c.isdigit() and (k == 0 and run > 1 or k + run == len(token))
            drop = [("", FILLER_COST if c in _FILLER or edge else 2 * DROP_COST if c.isdigit() else DROP_COST)]
            keep = [(c, KEEP_COST)] if c.isdigit() and run < 3 else []
            slots.append(like + drop + keep or [(c, 0.0)])
            if like and run == 2:
                slots.append(like + drop)
        k += run
    return slots


def viterbi(token: str, model: CharModel) -> str:
    """The likeliest reading of a token's lattice."""
    paths = {_START * 2: (0.0, "")}
    for slot in lattice(token):
        after: dict[str, tuple[float, str]] = {}
        for ctx, (score, read) in paths.items():
            for letters, cost in slot:
                s, c = score + cost, ctx
                for x in letters:
                    s += model.logp(c, x)
                    c = c[1] + x
                if c not in after or s > after[c][0]:
                    after[c] = (s, read + letters)
        paths = after
    return max((s + model.logp(c, _END), r) for c, (s, r) in paths.items())[1]


class Kept(dict):
    """Values of a function, at most ``_KEPT`` of them."""

    def __init__(self, of):
        super().__init__()
        self.of = of

    def __missing__(self, key):
        if len(self) >= _KEPT:
            self.clear()
        value = self[key] = self.of(key)
        return value


def tokens(text: str | None) -> set[str]:
    """The distinct lower-case tokens of a text, runs of single letters joined."""
    text = (text or "").lower()
    if _SINGLES.search(text):
        text = _SINGLES.sub(lambda m: m[0].replace(" ", ""), text)
    return set(text.split())


class Restorer:
    """Restores texts token by token; readings are kept in a bounded table."""

    def __init__(self, model: CharModel):
        self.model, self._read = model, Kept(self.read)

    def read(self, raw: str) -> str:
        """A lower-case token without edge signs, read through the lattice if it shows signs of disguise."""
        if raw.isalpha() and not _THRICE.search(raw):  # of letters alone, no other sign can be found
            return raw
        t = raw.strip(_EDGE)
        if t and not t.isalpha() or _SIGNS.search(raw):
            body = raw.strip(".,;:?\"'()[]{}%&#*") if _SIGNS.search(raw) else t
            if len(body) <= 40 and _MUST_LETTERS.search(body) and _SIGNS.search(body):
                t = viterbi(body, self.model)
        return t

    def words(self, text: str | None) -> set[str]:
        """The distinct restored words of a text."""
        out = set(map(self._read.__getitem__, tokens(text)))
        out.discard("")
        return out


def grams(word: str) -> tuple[str, ...]:
    """A word's features: itself, and its first four to six letters."""
    return ("w:" + word, *("p:" + word[:k] for k in (4, 5, 6) if len(word) >= k))


@dataclass
class Model:
    chars: CharModel
    weights: dict[str, float]
    bias: float

    def scorer(self):
        """text -> score, with a restorer and per-word sums of its own."""
        read, w, bias = Restorer(self.chars).read, self.weights, self.bias
        known = Kept(lambda raw: tuple(g for g in grams(read(raw)) if g in w))

        def score(text: str | None) -> float:
            hit = set().union(*map(known.__getitem__, tokens(text)))
            z = bias + sum(w[g] for g in sorted(hit))
            return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))

        return score


def fit(docs: DataFrame, labels: DataFrame, n_features: int = 3_000, min_docs: int = 3, l2: float = 0.3) -> Model:
    """Learn from ``docs(doc_id, text)`` and ``labels(doc_id, toxic)``: every labelled row of a text.

    The labelled texts are written once, then their restored words; counts are added up per task and summed by Spark."""
    spark = docs.sparkSession
    ids = labels.where("toxic in (0, 1) and doc_id is not null").select("doc_id", F.col("toxic").cast("int").alias("y")).distinct()
    texts = written(docs.select("doc_id", "text").join(small_side(ids, 1_000_000), "doc_id").select("text", "y"), "toxicity_texts")

    def counted(batches):
        """Plain words and their number, for the character model."""
        n = Counter()

        def plain():
            words = Counter()
            for raw, c in n.items():
                if (t := raw.strip(_EDGE)).isalpha() and not _SIGNS.search(raw):
                    words[t] += c
            yield from emit(words.items(), pa.schema([("word", pa.string()), ("n", pa.int64())]), 8192)

        for (text,) in rows_of(batches, "text"):
            n.update((text or "").lower().split())
            if len(n) >= _KEPT:
                yield from plain()
                n.clear()
        yield from plain()

    words = texts.select("text").mapInArrow(counted, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))

    def trigrams(batches):
        n = Counter()
        for w, c in rows_of(batches, "word", "n"):
            if len(w) <= 40:
                s = _START * 2 + w + _END
                c = int(math.log2(c)) + 1  # frequent words must not hide the others
                for k in range(2, len(s)):
                    n[s[k - 2:k + 1]] += c
        yield from emit(n.items(), pa.schema([("gram", pa.string()), ("n", pa.int64())]), 8192)

    table = words.mapInArrow(trigrams, "gram string, n bigint").groupBy("gram").agg(F.sum("n").alias("n")).where("n > 1").collect()
    chars = _from_trigrams({r.gram: r.n for r in table})
    shared = spark.sparkContext.broadcast(chars)

    def restored(batches):
        restore = Restorer(shared.value)
        rows = ((y, " ".join(sorted(restore.words(t)))) for t, y in rows_of(batches, "text", "y"))
        yield from emit(rows, pa.schema([("y", pa.int32()), ("words", pa.string())]), 256)

    found = written(texts.mapInArrow(restored, "y int, words string"), "toxicity_words")
    sums = found.agg(F.count("*"), F.sum("y")).first()
    n, pos = sums[0], sums[1] or 0
    odds = math.log((pos + 0.5) / (n - pos + 0.5))
    if pos in (0, n):
        return Model(chars, {}, odds)

    def presence(batches):
        """Rows and toxic rows that hold a feature."""
        have, bad, known = Counter(), Counter(), Kept(grams)

        def added():
            yield from emit(((g, bad[g], d) for g, d in have.items()), pa.schema([("g", pa.string()), ("a", pa.int64()), ("d", pa.int64())]), 8192)

        for y, some in rows_of(batches, "y", "words"):
            hit = set().union(*map(known.__getitem__, some.split()))
            have.update(hit)
            if y:
                bad.update(hit)
            if len(have) >= _KEPT:
                yield from added()
                have.clear()
                bad.clear()
        yield from added()

    df = (found.mapInArrow(presence, "g string, a bigint, d bigint").groupBy("g").agg(F.sum("a").alias("a"), F.sum("d").alias("d"))
          .where(F.col("d") >= min_docs))
    lift = F.col("a") - F.col("d") * F.lit(pos / n)
    chi = lift * lift / (F.col("d") * F.lit(pos / n * (1 - pos / n)) * (1 - F.col("d") / F.lit(n + 1)))
    top = [r.g for r in df.withColumn("chi", chi).where("chi > 6").orderBy(F.desc("chi"), "g").limit(n_features).collect()]
    if not top:
        return Model(chars, {}, odds)
    mine = spark.sparkContext.broadcast(frozenset(top))

    def chosen(batches):
        keep = mine.value
        known = Kept(lambda word: tuple(g for g in grams(word) if g in keep))
        rows = ((float(y), sorted(set().union(*map(known.__getitem__, t.split())))) for y, t in rows_of(batches, "y", "words"))
        yield from emit(rows, pa.schema([("y", pa.float64()), ("g", pa.list_(pa.string()))]), 1024)

    vectors = CountVectorizerModel.from_vocabulary(top, inputCol="g", outputCol="features").setBinary(True).setMinTF(0)
    data = vectors.transform(found.mapInArrow(chosen, "y double, g array<string>")).select("y", "features").persist()
    linear = LogisticRegression(labelCol="y", regParam=l2 / n, standardization=False, maxIter=200, tol=1e-9).fit(data)
    cut = _cut(linear.transform(data).select("y", vector_to_array("rawPrediction")[1].alias("z")))
    data.unpersist()
    return Model(chars, {g: float(x) for g, x in zip(top, linear.coefficients.toArray(), strict=True)}, float(linear.intercept) - cut)


def _cut(rows: DataFrame, per_unit: int = 256) -> float:
    """The cut of ``rows(y, z)`` between the two classes with the fewest errors: the middle of the widest gap that has so few.

    Gaps are looked for between the cells of a grid over z (at most 1,000 x ``per_unit`` cells, whatever the rows)."""
    z = F.least(F.greatest("z", F.lit(-500.0)), F.lit(500.0))
    cells = (rows.select("y", z.alias("z")).groupBy(F.floor(F.col("z") * per_unit).alias("cell"))
             .agg(F.min("z").alias("lo"), F.max("z").alias("hi"), F.sum("y").alias("pos"), F.count("*").alias("n")).orderBy("cell").collect())
    if len(cells) < 2:
        return 0.0
    lo, hi, pos, n = (np.array([r[c] for r in cells], float) for c in ("lo", "hi", "pos", "n"))
    wrong = np.cumsum(pos)[:-1] + (n - pos).sum() - np.cumsum(n - pos)[:-1]  # of the cut behind each cell but the last
    best = np.flatnonzero(wrong == wrong.min())
    k = best[np.argmax(lo[best + 1] - hi[best])]
    return float(hi[k] + lo[k + 1]) / 2


def _from_trigrams(tri: dict[str, int]) -> CharModel:
    """The character model of trigram counts (each trigram ends in its predicted character)."""
    uni, bi, ctx1, ctx2 = Counter(), Counter(), Counter(), Counter()
    for g, c in sorted(tri.items()):
        uni[g[2]] += c
        bi[g[1:]] += c
        ctx1[g[1]] += c
        ctx2[g[:2]] += c
    total = sum(uni.values()) + len(uni) + 1
    p1 = {a: (c + 1) / total for a, c in uni.items()}
    p2 = {g: (c + 4 * p1[g[1]]) / (ctx1[g[0]] + 4) for g, c in bi.items()}
    p3 = {g: math.log((c + 4 * p2[g[1:]]) / (ctx2[g[:2]] + 4)) for g, c in tri.items()}
    return CharModel(p3, {g: math.log(p / 2) for g, p in p2.items()}, {a: math.log(p / 4) for a, p in p1.items()})


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """``docs(doc_id, text)`` -> (doc_id, score) of each whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        score = shared.value.scorer()
        yield from emit(((d, score(t)) for d, t in rows_of(batches, "doc_id", "text")),
                        pa.schema([("doc_id", pa.int64()), ("score", pa.float64())]), 4096)

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "doc_id bigint, score double")
