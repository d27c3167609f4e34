"""Secret scan: fixed rules, and a character convolutional network over every further candidate.

Rules (kinds ``assign``, ``access``, ``hex``) give spans that always stay.
Candidates are runs of eight or more key characters, less what rules' spans
cover of them (parts from four on beside a span).  The network reads a
candidate with its surroundings (24 characters before, up to 32 first and 16
last of its own, 12 after), embeds characters, convolves them, takes maxima over
the three regions and a mean over the candidate, and gives a probability.  A
candidate of more than 48 characters is read through windows of 48 at every 24,
and has the highest of their probabilities.  It becomes a span of kind ``net``
if its probability reaches the threshold.

Labelled findings for training: candidates inside a rule's span are secrets;
candidates that are numbers, dotted numbers, addresses or dates, and long plain words, are not;
others are not used.  All distinct findings of all rows are taken; contexts are
hidden at random so that the candidate's own characters count.  They are dealt by
hash into shares of about ten times ``sample``: each share trains a copy of the
network, the copies are averaged by their findings, and a second round starts
from the average.  Both labels weigh the same.  A fifth of the findings is kept apart: a scale and
an offset of the logit are fitted on all of it, and the threshold is the highest one
that keeps ``recall`` of its secrets, to a ``1 / CELLS`` of a logit.

Defined results: a null text is empty and has no spans; ties at one start
are ordered assign, access, hex, net; repeated rows get equal results; without
findings of both labels there is no network and no ``net`` span; an empty
table gives an empty table; positions are code points, ends exclusive; other
columns are not read (``redact`` keeps them).
"""

from __future__ import annotations

import re
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import emit, rows_of, written

KINDS = ("assign", "access", "hex", "net")
# Rules of the contract (fixed patterns).
_ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{12,}")  # of the labelled findings
_RUN = re.compile(r"[A-Za-z0-9+/_.=-]{8,}")
_REST = 4  # the least part of a run beside a rule's span
_PLAIN = re.compile(r"[0-9][0-9./:_-]*|[A-Za-z]+|\d{4}-\d\d-\d\d\S*|[A-Za-z0-9_.-]+\.[A-Za-z]{2,}")
_DIGIT = re.compile(r"[0-9]")
BEFORE, HEAD, TAIL, AFTER = 24, 32, 16, 12
WIDTH = BEFORE + HEAD + TAIL + AFTER
SHORT = 16  # most candidates are at most so long
ROUNDS, CELLS = 2, 1024  # averaged rounds of training; cells of a logit in the calibration


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the rules' matches, in order."""
    out = []
    if "=" in text or ":" in text:
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def candidates(text: str, spans: list[tuple[int, int, int]] = ()) -> list[tuple[int, int]]:
    """The key-character runs without what ``spans`` (in order) cover."""
    out, k = [], 0
    ends = list(accumulate((e for _, _, e in spans), max))
    for m in _RUN.finditer(text):
        at, end = m.span()
        while k < len(spans) and ends[k] <= at:
            k += 1
        j = k
        while j < len(spans) and spans[j][0] < end:
            if spans[j][0] - at >= _REST:
                out.append((at, spans[j][0]))
            at = max(at, spans[j][2])
            j += 1
        if end - at >= _REST:
            out.append((at, end))
    return out


def views(start: int, end: int) -> list[tuple[int, int]]:
    """The windows that a candidate is read through."""
    size = HEAD + TAIL
    if end - start <= size:
        return [(start, end)]
    return [(s, s + size) for s in [*range(start, end - size, size // 2), end - size]]


def window(text: str, start: int, end: int) -> bytes:
    """The network's input: one byte a character, 0 where there is none."""
    left, right = text[max(0, start - BEFORE):start], text[end:end + AFTER]
    body = text[start:end]
    head, tail = (body, "") if len(body) <= HEAD else (body[:HEAD], body[HEAD:][-TAIL:])
    put = lambda s: bytes(ord(c) if 32 <= ord(c) < 127 else 127 if c.isalpha() else 1 for c in s)
    return (put(left).rjust(BEFORE, b"\0") + put(head).ljust(HEAD, b"\0") + put(tail).ljust(TAIL, b"\0") + put(right).ljust(AFTER, b"\0"))


_ASCII = np.array([c if 32 <= c < 127 else 1 for c in range(128)], np.uint8)


def characters(text: str) -> np.ndarray:
    """The network's code of every character of a text, with what ``window`` puts around it."""
    u = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    out = np.zeros(BEFORE + len(u) + AFTER, np.uint8)
    body = out[BEFORE:BEFORE + len(u)]
    body[:] = _ASCII[np.minimum(u, 127)]
    other = np.flatnonzero(u >= 128)
    if len(other):
        have, of = np.unique(u[other], return_inverse=True)
        body[other] = np.array([127 if chr(c).isalpha() else 1 for c in have.tolist()], np.uint8)[of]
    return out


def windows(codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """``window`` of many spans of one text at once, from its ``characters``."""
    def piece(first, size, stop):
        at = first[:, None] + np.arange(size)
        return np.where(at < stop[:, None], codes[np.minimum(at + BEFORE, len(codes) - 1)], 0)

    tail = end - np.clip(end - start - HEAD, 0, TAIL)
    return np.concatenate([piece(start - BEFORE, BEFORE, start), piece(start, HEAD, end), piece(tail, TAIL, end), piece(end, AFTER, end + AFTER)], axis=1)


def _logistic(z):
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


class Net:
    """Embedding, one convolution, region maxima and a mean, one logistic output; all in numpy."""

    EMBED, FILTERS, SPAN = 8, 24, 5

    def __init__(self, seed: int = 5):
        r = np.random.default_rng(seed)
        f = self.FILTERS
        self.p = {"e": r.normal(0, 0.3, (128, self.EMBED)), "w": r.normal(0, 0.2, (self.SPAN * self.EMBED, f)), "b": np.zeros(f),
                  "o": r.normal(0, 0.1, 4 * f), "c": np.zeros(1)}
        edges = [0, BEFORE, BEFORE + HEAD + TAIL, WIDTH]
        n = WIDTH - self.SPAN + 1
        self.regions = [(edges[k], min(edges[k + 1], n)) for k in range(3)]
        self.scale, self.offset, self.threshold = 1.0, 0.0, 0.5
        self.tables = None

    def _forward(self, x: np.ndarray):
        emb = self.p["e"][x]  # rows, WIDTH, EMBED
        cols = np.lib.stride_tricks.sliding_window_view(emb, self.SPAN, axis=1).transpose(0, 1, 3, 2).reshape(len(x), -1, self.SPAN * self.EMBED)
        act = np.maximum(cols @ self.p["w"] + self.p["b"], 0)
        arg = [act[:, s:e].argmax(axis=1) + s for s, e in self.regions]
        s, e = self.regions[1]
        feat = np.concatenate([*(np.take_along_axis(act, a[:, None], 1)[:, 0] for a in arg), act[:, s:e].mean(axis=1)], axis=1)
        return cols, act, arg, feat, feat @ self.p["o"] + self.p["c"][0]

    def _tables(self) -> tuple[np.ndarray, ...]:
        """The convolution's sums for two characters, two further ones and the last."""
        taps = [self.p["e"] @ self.p["w"][k * self.EMBED:(k + 1) * self.EMBED] for k in range(self.SPAN)]
        pair = lambda a, b: (a[:, None] + b[None]).reshape(-1, self.FILTERS).astype(np.float32)
        return pair(taps[0], taps[1]), pair(taps[2], taps[3]), (taps[4] + self.p["b"]).astype(np.float32)

    def logits(self, x: np.ndarray) -> np.ndarray:
        """As ``_forward``, from tables of the trained weights."""
        if self.tables is None:
            self.tables = self._tables()
        out = np.empty(len(x))
        short = ~x[:, BEFORE + SHORT:BEFORE + HEAD + TAIL].any(axis=1)
        for rows, features in ((np.flatnonzero(short), self._short_features), (np.flatnonzero(~short), self._features)):
            for at in range(0, len(rows), 128):
                some = rows[at:at + 128]
                out[some] = features(x[some]) @ self.p["o"] + self.p["c"][0]
        return out * self.scale + self.offset

    def _convolved(self, x: np.ndarray, at: np.ndarray | slice) -> np.ndarray:
        """The convolution at the places ``at``."""
        first, second, last = self.tables
        two = x[:, :-1] * 128 + x[:, 1:]
        act = first[two[:, :-3][:, at]]
        act += second[two[:, 2:-1][:, at]]
        act += last[x[:, 4:][:, at]]
        return act

    def _features(self, x: np.ndarray) -> np.ndarray:
        act = np.maximum(self._convolved(x, slice(0, WIDTH - self.SPAN + 1)), 0)
        s, e = self.regions[1]
        return np.concatenate([*(act[:, a:b].max(axis=1) for a, b in self.regions), act[:, s:e].mean(axis=1)], axis=1)

    def _short_features(self, x: np.ndarray) -> np.ndarray:
        """The same for candidates of at most ``SHORT`` characters: the places that see padding only have one value, computed once."""
        (_, a), (_, b), (_, c) = self.regions
        pad = b - self.SPAN + 1  # from here on the characters after the candidate are seen
        act = np.maximum(self._convolved(x, np.r_[0:a + SHORT, pad:c]), 0)
        empty = np.maximum(self._convolved(np.zeros((1, WIDTH), np.int64), slice(0, 1))[0, 0], 0)
        own, after = act[:, a:a + SHORT + b - pad], act[:, a + SHORT + b - pad:]
        mean = (own.sum(axis=1) + (pad - a - SHORT) * empty) / (b - a)
        return np.concatenate([act[:, :a].max(axis=1), np.maximum(own.max(axis=1), empty), after.max(axis=1), mean], axis=1)

    def _gradients(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray | float = 1) -> dict[str, np.ndarray]:
        cols, act, arg, feat, z = self._forward(x)
        f = self.FILTERS
        d = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y) * weight / len(y)
        g = {"o": feat.T @ d, "c": np.array([d.sum()])}
        df = d[:, None] * self.p["o"]
        da = np.zeros_like(act)
        for k, a in enumerate(arg):
            np.put_along_axis(da, a[:, None], df[:, None, k * f:(k + 1) * f], 1)
        s, e = self.regions[1]
        da[:, s:e] += df[:, None, 3 * f:] / (e - s)
        da *= act > 0
        g["w"] = cols.reshape(-1, cols.shape[2]).T @ da.reshape(-1, f)
        g["b"] = da.sum(axis=(0, 1))
        dc = (da @ self.p["w"].T).reshape(len(x), -1, self.SPAN, self.EMBED)
        de = np.zeros((len(x), WIDTH, self.EMBED), da.dtype)
        for k in range(self.SPAN):
            de[:, k:k + dc.shape[1]] += dc[:, :, k]
        flat = x.ravel()
        g["e"] = np.stack([np.bincount(flat, de[..., k].ravel(), len(self.p["e"])) for k in range(self.EMBED)], axis=1)
        return g

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = 10, rate: float = 0.01, seed: int = 6, weight: np.ndarray | None = None) -> None:
        """Adam over mini-batches, in single precision; each context is hidden in a third of the draws."""
        self.tables = None
        r = np.random.default_rng(seed)
        self.p = {k: p.astype(np.float32) for k, p in self.p.items()}
        y, weight = y.astype(np.float32), np.ones(len(y), np.float32) if weight is None else weight.astype(np.float32)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(p) for k, p in self.p.items()}
        t = 0
        for _ in range(epochs):
            order = r.permutation(len(x))
            for at in range(0, len(x), 128):
                pick = order[at:at + 128]
                xb = x[pick].astype(np.int64)
                xb[r.random(len(pick)) < 0.33, :BEFORE] = 0
                xb[r.random(len(pick)) < 0.33, -AFTER:] = 0
                t += 1
                for k, g in self._gradients(xb, y[pick], weight[pick]).items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    self.p[k] = (self.p[k] - rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)).astype(np.float32)
        self.p = {k: p.astype(float) for k, p in self.p.items()}

    def calibrate(self, x: np.ndarray, y: np.ndarray, recall: float) -> None:
        """Scale, offset and threshold by held-back findings."""
        z = self.logits(x)
        self.settle(z, z, y, np.ones(len(z)), recall)

    def settle(self, z: np.ndarray, low: np.ndarray, y: np.ndarray, n: np.ndarray, recall: float) -> None:
        """Scale and offset of the logit by Newton steps, then the threshold, from cells of ``n`` findings: mean and lowest logit, label."""
        a, b = 1.0, 0.0
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(a * z + b, -50, 50)))
            w = n * (p * (1 - p) + 1e-9)
            g = np.array([(n * (p - y) * z).sum() + 0.1 * (a - 1), (n * (p - y)).sum() + 0.1 * b])
            h = np.array([[(w * z * z).sum() + 0.1, (w * z).sum()], [(w * z).sum(), w.sum() + 0.1]])
            step = np.linalg.solve(h, g)
            a, b = a - step[0], b - step[1]
        self.scale, self.offset = max(a, 1e-3), b
        low, n = low[y == 1], n[y == 1]
        order = np.argsort(low, kind="stable")
        seen = np.cumsum(n[order])
        least = low[order][np.searchsorted(seen, int((1 - recall) * seen[-1]), side="right")]
        self.threshold = float(_logistic(least * self.scale + self.offset))

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return _logistic(self.logits(x))


def findings(text: str):
    """(input bytes, label) of the candidates whose label is known, and of long plain words."""
    spans = base_spans(text)
    for m in _CANDIDATE.finditer(text):
        s, e = m.span()
        if any(a < e and s < b for a, _, b in spans):
            # the value that a rule found, without the name it was assigned to
            value = re.search(r"[A-Za-z0-9+/]{12,}$", m[0])
            if value and _DIGIT.search(value[0]):
                yield window(text, s + value.start(), e), 1
        elif _PLAIN.fullmatch(m[0]):
            yield window(text, s, e), 0


def _inputs(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, WIDTH)


def fit(docs: DataFrame, sample: int = 3000, recall: float = 0.98) -> Net | None:
    """Train on all distinct findings of ``docs(doc_id, text)``, in shares of about ten times ``sample``."""
    spark = docs.sparkSession

    def run(batches):
        def rows():
            seen = set()
            for (text,) in rows_of(batches, "text"):
                for f in findings(text or ""):
                    if f not in seen:
                        if len(seen) >= 50_000:
                            seen.clear()
                        seen.add(f)
                        yield xxhash.xxh3_64_intdigest(f[0]) >> 1, f[1], f[0]

        yield from emit(rows(), pa.schema([("h", pa.int64()), ("y", pa.int32()), ("x", pa.binary())]), 8192)

    found = written(docs.select("text").mapInArrow(run, "h bigint, y int, x binary").distinct(), "secrets_findings")
    held = F.col("h") % 5 == 0
    number = {(r.held, r.y): r.n for r in found.groupBy(held.alias("held"), "y").agg(F.count("*").alias("n")).collect()}
    if len(number) < 4:
        return None
    plain, secret = number[False, 0], number[False, 1]
    shares = max(1, round((plain + secret) / (10 * sample)))
    epochs = max(1, min(5, 60_000 // (plain + secret)))  # of a round; few findings are seen more often
    times = max(1, min(64, plain // (16 * secret)))  # secrets are shown so often in an epoch
    weigh = np.array([0.5 / plain, 0.5 / (secret * times)]) * (plain + secret * times)
    net = Net()
    for turn in range(ROUNDS):
        start = spark.sparkContext.broadcast(net.p)

        def learn(table: pa.Table) -> pa.Table:  # sent out in the same turn
            table = table.sort_by([("h", "ascending"), ("x", "ascending"), ("y", "ascending")])
            x, y = _inputs(table.column("x")), table.column("y").to_numpy()
            pick = np.repeat(np.arange(len(y)), np.where(y == 1, times, 1))
            own = Net()
            own.p = dict(start.value)  # noqa: B023
            own.train(x[pick], y[pick], epochs, 0.01 / (1 + turn), 6 + turn, weigh[y[pick]])  # noqa: B023
            return pa.table({"share": table.column("share")[:1], "n": pa.array([float(len(y))]),
                             "p": pa.array([np.concatenate([own.p[k].ravel() for k in own.p]).tobytes()], pa.binary())})

        def total(table: pa.Table) -> pa.Table:
            table = table.sort_by("share")
            n = table.column("n").to_numpy()
            p = np.stack([np.frombuffer(b, float) for b in table.column("p").to_pylist()])
            return pa.table({"share": table.column("share")[:1], "n": pa.array([n.sum()]), "p": pa.array([(n @ p).tobytes()], pa.binary())})

        schema = "share bigint, n double, p binary"
        trained = found.where(~held).withColumn("share", F.expr(f"(h div 5) % {shares}")).groupBy("share").applyInArrow(learn, schema)
        sums = sorted(trained.groupBy(F.col("share") % 16).applyInArrow(total, schema).collect())
        flat, at = sum(np.frombuffer(bytes(r.p), float) for r in sums) / sum(r.n for r in sums), 0
        for k, p in net.p.items():
            net.p[k] = flat[at:at + p.size].reshape(p.shape)
            at += p.size
        start.destroy()
    shared = spark.sparkContext.broadcast(net)

    def logits(batches):
        for b in batches:
            x, y = _inputs(b.column(b.schema.get_field_index("x"))), b.column(b.schema.get_field_index("y"))
            yield pa.RecordBatch.from_arrays([y, pa.array(shared.value.logits(x.astype(np.int64)))], names=["y", "z"])

    cell = F.floor(F.least(F.greatest("z", F.lit(-64.0)), F.lit(64.0)) * CELLS)
    cells = (found.where(held).select("y", "x").mapInArrow(logits, "y int, z double").groupBy("y", cell.alias("cell"))
             .agg(F.avg("z").alias("z"), F.min("z").alias("low"), F.count("*").alias("n")).orderBy("y", "cell").collect())
    net.settle(*(np.array([r[c] for r in cells], float) for c in ("z", "low", "y", "n")), recall)
    return net


def all_spans(text: str, net: Net | None) -> list[tuple[int, int, int]]:
    spans = base_spans(text)
    if net is not None:
        free = candidates(text, spans)
        codes = characters(text if free else "")

        def probable(some):
            at = np.array(some, dtype=np.int64)
            return net.probabilities(windows(codes, at[:, 1], at[:, 2]).astype(np.int64))

        best = [0.0] * len(free)
        parts = [(n, s, e) for n, c in enumerate(free) for s, e in views(*c)]
        for at in range(0, len(parts), 512):
            some = parts[at:at + 512]
            for (n, _, _), q in zip(some, probable(some), strict=True):
                best[n] = max(best[n], q)
        spans = spans + [(s, 3, e) for (s, e), q in zip(free, best, strict=True) if q >= net.threshold]
    return sorted(spans)


def scan(docs: DataFrame, net: Net | None) -> DataFrame:
    """``docs(doc_id, text)`` -> (doc_id, spans): array of (kind, start, end) in order."""
    shared = docs.sparkSession.sparkContext.broadcast(net)
    item = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches):
        rows = ((d, [{"kind": KINDS[k], "start": s, "end": e} for s, k, e in all_spans(t or "", shared.value)])
                for d, t in rows_of(batches, "doc_id", "text"))
        yield from emit(rows, pa.schema([("doc_id", pa.int64()), ("spans", pa.list_(item))]), 2048)

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        run, "doc_id bigint, spans array<struct<kind:string,start:bigint,end:bigint>>")


def redacted(text: str | None, net: Net | None, mark: str = "[SECRET]") -> str | None:
    """The text with every span (overlapping ones together) replaced by ``mark``."""
    if text is None:
        return None
    out, at = [], 0
    last = -1
    for s, _, e in all_spans(text, net):
        if s >= last:
            out += [text[at:s], mark]
        last = max(last, e)
        at = last
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, net: Net | None, text_col: str = "text") -> DataFrame:
    """``docs`` with the secrets in ``text_col`` replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches):
        for b in batches:
            k = b.schema.get_field_index(text_col)
            for at in range(0, b.num_rows, 256):
                piece = b.slice(at, 256)
                text = pa.array([redacted(t, shared.value) for t in piece.column(k).to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([text if j == k else c for j, c in enumerate(piece.columns)], names=piece.schema.names)

    return docs.mapInArrow(run, docs.schema)
