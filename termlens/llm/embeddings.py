"""Embedding near-duplicates: every pair of vectors with cosine >= threshold, by PCA-ordered tiles.

The covariance of the unit vectors is summed over all rows; its eigenvectors,
largest first, order the dimensions.  Linked unit vectors are at most
r = sqrt(2 - 2 * threshold) apart, so their first coordinates are too: vectors
go to cells of width r of the first coordinate and only equal and adjacent
cells are compared.  A cell is cut into stripes of about ``stripe_rows``
vectors, a task compares two stripes tile by tile: the products of the leading
dimensions are accumulated first, the rest is bounded by the product of the
suffix norms (Cauchy-Schwarz), and pairs whose sum stays below the threshold
stop there.  Survivors get their cosine in double precision from the vectors
as given.  A task returns each vector's number of links and a spanning forest
of them, never the pairs themselves.

Every vector is compared with every vector it could link to, so the work is
quadratic within neighbouring cells; stripes bound a task's memory at any
size.  Defined results: vectors that are null, empty, zero, or hold null or
non-finite numbers link with nothing and are their own component; vectors of
different lengths do not link; repeated rows are vectors of their own; a null
id is a vector without id: it counts as a link, its own component_id is the
smallest id reachable (null if none); an empty table gives an empty table;
other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .graph import components

_SLACK = 1e-4  # for single-precision products before the exact check
_TILE = 1024


def _vectors(batch: pa.RecordBatch, name: str = "v") -> list[np.ndarray]:
    col = batch.column(batch.schema.get_field_index(name))
    return [np.frombuffer(x.as_py(), "<f8") for x in col]


def prepare(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(row, id, dim, v): v holds the doubles of a comparable vector; other rows have null."""
    vec = F.col(vec_col).cast("array<double>")

    def run(batches):
        for b in batches:
            ids, vs, out = b.column(0), b.column(1), []
            for x in vs:
                a = None
                if x.is_valid and len(x) and not x.values.null_count:
                    a = x.values.to_numpy(zero_copy_only=False)
                    with np.errstate(over="ignore"):
                        n = float(np.sqrt(a @ a)) if np.isfinite(a).all() else 0.0
                    if n and not math.isfinite(n) or 0 < n < 1e-150:  # keeps squares in range; cosines do not change
                        a = a / np.abs(a).max()
                    elif not n:
                        a = a / np.abs(a).max() if np.isfinite(a).all() and a.any() else None
                out.append(a)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([0 if a is None else len(a) for a in out], pa.int32()),
                 pa.array([None if a is None else a.astype("<f8").tobytes() for a in out], pa.binary())], names=["id", "dim", "v"])

    rows = df.select(F.col(id_col).cast("bigint").alias("id"), vec.alias("x")).mapInArrow(run, "id bigint, dim int, v binary")
    return written(rows.select(F.monotonically_increasing_id().alias("row"), "id", "dim", "v"), "vectors")


def principal_axes(vectors: DataFrame) -> dict[int, np.ndarray]:
    """For each vector length, the eigenvectors of the unit vectors' second moments, largest first (length squared numbers)."""

    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            by: dict[int, list[np.ndarray]] = {}
            for v in _vectors(b):
                by.setdefault(len(v), []).append(v)
            for d, vs in by.items():
                x = np.array(vs)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                sums[d] = sums.get(d, 0) + x.T @ x
        for d, s in sums.items():
            for i in range(d):
                yield pa.RecordBatch.from_pydict({"d": pa.array([d] * d, pa.int32()), "i": pa.array([i] * d, pa.int32()),
                                                  "j": pa.array(range(d), pa.int32()), "s": pa.array(s[i])})

    got = vectors.select("v").mapInArrow(run, "d int, i int, j int, s double").groupBy("d", "i", "j").agg(F.sum("s").alias("s"))
    out: dict[int, np.ndarray] = {}
    for r in got.toLocalIterator():
        out.setdefault(r.d, np.zeros((r.d, r.d)))[r.i, r.j] = r.s
    return {d: np.linalg.eigh((m + m.T) / 2)[1][:, ::-1] for d, m in out.items()}


def _union(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the trees of i[k] and j[k] for every k."""
    while True:
        a, b = root[i], root[j]
        if (a == b).all():
            return
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root[:] = up


class _Side:
    def __init__(self, vs: list[np.ndarray], axes: np.ndarray, lead: int):
        self.raw = np.array(vs)
        self.norm = np.linalg.norm(self.raw, axis=1)
        unit = (self.raw / self.norm[:, None]) @ axes[:, :lead]
        rest = np.sqrt(np.maximum(0, 1 - (unit * unit).sum(axis=1)))
        self.lead = np.ascontiguousarray(np.hstack([unit, rest[:, None]]), dtype=np.float32)


def _compare(a: _Side, b: _Side, same: bool, threshold: float):
    """Pairs (i, j) of linked rows, tile by tile."""
    for s in range(0, len(a.raw), _TILE):
        for t in range(s if same else 0, len(b.raw), _TILE):
            reach = a.lead[s:s + _TILE] @ b.lead[t:t + _TILE].T  # leading products plus the bound of the rest
            if reach.max() < threshold - _SLACK:
                continue
            i, j = np.nonzero(reach >= threshold - _SLACK)
            if same and s == t:
                i, j = i[i < j], j[i < j]
            i, j = i + s, j + t
            for k in range(0, len(i), 100_000):
                x, y = i[k:k + 100_000], j[k:k + 100_000]
                cos = np.einsum("ij,ij->i", a.raw[x], b.raw[y]) / (a.norm[x] * b.norm[y])
                ok = cos >= threshold
                yield x[ok], y[ok]


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = 0.95,
                    stripe_rows: int = 4096, lead: int = 16) -> DataFrame:
    """(id, n_links, component_id, kept), one row per row of ``df``."""
    if not 0 < threshold < 1:
        raise ValueError("threshold must be between 0 and 1")
    spark = df.sparkSession
    vectors = prepare(df, id_col, vec_col)
    good = vectors.where("v is not null")
    axes = spark.sparkContext.broadcast(principal_axes(good))
    width = math.sqrt(2 - 2 * threshold) + 1e-6

    def cells(batches):
        for b in batches:
            first = [math.floor(float(v @ axes.value[len(v)][:, 0]) / float(np.linalg.norm(v)) / width) for v in _vectors(b)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(first, pa.int32())], names=[*b.schema.names, "cell"])

    placed = written(good.select("row", "dim", "v").mapInArrow(cells, "row bigint, dim int, v binary, cell int"), "cells")
    # one row per length and cell: 2 / width + 1 cells at most for each length
    count = {(r.dim, r.cell): -(-r["count"] // stripe_rows) for r in placed.groupBy("dim", "cell").count().toLocalIterator()}

    if not count:
        return vectors.select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    sizes = spark.createDataFrame([(d, c, n, count.get((d, c - 1), 0), count.get((d, c + 1), 0)) for (d, c), n in sorted(count.items())],
                                  "dim int, cell int, n int, below int, above int")
    me = F.pmod(F.xxhash64("row"), F.col("n")).cast("int")

    def upto(n):
        return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))

    def pair(ca, ia, cb, ib, side):
        return F.struct(ca.alias("ca"), ia.alias("ia"), cb.alias("cb"), ib.alias("ib"), F.lit(side).alias("side"))

    c, s = F.col("cell"), F.col("stripe")
    dealt = placed.join(F.broadcast(sizes), ["dim", "cell"]).withColumn("stripe", me).withColumn("to", F.explode(F.concat(
        F.transform(F.sequence(s, F.col("n") - 1), lambda o: pair(c, s, c, o, 0)),
        F.transform(F.when(s > 0, F.sequence(F.lit(0), s - 1)).otherwise(F.array().cast("array<int>")), lambda o: pair(c, o, c, s, 1)),
        F.transform(upto(F.col("above")), lambda o: pair(c, s, c + 1, o, 0)),
        F.transform(upto(F.col("below")), lambda o: pair(c - 1, o, c, s, 1))))).select(
        "row", "dim", "v", "to.ca", "to.ia", "to.cb", "to.ib", "to.side")

    def linked(table: pa.Table) -> pa.Table:
        t = table.combine_chunks()
        first = t.slice(0, 1).to_pylist()[0]
        same = (first["ca"], first["ia"]) == (first["cb"], first["ib"])
        side = t.column("side").to_numpy()
        rows = t.column("row").to_numpy()
        vs = [np.frombuffer(x.as_py(), "<f8") for x in t.column("v")]
        order = np.argsort(side, kind="stable")
        n_a = int((side == 0).sum())
        rows = rows[order]
        n, root = np.zeros(len(rows), np.int64), np.arange(len(rows))
        if n_a and (same or n_a < len(rows)):
            ax = axes.value[first["dim"]]
            a = _Side([vs[k] for k in order[:n_a]], ax, lead)
            b = a if same else _Side([vs[k] for k in order[n_a:]], ax, lead)
            for i, j in _compare(a, b, same, threshold):
                j = j if same else j + n_a
                n += np.bincount(i, minlength=len(n)) + np.bincount(j, minlength=len(n))
                _union(root, i, j)
        hit = n > 0
        return pa.table({"row": rows[hit], "n": n[hit], "root": rows[root][hit]})

    found = written(dealt.groupBy("dim", "ca", "ia", "cb", "ib").applyInArrow(linked, "row bigint, n bigint, root bigint"), "links")
    comp = components(found.select(F.col("row").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("row").agg(F.sum("n").alias("n_links"))
    known = vectors.select("row", "id").join(links, "row", "left").join(comp.withColumnRenamed("node", "row"), "row", "left").select(
        "id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component", "row").alias("component"))
    least = known.groupBy("component").agg(F.min("id").alias("component_id"))
    return known.join(least, "component").select("id", "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
