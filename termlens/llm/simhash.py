"""SimHash near-duplicates, with pigeonring filtering of the candidates.

A text's fingerprint has a bit set where over half of its shingle hashes have
it.  Two fingerprints link if they differ in at most ``max_bits`` bits.

Search.  The 64 bits are a ring of ``max_bits + 1`` segments.  If two
fingerprints differ in at most t bits, the ring has a start from which every
chain of l consecutive segments differs in at most l * t / (t + 1) bits in
total.  For l = 1 that is an equal segment, an equi-join key; the longer
chains are checked before the full distance.  Equal fingerprints are one node
from the start.  A bucket (start, segment value) of more than ``bucket``
fingerprints is not compared pair by pair: its members emit every fingerprint
within t // 2 bits of their own, and for even t two fingerprints are within t
bits exactly if they share one of those; each such key links its members to
its smallest one (for odd t the split is made on t + 1 and links are checked).
Either way no link is lost and no group emits all its pairs.

Defined results: a null or word-less text has fingerprint zero, which links
like any other; a text of fewer words than a shingle hashes its whole word
sequence; repeated rows share a fingerprint and a component; a null doc_id
keeps its row and is in a component of its fingerprint's other ids (null if
there are none); an empty table gives an empty table; other columns are not
read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import emit, rows_of, written
from .graph import components

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_BLOCK = 1 << 16


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of a text's word shingles (repeats included), as an unsigned integer."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:n].tolist()
    stops = ends[min(shingle, len(words)) - 1:].tolist()
    h, ones = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64)
    for at in range(0, n, _BLOCK):
        v = np.array([h(joined[s:e], seed) for s, e in zip(starts[at:at + _BLOCK], stops[at:at + _BLOCK], strict=True)], dtype="<u8")
        bits = np.unpackbits(v.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits((2 * ones > n).astype(np.uint8), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fp): the fingerprint of each whole text as a signed 64-bit integer."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(batches):
        yield from emit(((d, int(np.uint64(fingerprint(t, shingle, seed)).astype(np.int64))) for d, t in rows_of(batches, "doc_id", "text")),
                        schema, 4096)

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "doc_id bigint, fp bigint")


def _segments(t: int) -> list[tuple[int, int]]:
    """(shift, mask) of each segment of the ring."""
    cuts = [round(64 * k / (t + 1)) for k in range(t + 2)]
    return [(lo, (1 << (hi - lo)) - 1) for lo, hi in zip(cuts[:-1], cuts[1:], strict=True)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def link_edges(fps: DataFrame, max_bits: int = 2, bucket: int = 32) -> DataFrame:
    """``fps(fp)`` distinct -> edges (a, b) whose components are those of all links within ``max_bits`` bits."""
    t, m = max_bits, max_bits + 1
    seg = _segments(t)

    def value(col, k):
        shift, mask = seg[k]
        return F.shiftrightunsigned(col, shift).bitwiseAND(F.lit(mask))

    keys = fps.select("fp", F.posexplode(F.array(*[value(F.col("fp"), k) for k in range(m)])).alias("start", "val"))
    count = keys.groupBy("start", "val").agg(F.count("*").alias("n")).where("n > 1")
    held = keys.join(count, ["start", "val"])

    small = held.where(F.col("n") <= bucket)
    a = small.select("start", "val", F.col("fp").alias("a"))
    b = small.select("start", "val", F.col("fp").alias("b"))
    diff = F.col("a").bitwiseXOR(F.col("b"))
    ok = F.col("a") < F.col("b")
    for length in range(2, m):  # chains from the equal segment on, before the full distance
        chain = [F.lit(0)] * m
        for s in range(m):
            mask = sum(seg[(s + k) % m][1] << seg[(s + k) % m][0] for k in range(length))
            chain[s] = F.bit_count(diff.bitwiseAND(F.lit(_signed(mask))))
        total = F.when(F.col("start") == 0, chain[0])
        for s in range(1, m):
            total = total.when(F.col("start") == s, chain[s])
        ok = ok & (total <= length * t // m)
    pairs = a.join(b, ["start", "val"]).where(ok & (F.bit_count(diff) <= t)).select("a", "b")

    half = (t + 1) // 2
    masks = [0]
    for _ in range(half):
        masks = sorted({x | (1 << k) for x in masks for k in range(64)} | set(masks))
    big = held.where(F.col("n") > bucket).select("fp").distinct()
    near = big.select("fp", F.explode(F.transform(F.array(*[F.lit(_signed(x)) for x in masks]),
                                                  lambda x: x.bitwiseXOR(F.col("fp")))).alias("key"))
    if t % 2 == 0:
        least = near.groupBy("key").agg(F.min("fp").alias("a"), F.max("fp").alias("z")).where("a < z")
        stars = near.join(least, "key").where("fp <> a").select("a", F.col("fp").alias("b"))
    else:  # shared keys mean t + 1 bits: check the pair
        other = near.select("key", F.col("fp").alias("b"))
        stars = near.select("key", F.col("fp").alias("a")).join(other, "key").where(
            (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= t)).select("a", "b")
    return pairs.unionAll(stars).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2, seed: int = 42, bucket: int = 32) -> DataFrame:
    """``docs(doc_id, text)`` -> (doc_id, fp, component_id), one row per input row."""
    fp = written(fingerprints(docs, shingle, seed), "fingerprints")
    first = written(fp.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprint_ids")
    comp = components(link_edges(first.select("fp"), max_bits, bucket))
    labels = first.join(comp.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = labels.groupBy("component").agg(F.min("least").alias("component_id"))
    ids = labels.select("fp", "component").join(least, "component").select("fp", "component_id")
    return fp.join(ids, "fp").select("doc_id", "fp", "component_id")
