"""Connected components by large-star / small-star steps, all on DataFrames.

Each step takes the smallest neighbour of a node by a partial aggregate and
joins it back, so a node with very many neighbours sends one row per task and
its join partition can be split by adaptive execution.  The edge list is
written to the shared folder after each round and rounds end when it no longer
changes; the driver sees one count and one checksum per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """One star step on rows (u, v), u > v."""
    if large:  # all neighbours of u; those above u move to the smallest one
        near = pairs.select("u", "v").unionAll(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = pairs.select("u", "v")
    least = near.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u"), F.least("u", "m").alias("m"))
    joined = near.join(least, "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(
            least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").select("u", "v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` -> (node, component): the smallest node reachable, for every node of an edge to another node."""
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now = written(now, "edges")
    seen = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen or not mark[0]:
            break
        seen = mark
        now = written(_star(_star(now, True), False), "edges")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
