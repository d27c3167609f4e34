"""Readers for the driver's Parquet tables (one file per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Tables whose rows carry long texts: tokenizing them is CPU-bound per byte.
TEXT_TABLES = ("documents", "pages", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read ``<sf_dir>/<name>.parquet``; Catalyst prunes columns and pushes filters."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df) if name in TEXT_TABLES else df


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Give a text scan at least one split per core.

    A Parquet file is split by row group; a small corpus written as one row
    group becomes one task and tokenization runs on one core.  Only in that
    case the rows are dealt round-robin to ``min_partitions`` (default: the
    cluster's default parallelism).  A large scan already has more splits
    than cores and is returned unchanged, so no shuffle is added at scale.
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corpus rows (doc_id, text, ...)."""
    return table(spark, sf_dir, "documents")


def benchmark_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query batch (query_id, text) from ``benchmark(item_id, text)``."""
    return table(spark, sf_dir, "benchmark").selectExpr("item_id AS query_id", "text")
