"""Helpers shared by the corpus operators: tables, written intermediates, Arrow loops."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termlens.session import scratch_root

WORD_BYTES = rb"[^\x20\x09-\x0D]+"  # what bytes.split() yields on UTF-8 text


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder, deleted when the driver's JVM ends."""
    path = scratch_root(spark, name)
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(jpath)
    fs.deleteOnExit(jpath)
    return path


def written(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here, lost executors cost nothing done before."""
    spark = df.sparkSession
    path = scratch(spark, name) + "/t"
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_remainder(col: str, modulus: int):
    """crc32 of the id as text, modulo ``modulus`` (null for a null id)."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % F.lit(modulus)


def rows_of(batches: Iterable[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """Rows of Arrow batches, a few at a time so that no batch is copied to Python whole."""
    for batch in batches:
        cols = [batch.column(batch.schema.get_field_index(n)) for n in names]
        for at in range(0, batch.num_rows, 64):
            yield from zip(*(c.slice(at, 64).to_pylist() for c in cols), strict=True)


def emit(rows: Iterable[tuple], schema: pa.Schema, n_rows: int = 1024, size: Callable[[tuple], int] | None = None,
         n_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``n_rows`` rows, or of about ``n_bytes`` by ``size``."""
    buf: list[tuple] = []
    held = 0
    for r in rows:
        buf.append(r)
        held += size(r) if size else 0
        if len(buf) >= n_rows or held >= n_bytes:
            yield _batch(buf, schema)
            buf, held = [], 0
    if buf:
        yield _batch(buf, schema)


def _batch(buf: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*buf, strict=True), schema, strict=True)],
                                      schema=schema)
