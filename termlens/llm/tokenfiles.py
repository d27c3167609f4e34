"""Token files: Parquet with list columns, small pages and page indexes.

One row per document in ascending id order: ``doc_id``, ``n_tokens``,
``part``, ``in_part`` (ids of the part's documents before it) and ``ids``
(array<int>, end id included).  Ids are dictionary coded with delta fallback
(format version 2), row groups and pages have fixed sizes, and Parquet's
column and offset indexes let a reader fetch the metadata columns alone or
the pages of a few documents.

Texts are dealt by ranges of doc_id before encoding, so ids are made where
they are written.  Defined results: null text is an empty document (only the
end id); a null doc_id sorts first; repeated ids stay and are ordered by text;
an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import vocabulary_path, with_ids

SCHEMA = "doc_id bigint, n_tokens bigint, part int, in_part bigint, ids array<int>"


def write_tokens(docs: DataFrame, out: str, path: str | None = None, end_id: int = 0, row_group_bytes: int = 16 << 20,
                 page_bytes: int = 64 << 10, page_rows: int = 512) -> None:
    """Encode ``docs(doc_id, text)`` and write the token files to folder ``out``."""
    path = path or vocabulary_path()

    def run(batches):
        part, at = TaskContext.get().partitionId(), 0
        for b in with_ids(batches, path, "text", "ids", end_id):
            n = np.diff(b.column(2).offsets.to_numpy()).astype(np.int64)
            before = at + np.cumsum(n) - n
            at += int(n.sum())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n), pa.array(np.full(len(n), part, np.int32)), pa.array(before), b.column(2)],
                names=["doc_id", "n_tokens", "part", "in_part", "ids"])

    (docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
     .mapInArrow(run, SCHEMA)
     .write.option("compression", "zstd").option("parquet.writer.version", "PARQUET_2_0")
     .option("parquet.enable.dictionary", "true").option("parquet.block.size", str(row_group_bytes))
     .option("parquet.page.size", str(page_bytes)).option("parquet.page.row.count.limit", str(page_rows))
     .parquet(out))


def read_tokens(spark: SparkSession, out: str, columns: tuple[str, ...] = ("doc_id", "n_tokens", "part", "in_part", "ids")) -> DataFrame:
    """The files' rows; only the asked columns are read, and filters on doc_id skip row groups and pages."""
    return spark.read.schema(SCHEMA).parquet(out).select(*columns)


def starts(spark: SparkSession, out: str) -> DataFrame:
    """(part, base): ids in all parts before a part, from the metadata columns alone; one row per written part."""
    sums = read_tokens(spark, out, ("part", "n_tokens")).groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def checksums(tokens: DataFrame) -> DataFrame:
    """``tokens`` with ids replaced by ``ids_crc32``: crc32 of the ids as little-endian unsigned 32-bit integers."""
    keep = [c for c in tokens.columns if c != "ids"]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in tokens.schema if f.name != "ids"), "ids_crc32 bigint"])

    def run(batches):
        for b in batches:
            ids = b.column(b.schema.get_field_index("ids"))
            flat, off = ids.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False), ids.offsets.to_numpy()
            crc = [zlib.crc32(flat[s:e].tobytes()) for s, e in zip(off[:-1], off[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(c)) for c in keep), pa.array(crc, pa.int64())],
                                             names=[*keep, "ids_crc32"])

    return tokens.mapInArrow(run, schema)


def index(spark: SparkSession, out: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""
    t = checksums(read_tokens(spark, out))
    return t.join(starts(spark, out), "part").select(
        "doc_id", (F.col("base") + F.col("in_part")).alias("start"), "n_tokens", "ids_crc32")
