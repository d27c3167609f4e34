"""Cell lines imported into a table, with the totals of the run, in one read of the lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from termlens.sources.formats import parse_cell_lines

CELL_SCHEMA = "row_key string, qualifier string, value string, family string"


def import_cells(lines: DataFrame, path: str, index_table: bool = True) -> dict[str, int]:
    """Parse ``lines`` (value) and write the valid cells to ``path``, a folder per column family.

    Returns lines, cells and invalid (rows of no known form) as counted while the cells were written; nothing is read
    twice and nothing but the totals reaches the driver.  Writing again replaces the families that occur.
    """
    seen, parsed = Observation(), Observation()
    lines = lines.observe(seen, F.count(F.lit(1)).alias("lines"))
    valid = F.coalesce(F.col("valid"), F.lit(False))
    cells = parse_cell_lines(lines, index_table).observe(
        parsed, F.count(F.when(valid, 1)).alias("cells"), F.count(F.when(~valid, 1)).alias("invalid"))
    (cells.where(valid).select("row_key", "qualifier", "value", "family").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("family").parquet(path))
    return {**seen.get, **parsed.get}


def read_cells(lines_path: str, spark) -> DataFrame:
    """The cells of an imported table."""
    return spark.read.schema(CELL_SCHEMA).parquet(lines_path)
