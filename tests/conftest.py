from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    ckpt = tempfile.mkdtemp(prefix="termlens-test-ckpt-")
    s = (
        SparkSession.builder.master("local[4]")
        .appName("termlens-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.checkpoint.dir", ckpt)
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    s.sparkContext.setCheckpointDir(ckpt)
    yield s
    s.stop()


# Golden mini-corpus (FIXTURES.md section 4).
GOLDEN_DOCS = [
    ("00001.txt", "The bison, the hunter's trap & snow."),
    ("00002.txt", "Trap lines in deep snow; don't lose the trap!"),
    ("00003.txt", "Bison herds and deep rivers"),
    ("00004.txt", ""),
    ("00005.txt", "Snow snow SNOW_melt rivers"),
]
GOLDEN_QUERY = ("q.txt", "deep snow traps and rivers")


@pytest.fixture(scope="session")
def golden(spark):
    docs = spark.createDataFrame(GOLDEN_DOCS, "doc_id string, text string")
    q = spark.createDataFrame([GOLDEN_QUERY], "query_id string, text string")
    return docs, q
