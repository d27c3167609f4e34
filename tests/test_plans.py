"""Plan properties that matter at scale (checked on the physical plan)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from termlens.operators import index as I
from termlens.operators import ranking as R
from termlens.operators import similarity as S
from termlens.operators.joins import small_side, term_pairs
from termlens.sources.tables import spread


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_topk_has_partial_group_limit_before_shuffle(spark):
    rows = [(1 if i % 3 else 2, i, float(i % 17)) for i in range(500)]
    df = spark.createDataFrame(rows, "query_id long, doc_id long, similarity double")
    top = R.top_k(df, [F.desc("similarity")], 5)
    plan = top._jdf.queryExecution().sparkPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert top.count() == 10


def test_overall_topk_numbers_only_k_rows(spark):
    df = spark.range(20_000).select(F.col("id").alias("doc_id"), (F.col("id") % 997).cast("double").alias("similarity"))
    top = R.top_k(df, [F.desc("similarity")], 5000, group=None)
    plan = top._jdf.queryExecution().sparkPlan().toString()
    assert "TakeOrderedAndProject" in plan and plan.index("Window") < plan.index("TakeOrdered")
    assert top.count() == 5000
    with pytest.raises(ValueError):
        R.top_k(df, [F.desc("similarity")], 1001, group="doc_id")


def test_small_side_respects_bound(spark):
    df = spark.range(100)
    assert "broadcast" in small_side(df, 1000)._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" not in small_side(df, 10)._jdf.queryExecution().logical().toString().lower()


def test_jpii_filters_postings_before_any_shuffle(spark):
    docs = spark.createDataFrame([(i, f"alpha beta w{i} gamma{i % 5}") for i in range(60)], "doc_id long, text string")
    q = spark.createDataFrame([(1, "alpha gamma1")], "query_id long, text string")
    s = S.jpii(I.postings(docs), I.corpus_size(docs), S.query_terms(q))
    plan = s._jdf.queryExecution().sparkPlan().toString()
    assert "LeftSemi" in plan and "BroadcastHashJoin" in plan
    assert s.count() > 0


def test_hot_term_is_split_into_blocks(spark):
    # one term in every document: with block_docs=10 its pairs spread over 15 block pairs
    post = spark.createDataFrame([("hot", i, 3, 50) for i in range(50)], "term string, doc_id long, w long, df long")
    pairs = term_pairs(post, block_docs=10)
    assert pairs.count() == 50 * 49 // 2
    plan = _plan(pairs)
    keys = plan[plan.index("Join"):].split("\n")[0]
    assert "term" in keys and ("_i" in keys or "blk" in keys or "b1" in keys or keys.count(",") >= 2), keys


def test_spread_only_when_splits_are_few(spark):
    one = spark.range(1000).coalesce(1)
    assert spread(one, 4).rdd.getNumPartitions() == 4
    many = spark.range(1000).repartition(6)
    assert spread(many, 4) is many
