"""Driver contract smoke tests."""

from __future__ import annotations

import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["query_id", "rank", "doc_id", "jaccard", "f1", "overlap", "match_count"]
    assert df.count() > 0


def _corpus_operator(name: str) -> bool:
    return name == "pipeline" or name.startswith("op") and name[2:].split("_")[0].isdigit()


def test_every_query_has_an_oracle():
    qs, sql = set(E.queries()), set(E.oracle_sql())
    assert sql <= qs
    own = {k for k in qs if not _corpus_operator(k)}
    assert own == {k for k in sql if not _corpus_operator(k)} and len(own) >= 60
