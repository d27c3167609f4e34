"""Benchmark the headline searches; prints ONE JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).

Each query runs to completion into Spark's ``noop`` sink (every row is
produced, nothing is collected to the driver) after one untimed warm-up
pass of the JVM on the sf0.01 fixture (BENCH_WARM_DIR).  ``value`` is the sum of the query times.
Stages mirror the published runs: index build, JPII search with ranking,
IDF-filtered JPII, pairwise similarity, near-duplicate pairs.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))

    from termlens.session import get_session

    spark = get_session(f"local[{cpus}]", shuffle_partitions=2 * cpus, app_name="termlens-bench")

    from termlens.operators import index as I
    from termlens.operators import ranking as R
    from termlens.operators import similarity as S
    from termlens.plans import search as P
    from termlens.sources.tables import benchmark_queries, documents

    def q_index_build(sf):
        """Stage 1: tokenize, df, prune (F1) — the pruned postings."""
        d = documents(spark, sf)
        return I.prune(I.postings(d), I.corpus_size(d), "both")

    def q_jpii_search(sf):
        """Every benchmark query against the corpus, ranked top-5."""
        return P.jpii_search(documents(spark, sf), benchmark_queries(spark, sf))

    def q_jpii_idf(sf):
        """P3 core: IDF-filtered query terms [0.3, 0.95], ranked top-5."""
        d = documents(spark, sf)
        s = S.jpii_idf(I.postings(d), I.corpus_size(d), S.query_terms(benchmark_queries(spark, sf)),
                       lo=0.3, hi=0.95)
        return R.rank_jpii(s)

    def q_pairwise(sf):
        """Pairs over kept terms with IDF in [0.05, 0.95], ranked top-5 (falling thresholds)."""
        return P.pairwise_search(documents(spark, sf))

    def q_near_duplicates(sf):
        """All pairs with pruned Jaccard >= 0.8 (prefix-filter join)."""
        return P.near_duplicates(documents(spark, sf), 0.8)

    def q_pairwise_threshold(sf):
        """Every pair with similarity >= 0.5 over kept terms with IDF in [0.05, 0.95]."""
        d = documents(spark, sf)
        return S.pairwise_threshold(I.postings(d), I.corpus_size(d), 0.5, lo=0.05, hi=0.95)

    queries = {
        "index_build": q_index_build,
        "jpii_search": q_jpii_search,
        "jpii_idf_search": q_jpii_idf,
        "pairwise_search": q_pairwise,
        "pairwise_threshold": q_pairwise_threshold,
        "near_duplicates": q_near_duplicates,
    }

    # Warm the JVM (JIT, codegen caches) outside the timed window, as a
    # long-running cluster would be; sf0.01 is large enough to compile the
    # hot tokenizer and join paths.
    warm = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.01")
    if os.path.isdir(warm) and os.path.abspath(warm) != os.path.abspath(sf_dir):
        for fn in queries.values():
            fn(warm).write.format("noop").mode("overwrite").save()
        spark.catalog.clearCache()

    times = {}
    for name, fn in queries.items():
        spark.catalog.clearCache()  # no query profits from another one's data
        t0 = time.perf_counter()
        fn(sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)

    sf = sf_dir.rsplit("sf", 1)[-1]
    try:
        sf_val: float | str = float(sf)
    except ValueError:
        sf_val = sf
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf_val, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
