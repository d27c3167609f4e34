"""termlens: set-similarity search over a text corpus, written for Spark.

Everything is expressed with the DataFrame API and built-in column
functions so that Catalyst plans it (pushdown, pruning, codegen, AQE)
and the same code runs on ``local[*]`` and on a large cluster.

Layout
------
functions/   column expressions: tokenizer, cleaners, similarity measures
sources/     corpus / query / metadata / page readers, text formats
operators/   index build, similarity joins, ranking, result store, metrics
streaming/   incremental index maintenance (batch and Structured Streaming)
plans/       end-to-end compositions of the operators
"""

from termlens.session import get_session, scratch_root

__all__ = ["get_session", "scratch_root"]
