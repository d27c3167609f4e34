"""Similarity measures and score helpers as column expressions
(M1-M6, T16-T18).

Every measure keeps the reference's arithmetic order so the double
results carry the same bits (division and multiplication are correctly
rounded in the JVM and in other SQL engines alike).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _dbl(c: str | Column) -> Column:
    return _col(c).cast("double")


def jaccard(m: str | Column, w_a: str | Column, w_b: str | Column) -> Column:
    """M1/M2/M3: m / (w_a + w_b - m); 0.0 when the union is not positive."""
    union = _col(w_a) + _col(w_b) - _col(m)
    return F.when(union > 0, _dbl(m) / _dbl(union)).otherwise(F.lit(0.0))


def ratio(num: str | Column, den: str | Column) -> Column:
    """M4: sum(min) / sum(max); 0.0 when the denominator is not positive."""
    return F.when(_col(den) > 0, _dbl(num) / _dbl(den)).otherwise(F.lit(0.0))


def overlap(m: str | Column, q: str | Column, e: str | Column) -> Column:
    """M5: overlap coefficient m / min(q, e); 0.0 when the minimum is 0."""
    lo = F.least(_col(q), _col(e))
    return F.when(lo == 0, F.lit(0.0)).otherwise(_dbl(m) / _dbl(lo))


def f1(m: str | Column, q: str | Column, e: str | Column) -> Column:
    """M6: F1 of recall m/q and precision m/e, each 0-guarded.

    Kept in the two-step form 2*(p*r)/(p+r) rather than 2m/(q+e) so the
    double result has the same bits as the reference.
    """
    recall = F.when(_col(q) > 0, _dbl(m) / _dbl(q)).otherwise(F.lit(0.0))
    precision = F.when(_col(e) > 0, _dbl(m) / _dbl(e)).otherwise(F.lit(0.0))
    return F.when(precision + recall == 0, F.lit(0.0)).otherwise(
        F.lit(2.0) * (precision * recall) / (precision + recall)
    )


def round_half_up(x: str | Column, digits: int) -> Column:
    """Rounding to ``digits`` decimals as floor(x*10^k + 0.5) / 10^k.

    Spark's round() and other engines' round() disagree on binary ties;
    this form gives the same double in every engine.
    """
    scale = float(10 ** digits)
    return F.floor(_dbl(x) * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def fixed_decimals(x: str | Column, digits: int) -> Column:
    """Fixed-point text with ``digits`` decimals (round half up)."""
    return F.format_string(f"%.{digits}f", round_half_up(x, digits))


def normalized_idf(df: str | Column, n: str | Column) -> Column:
    """ln(N/df) / ln(N); 0 when N or df is 0; 0.5 for every term if N <= 1."""
    n_d = _dbl(n)
    val = F.log(n_d / _dbl(df)) / F.log(n_d)
    return (
        F.when(_col(n) <= 1, F.lit(0.5))
        .when((_col(df) == 0) | (_col(n) == 0), F.lit(0.0))
        .otherwise(val)
    )


def score_band(sim: str | Column) -> Column:
    """T18: 'high' (>= 0.7), 'medium' (>= 0.4), else 'low'."""
    s = _col(sim)
    return F.when(s >= 0.7, "high").when(s >= 0.4, "medium").otherwise("low")
