"""Rates and deltas (survey 2.3 math, Q1, Q2, A14, A15).

Rates are computed from integer counts with one final division so that any
engine gets the same double: ``floor((2*10^k*100*n + d) / (2d)) / 10^k`` is the
percentage rounded half-up at ``k`` decimals (Python's half-even ``round`` on
binary floats differs from it on exact ties only).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rate(num, den, decimals: int = 1) -> Column:
    """Percentage ``100*num/den`` rounded half-up; null when ``den`` is 0."""
    n, d = _col(num), _col(den)
    scale = 10 ** decimals
    return F.when(
        d > 0, F.floor((n * (200 * scale) + d) / (d * 2)).cast("double") / scale
    )


def raw_rate(num, den) -> Column:
    """Unrounded percentage ``num/den*100`` (the browser's form); null on 0."""
    n, d = _col(num), _col(den)
    return F.when(d > 0, n / d * 100)


def delta_pp(a, b) -> Column:
    """Difference of two 1-decimal rates, exact in tenths; null if either is."""
    return (F.round(_col(a) * 10) - F.round(_col(b) * 10)) / 10


def mean_rounded(total, count, decimals: int = 1) -> Column:
    """``total/count`` rounded half away from zero; null on 0."""
    t, c = _col(total), _col(count)
    scale = 10 ** decimals
    size = F.floor((F.abs(t) * (2 * scale) + c) / (c * 2)).cast("double") / scale
    return F.when(c > 0, F.when(t < 0, -size).otherwise(size))


def weighted_mean(total, weight, value=None) -> Column:
    """A14 as an aggregate: mean of per-row means weighted by their counts,
    ignoring rows whose value is null or whose weight is not positive.

    Rows carry their exact integer ``total`` (= value * weight), so the
    result is one division of two integer sums.
    """
    keep = _col(weight) > 0
    if value is not None:
        keep = keep & _col(value).isNotNull()
    w = F.sum(F.when(keep, _col(weight)))
    t = F.sum(F.when(keep, _col(total)))
    return F.when(w > 0, t / w)
