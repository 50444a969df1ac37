"""Date buckets (P5, P6, P7) and date literals."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def week_of(d) -> Column:
    """P5: Monday of the ISO week, as DATE."""
    return F.date_trunc("week", _col(d)).cast("date")


def month_key(d) -> Column:
    """``yyyy-MM`` text of a date (for P7, of the week's Monday)."""
    return F.date_format(_col(d), "yyyy-MM")


def in_window(d, lo: date, hi: date) -> Column:
    """Closed range ``lo <= d <= hi`` on DATEs (false when empty)."""
    c = _col(d)
    return (c >= F.lit(lo)) & (c <= F.lit(hi))
