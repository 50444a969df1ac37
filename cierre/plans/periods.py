"""Period tagging (survey 2.9).

A row falls into zero or more periods; each tag is a
``struct(period_kind, period)`` where a literal window holds the row's date, so
one ``explode`` replaces one query per period and no join is needed at all (the
windows are parameters, not data).
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cierre.params import Params



def _iso(x: date) -> str:
    return f"DATE'{x.isoformat()}'"


def _tag_sql(kind: str, period_sql: str, cond_sql: str) -> str:
    return (f"CASE WHEN {cond_sql} THEN named_struct('period_kind', '{kind}', 'period', "
            f"CAST({period_sql} AS DATE)) END")


def weekly_tags_sql(d: str, p: Params) -> list[str]:
    """Closed week, WTD and LWTD tags of a close date (Q3: WTD ends yesterday), as
    one expression string each. Weeks after the current one never occur since rows
    end at ``as_of - 1``."""
    ws = _iso(p.weeks_start)
    return [
        _tag_sql("week", f"date_trunc('week', {d})", f"{d} >= {ws} AND {d} < {_iso(p.wtd_start)}"),
        _tag_sql("wtd", _iso(p.wtd_start), f"{d} >= {ws} AND {d} BETWEEN {_iso(p.wtd_start)} AND {_iso(p.wtd_end)}"),
        _tag_sql("lwtd", _iso(p.lwtd_start), f"{d} BETWEEN {_iso(p.lwtd_start)} AND {_iso(p.lwtd_end)}"),
    ]


def monthly_tags_sql(d: str, p: Params) -> list[str]:
    return [_tag_sql("month", f"date_trunc('month', {d})",
                     f"{d} BETWEEN {_iso(p.months_start)} AND {_iso(p.yesterday)}")]


def period_label(lo: date, hi: date) -> str:
    """``d/m–d/m`` label of a window (the reference's WTD/MTD labels)."""
    return f"{lo.day}/{lo.month}–{hi.day}/{hi.month}"


def period_table(df: DataFrame, p: Params) -> DataFrame:
    """The literal period table ``(period_kind, lo, hi, label)`` as a small
    DataFrame in the session of ``df``. Empty windows keep their row."""
    from cierre.plans.totals import literal_rows

    rows = []
    for kind, (lo, hi) in p.windows().items():
        label = "—" if hi < lo else period_label(lo, hi)
        rows.append((kind, lo, hi, label))
    schema = [("period_kind", "string"), ("lo", "date"), ("hi", "date"), ("label", "string")]
    return literal_rows(df.sparkSession, rows, schema)


#: Days of a bin of ``with_periods``.
BIN_DAYS = 28


def with_periods(rows: DataFrame, day: str, periods: DataFrame, bin_days: int = BIN_DAYS) -> DataFrame:
    """Each row of ``rows`` once for each period that holds its DATE ``day``, with
    the columns of ``periods``; ``[lo, hi]`` are its first and last day, of any
    table of periods, overlapping or not.

    A range join through bins of days: a period stands in every bin that it
    touches, a row in one, and both meet by an equality join on the bin, so a date
    is compared with the periods of its bin only. Rows without day and empty
    periods (``hi < lo``, or null) match nothing.
    """
    epoch = F.lit("1970-01-01").cast("date")
    of = lambda c: F.floor(F.datediff(F.col(c), epoch) / bin_days).cast("int")
    binned = periods.filter("lo <= hi").select("*", F.explode(F.sequence(of("lo"), of("hi"))).alias("_bin"))
    placed = rows.filter(F.col(day).isNotNull()).withColumn("_bin", of(day))
    joined = placed.alias("r").join(binned.alias("p"), "_bin").filter(F.col(f"r.{day}").between(F.col("p.lo"), F.col("p.hi")))
    return joined.select(*[F.col(f"r.{c}") for c in rows.columns], *[F.col(f"p.{c}") for c in periods.columns])
