"""Country totals (A11) and a one-row attachment helper."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cierre.functions.buckets import COUNTRY_HUB


def with_country_total(df: DataFrame, keys: list[str], hub: str, measures: list[str]) -> DataFrame:
    """Add, per ``keys``, a ``__MX__`` row summing ``measures`` over hubs.

    Runs ``GROUPING SETS ((keys, hub), (keys))`` over the already
    hub-level frame (the Expand stays off the raw rows); ``grouping(hub)``
    tells the total row from a hub that is itself null. No total row is made
    for an empty input.
    """
    aggs = [F.sum(m).alias(m) for m in measures]
    sets = [[*keys, hub], [*keys]] if keys else [[hub], []]
    g = df.groupingSets(sets, *keys, hub).agg(*aggs, F.grouping(hub).alias("_gt"))
    return g.withColumn(hub, F.when(F.col("_gt") == 1, F.lit(COUNTRY_HUB)).otherwise(F.col(hub))).drop("_gt")


def attach_one_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row frame (global aggregate results such
    as "last closed week") to every row of ``df``.

    The one-row side is a global aggregate, of one row at any size of the data; it
    is a scalar subquery, computed once and then a constant to every task.
    """
    row = one_row.select(F.struct("*").alias("row")).scalar()
    return df.select("*", *[row[c].alias(c) for c in one_row.columns])


def _sql_literal(v, t: str) -> str:
    from datetime import date

    if v is None:
        return f"CAST(NULL AS {t})"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, date):
        return f"DATE'{v.isoformat()}'"
    if isinstance(v, (int, float)):
        return f"CAST({v!r} AS {t})"
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def literal_rows(spark, rows: list[tuple], schema: list[tuple[str, str]]):
    """A small literal table (parameters such as periods and labels, never
    data): ``VALUES`` plans as a local relation in the JVM, with no Python
    RDD behind it and no Python workers at execution."""
    names = ", ".join(n for n, _ in schema)
    casts = ", ".join(f"CAST({n} AS {t}) AS {n}" for n, t in schema)
    if not rows:
        nulls = ", ".join(f"CAST(NULL AS {t}) AS {n}" for n, t in schema)
        return spark.sql(f"SELECT {nulls} WHERE FALSE")
    values = ", ".join(
        "(" + ", ".join(_sql_literal(v, t) for v, (_, t) in zip(r, schema)) + ")" for r in rows
    )
    return spark.sql(f"SELECT {casts} FROM VALUES {values} AS t({names})")
