"""Closed rows (P3, P4) and the inventory enrichment joins.

Snapshots are read only before ``as_of`` (a report sees the data as of that
day) and reduced to one row per car, or per (car, day), before any join (Q8), so
no join fans out. Join strategy is left to AQE: the snapshot side grows with the
data, so nothing here is broadcast by hint.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cierre.functions import buckets as B
from cierre.plans.asof import as_of_join
from cierre.sources.schema import BOOKING_DATE_COLUMNS


def sale_date():
    return F.col("fecha_venta_declarada")


def cancel_date():
    return F.col("fecha_cancelacion_reserva")


def is_sale():
    """Sale: a declared sale date."""
    return sale_date().isNotNull()


def is_cancel():
    """Cancel: a cancel date and ``estimate_flag = 1``."""
    return cancel_date().isNotNull() & (F.col("estimate_flag") == 1)


def close_date():
    """The close date, sale first."""
    return F.coalesce(sale_date(), cancel_date())


SNAPSHOT_VALUE_COLUMNS = [
    "real_published_price",
    "flag_coming_soon",
    "pix_financing",
    "pix_cash",
    "item_receipt_date",
    "stock_region",
]


def closed_where(lo: date, hi: date, alias: str = "") -> str:
    """P4 + P3 in SQL: b2b=0 rows that closed (sale, or cancel with
    estimate_flag=1) with close date in ``[lo, hi]``. ``alias`` names the table.

    The close-date range is also stated per column (``sale >= lo OR cancel >=
    lo``), which it implies, because a COALESCE predicate is not pushed to the
    Parquet scan while the per-column form is (survey section 4).
    """
    lo_s, hi_s, t = f"DATE'{lo.isoformat()}'", f"DATE'{hi.isoformat()}'", f"{alias}." if alias else ""
    sale, can = f"{t}fecha_venta_declarada", f"{t}fecha_cancelacion_reserva"
    return (
        f"{t}b2b = 0 AND ({sale} IS NOT NULL OR ({can} IS NOT NULL AND {t}estimate_flag = 1)) "
        f"AND ({sale} >= {lo_s} OR {can} >= {lo_s}) AND ({sale} <= {hi_s} OR {can} <= {hi_s}) "
        f"AND coalesce({sale}, {can}) BETWEEN {lo_s} AND {hi_s}"
    )


def closed_rows(bookings: DataFrame, lo: date, hi: date) -> DataFrame:
    """The closed rows of ``closed_where``; adds ``close_date``, ``venta``, ``cancel``."""
    sale, can = "fecha_venta_declarada", "fecha_cancelacion_reserva"
    return bookings.filter(F.expr(closed_where(lo, hi))).select(
        "*",
        F.expr(f"coalesce({sale}, {can})").alias("close_date"),
        F.expr(f"CAST({sale} IS NOT NULL AS INT)").alias("venta"),
        F.expr(f"CAST({can} IS NOT NULL AND estimate_flag = 1 AS INT)").alias("cancel"),
    )


def recent_rows(bookings: DataFrame, lo: date, hi: date) -> DataFrame:
    """b2b=0 rows with any event date in ``[lo, hi]``: all that reports of that window
    read. The ranges reach the Parquet scan."""
    window = f"BETWEEN DATE'{lo.isoformat()}' AND DATE'{hi.isoformat()}'"
    return bookings.filter("b2b = 0 AND (" + " OR ".join(f"{c} {window}" for c in BOOKING_DATE_COLUMNS) + ")")


def snapshots_before(inventory: DataFrame, as_of: date) -> DataFrame:
    return inventory.filter(F.col("inv_date") < F.lit(as_of))


def first_receipt(inventory: DataFrame, as_of: date) -> DataFrame:
    """A5/J1 right side: first receipt date per car (cars with one only)."""
    return car_facts(snapshots_before(inventory, as_of)).filter("item_receipt_date IS NOT NULL").select(
        "bk_stock", "item_receipt_date")


def latest_stock_region(inventory: DataFrame, as_of: date) -> DataFrame:
    """The region of each car's latest snapshot day with a listed region."""
    return car_facts(snapshots_before(inventory, as_of)).filter("latest_region IS NOT NULL").select(
        "bk_stock", F.col("latest_region").alias("stock_region"))


def _listed_region() -> str:
    names = ", ".join(B.q(n) for n in B.stock_region_names())
    return f"CASE WHEN stock_region IN ({names}) THEN stock_region END"


def _region_rank() -> str:
    """A number that is greater for the regions first by name."""
    return "CASE stock_region " + " ".join(
        f"WHEN {B.q(n)} THEN {-k}" for k, n in enumerate(sorted(B.stock_region_names()))) + " END"


def car_facts(snaps: DataFrame) -> DataFrame:
    """One row per car: its first receipt date (J1) and the region of its latest
    snapshot day that has a listed one (W1; of two on that day the first by name,
    Q9).

    The latest region is the greatest (day, region by falling name): one
    aggregate, without a window sort, that combines map-side.
    """
    return snaps.groupBy("bk_stock").agg(
        F.min("item_receipt_date").alias("item_receipt_date"),
        F.max(F.expr(f"CASE WHEN {_region_rank()} IS NOT NULL THEN struct(inv_date, {_region_rank()} AS k, stock_region) END"))[
            "stock_region"].alias("latest_region"))


def day_facts(snaps: DataFrame, columns: list[str]) -> DataFrame:
    """Exactly one row per (car, day): ``snap``, the day's snapshot (Q8), ``region``,
    its listed region, and ``receipt``, the first receipt date it states.

    Duplicate snapshots keep the row that is smallest in column order
    (``SNAPSHOT_VALUE_COLUMNS``, nulls first); only the prefix of that order that
    covers ``columns`` is carried, which keeps the same row. The aggregate combines
    map-side, so a car with very many rows is small before it moves.
    """
    last = max((SNAPSHOT_VALUE_COLUMNS.index(c) for c in columns), default=-1)
    keep = SNAPSHOT_VALUE_COLUMNS[: last + 1]
    if len(keep) == 1:
        # The same without a struct, which would need sorts: null is the smallest.
        some = F.min(keep[0])
        snap = F.struct(F.when(F.count(keep[0]) == F.count(F.lit(1)), some).alias(keep[0]))
    else:
        snap = F.min(F.struct(*keep) if keep else F.struct(F.lit(1).alias("seen")))
    return snaps.groupBy("bk_stock", "inv_date").agg(
        snap.alias("snap"), F.min(F.expr(_listed_region())).alias("region"), F.min("item_receipt_date").alias("receipt"))


def car_history(snaps: DataFrame, columns: list[str]) -> DataFrame:
    """One row per car with all that reports ask: first receipt, latest listed
    region, and ``days``, a map from each snapshot day to its facts. The map is as
    long as the car's days on the lot, however many rows it has.

    Both aggregates group by the car, so over snapshots stored by car
    (``sources.layout``) neither shuffles.
    """
    return day_facts(snaps, columns).groupBy("bk_stock").agg(
        F.min("receipt").alias("item_receipt_date"),
        F.max(F.expr("CASE WHEN region IS NOT NULL THEN struct(inv_date, region) END"))["region"].alias("latest_region"),
        F.map_from_entries(F.collect_list(F.struct("inv_date", F.struct("snap", "region")))).alias("days"))


def car_regions(snaps: DataFrame) -> DataFrame:
    """One row per car: its first receipt, and ``listed``, the distinct (day, region)
    pairs with a listed region; a set of at most days x regions that combines
    map-side. The greatest pair of a range of days is its latest day's first region
    by name (Q9)."""
    pair = f"CASE WHEN {_region_rank()} IS NOT NULL THEN struct(inv_date, {_region_rank()} AS k, stock_region) END"
    return snaps.groupBy("bk_stock").agg(
        F.min("item_receipt_date").alias("item_receipt_date"), F.collect_set(F.expr(pair)).alias("listed"))


def stock_region_asof(rows: DataFrame, inventory: DataFrame, as_of: date) -> DataFrame:
    """Region on the reservation day, else the day before, else the latest
    known; first non-null wins. Adds ``stock_region_asof``."""
    listed = snapshots_before(inventory, as_of).select(
        "bk_stock", "inv_date", F.expr(_listed_region()).alias("stock_region"), F.expr(_region_rank()).alias("rank"))
    return as_of_join(rows, listed, ("stock_key", "fecha_reserva"), ("bk_stock", "inv_date"), "stock_region", 1,
                      "stock_region_asof", prefer=F.col("rank"), otherwise_latest=True)


def spread_key(alias: str) -> str:
    """The car key for a join. Rows without one match nothing; their booking id
    stands in, so that they don't all go to one task (the join also asks for the
    key, so a stand-in never matches)."""
    return f"coalesce({alias}.stock_key, -1 - CAST({alias}.booking_id AS BIGINT))"
