"""The funnel from daily bitmaps: distinct counts that roll up.

COUNT(DISTINCT booking) of a week is not the sum of its days'. A set of bookings
can be merged, though: for each (day, hub, stage, trade-in variant) the bookings
are kept as bitmaps over their numbers, 32,768 numbers each, and a week, MTD or
LMTD is the union of its days' bitmaps. One scan of the bookings serves all
windows (R15, R17), and windows that overlap share their days.

Bitmaps combine map-side, in any order; a hub that holds a third of all bookings
is spread over days and ranges of numbers. Each takes 4 KB however few bookings
it holds, so the frame suits hubs with hundreds of bookings a day; for few, the
plain counts of ``funnel`` are smaller.

Bookings without a number are not counted (COUNT DISTINCT leaves out nulls).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cierre.functions import buckets as B
from cierre.functions.dates import in_window, week_of
from cierre.operators import funnel as FN
from cierre.params import Params

KEYS = ["fecha", "hub", "stage", "variant", "bucket"]
#: Marks a hub's sale and cancel days, which give it a row even without any stage.
SEEN = "seen"


def _events_sql() -> str:
    """(stage, day) structs of a booking row: each stage on its own date, approved
    bookings sold or cancelled on both their sale and their cancel date."""
    sale, cancel = "fecha_venta_declarada", "fecha_cancelacion_reserva"
    spec = [("ho", "fecha_handoff", "TRUE"), ("can_no_ho", cancel, "fecha_handoff IS NULL"),
            ("app", "fecha_aprobacion", "TRUE"), ("can_no_app", cancel, "fecha_aprobacion IS NULL")]
    for day in (sale, cancel):
        spec += [("vta_app", day, f"fecha_aprobacion IS NOT NULL AND {sale} IS NOT NULL"),
                 ("cancel_app", day, f"fecha_aprobacion IS NOT NULL AND {cancel} IS NOT NULL"), (SEEN, day, "TRUE")]
    return ", ".join(f"CASE WHEN {col} IS NOT NULL AND {cond} THEN named_struct('stage', '{stage}', 'fecha', {col}) END"
                     for stage, col, cond in spec)


def daily_bitmaps(bookings: DataFrame, lo, hi) -> DataFrame:
    """``KEYS`` and ``bits``: the bookings of each day of ``[lo, hi]``. One scan; the
    range of any event date reaches it."""
    dates = FN.STAGE_DATES + ["fecha_venta_declarada"]
    rows = bookings.filter(f"{FN._base_where()} AND {FN._any_in(dates, lo, hi)} AND booking_id IS NOT NULL")
    events = rows.select(
        "booking_id", B.hub_label().alias("hub"),
        F.expr("array_compact(array('total', CASE WHEN trade_in = 0 THEN 'sales' WHEN trade_in = 1 THEN 'ti' END))").alias("variants"),
        F.explode(F.expr(f"array_compact(array({_events_sql()}))")).alias("e"))
    events = events.select("booking_id", "hub", "e.fecha", "e.stage", F.explode("variants").alias("variant"))
    return events.filter(in_window("fecha", lo, hi)).groupBy(
        "fecha", "hub", "stage", "variant", F.bitmap_bucket_number("booking_id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("booking_id")).alias("bits"))


def days_of(bookings: DataFrame, p: Params) -> DataFrame:
    """The daily bitmaps behind all windows of ``p``."""
    w = p.windows()
    return daily_bitmaps(bookings, min(p.weeks_start, w["mtd"][0], w["lmtd"][0]), p.yesterday)


def merged(days: DataFrame, *more: DataFrame) -> DataFrame:
    """Frames of daily bitmaps as one: a booking that several hold counts once."""
    for other in more:
        days = days.unionByName(other)
    return days.groupBy(*KEYS).agg(F.bitmap_or_agg("bits").alias("bits"))


def _counts(days: DataFrame, group: list, measures: list[str]) -> DataFrame:
    """Distinct bookings by ``group`` as one column for each (stage, variant)."""
    sets = days.groupBy(*group, "stage", "variant", "bucket").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n"))
    keys = [c for c in sets.columns if c not in ("stage", "variant", "bucket", "n")]
    cell = F.concat_ws("_", "stage", "variant")
    return sets.groupBy(*keys).agg(*[F.coalesce(F.sum(F.when(cell == m, F.col("n"))), F.lit(0)).cast("bigint").alias(m) for m in measures])


def funnel_weekly_of(days: DataFrame, p: Params) -> DataFrame:
    """R15 from daily bitmaps."""
    rows = days.filter(in_window("fecha", p.weeks_start, p.yesterday) & F.col("stage").isin(FN.STAGES))
    return _counts(rows, [week_of("fecha").alias("semana"), "hub"], FN.STAGE_MEASURES)


def funnel_period_of(days: DataFrame, p: Params, kind: str) -> DataFrame:
    """R17 from daily bitmaps: ``kind`` is one of ``p.windows()``."""
    return _counts(days.filter(in_window("fecha", *p.windows()[kind])), ["hub"], FN.STAGE_MEASURES + FN.VTA_MEASURES)
