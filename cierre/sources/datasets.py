"""Derived input datasets of survey 1.4 (their producers are not in the
reference; definitions follow the labels that read them).

All three come from bookings with the funnel base filter (b2b=0, financing
method, estimate_flag=1) and carry ``semana`` (Monday), ``hub`` (null
labelled ``null``) and ``ti_flag`` (``con_ti`` / ``sin_ti``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cierre.functions import buckets as B
from cierre.functions.dates import in_window, week_of
from cierre.params import Params

# SLA stages: (name, start column, end column); grouped by the week of the END.
SLA_STAGES = [
    ("res_ho", "fecha_reserva", "fecha_handoff"),
    ("ho_app", "fecha_handoff", "fecha_aprobacion"),
    ("res_vta", "fecha_reserva", "fecha_venta_declarada"),
]


def _base(bookings: DataFrame) -> DataFrame:
    return bookings.filter((F.col("b2b") == 0) & B.is_financing() & (F.col("estimate_flag") == 1))


def sla_dataset(bookings: DataFrame, p: Params) -> DataFrame:
    """Mean days per stage by week of the stage's end event.

    Columns ``stage, semana, hub, ti_flag, sla, n, days``: ``n`` rows with both
    dates, ``days`` their summed day difference, ``sla = days / n``.
    """
    items = [
        F.when(
            F.col(start).isNotNull() & in_window(end, p.weeks_start, p.yesterday),
            F.named_struct(F.lit("stage"), F.lit(name), F.lit("semana"), week_of(end),
                           F.lit("days"), F.datediff(F.col(end), F.col(start))),
        )
        for name, start, end in SLA_STAGES
    ]
    implied = None
    for _, _, end in SLA_STAGES:
        c = in_window(end, p.weeks_start, p.yesterday)
        implied = c if implied is None else implied | c
    ev = _base(bookings).filter(implied).select(
        B.hub_label().alias("hub"), B.ti_flag().alias("ti_flag"),
        F.explode(F.filter(F.array(*items), lambda x: x.isNotNull())).alias("t"),
    )
    g = ev.groupBy(F.col("t.stage").alias("stage"), F.col("t.semana").alias("semana"), "hub", "ti_flag").agg(
        F.count(F.lit(1)).alias("n"), F.sum("t.days").cast("bigint").alias("days")
    )
    return g.withColumn("sla", F.col("days") / F.col("n")).select("stage", "semana", "hub", "ti_flag", "sla", "n", "days")


VERDICT_SCHEMA = "booking_id bigint, dictamen string, event_time timestamp, event_id bigint"
PAYMENT_SCHEMA = "booking_id bigint, payment_id bigint, paid_on timestamp, amount double"


def first_verdicts(events: DataFrame) -> DataFrame:
    """The first verdict of each booking from a log of verdict events
    (``VERDICT_SCHEMA``): the earliest by time, of several at one time the one with
    the smallest event id, then the first by name. Events without a verdict are
    none; those without time, or id, come after those with one. One aggregate that
    combines map-side, so a booking with very many events is small before it moves."""
    order = F.struct(F.col("event_time").isNull(), F.col("event_time"), F.col("event_id").isNull(), F.col("event_id"), F.col("dictamen"))
    return events.filter("booking_id IS NOT NULL AND dictamen IS NOT NULL").groupBy("booking_id").agg(
        F.min_by("dictamen", order).alias("dictamen"))


def first_payments(payments: DataFrame) -> DataFrame:
    """``booking_id, amount``: the first payment of each booking by time, ties by
    payment id, then the smaller amount (``PAYMENT_SCHEMA``). A payment without
    amount or time is none."""
    order = F.struct(F.col("paid_on"), F.col("payment_id").isNull(), F.col("payment_id"), F.col("amount"))
    known = payments.filter("booking_id IS NOT NULL AND paid_on IS NOT NULL AND amount IS NOT NULL")
    return known.groupBy("booking_id").agg(F.min_by("amount", order).alias("amount"))


def verdict_dataset(bookings: DataFrame, verdicts: DataFrame, p: Params) -> DataFrame:
    """R23 input: distinct bookings per (reservation week, hub, ti_flag,
    verdict). ``verdicts``: the log of verdict events, of which each booking's first
    counts; a booking without one has none (null)."""
    b = _base(bookings).filter(in_window("fecha_reserva", p.weeks_start, p.yesterday))
    keyed = b.select(
        week_of("fecha_reserva").alias("semana"), B.hub_label().alias("hub"), B.ti_flag().alias("ti_flag"), "booking_id",
    ).distinct()
    return keyed.join(first_verdicts(verdicts), "booking_id", "left").groupBy("semana", "hub", "ti_flag", "dictamen").agg(
        F.count(F.lit(1)).alias("n"))


PROFILE_STAGES = ["n_ho", "n_cancel_no_ho", "n_app", "n_cancel_no_app", "n_vta", "n_cancel_after_app"]


def profile_dataset(bookings: DataFrame, p: Params) -> DataFrame:
    """R25 input: distinct bookings per (event week, hub, ti_flag, perfil)
    and stage, each stage by its own event date (Q14: as the general funnel).
    ``n_vta`` / ``n_cancel_after_app``: approved bookings sold / cancelled."""
    ho, app = F.col("fecha_handoff"), F.col("fecha_aprobacion")
    sale, can = F.col("fecha_venta_declarada"), F.col("fecha_cancelacion_reserva")
    spec = [
        ("n_ho", ho, ho.isNotNull()),
        ("n_cancel_no_ho", can, ho.isNull()),
        ("n_app", app, app.isNotNull()),
        ("n_cancel_no_app", can, app.isNull()),
        ("n_vta", sale, app.isNotNull()),
        ("n_cancel_after_app", can, app.isNotNull()),
    ]
    items = [
        F.when(cond & in_window(dt, p.weeks_start, p.yesterday),
               F.named_struct(F.lit("stage"), F.lit(name), F.lit("semana"), week_of(dt)))
        for name, dt, cond in spec
    ]
    implied = None
    for _, dt, _ in spec:
        c = in_window(dt, p.weeks_start, p.yesterday)
        implied = c if implied is None else implied | c
    ev = _base(bookings).filter(implied).select(
        "booking_id", B.hub_label().alias("hub"), B.ti_flag().alias("ti_flag"), "perfil",
        F.explode(F.filter(F.array(*items), lambda x: x.isNotNull())).alias("t"),
    ).select("booking_id", "hub", "ti_flag", "perfil", F.col("t.stage").alias("stage"), F.col("t.semana").alias("semana"))
    keys = ["semana", "hub", "ti_flag", "perfil"]
    l1 = ev.select(*keys, "stage", "booking_id").distinct()
    return l1.groupBy(*keys).agg(*[F.count(F.when(F.col("stage") == s, 1)).alias(s) for s in PROFILE_STAGES])
