"""KPI reports R9-R14: weekly STR and bookings by hub, profile mix, MTD/LMTD,
daily and last-month measures.

Hubs: a null hub is labelled ``null`` before any grouping (Q11, Q30), so it is
one key everywhere; ``__MX__`` is the country row (A11).
Methods: the KPI measures keep only the three listed methods (P2) except where
the reference counts bookings without a method filter (origin-date legs).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cierre.functions import buckets as B
from cierre.functions.dates import in_window, week_of
from cierre.params import Params
from cierre.plans.totals import with_country_total


def _d(x) -> str:
    return f"DATE'{x.isoformat()}'"


# ------------------------------------------------------------ event legs ----
#: Legs: what a booking counts as, and on which day. ``k`` close (listed methods),
#: ``o`` origin and ``r`` reservation (any method), ``v`` sale, ``e`` delivery,
#: ``d`` return and ``c`` cancel (listed methods; cancels with estimate_flag=1).
SALE = "fecha_venta_declarada IS NOT NULL"
CANCEL = "(fecha_cancelacion_reserva IS NOT NULL AND estimate_flag = 1)"


def _legs() -> dict[str, tuple[str, str]]:
    kpi = f"metodo_de_pago IN ({', '.join(B.q(m) for m in B.KPI_METHODS)})"
    return {
        "k": ("coalesce(fecha_venta_declarada, fecha_cancelacion_reserva)", f"({SALE} OR {CANCEL}) AND {kpi}"),
        "o": ("fecha_origen", "TRUE"),
        "r": ("fecha_reserva", "TRUE"),
        "v": ("fecha_venta_declarada", kpi),
        "e": ("fecha_entrega", kpi),
        "d": ("devolucion_date", kpi),
        "c": ("fecha_cancelacion_reserva", f"{kpi} AND estimate_flag = 1"),
    }


EVENT_KEYS = ["leg", "fecha", "hub", "fin", "cash", "captive", "ef", "sale", "cancel", "perfil"]


def kpi_events(bookings: DataFrame, p: Params, legs: str, lo, hi, daily: bool = False) -> DataFrame:
    """The events of b2b=0 bookings in ``[lo, hi]`` behind R9-R14: ``EVENT_KEYS``
    and how many (``n``).

    One scan: each booking explodes into its legs. ``daily`` counts equal events
    once more, which bounds the frame by days x hubs x a few flags whatever the
    number of bookings; the refresh keeps that one frame for all seven reports.
    A range of any event date is implied, and reaches the Parquet scan.
    """
    spec = {k: v for k, v in _legs().items() if k in legs}
    win = f"BETWEEN {_d(lo)} AND {_d(hi)}"
    items = ", ".join(f"CASE WHEN {cond} AND {col} {win} THEN named_struct('leg', '{k}', 'fecha', {col}) END"
                      for k, (col, cond) in spec.items())
    dates = {col for k, (col, _) in spec.items() if k != "k"}
    if "k" in spec:
        dates |= {"fecha_venta_declarada", "fecha_cancelacion_reserva"}
    implied = " OR ".join(f"{c} {win}" for c in sorted(dates))
    fin = ", ".join(B.q(m) for m in B.FINANCING_METHODS)
    columns = f"""t.leg AS leg, t.fecha AS fecha, coalesce(reservation_hub_name, '{B.NULL_HUB}') AS hub,
      coalesce(metodo_de_pago IN ({fin}), FALSE) AS fin, coalesce(metodo_de_pago = {B.q(B.CASH)}, FALSE) AS cash,
      coalesce(financing_provider = {B.q(B.CAPTIVE_PROVIDER)}, FALSE) AS captive, coalesce(estimate_flag = 1, FALSE) AS ef,
      {SALE} AS sale, coalesce({CANCEL}, FALSE) AS cancel, CASE WHEN t.leg = 'o' THEN perfil END AS perfil"""
    events = bookings.sparkSession.sql(
        f"""SELECT {columns}, 1L AS n
        FROM (SELECT *, array_compact(array({items})) AS ev FROM {{b}} WHERE b2b = 0 AND ({implied}))
        LATERAL VIEW explode(ev) e AS t""", b=bookings)
    return events.groupBy(*EVENT_KEYS).agg(F.sum("n").alias("n")) if daily else events


def daily_events(bookings: DataFrame, p: Params) -> DataFrame:
    """All legs of all windows, counted by day: the one input of R9-R14."""
    lo = min(p.weeks_start, *(w[0] for w in p.windows().values()))
    return kpi_events(bookings, p, "korvedc", lo, p.yesterday, daily=True)


def _n(cond: str, name: str) -> Column:
    return F.expr(f"coalesce(sum(CASE WHEN {cond} THEN n END), 0L)").alias(name)


def _within(events: DataFrame, legs: str, lo, hi) -> DataFrame:
    return events.filter(F.col("leg").isin(*legs) & in_window("fecha", lo, hi))


# --------------------------------------------------------------- R9 ---------
def weekly_hub_str(bookings: DataFrame, p: Params) -> DataFrame:
    """By (week of close date, hub): sales and cancels, total / financing / cash."""
    return weekly_hub_str_of(kpi_events(bookings, p, "k", p.weeks_start, p.yesterday), p)


def weekly_hub_str_of(events: DataFrame, p: Params) -> DataFrame:
    rows = _within(events, "k", p.weeks_start, p.yesterday)
    return rows.groupBy(week_of("fecha").alias("semana"), "hub").agg(
        _n("sale", "ventas_total"), _n("sale AND fin", "ventas_fin"), _n("sale AND cash", "ventas_cash"),
        _n("cancel", "cancel_total"), _n("cancel AND fin", "cancel_fin"), _n("cancel AND cash", "cancel_cash"),
    )


# --------------------------------------------------------------- R10 --------
BOOKINGS_WEEKLY_MEASURES = [
    "reservas_total", "reservas_netas", "reservas_fin", "reservas_cash", "reservas_netas_fin",
    "reservas_netas_cash", "ventas_total", "ventas_fin", "ventas_cash", "cancel_total", "cancel_fin",
    "cancel_cash",
]


def bookings_weekly(bookings: DataFrame, p: Params) -> DataFrame:
    """By (week, hub): gross bookings by reservation week, net
    bookings and their sales/cancels by origin week.

    Both legs in one aggregate; only (week, hub) pairs with an origin row are
    kept (Q16: the reference's left join drops gross-only pairs).
    """
    return bookings_weekly_of(kpi_events(bookings, p, "or", p.weeks_start, p.yesterday), p)


def bookings_weekly_of(events: DataFrame, p: Params) -> DataFrame:
    o, r = "leg = 'o'", "leg = 'r'"
    g = _within(events, "or", p.weeks_start, p.yesterday).groupBy(week_of("fecha").alias("semana"), "hub").agg(
        _n(o, "_has_origin"),
        _n(r, "reservas_total"), _n(f"{r} AND fin", "reservas_fin"), _n(f"{r} AND cash", "reservas_cash"),
        _n(f"{o} AND ef", "reservas_netas"), _n(f"{o} AND ef AND fin", "reservas_netas_fin"),
        _n(f"{o} AND ef AND cash", "reservas_netas_cash"),
        _n(f"{o} AND sale", "ventas_total"), _n(f"{o} AND sale AND fin", "ventas_fin"),
        _n(f"{o} AND sale AND cash", "ventas_cash"),
        _n(f"{o} AND cancel", "cancel_total"), _n(f"{o} AND cancel AND fin", "cancel_fin"),
        _n(f"{o} AND cancel AND cash", "cancel_cash"),
    )
    return g.filter(F.col("_has_origin") > 0).select("semana", "hub", *BOOKINGS_WEEKLY_MEASURES)


# --------------------------------------------------------------- R11 --------
def profile_mix_weekly(bookings: DataFrame, p: Params) -> DataFrame:
    """Net bookings by (origin week, hub) split by credit profile."""
    return profile_mix_weekly_of(kpi_events(bookings, p, "o", p.weeks_start, p.yesterday), p)


def profile_mix_weekly_of(events: DataFrame, p: Params) -> DataFrame:
    known = f"(perfil IS NOT NULL AND perfil <> {B.q(B.PROFILE_REVIEW)})"
    rows = _within(events, "o", p.weeks_start, p.yesterday).filter("ef")
    return rows.groupBy(week_of("fecha").alias("semana"), "hub").agg(
        _n("TRUE", "reservas_total"), _n(known, "n_perfilados"), _n("perfil = 'X'", "n_x"), _n("perfil = 'A'", "n_a"),
        _n("perfil = 'B'", "n_b"), _n("perfil = 'C'", "n_c"), _n("perfil = 'Z_R'", "n_zr"), _n(f"NOT {known}", "n_sin_perfil"),
    )


# --------------------------------------------------------------- R12 --------
KPI_PERIOD_MEASURES = [
    "ventas_total", "ventas_fin", "ventas_cash", "cancel_total", "cancel_fin", "cancel_cash",
    "reservas_total", "reservas_fin", "reservas_cash", "reservas_netas", "reservas_netas_fin",
    "reservas_netas_cash",
]


def kpi_periods(bookings: DataFrame, p: Params, kinds=("mtd", "lmtd")) -> DataFrame:
    """R12 (U1 + A11): per period and hub (plus ``__MX__``): sales/cancels
    by close date (listed methods) and bookings by origin date (any method).

    The reference runs a two-leg UNION ALL per period; here every event is
    tagged with the periods it belongs to and one aggregate serves them all.
    """
    w = p.windows()
    lo, hi = min(w[k][0] for k in kinds), max(w[k][1] for k in kinds)
    return kpi_periods_of(kpi_events(bookings, p, "ko", lo, hi), p, kinds)


def kpi_periods_of(events: DataFrame, p: Params, kinds=("mtd", "lmtd")) -> DataFrame:
    w = p.windows()
    tags = ", ".join(f"CASE WHEN fecha BETWEEN {_d(w[k][0])} AND {_d(w[k][1])} THEN '{k}' END" for k in kinds)
    rows = events.filter("leg IN ('k', 'o')").withColumn("period_kind", F.explode(F.expr(f"array_compact(array({tags}))")))
    c, o = "leg = 'k'", "leg = 'o'"
    g = rows.groupBy("period_kind", "hub").agg(
        _n(f"{c} AND sale", "ventas_total"), _n(f"{c} AND sale AND fin", "ventas_fin"),
        _n(f"{c} AND sale AND cash", "ventas_cash"), _n(f"{c} AND cancel", "cancel_total"),
        _n(f"{c} AND cancel AND fin", "cancel_fin"), _n(f"{c} AND cancel AND cash", "cancel_cash"),
        _n(o, "reservas_total"), _n(f"{o} AND fin", "reservas_fin"), _n(f"{o} AND cash", "reservas_cash"),
        _n(f"{o} AND ef", "reservas_netas"), _n(f"{o} AND ef AND fin", "reservas_netas_fin"),
        _n(f"{o} AND ef AND cash", "reservas_netas_cash"),
    )
    return with_country_total(g, ["period_kind"], "hub", KPI_PERIOD_MEASURES)


def kpi_period(bookings: DataFrame, p: Params, kind: str) -> DataFrame:
    return kpi_periods(bookings, p, (kind,)).drop("period_kind")


# --------------------------------------------------------------- R13/R14 ----
DAILY_MEASURES = [
    "ventas_total", "ventas_fin", "ventas_cash", "ventas_captive", "cancel_total", "cancel_fin", "cancel_cash",
    "reservas_netas", "reservas_netas_fin", "reservas_netas_cash", "entregas_brutas", "entregas_netas",
    "entregas_fin", "entregas_cash", "entregas_captive",
]
LAST_MONTH_MEASURES = [
    "ventas_total", "ventas_fin", "ventas_cash", "ventas_captive", "entregas_brutas", "entregas_netas",
    "entregas_fin", "entregas_captive",
]


def _leg_counts(events: DataFrame, lo, hi, legs: str, keys: list[str]) -> DataFrame:
    """Events in ``[lo, hi]`` counted per ``keys`` (``fecha`` and/or ``hub``) in
    one aggregate; each leg keeps its own filter, as the five reference queries do.
    ``_live`` counts rows of any leg but returns (row presence, Q17/Q18),
    ``_ve`` rows of sales or deliveries.
    """
    v, e, c, o = (f"leg = '{x}'" for x in "veco")
    return _within(events, legs, lo, hi).groupBy(*keys).agg(
        _n(v, "ventas_total"), _n(f"{v} AND fin", "ventas_fin"), _n(f"{v} AND cash", "ventas_cash"),
        _n(f"{v} AND captive", "ventas_captive"),
        _n(e, "entregas_brutas"), _n(f"{e} AND fin", "entregas_fin"), _n(f"{e} AND cash", "entregas_cash"),
        _n(f"{e} AND captive", "entregas_captive"), _n("leg = 'd'", "devoluciones"),
        _n(c, "cancel_total"), _n(f"{c} AND fin", "cancel_fin"), _n(f"{c} AND cash", "cancel_cash"),
        _n(f"{o} AND ef", "reservas_netas"), _n(f"{o} AND ef AND fin", "reservas_netas_fin"),
        _n(f"{o} AND ef AND cash", "reservas_netas_cash"),
        _n("leg <> 'd'", "_live"), _n("leg IN ('v', 'e')", "_ve"),
    )


def _net(eb: str = "entregas_brutas", dev: str = "devoluciones") -> Column:
    return F.greatest(F.lit(0).cast("bigint"), F.col(eb) - F.col(dev)).alias("entregas_netas")


def daily_hub(bookings: DataFrame, p: Params) -> DataFrame:
    """R13 (J7, A11): last 45 days by (date, hub) plus a ``__MX__`` row per date.

    Dates: those with a sale, delivery, cancel or booking row (returns alone
    do not make a date). Hub rows: hubs that sell or deliver somewhere in the
    window, on dates where they have a sale, delivery, cancel or booking row
    (Q17, Q18: presence depends on rows, not counts). ``entregas_netas`` is
    ``max(0, deliveries - returns)``, for the country from its own sums.

    The (date, hub) aggregate is consumed once: grouping sets over it add
    the per-date country rows, a window over hub marks the selling hubs.
    """
    return daily_hub_of(kpi_events(bookings, p, "vedco", p.daily_start, p.daily_end), p)


def daily_hub_of(events: DataFrame, p: Params) -> DataFrame:
    g = _leg_counts(events, p.daily_start, p.daily_end, "vedco", ["fecha", "hub"])
    sums = [c for c in g.columns if c not in ("fecha", "hub")]
    t = g.groupingSets([["fecha", "hub"], ["fecha"]], "fecha", "hub").agg(
        *[F.sum(c).alias(c) for c in sums], F.grouping("hub").alias("_gt")
    )
    seller = F.max(F.when(F.col("_gt") == 0, F.col("_ve"))).over(Window.partitionBy("_gt", "hub"))
    t = t.withColumn("_seller", seller)
    keep = (F.col("_live") > 0) & ((F.col("_gt") == 1) | (F.col("_seller") > 0))
    hub = F.when(F.col("_gt") == 1, F.lit(B.COUNTRY_HUB)).otherwise(F.col("hub")).alias("hub")
    cols = [F.col(c) if c != "entregas_netas" else _net() for c in DAILY_MEASURES]
    return t.filter(keep).select("fecha", hub, *cols)


def last_month_hub(bookings: DataFrame, p: Params) -> DataFrame:
    """R14 (J8, A11): previous calendar month by hub plus ``__MX__``.

    Hubs with a sale or delivery appear; returns count in the country net
    deliveries even for hubs without either. The country row comes from
    grouping sets over the small hub-level aggregate (none for empty input).
    """
    return last_month_hub_of(kpi_events(bookings, p, "ved", p.last_month_start, p.last_month_end), p)


def last_month_hub_of(events: DataFrame, p: Params) -> DataFrame:
    g = _leg_counts(events, p.last_month_start, p.last_month_end, "ved", ["hub"])
    sums = ["ventas_total", "ventas_fin", "ventas_cash", "ventas_captive", "entregas_brutas", "entregas_fin",
            "entregas_captive", "devoluciones", "_ve"]
    t = g.groupingSets([["hub"], []], "hub").agg(*[F.sum(c).alias(c) for c in sums], F.grouping("hub").alias("_gt"))
    hub = F.when(F.col("_gt") == 1, F.lit(B.COUNTRY_HUB)).otherwise(F.col("hub")).alias("hub")
    cols = [F.col(c) if c != "entregas_netas" else _net() for c in LAST_MONTH_MEASURES]
    return t.filter(F.col("_ve") > 0).select(hub, *cols)
