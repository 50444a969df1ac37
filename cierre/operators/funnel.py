"""Financing funnel R15-R20 (and the P7 month view).

Base rows (survey 2.10): b2b=0, a financing method, estimate_flag=1. Each
stage counts DISTINCT bookings by its own event date; the cancel stages are
cancels of bookings that never reached the stage (P18).

Distinct counts run as two aggregates instead of one COUNT(DISTINCT) per
measure (which would Expand every row 12-18 times): first one row per
(period, hub, stage, booking) with 0/1 trade-in flags, then sums per
(period, hub). The first level is keyed by booking, so a hot hub cannot skew
it; the second combines map-side. Null hubs are one ``null`` key (Q11).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cierre.functions import buckets as B
from cierre.functions.dates import month_key
from cierre.functions.rates import rate, raw_rate
from cierre.operators.sla import week_marks
from cierre.params import Params
from cierre.plans.totals import attach_one_row

STAGES = ["ho", "can_no_ho", "app", "can_no_app"]
VARIANTS = [("total", None), ("sales", 0), ("ti", 1)]
STAGE_MEASURES = [f"{s}_{v}" for s in STAGES for v, _ in VARIANTS]
VTA_MEASURES = [f"{m}_{v}" for m in ("vta_app", "cancel_app") for v, _ in VARIANTS]
# TI modes of the browser: which measure variant each reads.
TI_MODES = [("total", "total"), ("sin_ti", "sales"), ("con_ti", "ti")]


def _d(x) -> str:
    return f"DATE'{x.isoformat()}'"


def _base_where() -> str:
    fin = ", ".join(B.q(m) for m in B.FINANCING_METHODS)
    return f"b2b = 0 AND metodo_de_pago IN ({fin}) AND estimate_flag = 1"


def _any_in(columns: list[str], lo, hi) -> str:
    """Implied row predicate "some event date in [lo, hi]": rows without one
    emit no event, and the per-column ranges reach the Parquet scan."""
    return "(" + " OR ".join(f"{c} BETWEEN {_d(lo)} AND {_d(hi)}" for c in columns) + ")"


STAGE_DATES = ["fecha_handoff", "fecha_aprobacion", "fecha_cancelacion_reserva"]


def _stage_items_sql(lo, hi, period) -> list[str]:
    """(stage, period) structs of a row for the window [lo, hi]; ``period``
    maps the event-date column name to the period SQL."""
    win = lambda c: f"{c} BETWEEN {_d(lo)} AND {_d(hi)}"

    def item(stage, col, cond):
        return (f"CASE WHEN {cond} AND {win(col)} THEN named_struct('stage', '{stage}', "
                f"'period', {period(col)}) END")

    return [
        item("ho", "fecha_handoff", "fecha_handoff IS NOT NULL"),
        item("can_no_ho", "fecha_cancelacion_reserva", "fecha_handoff IS NULL"),
        item("app", "fecha_aprobacion", "fecha_aprobacion IS NOT NULL"),
        item("can_no_app", "fecha_cancelacion_reserva", "fecha_aprobacion IS NULL"),
    ]


def _stage_sums_sql() -> str:
    out = []
    for s in STAGES:
        out += [
            f"COUNT(CASE WHEN stage = '{s}' THEN 1 END) AS {s}_total",
            f"COUNT(CASE WHEN stage = '{s}' AND _t0 = 1 THEN 1 END) AS {s}_sales",
            f"COUNT(CASE WHEN stage = '{s}' AND _t1 = 1 THEN 1 END) AS {s}_ti",
        ]
    return ", ".join(out)


def funnel_weekly(bookings: DataFrame, p: Params) -> DataFrame:
    """R15 (J5): by (event week, hub): 4 stages x (total, sales = no trade-in,
    ti = trade-in) distinct bookings; absent combinations are 0."""
    items = _stage_items_sql(p.weeks_start, p.yesterday, lambda c: f"CAST(date_trunc('week', {c}) AS DATE)")
    sql = f"""
    SELECT semana, hub, {_stage_sums_sql()}
    FROM (
      SELECT t.period AS semana, hub, t.stage AS stage, booking_id,
             MAX(CAST(trade_in = 0 AS INT)) AS _t0, MAX(CAST(trade_in = 1 AS INT)) AS _t1
      FROM (SELECT booking_id, coalesce(reservation_hub_name, '{B.NULL_HUB}') AS hub, trade_in,
                   array_compact(array({", ".join(items)})) AS ev
            FROM {{b}} WHERE {_base_where()} AND {_any_in(STAGE_DATES, p.weeks_start, p.yesterday)})
      LATERAL VIEW explode(ev) e AS t
      GROUP BY t.period, hub, t.stage, booking_id
    )
    GROUP BY semana, hub
    """
    return bookings.sparkSession.sql(sql, b=bookings)


def _vta_flags_sql(also: str = "TRUE", prefix: str = "") -> str:
    """0/1 flags of approved bookings sold and cancelled, where ``also`` holds too."""
    out = []
    for name, date in (("vta_app", "fecha_venta_declarada"), ("cancel_app", "fecha_cancelacion_reserva")):
        for v, t in VARIANTS:
            only = "" if t is None else f" AND trade_in = {t}"
            out.append(f"MAX(CAST({also} AND fecha_aprobacion IS NOT NULL AND {date} IS NOT NULL{only} AS INT)) AS {prefix}{name}_{v}")
    return ", ".join(out)


def funnel_app_sale_weekly(bookings: DataFrame, p: Params) -> DataFrame:
    """By (week of COALESCE(sale, cancel), hub): approved bookings sold
    and approved bookings cancelled (distinct), for rows whose sale or cancel
    falls in the window (Q21: the week itself may fall outside it)."""
    lo, hi = _d(p.weeks_start), _d(p.yesterday)
    sums = ", ".join(f"CAST(SUM({m}) AS BIGINT) AS {m}" for m in VTA_MEASURES)
    sql = f"""
    SELECT semana, hub, {sums}
    FROM (
      SELECT CAST(date_trunc('week', coalesce(fecha_venta_declarada, fecha_cancelacion_reserva)) AS DATE) AS semana,
             coalesce(reservation_hub_name, '{B.NULL_HUB}') AS hub, booking_id, {_vta_flags_sql()}
      FROM {{b}}
      WHERE {_base_where()}
        AND (fecha_venta_declarada BETWEEN {lo} AND {hi} OR fecha_cancelacion_reserva BETWEEN {lo} AND {hi})
      GROUP BY 1, 2, 3
    )
    GROUP BY semana, hub
    """
    return bookings.sparkSession.sql(sql, b=bookings)


def funnel_periods(bookings: DataFrame, p: Params, kinds=("mtd", "lmtd")) -> DataFrame:
    """R17 (J6): by (period, hub): the 12 stage measures and the 6 approved
    sale/cancel measures, 0 where a hub has none (one pass, no outer joins)."""
    w = p.windows()
    items = []
    for k in kinds:
        lo, hi = w[k]
        items += _stage_items_sql(lo, hi, lambda _c, k=k: f"'{k}'")
        sold_or_cancelled = (f"(fecha_venta_declarada BETWEEN {_d(lo)} AND {_d(hi)} "
                             f"OR fecha_cancelacion_reserva BETWEEN {_d(lo)} AND {_d(hi)})")
        items.append(f"CASE WHEN {sold_or_cancelled} THEN named_struct('stage', 'vta', 'period', '{k}') END")
    vta_flags = _vta_flags_sql("t.stage = 'vta'", "_")
    vta_sums = ", ".join(f"CAST(SUM(_{m}) AS BIGINT) AS {m}" for m in VTA_MEASURES)
    lo_all, hi_all = min(w[k][0] for k in kinds), max(w[k][1] for k in kinds)
    sql = f"""
    SELECT period_kind, hub, {_stage_sums_sql()}, {vta_sums}
    FROM (
      SELECT t.period AS period_kind, hub, t.stage AS stage, booking_id,
             MAX(CAST(trade_in = 0 AS INT)) AS _t0, MAX(CAST(trade_in = 1 AS INT)) AS _t1, {vta_flags}
      FROM (SELECT booking_id, coalesce(reservation_hub_name, '{B.NULL_HUB}') AS hub, trade_in,
                   fecha_aprobacion, fecha_venta_declarada, fecha_cancelacion_reserva,
                   array_compact(array({", ".join(items)})) AS ev
            FROM {{b}} WHERE {_base_where()} AND {_any_in(STAGE_DATES + ["fecha_venta_declarada"], lo_all, hi_all)})
      LATERAL VIEW explode(ev) e AS t
      GROUP BY t.period, hub, t.stage, booking_id
    )
    GROUP BY period_kind, hub
    """
    return bookings.sparkSession.sql(sql, b=bookings)


def funnel_period(bookings: DataFrame, p: Params, kind: str) -> DataFrame:
    return funnel_periods(bookings, p, (kind,)).drop("period_kind")


def funnel_by_week_month(weekly: DataFrame) -> DataFrame:
    """Weekly funnel summed by the month of the week's Monday."""
    return weekly.groupBy(month_key("semana").alias("mes"), "hub").agg(
        *[F.sum(m).cast("bigint").alias(m) for m in STAGE_MEASURES]
    )


# ---------------------------------------------------------------------------
# Browser-side reports (R18-R20): the filters become parameters / columns.
# ---------------------------------------------------------------------------
def _long(df: DataFrame, keys: list[str], has: str) -> DataFrame:
    """Rows per TI mode and scope (the hub itself and ``__MX__``) with
    generic columns ho, cnh, app, cna, vta, can."""
    src = {
        "ho": "ho", "cnh": "can_no_ho", "app": "app", "cna": "can_no_app", "vta": "vta_app", "can": "cancel_app",
    }
    modes = []
    for mode, var in TI_MODES:
        fields = [F.lit("ti_mode"), F.lit(mode)]
        for k, base in src.items():
            col = f"{base}_{var}"
            fields += [F.lit(k), F.col(col).cast("bigint") if col in df.columns else F.lit(0).cast("bigint")]
        modes.append(F.named_struct(*fields))
    return df.select(
        *keys,
        F.explode(F.array(F.col("hub"), F.lit(B.COUNTRY_HUB))).alias("scope"),
        F.explode(F.array(*modes)).alias("m"),
        F.lit(1 if has == "f" else 0).alias("_has_f"),
        F.lit(1 if has == "v" else 0).alias("_has_v"),
    ).select(*keys, "scope", "m.*", "_has_f", "_has_v")


def _kpi_from(long: DataFrame, cur: Column, prv: Column, gran: str) -> DataFrame:
    sums = []
    for tag, cond in (("cur", cur), ("prv", prv)):
        for k in ("ho", "cnh", "app", "cna", "vta", "can"):
            sums.append(F.sum(F.when(cond, F.col(k)).otherwise(0)).alias(f"{k}_{tag}"))
    g = long.groupBy("scope", "ti_mode").agg(*sums)
    out = [F.col("scope"), F.col("ti_mode"), F.lit(gran).alias("granularity")]
    for name, n, o in (("ho", "ho", "cnh"), ("app", "app", "cna"), ("vta", "vta", "can")):
        c = raw_rate(F.col(f"{n}_cur"), F.col(f"{n}_cur") + F.col(f"{o}_cur"))
        v = raw_rate(F.col(f"{n}_prv"), F.col(f"{n}_prv") + F.col(f"{o}_prv"))
        out += [c.alias(f"cr_{name}_cur"), v.alias(f"cr_{name}_prv"), (c - v).alias(f"cr_{name}_delta")]
    return g.select(*out)


def funnel_kpi(weekly: DataFrame, vta_weekly: DataFrame, periods: DataFrame, p: Params) -> DataFrame:
    """R18 (A12, W4): the three conversion rates for the current period and
    the previous one, with the delta in points (unrounded, Q2), per scope
    (each hub and ``__MX__``) and TI mode.

    ``semanal`` compares the current week with the last closed week (Q20: with
    no current rows they are the same week); ``mensual`` compares MTD and LMTD,
    both from the one frame of ``funnel_periods``.
    """
    wk = _long(weekly, ["semana"], "f").unionByName(_long(vta_weekly, ["semana"], "v"))
    wk = attach_one_row(wk, week_marks(weekly, p))
    weekly_kpi = _kpi_from(wk, F.col("semana") == F.col("cur_w"), F.col("semana") == F.col("last_w"), "semanal")
    mo = _long(periods, ["period_kind"], "f")
    monthly_kpi = _kpi_from(mo, F.col("period_kind") == "mtd", F.col("period_kind") == "lmtd", "mensual")
    return weekly_kpi.unionByName(monthly_kpi)


def funnel_by_ti(kpi: DataFrame) -> DataFrame:
    """Current-period rates split Sin TI / Con TI (shown in total mode)."""
    split = F.when(F.col("ti_mode") == "sin_ti", F.lit("Sin TI")).otherwise(F.lit("Con TI"))
    return kpi.filter(F.col("ti_mode").isin("sin_ti", "con_ti")).select(
        "scope", "granularity", split.alias("split"),
        F.col("cr_ho_cur").alias("cr_ho"), F.col("cr_app_cur").alias("cr_app"), F.col("cr_vta_cur").alias("cr_vta"),
    )


def funnel_trend(weekly: DataFrame, vta_weekly: DataFrame) -> DataFrame:
    """R19 (A13): rates per time key (week ``yyyy-MM-dd`` or month ``yyyy-MM``
    of the week label, P7), 2 decimals; null where the key has no rows in
    that series or a zero denominator."""
    wk = _long(weekly, ["semana"], "f").unionByName(_long(vta_weekly, ["semana"], "v"))
    keyed = wk.select(
        "*",
        F.explode(
            F.array(
                F.named_struct(F.lit("granularity"), F.lit("semanal"), F.lit("time_key"), F.date_format("semana", "yyyy-MM-dd")),
                F.named_struct(F.lit("granularity"), F.lit("mensual"), F.lit("time_key"), month_key("semana")),
            )
        ).alias("k"),
    ).select("*", "k.granularity", "k.time_key").drop("k")
    g = keyed.groupBy("scope", "ti_mode", "granularity", "time_key").agg(
        *[F.sum(c).alias(c) for c in ("ho", "cnh", "app", "cna", "vta", "can", "_has_f", "_has_v")]
    )
    f, v = F.col("_has_f") > 0, F.col("_has_v") > 0
    return g.select(
        "scope", "ti_mode", "granularity", "time_key",
        F.when(f, rate(F.col("ho"), F.col("ho") + F.col("cnh"), 2)).alias("cr_ho"),
        F.when(f, rate(F.col("app"), F.col("app") + F.col("cna"), 2)).alias("cr_app"),
        F.when(v, rate(F.col("vta"), F.col("vta") + F.col("can"), 2)).alias("cr_vta"),
    )
