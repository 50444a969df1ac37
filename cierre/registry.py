"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator of survey section 2, run on the fixture views with FIXTURE_PARAMS."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from cierre.params import FIXTURE_PARAMS as P
from cierre.params import Params
from cierre.session import cut_lineage
from cierre.sources import layout as L
from cierre.sources.fixtures import fixture_bookings, fixture_campaigns, fixture_inventory, fixture_payments, fixture_verdicts

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn

    return deco


def _b(spark, sf):
    return fixture_bookings(spark, sf)


def _i(spark, sf):
    return fixture_inventory(spark, sf)


# ---------------------------------------------------------------- dims ------
from cierre.operators import dims as D  # noqa: E402

_DIM_KEYS = {
    "region": "str_region",
    "aging": "str_aging",
    "price": "str_price",
    "coming_soon": "str_coming_soon",
    "pix": "str_pix",
    "stock_region": "str_stock_region",
}


def _dim_query(dim, grain):
    def q(spark, sf):
        return D.str_report(_b(spark, sf), _i(spark, sf), P, dim, grain)

    return q


for _dim, _key in _DIM_KEYS.items():
    REGISTRY[f"{_key}_weekly"] = _dim_query(_dim, "week")
    REGISTRY[f"{_key}_monthly"] = _dim_query(_dim, "month")


@register("dim_report_all")
def _q_dim_report_all(spark, sf):
    """All twelve dimension reports in one pass (the long-form API)."""
    return D.report(_b(spark, sf), _i(spark, sf), P)


@register("dim_report_wide")
def _q_dim_report_wide(spark, sf):
    """Every week of six years: the closed rows of nearly the whole table."""
    return D.report(_b(spark, sf), _i(spark, sf), Params(as_of=P.as_of, weeks_start=date(1995, 1, 2)), grains=["week"])


@register("dim_report_monday")
def _q_dim_report_monday(spark, sf):
    """A refresh on a Monday: the week to date is empty (Q3)."""
    return D.report(_b(spark, sf), _i(spark, sf), Params(as_of=date(2001, 4, 23), weeks_start=P.weeks_start))


@register("dim_report_stored")
def _q_dim_report_stored(spark, sf):
    """All dimension reports over snapshots that are stored by car."""
    import uuid

    table = f"cierre_snapshots_{uuid.uuid4().hex[:8]}"
    L.write_snapshots(_i(spark, sf), table, int(spark.conf.get("spark.sql.shuffle.partitions")))
    out = cut_lineage(D.report(_b(spark, sf), L.read_snapshots(spark, table), P, stored_by_car=True))
    spark.sql(f"DROP TABLE {table}")
    return out


@register("dim_report_pruned")
def _q_dim_report_pruned(spark, sf):
    """All dimension reports over snapshots that a Bloom filter has cut; the filter
    is small, so that it lets many others through."""
    return D.report(_b(spark, sf), _i(spark, sf), P, prune=True, words=1 << 10)


@register("str_payment_weekly")
def _q_str_payment_weekly(spark, sf):
    return D.str_report(_b(spark, sf), _i(spark, sf), P, "payment", payments=fixture_payments(spark, sf))


@register("str_payment_monthly")
def _q_str_payment_monthly(spark, sf):
    return D.str_report(_b(spark, sf), _i(spark, sf), P, "payment", "month", payments=fixture_payments(spark, sf))


@register("payment_split")
def _q_payment_split(spark, sf):
    return D.payment_split(_b(spark, sf), fixture_payments(spark, sf), P)


@register("str_region_weekly_first")
def _q_str_region_weekly_first(spark, sf):
    """A refresh on the 1st (Q12)."""
    return D.str_report(_b(spark, sf), _i(spark, sf), Params(as_of=date(2001, 4, 1), weeks_start=P.weeks_start), "region")


@register("str_region_weekly_last")
def _q_str_region_weekly_last(spark, sf):
    """A refresh on the 31st (Q13)."""
    return D.str_report(_b(spark, sf), _i(spark, sf), Params(as_of=date(2001, 3, 31), weeks_start=P.weeks_start), "region")


# ---------------------------------------------------------------- kpis ------
from cierre.operators import kpis as K  # noqa: E402


@register("weekly_hub_str")
def _q_weekly_hub_str(spark, sf):
    return K.weekly_hub_str(_b(spark, sf), P)


@register("bookings_weekly")
def _q_bookings_weekly(spark, sf):
    return K.bookings_weekly(_b(spark, sf), P)


@register("profile_mix_weekly")
def _q_profile_mix_weekly(spark, sf):
    return K.profile_mix_weekly(_b(spark, sf), P)


@register("kpi_mtd")
def _q_kpi_mtd(spark, sf):
    return K.kpi_period(_b(spark, sf), P, "mtd")


@register("kpi_lmtd")
def _q_kpi_lmtd(spark, sf):
    return K.kpi_period(_b(spark, sf), P, "lmtd")


@register("daily_hub")
def _q_daily_hub(spark, sf):
    return K.daily_hub(_b(spark, sf), P)


@register("last_month_hub")
def _q_last_month_hub(spark, sf):
    return K.last_month_hub(_b(spark, sf), P)


# ---------------------------------------------------------------- funnel ----
from cierre.operators import funnel as FN  # noqa: E402


@register("funnel_weekly")
def _q_funnel_weekly(spark, sf):
    return FN.funnel_weekly(_b(spark, sf), P)


@register("funnel_app_sale_weekly")
def _q_funnel_app_sale_weekly(spark, sf):
    return FN.funnel_app_sale_weekly(_b(spark, sf), P)


@register("funnel_mtd")
def _q_funnel_mtd(spark, sf):
    return FN.funnel_period(_b(spark, sf), P, "mtd")


@register("funnel_lmtd")
def _q_funnel_lmtd(spark, sf):
    return FN.funnel_period(_b(spark, sf), P, "lmtd")


from cierre.operators import funnel_days as FD  # noqa: E402


@register("funnel_weekly_from_days")
def _q_funnel_weekly_from_days(spark, sf):
    """The weekly funnel as unions of daily bitmaps."""
    return FD.funnel_weekly_of(FD.days_of(_b(spark, sf), P), P)


@register("funnel_mtd_from_days")
def _q_funnel_mtd_from_days(spark, sf):
    return FD.funnel_period_of(FD.days_of(_b(spark, sf), P), P, "mtd")


@register("funnel_lmtd_from_days")
def _q_funnel_lmtd_from_days(spark, sf):
    return FD.funnel_period_of(FD.days_of(_b(spark, sf), P), P, "lmtd")


@register("funnel_by_week_month")
def _q_funnel_by_week_month(spark, sf):
    return FN.funnel_by_week_month(FN.funnel_weekly(_b(spark, sf), P))


def _funnel_inputs(spark, sf):
    """The three funnel frames, each built once: they are small, and read again."""
    b = _b(spark, sf)
    return tuple(cut_lineage(df) for df in (FN.funnel_weekly(b, P), FN.funnel_app_sale_weekly(b, P), FN.funnel_periods(b, P)))


@register("funnel_kpi")
def _q_funnel_kpi(spark, sf):
    return FN.funnel_kpi(*_funnel_inputs(spark, sf), P)


@register("funnel_by_ti")
def _q_funnel_by_ti(spark, sf):
    return FN.funnel_by_ti(FN.funnel_kpi(*_funnel_inputs(spark, sf), P))


@register("funnel_trend")
def _q_funnel_trend(spark, sf):
    b = _b(spark, sf)
    return FN.funnel_trend(FN.funnel_weekly(b, P), FN.funnel_app_sale_weekly(b, P))


# ---------------------------------------------------------------- sla, verdict, profile
from cierre.operators import profile as PF  # noqa: E402
from cierre.operators import sla as SL  # noqa: E402
from cierre.operators import verdict as VD  # noqa: E402
from cierre.sources import datasets as DS  # noqa: E402


@register("sla_weekly")
def _q_sla_weekly(spark, sf):
    return DS.sla_dataset(_b(spark, sf), P)


@register("sla_kpi")
def _q_sla_kpi(spark, sf):
    return SL.sla_kpi(DS.sla_dataset(_b(spark, sf), P), P)


@register("sla_trend")
def _q_sla_trend(spark, sf):
    return SL.sla_trend(DS.sla_dataset(_b(spark, sf), P))


def _verdicts(spark, sf):
    b = _b(spark, sf)
    return DS.verdict_dataset(b, fixture_verdicts(b), P)


@register("first_verdict")
def _q_first_verdict(spark, sf):
    return DS.first_verdicts(fixture_verdicts(_b(spark, sf)))


@register("first_payment")
def _q_first_payment(spark, sf):
    return DS.first_payments(fixture_payments(spark, sf))


@register("verdict_dataset")
def _q_verdict_dataset(spark, sf):
    return _verdicts(spark, sf)


@register("verdict_mix")
def _q_verdict_mix(spark, sf):
    return VD.verdict_mix(_verdicts(spark, sf))


@register("verdict_approved_kpi")
def _q_verdict_approved_kpi(spark, sf):
    return VD.verdict_approved_kpi(_verdicts(spark, sf), P)


@register("profile_dataset")
def _q_profile_dataset(spark, sf):
    return DS.profile_dataset(_b(spark, sf), P)


@register("profile_funnel")
def _q_profile_funnel(spark, sf):
    return PF.profile_funnel(cut_lineage(DS.profile_dataset(_b(spark, sf), P)), P)


# ---------------------------------------------------------------- building blocks
from pyspark.sql import functions as F  # noqa: E402

from cierre.functions import buckets as B  # noqa: E402
from cierre.operators import qa as QA  # noqa: E402
from cierre.plans import enrich as E  # noqa: E402
from cierre.plans.periods import period_table, with_periods  # noqa: E402


@register("src_bookings")
def _q_src_bookings(spark, sf):
    return _b(spark, sf)


@register("src_inventory")
def _q_src_inventory(spark, sf):
    return _i(spark, sf)


@register("method_norm")
def _q_method_norm(spark, sf):
    b = _b(spark, sf).filter(F.col("b2b") == 0)
    return b.groupBy(F.col("metodo_de_pago").alias("metodo_de_pago_raw")).agg(F.count(F.lit(1)).alias("n")).select(
        "metodo_de_pago_raw", B.method_norm("metodo_de_pago_raw").alias("metodo_de_pago"),
        F.coalesce(B.is_kpi_method("metodo_de_pago_raw"), F.lit(False)).alias("kpi_method"), "n",
    )


@register("closed_rows")
def _q_closed_rows(spark, sf):
    return E.closed_rows(_b(spark, sf), P.weeks_start, P.yesterday).select(
        "booking_id", "metodo_de_pago", "reservation_hub_name", "close_date", "venta", "cancel"
    )


@register("weekly_str")
def _q_weekly_str(spark, sf):
    return D.method_weekly(_b(spark, sf), P, "week", fold=False)


@register("monthly_str")
def _q_monthly_str(spark, sf):
    return D.method_weekly(_b(spark, sf), P, "month", fold=False)


@register("str_method_fold")
def _q_str_method_fold(spark, sf):
    return D.method_weekly(_b(spark, sf), P, "week", fold=True)


@register("dim_order")
def _q_dim_order(spark, sf):
    return D.with_dim_order(D.str_report(_b(spark, sf), _i(spark, sf), P, "aging", "week"), "aging")


@register("first_receipt")
def _q_first_receipt(spark, sf):
    return E.first_receipt(_i(spark, sf), P.as_of)


@register("latest_stock_region")
def _q_latest_stock_region(spark, sf):
    return E.latest_stock_region(_i(spark, sf), P.as_of)


@register("stock_region_asof")
def _q_stock_region_asof(spark, sf):
    rows = E.closed_rows(_b(spark, sf), P.weeks_start, P.yesterday).select(
        "booking_id", "stock_key", "fecha_reserva"
    )
    out = E.stock_region_asof(rows, _i(spark, sf), P.as_of)
    return out.withColumn("stock_region_code", B.stock_region_code("stock_region_asof"))


@register("mix_weekly")
def _q_mix_weekly(spark, sf):
    return D.mix_rows(D.str_report(_b(spark, sf), _i(spark, sf), P, "aging", "week"))


@register("mix_monthly")
def _q_mix_monthly(spark, sf):
    return D.mix_rows(D.str_report(_b(spark, sf), _i(spark, sf), P, "price", "month"))


@register("wow_delta")
def _q_wow_delta(spark, sf):
    return D.last_two(D.str_report(_b(spark, sf), _i(spark, sf), P, "aging", "week"), "week")


@register("mom_delta")
def _q_mom_delta(spark, sf):
    return D.last_two(D.str_report(_b(spark, sf), _i(spark, sf), P, "region", "month"), "month")


@register("str_deltas")
def _q_str_deltas(spark, sf):
    return D.str_deltas(D.str_report(_b(spark, sf), _i(spark, sf), P, "region", "week"))


@register("region_pivot")
def _q_region_pivot(spark, sf):
    return D.pivot_weeks(D.str_report(_b(spark, sf), _i(spark, sf), P, "region", "week"), P)


@register("region_pivot_midweek")
def _q_region_pivot_midweek(spark, sf):
    """The pivot with a ``weeks_start`` that is no Monday."""
    p = Params(as_of=P.as_of, weeks_start=date(2001, 1, 3))
    return D.pivot_weeks(D.str_report(_b(spark, sf), _i(spark, sf), p, "region", "week"), p)


@register("str_deltas_all")
def _q_str_deltas_all(spark, sf):
    return D.all_deltas(D.report(_b(spark, sf), _i(spark, sf), P, grains=["week"]))[0]


@register("mom_deltas_all")
def _q_mom_deltas_all(spark, sf):
    return D.all_deltas(D.report(_b(spark, sf), _i(spark, sf), P, grains=["month"]))[1]


@register("period_labels")
def _q_period_labels(spark, sf):
    """The period table with its labels and the closed rows of each window."""
    b = _b(spark, sf)
    pt = period_table(b, P)
    lo = min(x[0] for x in P.windows().values())
    daily = E.closed_rows(b, lo, P.yesterday).groupBy("close_date").agg(F.count(F.lit(1)).alias("n"))
    n = with_periods(daily, "close_date", pt).groupBy("period_kind").agg(F.sum("n").alias("n_closed"))
    return pt.join(n, "period_kind", "left").na.fill(0, ["n_closed"])


@register("str_custom_periods")
def _q_str_custom_periods(spark, sf):
    """Close rates of any table of overlapping periods."""
    return D.period_report(_b(spark, sf), fixture_campaigns(spark, sf), P)


@register("qa_recent_weeks")
def _q_qa_recent_weeks(spark, sf):
    b = _b(spark, sf)
    return QA.qa_recent_weeks(K.weekly_hub_str(b, P), K.bookings_weekly(b, P), K.profile_mix_weekly(b, P))


@register("qa_period_totals")
def _q_qa_period_totals(spark, sf):
    b = _b(spark, sf)
    return QA.qa_period_totals(K.kpi_period(b, P, "mtd"), K.kpi_period(b, P, "lmtd"), K.last_month_hub(b, P))


@register("qa_funnel_weeks")
def _q_qa_funnel_weeks(spark, sf):
    b = _b(spark, sf)
    return QA.qa_funnel_weeks(FN.funnel_weekly(b, P), FN.funnel_app_sale_weekly(b, P))


@register("qa_funnel_expected")
def _q_qa_funnel_expected(spark, sf):
    """The last weeks against expected pairs: handoffs and approvals that a plain
    count finds, but for odd days of the month, where one more is expected."""
    b = _b(spark, sf)
    day = F.date_trunc("week", "fecha_handoff").cast("date").alias("semana")
    base = b.filter(F.col("b2b") == 0).filter(B.is_financing()).filter("estimate_flag = 1")
    ho = base.filter(F.col("fecha_handoff").between(F.lit(date(2001, 3, 12)), F.lit(P.yesterday))).groupBy(day).agg(
        F.count_distinct("booking_id", B.hub_label()).alias("ho"))
    app = base.filter(F.col("fecha_aprobacion").between(F.lit(date(2001, 3, 12)), F.lit(P.yesterday))).groupBy(
        F.date_trunc("week", "fecha_aprobacion").cast("date").alias("semana")).agg(F.count_distinct("booking_id", B.hub_label()).alias("app"))
    expected = ho.join(app, "semana", "full").withColumn("ho", F.col("ho") + F.day("semana") % 2)
    return QA.qa_funnel_expected(QA.qa_funnel_weeks(FN.funnel_weekly(b, P), FN.funnel_app_sale_weekly(b, P)), expected)


@register("qa_dim_row")
def _q_qa_dim_row(spark, sf):
    return QA.qa_dim_row(D.report(_b(spark, sf), _i(spark, sf), P, ["region", "aging"], ["week"]))


@register("kpi_from_daily_events")
def _q_kpi_from_daily_events(spark, sf):
    """R12 from the daily counts that the refresh keeps."""
    return K.kpi_periods_of(K.daily_events(_b(spark, sf), P), P)


@register("kpi_incremental")
def _q_kpi_incremental(spark, sf):
    """The daily report from a state that saw an older table first - some bookings
    missing, some not yet closed, some at another hub, some since removed - and
    then the changed bookings alone."""
    import uuid

    from cierre import incremental as INC
    from cierre.session import ensure_checkpoint_dir
    from cierre.sources.io import remove

    root = f"{ensure_checkpoint_dir(spark)}/state-{uuid.uuid4().hex[:8]}"
    now = cut_lineage(_b(spark, sf))
    k = F.col("booking_id")
    changes = now.filter((k % 10 == 3) | (k % 17 == 0) | (k % 29 == 0))
    open_ = lambda c: F.when(k % 10 != 3, F.col(c)).alias(c)
    before = now.filter(k % 29 != 0).select(
        *[open_(c) if c in ("fecha_venta_declarada", "fecha_cancelacion_reserva", "fecha_entrega", "devolucion_date")
          else F.when(k % 17 == 0, F.lit("GDL elsewhere")).otherwise(F.col(c)).alias(c) if c == "reservation_hub_name" else c
          for c in now.columns])
    extra = now.filter(k % 100 == 2).withColumn("booking_id", -k)
    INC.update(spark, root, before.unionByName(extra))
    INC.update(spark, root, changes, extra.select("booking_id"))
    out = cut_lineage(K.daily_hub_of(INC.events(spark, root), P))
    remove(spark, root)
    return out


def _published(spark, sf, check):
    """Publish three reports as a set of its own, replace one, check the set, and
    remove it."""
    import uuid

    from cierre.session import ensure_checkpoint_dir
    from cierre.sources.io import publish, remove

    root = f"{ensure_checkpoint_dir(spark)}/published-{uuid.uuid4().hex[:8]}"
    events = K.daily_events(_b(spark, sf), P)
    weekly = K.weekly_hub_str_of(events, P)
    publish({"weekly_hub_str": weekly, "bookings_weekly": K.bookings_weekly_of(events, P),
             "daily_hub": K.daily_hub_of(events, P)}, root)
    publish({"weekly_hub_str": weekly.filter("ventas_total > 0")}, root)
    out = cut_lineage(check(root))
    remove(spark, root)
    return out


@register("dataset_presence")
def _q_dataset_presence(spark, sf):
    """The set against the expected names (one of them is missing)."""
    from cierre.sources.io import dataset_presence

    return _published(spark, sf, lambda root: dataset_presence(
        spark, root, ["bookings_weekly", "daily_hub", "weekly_hub_str", "last_month_hub"]))


@register("dataset_checks")
def _q_dataset_checks(spark, sf):
    """The set against limits: rows at least, and the day that it must reach."""
    from cierre.sources.io import dataset_checks

    return _published(spark, sf, lambda root: dataset_checks(spark, root, [
        ("weekly_hub_str", 10, P.lwtd_start), ("bookings_weekly", 10**9, None), ("daily_hub", None, P.as_of),
        ("last_month_hub", None, None)]))
