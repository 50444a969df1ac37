"""Funnel: distinct counts with duplicate rows, stage semantics, browser KPIs."""

from datetime import date

from pyspark.sql import functions as F

from cierre.operators import funnel as FN
from cierre.operators import profile as PF
from cierre.operators import sla as SL
from cierre.operators import verdict as VD
from cierre.params import Params
from cierre.sources import datasets as DS
from cierre.sources.fixtures import fixture_verdicts
from tests.conftest import make_bookings, rows_by

P = Params(as_of=date(2001, 4, 18), weeks_start=date(2001, 3, 26))
W2, W3 = date(2001, 4, 2), date(2001, 4, 9)


def _dups(spark):
    ho = date(2001, 4, 3)
    return make_bookings(spark, [
        dict(booking_id=7, trade_in=0, fecha_handoff=ho, fecha_aprobacion=date(2001, 4, 4)),
        dict(booking_id=7, trade_in=1, fecha_handoff=ho, fecha_aprobacion=date(2001, 4, 4)),  # duplicate, other TI
        dict(booking_id=8, trade_in=1, fecha_cancelacion_reserva=date(2001, 4, 5)),             # cancel, no HO/App
        dict(booking_id=9, trade_in=0, fecha_handoff=ho, fecha_cancelacion_reserva=date(2001, 4, 10)),  # cancel after HO
        dict(booking_id=10, metodo_de_pago="Cash payment", fecha_handoff=ho),                    # not financing
        dict(booking_id=11, estimate_flag=0, fecha_handoff=ho),                                  # ghost booking
    ])


def test_funnel_weekly_distinct_counts(spark):
    b = _dups(spark)
    r = rows_by(FN.funnel_weekly(b, P), "semana", "hub")
    w2 = r[(W2, "CDMX Centro")]
    assert (w2["ho_total"], w2["ho_sales"], w2["ho_ti"]) == (2, 2, 1)   # bookings 7 (both TI) and 9
    assert (w2["app_total"], w2["can_no_ho_total"], w2["can_no_ho_ti"]) == (1, 1, 1)
    assert w2["can_no_app_total"] == 1                                   # booking 8
    w3 = r[(W3, "CDMX Centro")]
    assert (w3["can_no_app_total"], w3["can_no_ho_total"], w3["ho_total"]) == (1, 0, 0)  # booking 9


def test_two_level_equals_count_distinct(spark):
    b = _dups(spark)
    base = b.filter(FN._base_where()).withColumn("hub", F.coalesce("reservation_hub_name", F.lit("null"))).filter(F.col("fecha_handoff").between(P.weeks_start, P.yesterday))
    direct = base.groupBy(F.date_trunc("week", "fecha_handoff").cast("date").alias("semana"), "hub").agg(
        F.count_distinct("booking_id").alias("t"),
        F.count_distinct(F.when(F.col("trade_in") == 0, F.col("booking_id"))).alias("s"),
        F.count_distinct(F.when(F.col("trade_in") == 1, F.col("booking_id"))).alias("ti"),
    )
    want = {(r["semana"], r["hub"]): (r["t"], r["s"], r["ti"]) for r in direct.collect()}
    got = {(r["semana"], r["hub"]): (r["ho_total"], r["ho_sales"], r["ho_ti"])
           for r in FN.funnel_weekly(b, P).collect() if r["ho_total"] > 0}
    assert got == want


def test_no_expand_in_funnel_plans(spark):
    b = _dups(spark)
    for df in (FN.funnel_weekly(b, P), FN.funnel_app_sale_weekly(b, P), FN.funnel_periods(b, P)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Expand" not in plan


def test_app_sale_and_periods(spark):
    b = make_bookings(spark, [
        dict(fecha_aprobacion=date(2001, 4, 2), fecha_venta_declarada=date(2001, 4, 5)),
        dict(fecha_aprobacion=date(2001, 4, 2), fecha_cancelacion_reserva=date(2001, 4, 6), trade_in=1),
        dict(fecha_venta_declarada=date(2001, 4, 5)),   # sold without approval: row present, counts 0
    ])
    r = rows_by(FN.funnel_app_sale_weekly(b, P), "semana", "hub")[(W2, "CDMX Centro")]
    assert (r["vta_app_total"], r["cancel_app_total"], r["cancel_app_ti"]) == (1, 1, 1)
    m = rows_by(FN.funnel_period(b, P, "mtd"), "hub")[("CDMX Centro",)]
    assert (m["vta_app_total"], m["cancel_app_total"], m["app_total"]) == (1, 1, 2)


def test_funnel_kpi_current_vs_last_week(spark):
    b = make_bookings(spark, [
        dict(fecha_handoff=date(2001, 4, 16)),                                   # current week
        dict(fecha_handoff=date(2001, 4, 10)), dict(fecha_cancelacion_reserva=date(2001, 4, 11)),  # last closed
    ])
    fw, fv = FN.funnel_weekly(b, P), FN.funnel_app_sale_weekly(b, P)
    fp = FN.funnel_periods(b, P)
    kpi = FN.funnel_kpi(fw, fv, fp, P)
    r = rows_by(kpi, "scope", "ti_mode", "granularity")
    w = r[("__MX__", "total", "semanal")]
    assert w["cr_ho_cur"] == 100.0 and w["cr_ho_prv"] == 50.0 and w["cr_ho_delta"] == 50.0
    assert w["cr_vta_cur"] is None


def test_sla_verdict_profile_datasets(spark):
    b = make_bookings(spark, [
        dict(booking_id=9, fecha_reserva=date(2001, 4, 2), fecha_handoff=date(2001, 4, 5), perfil="X"),
        dict(booking_id=18, fecha_reserva=date(2001, 4, 2), fecha_handoff=date(2001, 4, 4), perfil="X"),
        dict(booking_id=17, fecha_reserva=date(2001, 4, 3), trade_in=1),   # verdict Foo -> Otro
    ])
    sla = rows_by(DS.sla_dataset(b, P), "stage", "semana", "ti_flag")
    s = sla[("res_ho", W2, "sin_ti")]
    assert (s["n"], s["days"], s["sla"]) == (2, 5, 2.5)
    kpi = rows_by(SL.sla_kpi(DS.sla_dataset(b, P), P), "stage", "scope", "ti_mode", "granularity")
    assert kpi[("res_ho", "__MX__", "total", "semanal")]["sla_cur"] == 2.5   # current week falls back to last
    mix = VD.verdict_mix(DS.verdict_dataset(b, fixture_verdicts(b), P))
    cats = {(r["dictamen"], r["pct"]) for r in mix.collect()
            if r["scope"] == "__MX__" and r["ti_mode"] == "total" and r["granularity"] == "semanal"}
    assert cats == {("Aprobada", 66.7), ("Otro", 33.3)}
    prof = rows_by(PF.profile_funnel(DS.profile_dataset(b, P), P), "scope", "ti_mode", "granularity", "time_key", "perfil")
    assert prof[("__MX__", "total", "semanal", "2001-04-02", "X")]["cr_ho"] == 100.0
    assert prof[("__MX__", "total", "semanal", "2001-04-02", "A")]["cr_ho"] is None
