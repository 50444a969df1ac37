"""More survey 2.13 rows: Q19 (week -> month by Monday), Q21 (week outside
the window), W5 (profile time keys), W8 (inactive verdicts dropped), labels."""

from datetime import date, timedelta

from cierre.operators import funnel as FN
from cierre.operators import profile as PF
from cierre.operators import verdict as VD
from cierre.params import Params
from cierre.plans.periods import period_label, period_table
from cierre.sources import datasets as DS
from cierre.sources.fixtures import fixture_verdicts
from tests.conftest import make_bookings, rows_by

P = Params(as_of=date(2001, 4, 18), weeks_start=date(2001, 3, 26))


def test_q21_week_of_coalesce_can_fall_outside_window(spark):
    # sale before the window, cancel inside it: the row is read (cancel in range) but its week is the sale's
    b = make_bookings(spark, [dict(fecha_aprobacion=date(2001, 3, 1), fecha_venta_declarada=date(2001, 3, 7),
                                   fecha_cancelacion_reserva=date(2001, 4, 3))])
    r = rows_by(FN.funnel_app_sale_weekly(b, P), "semana", "hub")
    assert list(r) == [(date(2001, 3, 5), "CDMX Centro")]
    assert r[(date(2001, 3, 5), "CDMX Centro")]["cancel_app_total"] == 1


def test_q19_week_lands_in_month_of_its_monday(spark):
    b = make_bookings(spark, [dict(fecha_handoff=date(2001, 4, 1))])   # Sunday; its Monday is 03-26
    m = rows_by(FN.funnel_by_week_month(FN.funnel_weekly(b, P)), "mes", "hub")
    assert list(m) == [("2001-03", "CDMX Centro")] and m[("2001-03", "CDMX Centro")]["ho_total"] == 1


def test_w5_profile_time_keys(spark):
    p = Params(as_of=date(2001, 4, 18), weeks_start=date(2001, 1, 1))
    rows = [dict(fecha_handoff=date(2001, 1, 1) + timedelta(days=7 * k), perfil="X") for k in range(15)]
    rows.append(dict(fecha_handoff=date(2001, 4, 16), perfil="X"))
    keys = PF.profile_time_keys(DS.profile_dataset(make_bookings(spark, rows), p), p).collect()[0]["keys"]
    weekly = [k["time_key"] for k in keys if k["granularity"] == "semanal"]
    monthly = [k["time_key"] for k in keys if k["granularity"] == "mensual"]
    assert weekly == ["2001-03-05", "2001-03-12", "2001-03-19", "2001-03-26", "2001-04-02", "2001-04-09", "2001-04-16"]
    assert monthly == ["2001-01", "2001-02", "2001-03", "2001-04"]


def test_w8_verdict_categories_zero_everywhere_are_dropped(spark):
    b = make_bookings(spark, [dict(booking_id=9, fecha_reserva=date(2001, 4, 2)),
                              dict(booking_id=12, fecha_reserva=date(2001, 4, 10))])   # 9 % 9 = 0 Aprobada, 12 -> Incompleta
    mix = VD.verdict_mix(DS.verdict_dataset(b, fixture_verdicts(b), P)).filter("scope = '__MX__' AND ti_mode = 'total' AND granularity = 'semanal'")
    got = {(r["time_key"], r["dictamen"]): (r["n"], r["pct"]) for r in mix.collect()}
    assert got == {("2001-04-02", "Aprobada"): (1, 100.0), ("2001-04-02", "Incompleta"): (0, 0.0),
                   ("2001-04-09", "Aprobada"): (0, 0.0), ("2001-04-09", "Incompleta"): (1, 100.0)}


def test_period_labels(spark):
    assert period_label(date(2001, 4, 16), date(2001, 4, 17)) == "16/4–17/4"
    b = make_bookings(spark, [dict()])
    t = {r["period_kind"]: r["label"] for r in period_table(b, Params(date(2001, 4, 16), date(2001, 1, 1))).collect()}
    assert t["wtd"] == "—" and t["mtd"] == "1/4–15/4"
