"""KPI reports: hub labels, country totals, row presence (Q11, Q16-Q18, Q30)."""

from datetime import date

from cierre.operators import kpis as K
from cierre.params import Params
from tests.conftest import make_bookings, rows_by

P = Params(as_of=date(2001, 4, 18), weeks_start=date(2001, 3, 26))


def test_kpi_mtd_country_total_and_null_hub(spark):
    b = make_bookings(spark, [
        dict(reservation_hub_name="A", fecha_venta_declarada=date(2001, 4, 3), fecha_origen=date(2001, 4, 1)),
        dict(reservation_hub_name=None, metodo_de_pago="Cash payment", fecha_cancelacion_reserva=date(2001, 4, 5),
             fecha_origen=date(2001, 3, 1)),
        dict(reservation_hub_name="B", metodo_de_pago="Other", fecha_venta_declarada=date(2001, 4, 3),
             fecha_origen=date(2001, 4, 2)),  # sale not counted (method), booking counted
    ])
    r = rows_by(K.kpi_period(b, P, "mtd"), "hub")
    assert set(r) == {("A",), ("null",), ("B",), ("__MX__",)}
    assert r[("A",)]["ventas_total"] == 1 and r[("null",)]["cancel_cash"] == 1
    assert r[("B",)]["ventas_total"] == 0 and r[("B",)]["reservas_total"] == 1
    mx = r[("__MX__",)]
    for m in K.KPI_PERIOD_MEASURES:
        assert mx[m] == sum(v[m] for k, v in r.items() if k != ("__MX__",)), m


def test_kpi_period_empty_on_first_of_month(spark):
    p = Params(as_of=date(2001, 5, 1), weeks_start=date(2001, 3, 26))
    b = make_bookings(spark, [dict(fecha_venta_declarada=date(2001, 4, 30), fecha_origen=date(2001, 4, 30))])
    assert K.kpi_period(b, p, "mtd").count() == 0
    assert K.kpi_period(b, p, "lmtd").count() == 0


def test_bookings_weekly_keeps_origin_pairs_only(spark):
    b = make_bookings(spark, [
        dict(reservation_hub_name=None, fecha_origen=date(2001, 4, 3), fecha_reserva=date(2001, 4, 3)),
        dict(reservation_hub_name="G", fecha_origen=date(2001, 3, 1), fecha_reserva=date(2001, 4, 10)),  # gross only
        dict(reservation_hub_name="H", estimate_flag=0, fecha_origen=date(2001, 4, 10), fecha_reserva=date(2001, 3, 1)),
    ])
    r = rows_by(K.bookings_weekly(b, P), "semana", "hub")
    assert set(r) == {(date(2001, 4, 2), "null"), (date(2001, 4, 9), "H")}
    assert r[(date(2001, 4, 2), "null")]["reservas_total"] == 1   # null hubs match (Q30 fix)
    assert r[(date(2001, 4, 9), "H")]["reservas_netas"] == 0


def test_daily_row_presence_and_net_deliveries(spark):
    d1, d2, d3 = date(2001, 4, 10), date(2001, 4, 11), date(2001, 4, 12)
    b = make_bookings(spark, [
        dict(reservation_hub_name="A", fecha_venta_declarada=d1, fecha_origen=date(2001, 1, 1)),
        dict(reservation_hub_name="A", fecha_entrega=d2, devolucion_date=d2, fecha_origen=date(2001, 1, 1)),
        dict(reservation_hub_name="A", devolucion_date=d2, fecha_origen=date(2001, 1, 1)),
        dict(reservation_hub_name="A", devolucion_date=d3, fecha_origen=date(2001, 1, 1)),   # returns only: no row
        dict(reservation_hub_name="C", fecha_cancelacion_reserva=d1, fecha_origen=date(2001, 1, 1)),  # hub C never sells
        dict(reservation_hub_name="A", estimate_flag=0, fecha_origen=d3),       # all-zero counts, row present
    ])
    r = rows_by(K.daily_hub(b, P), "fecha", "hub")
    assert set(r) == {(d1, "A"), (d2, "A"), (d3, "A"), (d1, "__MX__"), (d2, "__MX__"), (d3, "__MX__")}
    assert r[(d2, "A")]["entregas_brutas"] == 1 and r[(d2, "A")]["entregas_netas"] == 0   # max(0, 1 - 2)
    assert r[(d1, "__MX__")]["cancel_total"] == 1                                      # C counts in the country
    assert all(v == 0 for k, v in r[(d3, "A")].items() if k not in ("fecha", "hub"))


def test_last_month_hub_set_and_country_net(spark):
    b = make_bookings(spark, [
        dict(reservation_hub_name="A", fecha_entrega=date(2001, 3, 5), financing_provider="Captive"),
        dict(reservation_hub_name="B", devolucion_date=date(2001, 3, 6)),
        dict(reservation_hub_name="B", metodo_de_pago=None, fecha_venta_declarada=date(2001, 3, 6)),  # no method
    ])
    r = rows_by(K.last_month_hub(b, P), "hub")
    assert set(r) == {("A",), ("__MX__",)}
    assert r[("__MX__",)]["entregas_netas"] == 0 and r[("A",)]["entregas_netas"] == 1
    assert r[("A",)]["entregas_captive"] == 1


def test_last_month_empty(spark):
    b = make_bookings(spark, [dict(fecha_venta_declarada=date(2001, 1, 6))])
    assert K.last_month_hub(b, P).count() == 0
