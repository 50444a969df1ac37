"""First verdicts and first payments from event logs, and the payment split."""

from datetime import date, datetime

from cierre.operators import dims as D
from cierre.operators import verdict as VD
from cierre.params import FIXTURE_PARAMS as P
from cierre.sources import datasets as DS
from tests.conftest import empty_inventory, make_bookings, rows_by

T = [datetime(2001, 4, 2, h) for h in range(4)]


def _verdicts(spark, rows):
    return spark.createDataFrame(rows, DS.VERDICT_SCHEMA)


def test_first_verdict_is_the_earliest(spark):
    rows = [(1, "Rechazada", T[0], 9), (1, "Incompleta", T[1], 8), (1, "Aprobada", T[2], 7),   # falling by name and id
            (2, "Rechazada", T[1], 5), (2, "Incompleta", T[1], 4), (2, "Aprobada", T[1], None),  # one time: the smallest id
            (3, None, T[0], 1), (3, "Aprobada", T[3], 2),                                        # an event without verdict is none
            (4, "Foo", None, 1), (4, "Rechazada", T[3], 9),                                      # no time comes last
            (5, "b", None, None), (5, "a", None, None),                                          # then by name
            (None, "Aprobada", T[0], 1), (6, None, None, None)]
    got = {r.booking_id: r.dictamen for r in DS.first_verdicts(_verdicts(spark, rows)).collect()}
    assert got == {1: "Rechazada", 2: "Incompleta", 3: "Aprobada", 4: "Rechazada", 5: "a"}
    assert DS.first_verdicts(_verdicts(spark, [])).collect() == []


def test_verdict_reports_count_the_first(spark):
    b = make_bookings(spark, [dict(booking_id=n, fecha_reserva=date(2001, 4, 3)) for n in (1, 2, 3)])
    events = _verdicts(spark, [(n, v, T[k], 9 - k) for n in (1, 2) for k, v in enumerate(("Rechazada", "Incompleta", "Aprobada"))])
    mix = VD.verdict_mix(DS.verdict_dataset(b, events, P))
    key = dict(scope="__MX__", ti_mode="total", granularity="mensual", time_key="2001-04")
    got = {r.dictamen: r.n for r in mix.collect() if all(r[k] == v for k, v in key.items())}
    assert got == {"Rechazada": 2, "Otro": 1}


def _payments(spark, rows):
    return spark.createDataFrame(rows, DS.PAYMENT_SCHEMA)


PAID = [(1, 1, T[1], 5000.0), (1, 2, T[0], 999.99),            # the first one is too small
        (2, 2, T[0], 1000.0), (2, 1, T[3], 1.0),               # exactly enough
        (3, 7, T[0], 10.0), (3, 6, T[0], 2000.0),              # one time: the smaller payment id
        (4, 1, T[0], None), (4, 2, T[1], 3000.0),              # no amount is no payment
        (5, 1, None, 9000.0), (None, 1, T[0], 9000.0)]


def test_first_payments(spark):
    got = {r.booking_id: r.amount for r in DS.first_payments(_payments(spark, PAID)).collect()}
    assert got == {1: 999.99, 2: 1000.0, 3: 2000.0, 4: 3000.0}


def test_payment_split_and_dimension(spark):
    b = make_bookings(spark, [dict(booking_id=n, fecha_venta_declarada=date(2001, 4, 3)) for n in (1, 2, 3, 4, 5, 6)] + [
        dict(booking_id=2, fecha_cancelacion_reserva=date(2001, 4, 4), metodo_de_pago="Cash payment")])
    rows = rows_by(D.payment_split(b, _payments(spark, PAID), P), "metodo_de_pago", "pago_dim")
    assert {k: (r["ventas"], r["cancelaciones"]) for k, r in rows.items()} == {
        ("Financing", "Con Pago"): (3, 0), ("Financing", "Sin Pago"): (3, 0), ("Cash payment", "Con Pago"): (0, 1)}
    rep = rows_by(D.str_report(b, empty_inventory(spark), P, "payment", "month", payments=_payments(spark, PAID)), "method", "dim", "period")
    april = rep[("all", "Con Pago", date(2001, 4, 1))]
    assert (april["ventas"], april["cancelaciones"], april["str"], april["mix"]) == (3, 1, 75.0, 57.1)
    assert rep[("all", "Sin Pago", date(2001, 4, 1))]["mix"] == 42.9


def test_no_payments_is_the_empty_frame(spark):
    b = make_bookings(spark, [dict(fecha_venta_declarada=date(2001, 4, 3))])
    split = D.payment_split(b, _payments(spark, []), P)
    assert split.count() == 0 and split.columns == ["semana", "metodo_de_pago", "pago_dim", "ventas", "cancelaciones"]
