"""Dimension close-rate reports on hand-made frames (survey 1.5, Q3-Q10)."""

from datetime import date

from cierre.operators import dims as D
from cierre.params import Params
from tests.conftest import empty_inventory, make_bookings, make_inventory, rows_by

P = Params(as_of=date(2001, 4, 18), weeks_start=date(2001, 3, 26))  # Wed; weeks 03-26, 04-02, 04-09
W1, W2, W3 = date(2001, 3, 26), date(2001, 4, 2), date(2001, 4, 9)


def test_sale_and_cancel_count_in_both_and_method_fold(spark):
    b = make_bookings(spark, [
        # sale and cancel on the same row: counts in both, in the week of the sale date
        dict(metodo_de_pago="Financing", fecha_venta_declarada=date(2001, 4, 3), fecha_cancelacion_reserva=date(2001, 4, 12)),
        dict(metodo_de_pago="Cash payment", fecha_cancelacion_reserva=date(2001, 4, 4)),
        dict(metodo_de_pago=None, fecha_venta_declarada=date(2001, 4, 5)),
        dict(metodo_de_pago="Other", fecha_venta_declarada=date(2001, 4, 5)),   # counts in no method
        dict(metodo_de_pago="Financing Inhouse", fecha_cancelacion_reserva=date(2001, 4, 5), estimate_flag=0),  # not a cancel
        dict(b2b=1, fecha_venta_declarada=date(2001, 4, 5)),                     # b2b excluded
    ])
    rep = rows_by(D.str_report(b, empty_inventory(spark), P, "region", "week"), "method", "dim", "period_kind", "period")
    mx_all = rep[("all", "MX", "week", W2)]
    assert (mx_all["ventas"], mx_all["cancelaciones"]) == (2, 2)  # Financing sale+cancel, Cash cancel, null sale
    assert mx_all["str"] == 50.0
    fin = rep[("Financing", "MX", "week", W2)]
    assert (fin["ventas"], fin["cancelaciones"]) == (1, 1)
    cash = rep[("Cash payment", "MX", "week", W2)]
    assert (cash["ventas"], cash["cancelaciones"], cash["str"]) == (0, 1, 0.0)


def test_fixed_dims_scaffold_and_null_rate(spark):
    b = make_bookings(spark, [
        dict(reservation_hub_name="GDL Uno", fecha_venta_declarada=date(2001, 3, 27)),
        dict(reservation_hub_name="TIJ x", fecha_venta_declarada=date(2001, 4, 3)),  # no region: MX only
    ])
    r = D.str_report(b, empty_inventory(spark), P, "region", "week")
    rep = rows_by(r, "method", "dim", "period_kind", "period")
    dims = {k[1] for k in rep}
    assert dims == {"MX", "CDMX", "CUE", "GDL", "MTY", "PUE", "QRO"}
    # observed weeks only (W3 had no closings), plus wtd and lwtd
    assert {(k[2], k[3]) for k in rep} == {("week", W1), ("week", W2), ("wtd", date(2001, 4, 16)), ("lwtd", W3)}
    assert rep[("all", "CDMX", "week", W1)]["str"] is None          # STR null on no rows (Q7)
    assert rep[("all", "GDL", "week", W1)]["str"] == 100.0
    assert rep[("all", "MX", "week", W2)]["ventas"] == 1            # country row has no region filter (Q6)
    assert rep[("all", "GDL", "week", W2)]["ventas"] == 0


def test_wtd_bounded_by_yesterday_and_lwtd(spark):
    b = make_bookings(spark, [
        dict(fecha_venta_declarada=date(2001, 4, 16)),   # WTD (Monday)
        dict(fecha_venta_declarada=date(2001, 4, 18)),   # today: not in WTD (Q3 fix)
        dict(fecha_cancelacion_reserva=date(2001, 4, 10)),  # LWTD (Tue)
        dict(fecha_cancelacion_reserva=date(2001, 4, 11)),  # after LWTD end (D-8)
    ])
    rep = rows_by(D.str_report(b, empty_inventory(spark), P, "region", "week"), "method", "dim", "period_kind")
    assert (rep[("all", "MX", "wtd")]["ventas"], rep[("all", "MX", "wtd")]["cancelaciones"]) == (1, 0)
    assert (rep[("all", "MX", "lwtd")]["ventas"], rep[("all", "MX", "lwtd")]["cancelaciones"]) == (0, 1)
    deltas = rows_by(D.str_deltas(D.str_report(b, empty_inventory(spark), P, "region", "week")), "method", "dim")
    assert deltas[("all", "MX")]["wtd"] == 100.0 and deltas[("all", "MX")]["lwtd"] == 0.0
    assert deltas[("all", "MX")]["delta"] == 100.0


def test_monday_report_has_null_wtd(spark):
    p = Params(as_of=date(2001, 4, 16), weeks_start=date(2001, 3, 26))
    b = make_bookings(spark, [dict(fecha_venta_declarada=date(2001, 4, 15)), dict(fecha_venta_declarada=date(2001, 4, 16))])
    rep = rows_by(D.str_report(b, empty_inventory(spark), p, "region", "week"), "method", "dim", "period_kind")
    assert rep[("all", "MX", "wtd")]["str"] is None
    assert rep[("all", "MX", "lwtd")]["str"] is None


def test_aging_mix_and_observed_buckets(spark):
    b = make_bookings(spark, [
        dict(stock="10", fecha_reserva=date(2001, 3, 20), fecha_venta_declarada=date(2001, 4, 3)),
        dict(stock="11", fecha_reserva=date(2001, 3, 20), fecha_cancelacion_reserva=date(2001, 4, 4)),
        dict(stock="12", fecha_reserva=date(2001, 3, 20), fecha_venta_declarada=date(2001, 3, 28)),
        dict(stock="N/A-13", fecha_reserva=date(2001, 3, 20), fecha_venta_declarada=date(2001, 4, 3)),  # bad key
        dict(stock="14", fecha_reserva=date(2001, 3, 20), fecha_venta_declarada=date(2001, 4, 3)),  # no receipt
    ])
    inv = make_inventory(spark, [
        dict(bk_stock=10, inv_date=date(2001, 3, 1), item_receipt_date=date(2001, 3, 10)),  # 10 days
        dict(bk_stock=10, inv_date=date(2001, 3, 2), item_receipt_date=date(2001, 3, 12)),
        dict(bk_stock=11, inv_date=date(2001, 3, 1), item_receipt_date=date(2001, 1, 1)),   # 78 days
        dict(bk_stock=12, inv_date=date(2001, 3, 1), item_receipt_date=date(2001, 3, 15)),
        dict(bk_stock=14, inv_date=date(2001, 3, 1), item_receipt_date=None),
    ])
    rep = rows_by(D.str_report(b, inv, P, "aging", "week"), "method", "dim", "period_kind", "period")
    assert {k[1] for k in rep} == {"0-30d", "60-90d"}                    # observed buckets only
    a = rep[("all", "0-30d", "week", W2)]
    c = rep[("all", "60-90d", "week", W2)]
    assert (a["ventas"], c["cancelaciones"]) == (1, 1)
    assert a["mix"] == 50.0 and c["mix"] == 50.0
    w1 = rep[("all", "60-90d", "week", W1)]
    assert w1["str"] is None and w1["mix"] == 0.0                        # Q7: null STR, 0 mix
    assert rep[("all", "0-30d", "wtd", date(2001, 4, 16))]["mix"] is None  # empty period: null mix


def test_snapshot_duplicates_do_not_fan_out(spark):
    b = make_bookings(spark, [dict(stock="10", fecha_reserva=date(2001, 4, 1), fecha_venta_declarada=date(2001, 4, 3))])
    inv = make_inventory(spark, [
        dict(bk_stock=10, inv_date=date(2001, 4, 1), real_published_price=300000.0, flag_coming_soon=1),
        dict(bk_stock=10, inv_date=date(2001, 4, 1), real_published_price=200000.0, flag_coming_soon=0),
    ])
    for dim in ("price", "coming_soon", "pix"):
        rep = D.str_report(b, inv, P, dim, "week").collect()
        total = sum(r["ventas"] for r in rep if r["method"] == "all" and r["period_kind"] == "week")
        assert total == (1 if dim != "pix" else 0), dim
    price = rows_by(D.str_report(b, inv, P, "price", "week"), "method", "dim", "period_kind", "period")
    assert price[("all", "0-250K", "week", W2)]["ventas"] == 1   # the first row by column order is kept


def test_stock_region_fallback(spark):
    b = make_bookings(spark, [
        dict(stock="1", fecha_reserva=date(2001, 4, 2), fecha_venta_declarada=date(2001, 4, 3)),  # same day
        dict(stock="2", fecha_reserva=date(2001, 4, 2), fecha_venta_declarada=date(2001, 4, 3)),  # day before
        dict(stock="3", fecha_reserva=date(2001, 4, 2), fecha_venta_declarada=date(2001, 4, 3)),  # latest
        dict(stock="4", fecha_reserva=date(2001, 4, 2), fecha_venta_declarada=date(2001, 4, 3)),  # none
    ])
    inv = make_inventory(spark, [
        dict(bk_stock=1, inv_date=date(2001, 4, 2), stock_region="PUEBLA"),
        dict(bk_stock=1, inv_date=date(2001, 4, 1), stock_region="CDMX"),
        dict(bk_stock=2, inv_date=date(2001, 4, 1), stock_region="MONTERREY"),
        dict(bk_stock=3, inv_date=date(2001, 3, 1), stock_region="CDMX"),
        dict(bk_stock=3, inv_date=date(2001, 3, 5), stock_region="QUERETARO"),
        dict(bk_stock=3, inv_date=date(2001, 3, 5), stock_region="CUERNAVACA"),  # same day: first by name wins
        dict(bk_stock=4, inv_date=date(2001, 4, 2), stock_region="TIJUANA"),      # not a listed city
    ])
    rep = rows_by(D.str_report(b, inv, P, "stock_region", "week"), "method", "dim", "period_kind", "period")
    got = {k[1]: v["ventas"] for k, v in rep.items() if k[0] == "all" and k[3] == W2 and k[2] == "week"}
    assert got == {"MX": 4, "PUE": 1, "MTY": 1, "CUE": 1, "CDMX": 0, "GDL": 0, "QRO": 0}


def test_monthly_calendar_months_and_mom(spark):
    p = Params(as_of=date(2001, 4, 18), weeks_start=date(2001, 1, 1))
    b = make_bookings(spark, [
        dict(fecha_venta_declarada=date(2001, 2, 3)),
        dict(fecha_cancelacion_reserva=date(2001, 3, 3)),
        dict(fecha_venta_declarada=date(2001, 3, 4)),
        dict(fecha_venta_declarada=date(2000, 12, 30)),   # before the 4 months
    ])
    rep = D.str_report(b, empty_inventory(spark), p, "region", "month")
    rows = rows_by(rep, "method", "dim", "period")
    assert {k[2] for k in rows} == {date(2001, 1, 1), date(2001, 2, 1), date(2001, 3, 1), date(2001, 4, 1)}
    assert rows[("all", "MX", date(2001, 3, 1))]["str"] == 50.0
    mom = rows_by(D.last_two(rep, "month"), "method", "dim")
    assert mom[("all", "MX")]["str_last"] is None and mom[("all", "MX")]["delta"] is None
