"""Oracle SQL of the building-block keys and QA checks."""

from __future__ import annotations

from oracle.dates import FIXTURE as P
from oracle import dims as OD
from oracle import funnel as OF
from oracle import kpis as OK
from oracle.base import CLOSE, CLOSED, d, rate, with_base


def src_bookings_sql() -> str:
    return with_base(body="SELECT *, TRY_CAST(stock AS BIGINT) AS stock_key FROM bookings")


def src_inventory_sql() -> str:
    return with_base(body="SELECT * FROM inventory_velocity")


def method_norm_sql() -> str:
    return with_base(body="""SELECT metodo_de_pago AS metodo_de_pago_raw,
  CASE WHEN metodo_de_pago = 'Financing Inhouse' THEN 'Financing' ELSE metodo_de_pago END AS metodo_de_pago,
  COALESCE(metodo_de_pago IN ('Financing', 'Cash payment', 'Financing Inhouse'), FALSE) AS kpi_method,
  COUNT(*) AS n
FROM bookings WHERE b2b = 0 GROUP BY metodo_de_pago""")


def closed_rows_sql() -> str:
    return with_base(body=f"""SELECT b.booking_id, b.metodo_de_pago, b.reservation_hub_name, {CLOSE} AS close_date,
  CAST(b.fecha_venta_declarada IS NOT NULL AS INTEGER) AS venta,
  CAST(b.fecha_cancelacion_reserva IS NOT NULL AND b.estimate_flag = 1 AS INTEGER) AS cancel
FROM bookings b
WHERE b.b2b = 0 AND {CLOSED} AND {CLOSE} BETWEEN {d(P.weeks_start)} AND {d(P.yesterday)}""")


def first_receipt_sql() -> str:
    return with_base(body="SELECT bk_stock, first_receipt AS item_receipt_date FROM car WHERE first_receipt IS NOT NULL")


def latest_stock_region_sql() -> str:
    return with_base(body="SELECT bk_stock, last_region AS stock_region FROM car WHERE last_region IS NOT NULL")


def stock_region_asof_sql() -> str:
    """The listed region on the reservation day, the day before, or the last one known."""
    return with_base(OD.CLOSED_ROWS, body=f"""SELECT booking_id, closed.car AS stock_key, fecha_reserva, region AS stock_region_asof,
  code AS stock_region_code
FROM (
  SELECT closed.*, COALESCE(today.stock_region, eve.stock_region, last_region) AS region
  FROM closed LEFT JOIN car ON car.bk_stock = closed.car
  LEFT JOIN car_region_day today ON today.bk_stock = closed.car AND today.inv_date = fecha_reserva
  LEFT JOIN car_region_day eve ON eve.bk_stock = closed.car AND eve.inv_date + 1 = fecha_reserva
  WHERE closed_on BETWEEN {d(P.weeks_start)} AND {d(P.yesterday)}) closed
LEFT JOIN region_code c ON c.stock_region = region""")


def period_labels_sql() -> str:
    rows = []
    for kind, (lo, hi) in P.windows().items():
        label = "—" if hi < lo else f"{lo.day}/{lo.month}–{hi.day}/{hi.month}"
        rows.append(f"""SELECT '{kind}' AS period_kind, {d(lo)} AS lo, {d(hi)} AS hi, '{label}' AS label,
  (SELECT COUNT(*) FROM bookings b WHERE b.b2b = 0 AND {CLOSED} AND {CLOSE} BETWEEN {d(lo)} AND {d(hi)}) AS n_closed""")
    return with_base(body="\nUNION ALL\n".join(rows))


def qa_recent_weeks_sql() -> str:
    return with_base(
        f"e_rows AS ({OK.weekly_hub_str_sql()})",
        f"a_rows AS ({OK.bookings_weekly_sql()})",
        f"b_rows AS ({OK.profile_mix_weekly_sql()})",
        body=f"""SELECT source, semana, CAST(reservas AS BIGINT) AS reservas, CAST(ventas AS BIGINT) AS ventas,
  CAST(cancel AS BIGINT) AS cancel, CAST(n_x AS BIGINT) AS n_x, CAST(n_a AS BIGINT) AS n_a,
  CAST(n_sin_perfil AS BIGINT) AS n_sin_perfil,
  CASE WHEN source <> 'B' THEN {rate('ventas', 'ventas + cancel')} END AS str
FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY source ORDER BY semana DESC) AS rn FROM (
    SELECT 'E' AS source, semana, NULL AS reservas, SUM(ventas_total) AS ventas, SUM(cancel_total) AS cancel,
           NULL AS n_x, NULL AS n_a, NULL AS n_sin_perfil FROM e_rows GROUP BY semana
    UNION ALL
    SELECT 'A', semana, SUM(reservas_total), SUM(ventas_total), SUM(cancel_total), NULL, NULL, NULL
      FROM a_rows GROUP BY semana
    UNION ALL
    SELECT 'B', semana, SUM(reservas_total), NULL, NULL, SUM(n_x), SUM(n_a), SUM(n_sin_perfil)
      FROM b_rows GROUP BY semana))
WHERE rn <= 3""")


def qa_period_totals_sql() -> str:
    parts = [f"""SELECT '{name}' AS period, CAST(reservas_total AS BIGINT) AS reservas_total,
  CAST(reservas_netas AS BIGINT) AS reservas_netas, CAST(ventas_total AS BIGINT) AS ventas_total,
  CAST(cancel_total AS BIGINT) AS cancel_total, {rate('ventas_total', 'ventas_total + cancel_total')} AS str,
  CAST(NULL AS BIGINT) AS entregas_netas, CAST(NULL AS BIGINT) AS entregas_captive
FROM ({OK.kpi_period_sql(kind)}) WHERE hub = '__MX__'""" for kind, name in (("mtd", "MTD"), ("lmtd", "LMTD"))]
    parts.append(f"""SELECT 'LM', NULL, NULL, ventas_total, NULL, CAST(NULL AS DOUBLE), entregas_netas, entregas_captive
FROM ({OK.last_month_hub_sql()}) WHERE hub = '__MX__'""")
    return "\nUNION ALL\n".join(parts)


def qa_funnel_weeks_sql() -> str:
    ctes = OF.weekly_ctes() + OF.vta_weekly_ctes()
    body = f"""SELECT semana, CAST(ho AS BIGINT) AS ho, CAST(cnh AS BIGINT) AS cnh, CAST(app AS BIGINT) AS app,
  CAST(cna AS BIGINT) AS cna, CAST(COALESCE(vta, 0) AS BIGINT) AS vta, CAST(COALESCE(can, 0) AS BIGINT) AS can,
  {rate('ho', 'ho + cnh')} AS cr_ho, {rate('app', 'app + cna')} AS cr_app,
  {rate('COALESCE(vta, 0)', 'COALESCE(vta, 0) + COALESCE(can, 0)')} AS cr_vta
FROM (
  SELECT semana, SUM(ho_total) AS ho, SUM(can_no_ho_total) AS cnh, SUM(app_total) AS app,
         SUM(can_no_app_total) AS cna
  FROM fw GROUP BY semana ORDER BY semana DESC LIMIT 7) f
LEFT JOIN (SELECT semana, SUM(vta_app_total) AS vta, SUM(cancel_app_total) AS can FROM vw GROUP BY semana) v
USING (semana)"""
    return with_base(*ctes, body=body)


def qa_dim_row_sql() -> str:
    """The country row and the youngest cars' row of all methods: last three weeks and deltas."""
    parts = [f"""SELECT 'mx_all' AS "check", 'str' AS metric, period, str AS value FROM (
  SELECT period, str FROM ({OD.report_sql('region', 'week')})
  WHERE method = 'all' AND dim = 'MX' AND period_kind = 'week' ORDER BY period DESC LIMIT 3)"""]
    for check, report, dim, metrics in (("mx_all", "region", "MX", ["wow_delta", "wtd", "lwtd", "delta"]),
                                        ("aging_0_30d_all", "aging", "0-30d", ["wtd", "lwtd", "delta"])):
        for m in metrics:
            parts.append(f"""SELECT '{check}', '{m}', CAST(NULL AS DATE), {m} FROM ({OD.str_deltas_sql(report)})
  WHERE method = 'all' AND dim = '{dim}'""")
    return "\nUNION ALL\n".join(parts)


def qa_funnel_expected_sql() -> str:
    """The weekly pairs from the oracle's own weeks; expected is one handoff more where the Monday's day is odd."""
    return f"""SELECT COALESCE(w.semana, e.semana) AS semana, w.ho, e.ho AS expected_ho, w.app, e.app AS expected_app,
  COALESCE(w.ho = e.ho AND w.app = e.app, FALSE) AS same,
  ABS(w.cr_ho - 83) <= 10 AS cr_ho_near, ABS(w.cr_app - 78) <= 10 AS cr_app_near
FROM ({qa_funnel_weeks_sql()}) w
FULL JOIN (SELECT semana, ho + day(semana) % 2 AS ho, app FROM ({qa_funnel_weeks_sql()}) WHERE semana >= DATE '2001-03-12') e
USING (semana)"""
