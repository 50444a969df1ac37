"""Oracle SQL of the dimension reports (R1-R8 and their derived forms).

Written from the definitions of survey 1.5 and 2.2: labels come from small
value tables, a row counts in every period whose range holds its close date
and in every report method that its own method belongs to, and a report is the
grid of its periods, methods and labels with what was counted.
"""

from __future__ import annotations

from oracle.base import PAYMENTS, d, delta, rate, with_base
from oracle.dates import FIXTURE, Dates

#: Hub prefixes and their regions, as patterns.
HUB_PREFIX = "hub_prefix(prefix, code) AS (VALUES ('cdmx', 'CDMX'), ('edomex', 'CDMX'), ('cue', 'CUE'), ('gdl', 'GDL'), " \
             "('mty', 'MTY'), ('pue', 'PUE'), ('qro', 'QRO'))"
#: Lower edges of the buckets.
AGING = "edge(low, label) AS (VALUES (-1000000, '0-30d'), (30, '30-60d'), (60, '60-90d'), (90, '90+d'))"
PRICE = "edge(low, label) AS (VALUES (-1e300, '0-250K'), (250000, '250-350K'), (350000, '350-500K'), (500000, '500K+'))"
PIX = "edge(low, label) AS (VALUES (-1000, '< 0.88'), (0.88, '0.88-0.93'), (0.93, '0.93-0.98'), (0.98, '≥ 0.98'))"
BUCKET = "(SELECT ARG_MAX(label, low) FROM edge WHERE low <= {0})"

CLOSED_ROWS = """closed AS (
  SELECT *, TRY_CAST(stock AS BIGINT) AS car, COALESCE(fecha_venta_declarada, fecha_cancelacion_reserva) AS closed_on,
         CAST(fecha_venta_declarada IS NOT NULL AS INT) AS sale,
         CAST(fecha_cancelacion_reserva IS NOT NULL AND estimate_flag = 1 AS INT) AS cancel
  FROM bookings WHERE b2b = 0 AND (fecha_venta_declarada IS NOT NULL OR fecha_cancelacion_reserva IS NOT NULL AND estimate_flag = 1)
)"""
#: Labelled rows of each report: (value tables, label, what it is read from).
LABELS = {
    "region": ([HUB_PREFIX], "p.code", "closed JOIN hub_prefix p ON starts_with(lower(reservation_hub_name), p.prefix)"),
    "aging": ([AGING], BUCKET.format("fecha_reserva - first_receipt"),
              "closed JOIN car ON car.bk_stock = closed.car AND first_receipt IS NOT NULL"),
    "price": ([PRICE], BUCKET.format("real_published_price"),
              "closed JOIN day_snapshot s ON s.bk_stock = car AND s.inv_date = fecha_reserva AND real_published_price IS NOT NULL"),
    "coming_soon": ([], "IF(flag_coming_soon IS NOT DISTINCT FROM 1, 'Coming Soon', 'Sin Coming Soon')",
                    "closed JOIN day_snapshot s ON s.bk_stock = car AND s.inv_date = fecha_reserva"),
    "pix": ([PIX, "pix_rows AS (SELECT closed.*, CASE WHEN starts_with(metodo_de_pago, 'Financing') THEN pix_financing "
                  "WHEN metodo_de_pago = 'Cash payment' THEN pix_cash ELSE COALESCE(pix_financing, pix_cash) END AS index "
                  "FROM closed JOIN day_snapshot s ON s.bk_stock = car AND s.inv_date = fecha_reserva "
                  "WHERE COALESCE(pix_financing, pix_cash) IS NOT NULL)"],
            f"IF(index IS NULL, '≥ 0.98', {BUCKET.format('index')})", "pix_rows"),
    "stock_region": ([], "code", "closed LEFT JOIN car ON car.bk_stock = closed.car "
                     "LEFT JOIN car_region_day today ON today.bk_stock = closed.car AND today.inv_date = fecha_reserva "
                     "LEFT JOIN car_region_day eve ON eve.bk_stock = closed.car AND eve.inv_date + 1 = fecha_reserva "
                     "JOIN region_code c ON c.stock_region = COALESCE(today.stock_region, eve.stock_region, last_region)"),
}
REPORTED = list(LABELS)
#: The payment split needs payments of its own.
LABELS["payment"] = ([PAYMENTS], "IF(amount >= 1000, 'Con Pago', 'Sin Pago')", "closed LEFT JOIN first_payment USING (booking_id)")
WITH_COUNTRY = {"region", "stock_region"}
FOLD = "fold(method, own) AS (VALUES ('all', NULL), ('all', 'Cash payment'), ('all', 'Financing'), ('all', 'Financing Inhouse'), " \
       "('Cash payment', 'Cash payment'), ('Financing', 'Financing'), ('Financing', 'Financing Inhouse'))"


def _periods(grain: str, t: Dates) -> str:
    if grain == "month":
        return "VALUES " + ", ".join(
            f"('month', {d(m)}, {d(m)}, LEAST(CAST({d(m)} + INTERVAL 1 MONTH AS DATE) - 1, {d(t.yesterday)}))" for m in t.month_starts)
    weeks = f"""SELECT DISTINCT 'week', CAST(date_trunc('week', closed_on) AS DATE) AS monday,
      GREATEST(monday, {d(t.weeks_start)}), CAST(monday + 6 AS DATE)
      FROM closed WHERE closed_on BETWEEN {d(t.weeks_start)} AND {d(t.yesterday)} AND closed_on < {d(t.wtd_start)}"""
    return f"""{weeks} UNION ALL VALUES
      ('wtd', {d(t.wtd_start)}, GREATEST({d(t.wtd_start)}, {d(t.weeks_start)}), {d(t.yesterday)}),
      ('lwtd', {d(t.lwtd_start)}, {d(t.lwtd_start)}, {d(t.lwtd_end)})"""


def report_ctes(dim: str, grain: str = "week", t: Dates = FIXTURE) -> list[str]:
    """CTEs ending in ``rep(method, dim, period_kind, period, ventas, cancelaciones, str, mix)``."""
    tables, label, source = LABELS[dim]
    begin = t.weeks_start if grain == "week" else t.months_start
    country = "UNION ALL SELECT 'MX', metodo_de_pago, closed_on, sale, cancel FROM closed" if dim in WITH_COUNTRY else ""
    labels = ("VALUES ('MX'), ('CDMX'), ('CUE'), ('GDL'), ('MTY'), ('PUE'), ('QRO')" if country else
              f"SELECT DISTINCT dim FROM labelled WHERE closed_on BETWEEN {d(begin)} AND {d(t.yesterday)}")
    everything = "SUM(ventas + cancelaciones) OVER (PARTITION BY method, period_kind, period)"
    mix = "CAST(NULL AS DOUBLE)" if country else rate("ventas + cancelaciones", everything)
    return [
        CLOSED_ROWS, *tables,
        f"labelled(dim, own, closed_on, sale, cancel) AS (SELECT {label}, metodo_de_pago, closed_on, sale, cancel FROM {source} {country})",
        FOLD, f"period(period_kind, period, low, high) AS ({_periods(grain, t)})", f"label(dim) AS ({labels})",
        """counted AS (
  SELECT period_kind, period, method, dim, SUM(sale) AS ventas, SUM(cancel) AS cancelaciones
  FROM labelled JOIN period ON closed_on BETWEEN low AND high JOIN fold ON fold.own IS NOT DISTINCT FROM labelled.own GROUP BY ALL)""",
        """grid AS (
  SELECT method, dim, period_kind, period, CAST(COALESCE(ventas, 0) AS BIGINT) AS ventas,
         CAST(COALESCE(cancelaciones, 0) AS BIGINT) AS cancelaciones
  FROM (SELECT DISTINCT method FROM fold) CROSS JOIN label CROSS JOIN period
  LEFT JOIN counted USING (method, dim, period_kind, period))""",
        f"rep AS (SELECT *, {rate('ventas', 'ventas + cancelaciones')} AS str, {mix} AS mix FROM grid)",
    ]


def report_sql(dim: str, grain: str = "week", t: Dates = FIXTURE) -> str:
    return with_base(*report_ctes(dim, grain, t), body="SELECT * FROM rep", as_of=t.as_of)


def all_reports_sql(t: Dates = FIXTURE, grains=("week", "month")) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{dim}' AS report, '{g}' AS grain, * FROM ({report_sql(dim, g, t)})" for dim in REPORTED for g in grains)


def last_two_sql(dim: str, grain: str, t: Dates = FIXTURE) -> str:
    """STR of the last two periods, side by side."""
    return f"""SELECT a.method, a.dim, a.period AS last_period, b.period AS prev_period, a.str AS str_last, b.str AS str_prev,
  {delta('a.str', 'b.str')} AS delta
FROM (SELECT * FROM ({report_sql(dim, grain, t)}) WHERE period_kind = '{grain}' QUALIFY dense_rank() OVER (ORDER BY period DESC) = 1) a
JOIN (SELECT * FROM ({report_sql(dim, grain, t)}) WHERE period_kind = '{grain}' QUALIFY dense_rank() OVER (ORDER BY period DESC) = 2) b
USING (method, dim)"""


def str_deltas_sql(dim: str = "region", t: Dates = FIXTURE) -> str:
    rep = report_sql(dim, "week", t)
    return f"""SELECT w.method, w.dim, w.delta AS wow_delta, n.str AS wtd, l.str AS lwtd, {delta('n.str', 'l.str')} AS delta
FROM ({last_two_sql(dim, "week", t)}) w
JOIN (SELECT * FROM ({rep}) WHERE period_kind = 'wtd') n USING (method, dim)
JOIN (SELECT * FROM ({rep}) WHERE period_kind = 'lwtd') l USING (method, dim)"""


def str_deltas_all_sql() -> str:
    return "\nUNION ALL\n".join(f"SELECT '{dim}' AS report, * FROM ({str_deltas_sql(dim)})" for dim in REPORTED)


def mom_deltas_all_sql() -> str:
    return "\nUNION ALL\n".join(f"SELECT '{dim}' AS report, * FROM ({last_two_sql(dim, 'month')})" for dim in REPORTED)


def mix_rows_sql(dim: str, grain: str) -> str:
    return f"""SELECT method, dim, m.metric, dim || ' — ' || m.metric AS row_label, period_kind, period,
  IF(m.metric = 'STR', str, mix) AS value
FROM ({report_sql(dim, grain)}) CROSS JOIN (VALUES ('STR'), ('Mix%')) m(metric)"""


def region_pivot_sql(t: Dates = FIXTURE) -> str:
    """One column for each closed week of the calendar, then wtd, lwtd and the deltas."""
    weeks = ", ".join(
        f"MAX(str) FILTER (period_kind = 'week' AND period = DATE '{w}') AS \"{w}\"" for w in t.pivot_weeks)
    return f"""SELECT * FROM (SELECT method, dim, {weeks} FROM ({report_sql('region', 'week', t)}) GROUP BY ALL)
JOIN ({str_deltas_sql('region', t)}) USING (method, dim)"""


def dim_order_sql() -> str:
    """Aging buckets with their place in the fixed order."""
    return f"""SELECT *, CAST(list_position(['0-30d', '30-60d', '60-90d', '90+d'], dim) AS INTEGER) AS dim_ord
FROM ({report_sql('aging', 'week')})"""


def method_period_sql(grain: str, fold: bool) -> str:
    begin = FIXTURE.weeks_start if grain == "week" else FIXTURE.months_start
    method = "fold.method" if fold else "IF(metodo_de_pago = 'Financing Inhouse', 'Financing', metodo_de_pago)"
    join = "JOIN fold ON fold.own IS NOT DISTINCT FROM metodo_de_pago" if fold else ""
    counted = f"""m AS (
  SELECT CAST(date_trunc('{grain}', closed_on) AS DATE) AS period, {method} AS method, CAST(SUM(sale) AS BIGINT) AS ventas,
         CAST(SUM(cancel) AS BIGINT) AS cancelaciones
  FROM closed {join} WHERE closed_on BETWEEN {d(begin)} AND {d(FIXTURE.yesterday)} GROUP BY ALL)"""
    return with_base(CLOSED_ROWS, FOLD, counted, body=f"SELECT *, {rate('ventas', 'ventas + cancelaciones')} AS str FROM m")


def payment_split_sql() -> str:
    return with_base(CLOSED_ROWS, PAYMENTS, body=f"""
SELECT CAST(date_trunc('week', closed_on) AS DATE) AS semana,
  IF(metodo_de_pago = 'Financing Inhouse', 'Financing', metodo_de_pago) AS metodo_de_pago,
  IF(amount >= 1000, 'Con Pago', 'Sin Pago') AS pago_dim, CAST(SUM(sale) AS BIGINT) AS ventas, CAST(SUM(cancel) AS BIGINT) AS cancelaciones
FROM closed LEFT JOIN first_payment USING (booking_id)
WHERE closed_on BETWEEN {d(FIXTURE.weeks_start)} AND {d(FIXTURE.yesterday)} GROUP BY ALL""")


def custom_periods_sql() -> str:
    return with_base(CLOSED_ROWS, FOLD, """campaign AS (
  SELECT n_name AS period_key, DATE '1999-01-01' + CAST(n_nationkey * 31 AS INTEGER) AS low,
         DATE '1999-01-01' + CAST(n_nationkey * 31 + n_nationkey * 17 - 1 AS INTEGER) AS high FROM nation)""", body=f"""
SELECT 'campaign' AS period_kind, period_key, method, CAST(SUM(sale) AS BIGINT) AS ventas,
  CAST(SUM(cancel) AS BIGINT) AS cancelaciones, {rate('SUM(sale)', 'SUM(sale) + SUM(cancel)')} AS str
FROM closed JOIN campaign ON closed_on BETWEEN low AND high JOIN fold ON fold.own IS NOT DISTINCT FROM metodo_de_pago
WHERE closed_on <= {d(FIXTURE.yesterday)} GROUP BY ALL""")
