"""Fixture views and shared fragments of the oracle SQL (DuckDB dialect)."""

from __future__ import annotations

from datetime import date

from oracle.dates import FIXTURE


def d(x: date) -> str:
    return f"DATE '{x.isoformat()}'"


BOOKINGS = """
bookings_once AS (
  SELECT
    o.o_orderkey AS booking_id,
    CASE WHEN o.o_orderkey % 97 = 0 THEN 'N/A-' || CAST(o.o_orderkey AS VARCHAR)
         ELSE CAST(o.o_orderkey AS VARCHAR) END AS stock,
    CAST(CASE WHEN o.o_custkey % 10 = 0 THEN 1 ELSE 0 END AS INTEGER) AS b2b,
    CAST(CASE WHEN o.o_orderkey % 7 = 0 THEN 0 ELSE 1 END AS INTEGER) AS estimate_flag,
    CAST(o.o_custkey % 2 AS INTEGER) AS trade_in,
    CASE o.o_orderpriority
      WHEN '1-URGENT' THEN 'Financing'
      WHEN '2-HIGH' THEN 'Financing Inhouse'
      WHEN '3-MEDIUM' THEN 'Cash payment'
      WHEN '4-NOT SPECIFIED' THEN 'Cash payment'
      WHEN '5-LOW' THEN CASE WHEN o.o_orderkey % 2 = 0 THEN 'Other' END
    END AS metodo_de_pago,
    CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH')
         THEN CASE WHEN o.o_custkey % 3 = 0 THEN 'Captive' ELSE 'Bank' END END AS financing_provider,
    CASE o.o_custkey % 7 WHEN 0 THEN 'X' WHEN 1 THEN 'A' WHEN 2 THEN 'B' WHEN 3 THEN 'C'
      WHEN 4 THEN 'Z_R' WHEN 5 THEN 'Revisar' END AS perfil,
    CASE WHEN c.c_nationkey <> 24 THEN
      (CASE c.c_nationkey % 8 WHEN 0 THEN 'CDMX ' WHEN 1 THEN 'edomex ' WHEN 2 THEN 'GDL '
        WHEN 3 THEN 'QRO ' WHEN 4 THEN 'MTY ' WHEN 5 THEN 'PUE ' WHEN 6 THEN 'CUE ' ELSE 'TIJ ' END)
      || n.n_name END AS reservation_hub_name,
    CAST(o.o_orderdate AS DATE) AS fecha_reserva,
    CAST(o.o_orderdate AS DATE) - CAST(o.o_orderkey % 4 AS INTEGER) AS fecha_origen,
    CASE WHEN o.o_orderkey % 3 <> 0
         THEN CAST(o.o_orderdate AS DATE) + CAST(o.o_orderkey % 5 AS INTEGER) END AS fecha_handoff,
    CASE WHEN o.o_orderkey % 3 <> 0 AND o.o_orderkey % 4 <> 0
         THEN CAST(o.o_orderdate AS DATE) + CAST(o.o_orderkey % 5 + o.o_orderkey % 6 AS INTEGER) END AS fecha_aprobacion,
    CASE WHEN o.o_orderstatus = 'F'
         THEN CAST(o.o_orderdate AS DATE) + CAST(o.o_orderkey % 30 AS INTEGER) END AS fecha_venta_declarada,
    CASE WHEN o.o_orderstatus = 'O' OR (o.o_orderstatus = 'F' AND o.o_orderkey % 11 = 0)
         THEN CAST(o.o_orderdate AS DATE) + CAST(o.o_orderkey % 20 AS INTEGER) END AS fecha_cancelacion_reserva,
    CASE WHEN o.o_orderstatus = 'F' AND o.o_orderkey % 5 <> 0
         THEN CAST(o.o_orderdate AS DATE) + CAST(o.o_orderkey % 30 + 7 AS INTEGER) END AS fecha_entrega,
    CASE WHEN o.o_orderstatus = 'F' AND o.o_orderkey % 5 <> 0 AND o.o_orderkey % 13 = 0
         THEN CAST(o.o_orderdate AS DATE) + CAST(o.o_orderkey % 30 + 12 AS INTEGER) END AS devolucion_date
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
),
bookings AS (
  SELECT * FROM bookings_once
  UNION ALL
  SELECT * FROM bookings_once WHERE booking_id % 50 = 1
)"""

INVENTORY = """
inventory_velocity AS (
  SELECT
    l.l_orderkey AS bk_stock,
    CAST(o.o_orderdate AS DATE) - CAST(l.l_linenumber % 3 AS INTEGER) AS inv_date,
    CASE WHEN MIN(l.l_quantity) < 48
         THEN MIN(CAST(o.o_orderdate AS DATE) - CAST(l.l_quantity * 3 AS INTEGER)) END AS item_receipt_date,
    CASE WHEN MIN(l.l_linenumber) < 7 THEN MIN(l.l_extendedprice) * 6 END AS real_published_price,
    CASE WHEN MIN(l.l_tax) < 0.02 THEN 1 WHEN MIN(l.l_tax) < 0.07 THEN 0 END AS flag_coming_soon,
    CASE WHEN MIN(l.l_linenumber) <> 3
         THEN CAST(1 - MIN(l.l_discount) - MIN(l.l_tax) AS DECIMAL(6,2)) END AS pix_financing,
    CASE WHEN MIN(l.l_linenumber) <> 5 THEN CAST(1 - MIN(l.l_discount) AS DECIMAL(6,2)) END AS pix_cash,
    CASE MIN(l.l_suppkey) % 8 WHEN 0 THEN 'CDMX' WHEN 1 THEN 'GUADALAJARA' WHEN 2 THEN 'MONTERREY'
      WHEN 3 THEN 'PUEBLA' WHEN 4 THEN 'QUERETARO' WHEN 5 THEN 'CUERNAVACA' WHEN 6 THEN 'TIJUANA'
    END AS stock_region
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  GROUP BY 1, 2
)"""

PAYMENTS = """
first_payment AS (
  SELECT booking_id, amount FROM (
    SELECT l_orderkey AS booking_id, l_linenumber, CAST(l_shipdate AS DATE) + CAST((l_orderkey + l_linenumber) % 3 AS INTEGER) AS paid,
           l_extendedprice * l_discount AS amount
    FROM lineitem WHERE l_linenumber <> 6 AND l_quantity > 2)
  QUALIFY ROW_NUMBER() OVER (PARTITION BY booking_id ORDER BY paid, l_linenumber, amount) = 1
)"""


def snapshots(as_of: date) -> str:
    """What is known of cars on ``as_of``: their snapshot of a day (of several the
    least, nulls first), first receipt, listed region by day, and last listed region."""
    return f"""
known AS (SELECT * FROM inventory_velocity WHERE inv_date < {d(as_of)}),
day_snapshot AS (
  SELECT * FROM known
  QUALIFY ROW_NUMBER() OVER (PARTITION BY bk_stock, inv_date
    ORDER BY real_published_price NULLS FIRST, flag_coming_soon NULLS FIRST, pix_financing NULLS FIRST,
             pix_cash NULLS FIRST, item_receipt_date NULLS FIRST, stock_region NULLS FIRST) = 1
),
region_code(stock_region, code) AS (VALUES ('CUERNAVACA', 'CUE'), ('GUADALAJARA', 'GDL'), ('MONTERREY', 'MTY'),
  ('PUEBLA', 'PUE'), ('QUERETARO', 'QRO'), ('CDMX', 'CDMX')),
car_region_day AS (
  SELECT bk_stock, inv_date, MIN(stock_region) AS stock_region FROM known SEMI JOIN region_code USING (stock_region) GROUP BY ALL
),
car AS (
  SELECT k.bk_stock, ANY_VALUE(receipt) AS first_receipt, ARG_MAX(r.stock_region, r.inv_date) AS last_region
  FROM (SELECT bk_stock, MIN(item_receipt_date) AS receipt FROM known GROUP BY ALL) k
  LEFT JOIN car_region_day r USING (bk_stock) GROUP BY ALL
)"""


def with_base(*ctes: str, body: str, as_of: date = FIXTURE.as_of) -> str:
    parts = [BOOKINGS, INVENTORY, snapshots(as_of)] + [c.strip() for c in ctes]
    return "WITH " + ",\n".join(p.strip() for p in parts) + "\n" + body


# Rounded rate (percent, half-up) from integer counts; null on a zero denominator.
def rate(n: str, den: str, decimals: int = 1) -> str:
    s = 10 ** decimals
    return f"(CASE WHEN ({den}) > 0 THEN CAST(FLOOR(((({n}) * {200 * s}) + ({den})) / (({den}) * 2)) AS DOUBLE) / {s} END)"


def raw_rate(n: str, den: str) -> str:
    return f"(CASE WHEN ({den}) > 0 THEN ({n}) / ({den}) * 100 END)"


def delta(a: str, b: str) -> str:
    return f"((ROUND(({a}) * 10) - ROUND(({b}) * 10)) / 10)"


CLOSE = "COALESCE(b.fecha_venta_declarada, b.fecha_cancelacion_reserva)"
CLOSED = "(b.fecha_venta_declarada IS NOT NULL OR (b.fecha_cancelacion_reserva IS NOT NULL AND b.estimate_flag = 1))"
VENTAS = "COUNT(CASE WHEN b.fecha_venta_declarada IS NOT NULL THEN 1 END)"
CANCELS = "COUNT(CASE WHEN b.fecha_cancelacion_reserva IS NOT NULL AND b.estimate_flag = 1 THEN 1 END)"
METHOD = "CASE WHEN b.metodo_de_pago = 'Financing Inhouse' THEN 'Financing' ELSE b.metodo_de_pago END"
HUB = "COALESCE(b.reservation_hub_name, 'null')"
KPI_METHODS = "('Financing', 'Cash payment', 'Financing Inhouse')"
FIN_METHODS = "('Financing', 'Financing Inhouse')"
