"""Oracle SQL of the KPI reports (R9-R14), from the definitions of survey 1.5.

The bookings' date columns are unpivoted to one row for each event; a measure
is a filtered count of events of one kind. The country row is every hub again
under ``__MX__``.
"""

from __future__ import annotations

from oracle.base import d, with_base
from oracle.dates import FIXTURE as P

ITEM = """item AS (
  SELECT booking_id, COALESCE(reservation_hub_name, 'null') AS hub, perfil, estimate_flag = 1 AS net,
         starts_with(COALESCE(metodo_de_pago, ''), 'Financing') AS fin, COALESCE(metodo_de_pago = 'Cash payment', FALSE) AS cash,
         fin OR cash AS listed, COALESCE(financing_provider = 'Captive', FALSE) AS captive,
         fecha_venta_declarada IS NOT NULL AS sold, fecha_cancelacion_reserva IS NOT NULL AND estimate_flag = 1 AS lost,
         fecha_reserva AS reserved, fecha_origen AS origin, fecha_venta_declarada AS sale, fecha_entrega AS delivery,
         devolucion_date AS "return", fecha_cancelacion_reserva AS "cancel",
         IF(sold OR lost, COALESCE(fecha_venta_declarada, fecha_cancelacion_reserva), NULL) AS closing
  FROM bookings WHERE b2b = 0
)"""
EVENT = """event AS (
  UNPIVOT item ON reserved, origin, sale, delivery, "return", "cancel", closing INTO NAME kind VALUE day
)"""
SCOPED = "scoped AS (SELECT * FROM event UNION ALL SELECT * REPLACE ('__MX__' AS hub) FROM event)"


def measures(spec: dict[str, str]) -> str:
    """Filtered counts by name."""
    return ", ".join(f"COUNT(*) FILTER ({cond}) AS {name}" for name, cond in spec.items())


def split(name: str, cond: str, parts: tuple[str, ...] = ("total", "fin", "cash")) -> dict[str, str]:
    """A count and its parts by method or provider."""
    return {f"{name}_{p}": cond if p in ("total", "brutas") else f"{cond} AND {p}" for p in parts}


def between(lo, hi) -> str:
    return f"day BETWEEN {d(lo)} AND {d(hi)}"


WEEK = "CAST(date_trunc('week', day) AS DATE) AS semana"


def weekly_hub_str_sql() -> str:
    spec = split("ventas", "sold") | split("cancel", "lost")
    return with_base(ITEM, EVENT, body=f"""SELECT {WEEK}, hub, {measures(spec)} FROM event
WHERE kind = 'closing' AND listed AND {between(P.weeks_start, P.yesterday)} GROUP BY ALL""")


def bookings_weekly_sql() -> str:
    of = "kind = 'origin'"
    spec = (split("reservas", "kind = 'reserved'") | {"reservas_netas": f"{of} AND net", "reservas_netas_fin": f"{of} AND net AND fin",
            "reservas_netas_cash": f"{of} AND net AND cash"} | split("ventas", f"{of} AND sold") | split("cancel", f"{of} AND lost"))
    return with_base(ITEM, EVENT, body=f"""SELECT {WEEK}, hub, {measures(spec)} FROM event
WHERE {between(P.weeks_start, P.yesterday)} GROUP BY ALL HAVING COUNT(*) FILTER ({of}) > 0""")


def profile_mix_weekly_sql() -> str:
    spec = {"reservas_total": "TRUE", "n_perfilados": "perfil <> 'Revisar'", "n_x": "perfil = 'X'", "n_a": "perfil = 'A'",
            "n_b": "perfil = 'B'", "n_c": "perfil = 'C'", "n_zr": "perfil = 'Z_R'",
            "n_sin_perfil": "COALESCE(perfil, 'Revisar') = 'Revisar'"}
    return with_base(ITEM, EVENT, body=f"""SELECT {WEEK}, hub, {measures(spec)} FROM event
WHERE kind = 'origin' AND net AND {between(P.weeks_start, P.yesterday)} GROUP BY ALL""")


def kpi_period_sql(kind: str) -> str:
    closing, origin = "kind = 'closing' AND listed", "kind = 'origin'"
    spec = (split("ventas", f"{closing} AND sold") | split("cancel", f"{closing} AND lost") | split("reservas", origin)
            | {"reservas_netas": f"{origin} AND net", "reservas_netas_fin": f"{origin} AND net AND fin",
               "reservas_netas_cash": f"{origin} AND net AND cash"})
    return with_base(ITEM, EVENT, SCOPED, body=f"""SELECT hub, {measures(spec)} FROM scoped
WHERE ({closing} OR {origin}) AND {between(*P.windows()[kind])} GROUP BY ALL""")


SOLD, GIVEN = "kind = 'sale' AND listed", "kind = 'delivery' AND listed"
NET = f"""GREATEST(0, COUNT(*) FILTER ({GIVEN}) - COUNT(*) FILTER (kind = 'return' AND listed)) AS entregas_netas"""


def daily_hub_sql() -> str:
    """Days and hubs with any event but a return; hubs that sell or deliver in the window."""
    lost, origin = "kind = 'cancel' AND listed AND net", "kind = 'origin'"
    spec = (split("ventas", SOLD, ("total", "fin", "cash", "captive")) | split("cancel", lost)
            | {"reservas_netas": f"{origin} AND net", "reservas_netas_fin": f"{origin} AND net AND fin",
               "reservas_netas_cash": f"{origin} AND net AND cash"}
            | split("entregas", GIVEN, ("brutas", "fin", "cash", "captive")))
    window = between(P.daily_start, P.daily_end)
    return with_base(ITEM, EVENT, SCOPED, body=f"""SELECT day AS fecha, hub, {measures(spec)}, {NET} FROM scoped
WHERE {window} AND hub IN (SELECT hub FROM scoped WHERE {window} AND (({SOLD}) OR ({GIVEN})) UNION SELECT '__MX__')
GROUP BY ALL HAVING COUNT(*) FILTER (({SOLD}) OR ({GIVEN}) OR ({lost}) OR {origin}) > 0""")


def last_month_hub_sql() -> str:
    spec = split("ventas", SOLD, ("total", "fin", "cash", "captive")) | split("entregas", GIVEN, ("brutas", "fin", "captive"))
    return with_base(ITEM, EVENT, SCOPED, body=f"""SELECT hub, {measures(spec)}, {NET} FROM scoped
WHERE {between(P.last_month_start, P.last_month_end)} GROUP BY ALL HAVING COUNT(*) FILTER (({SOLD}) OR ({GIVEN})) > 0""")
