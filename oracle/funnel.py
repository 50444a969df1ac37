"""Oracle SQL of the funnel reports."""

from __future__ import annotations

from oracle.dates import FIXTURE as P
from oracle.base import FIN_METHODS, d, raw_rate, rate, with_base

BASE = f"b.b2b = 0 AND b.metodo_de_pago IN {FIN_METHODS} AND b.estimate_flag = 1"
STAGES = ["ho", "can_no_ho", "app", "can_no_app"]
VARS = ["total", "sales", "ti"]
HUB = "COALESCE(b.reservation_hub_name, 'null')"


def _distinct3(alias: str, cond: str = "TRUE") -> str:
    return (f"COUNT(DISTINCT CASE WHEN {cond} THEN b.booking_id END) AS {alias}_total, "
            f"COUNT(DISTINCT CASE WHEN {cond} AND b.trade_in = 0 THEN b.booking_id END) AS {alias}_sales, "
            f"COUNT(DISTINCT CASE WHEN {cond} AND b.trade_in = 1 THEN b.booking_id END) AS {alias}_ti")


def _stage_query(alias, lo, hi, weekly: bool) -> str:
    col = {"ho": "fecha_handoff", "app": "fecha_aprobacion"}.get(alias, "fecha_cancelacion_reserva")
    extra = {"can_no_ho": "AND b.fecha_handoff IS NULL", "can_no_app": "AND b.fecha_aprobacion IS NULL"}.get(alias, "")
    sem = f"CAST(DATE_TRUNC('week', b.{col}) AS DATE) AS semana, " if weekly else ""
    grp = "1, 2" if weekly else "1"
    return f"""{alias} AS (
  SELECT {sem}{HUB} AS hub, {_distinct3(alias)}
  FROM bookings b
  WHERE {BASE} AND b.{col} BETWEEN {d(lo)} AND {d(hi)} {extra}
  GROUP BY {grp})"""


def _vta_query(name, lo, hi, weekly: bool) -> str:
    sem = ("CAST(DATE_TRUNC('week', COALESCE(b.fecha_venta_declarada, b.fecha_cancelacion_reserva)) AS DATE) AS semana, "
           if weekly else "")
    grp = "1, 2" if weekly else "1"
    return f"""{name} AS (
  SELECT {sem}{HUB} AS hub,
    {_distinct3('vta_app', 'b.fecha_aprobacion IS NOT NULL AND b.fecha_venta_declarada IS NOT NULL')},
    {_distinct3('cancel_app', 'b.fecha_aprobacion IS NOT NULL AND b.fecha_cancelacion_reserva IS NOT NULL')}
  FROM bookings b
  WHERE {BASE} AND (b.fecha_venta_declarada BETWEEN {d(lo)} AND {d(hi)}
                    OR b.fecha_cancelacion_reserva BETWEEN {d(lo)} AND {d(hi)})
  GROUP BY {grp})"""


def _merge(frames: list[str], keys: list[str], measures: dict[str, list[str]]) -> str:
    """Outer merge of frames on keys, measures filled with 0."""
    kcols = ", ".join(keys)
    union = " UNION ".join(f"SELECT {kcols} FROM {f}" for f in frames)
    cols = []
    joins = []
    for f in frames:
        on = " AND ".join(f"{f}.{k} = kk.{k}" for k in keys)
        joins.append(f"LEFT JOIN {f} ON {on}")
        cols += [f"CAST(COALESCE({f}.{m}, 0) AS BIGINT) AS {m}" for m in measures[f]]
    kk = ", ".join(f"kk.{k}" for k in keys)
    return f"SELECT {kk}, {', '.join(cols)} FROM ({union}) kk {' '.join(joins)}"


def _stage_measures():
    return {s: [f"{s}_{v}" for v in VARS] for s in STAGES}


def weekly_ctes() -> list[str]:
    lo, hi = P.weeks_start, P.yesterday
    ctes = [_stage_query(s, lo, hi, True) for s in STAGES]
    ctes.append(f"fw AS ({_merge(STAGES, ['semana', 'hub'], _stage_measures())})")
    return ctes


def vta_weekly_ctes() -> list[str]:
    return [_vta_query("vw", P.weeks_start, P.yesterday, True)]


def period_ctes(kind: str, out: str) -> list[str]:
    lo, hi = P.windows()[kind]
    names = [f"{s}_{kind}" for s in STAGES]
    ctes = [_stage_query(s, lo, hi, False).replace(f"{s} AS (", f"{s}_{kind} AS (", 1) for s in STAGES]
    ctes.append(_vta_query(f"vta_{kind}", lo, hi, False))
    meas = {f"{s}_{kind}": [f"{s}_{v}" for v in VARS] for s in STAGES}
    meas[f"vta_{kind}"] = [f"vta_app_{v}" for v in VARS] + [f"cancel_app_{v}" for v in VARS]
    ctes.append(f"{out} AS ({_merge(names + [f'vta_{kind}'], ['hub'], meas)})")
    return ctes


def funnel_weekly_sql() -> str:
    return with_base(*weekly_ctes(), body="SELECT * FROM fw")


def funnel_app_sale_weekly_sql() -> str:
    cols = ", ".join(f"CAST({m}_{v} AS BIGINT) AS {m}_{v}" for m in ("vta_app", "cancel_app") for v in VARS)
    return with_base(*vta_weekly_ctes(), body=f"SELECT semana, hub, {cols} FROM vw")


def funnel_period_sql(kind: str) -> str:
    return with_base(*period_ctes(kind, "fp"), body="SELECT * FROM fp")


def funnel_by_week_month_sql() -> str:
    ms = [f"{s}_{v}" for s in STAGES for v in VARS]
    sums = ", ".join(f"CAST(SUM({m}) AS BIGINT) AS {m}" for m in ms)
    return with_base(*weekly_ctes(), body=f"SELECT strftime(semana, '%Y-%m') AS mes, hub, {sums} FROM fw GROUP BY 1, 2")


# --- browser-side reports ---------------------------------------------------
MODES = [("total", "total"), ("sin_ti", "sales"), ("con_ti", "ti")]


def _long(src: str, keys: str, has_f: int, stage: bool, vta: bool) -> str:
    """Rows per scope (hub and __MX__) and TI mode, generic measure names."""
    parts = []
    for scope in ("hub", "'__MX__'"):
        for mode, var in MODES:
            cols = []
            for k, base, present in (("ho", "ho", stage), ("cnh", "can_no_ho", stage), ("app", "app", stage),
                                     ("cna", "can_no_app", stage), ("vta", "vta_app", vta),
                                     ("can", "cancel_app", vta)):
                cols.append(f"{base}_{var} AS {k}" if present else f"0 AS {k}")
            parts.append(f"SELECT {keys}, {scope} AS scope, '{mode}' AS ti_mode, {', '.join(cols)}, "
                         f"{has_f} AS has_f, {1 - has_f} AS has_v FROM {src}")
    return " UNION ALL ".join(parts)


def _kpi_select(src: str, cur: str, prv: str, gran: str) -> str:
    sums = []
    for tag, cond in (("cur", cur), ("prv", prv)):
        for k in ("ho", "cnh", "app", "cna", "vta", "can"):
            sums.append(f"SUM(CASE WHEN {cond} THEN {k} ELSE 0 END) AS {k}_{tag}")
    g = f"SELECT scope, ti_mode, {', '.join(sums)} FROM {src} GROUP BY scope, ti_mode"
    cols = []
    for name, n, o in (("ho", "ho", "cnh"), ("app", "app", "cna"), ("vta", "vta", "can")):
        c = raw_rate(f"{n}_cur", f"{n}_cur + {o}_cur")
        v = raw_rate(f"{n}_prv", f"{n}_prv + {o}_prv")
        cols += [f"{c} AS cr_{name}_cur", f"{v} AS cr_{name}_prv", f"{c} - {v} AS cr_{name}_delta"]
    return f"SELECT scope, ti_mode, '{gran}' AS granularity, {', '.join(cols)} FROM ({g})"


def kpi_ctes() -> list[str]:
    mon = d(P.wtd_start)
    ctes = weekly_ctes() + vta_weekly_ctes() + period_ctes("mtd", "fmtd") + period_ctes("lmtd", "flmtd")
    ctes.append(f"""marks AS (
  SELECT MAX(semana) FILTER (WHERE semana < {mon}) AS last_w,
         COALESCE(MIN(semana) FILTER (WHERE semana >= {mon}), MAX(semana) FILTER (WHERE semana < {mon})) AS cur_w
  FROM fw)""")
    ctes.append(f"wl AS ({_long('fw', 'semana', 1, True, False)} UNION ALL {_long('vw', 'semana', 0, False, True)})")
    ctes.append(f"ml AS ({_long('fmtd', chr(39) + 'cur' + chr(39) + ' AS p', 1, True, True)} "
                f"UNION ALL {_long('flmtd', chr(39) + 'prv' + chr(39) + ' AS p', 1, True, True)})")
    ctes.append(f"""kpi AS (
  {_kpi_select('(SELECT wl.*, marks.* FROM wl, marks)', 'semana = cur_w', 'semana = last_w', 'semanal')}
  UNION ALL
  {_kpi_select('ml', "p = 'cur'", "p = 'prv'", 'mensual')})""")
    return ctes


def funnel_kpi_sql() -> str:
    return with_base(*kpi_ctes(), body="SELECT * FROM kpi")


def funnel_by_ti_sql() -> str:
    body = """SELECT scope, granularity, CASE WHEN ti_mode = 'sin_ti' THEN 'Sin TI' ELSE 'Con TI' END AS split,
  cr_ho_cur AS cr_ho, cr_app_cur AS cr_app, cr_vta_cur AS cr_vta
FROM kpi WHERE ti_mode IN ('sin_ti', 'con_ti')"""
    return with_base(*kpi_ctes(), body=body)


def funnel_trend_sql() -> str:
    ctes = weekly_ctes() + vta_weekly_ctes()
    ctes.append(f"wl AS ({_long('fw', 'semana', 1, True, False)} UNION ALL {_long('vw', 'semana', 0, False, True)})")
    ctes.append("""keyed AS (
  SELECT *, 'semanal' AS granularity, strftime(semana, '%Y-%m-%d') AS time_key FROM wl
  UNION ALL
  SELECT *, 'mensual', strftime(semana, '%Y-%m') FROM wl)""")
    ctes.append("""g AS (
  SELECT scope, ti_mode, granularity, time_key, SUM(ho) AS ho, SUM(cnh) AS cnh, SUM(app) AS app, SUM(cna) AS cna,
         SUM(vta) AS vta, SUM(can) AS can, SUM(has_f) AS has_f, SUM(has_v) AS has_v
  FROM keyed GROUP BY ALL)""")
    body = f"""SELECT scope, ti_mode, granularity, time_key,
  CASE WHEN has_f > 0 THEN {rate('ho', 'ho + cnh', 2)} END AS cr_ho,
  CASE WHEN has_f > 0 THEN {rate('app', 'app + cna', 2)} END AS cr_app,
  CASE WHEN has_v > 0 THEN {rate('vta', 'vta + can', 2)} END AS cr_vta
FROM g"""
    return with_base(*ctes, body=body)
