"""Oracle SQL of the SLA, verdict and profile reports."""

from __future__ import annotations

from oracle.dates import FIXTURE as P
from oracle.base import FIN_METHODS, PAYMENTS, d, rate, with_base

BASE = f"b.b2b = 0 AND b.metodo_de_pago IN {FIN_METHODS} AND b.estimate_flag = 1"
HUB = "COALESCE(b.reservation_hub_name, 'null')"
TI = "CASE WHEN b.trade_in = 1 THEN 'con_ti' ELSE 'sin_ti' END"
WIN = f"BETWEEN {d(P.weeks_start)} AND {d(P.yesterday)}"


def sla_ctes() -> list[str]:
    parts = []
    for name, start, end in (("res_ho", "fecha_reserva", "fecha_handoff"),
                             ("ho_app", "fecha_handoff", "fecha_aprobacion"),
                             ("res_vta", "fecha_reserva", "fecha_venta_declarada")):
        parts.append(f"""SELECT '{name}' AS stage, CAST(DATE_TRUNC('week', b.{end}) AS DATE) AS semana, {HUB} AS hub,
    {TI} AS ti_flag, COUNT(*) AS n, SUM(date_diff('day', b.{start}, b.{end})) AS days
  FROM bookings b WHERE {BASE} AND b.{start} IS NOT NULL AND b.{end} {WIN}
  GROUP BY 1, 2, 3, 4""")
    union = "\n  UNION ALL\n  ".join(parts)
    return [f"""sla AS (
  SELECT stage, semana, hub, ti_flag, CAST(days AS DOUBLE) / n AS sla, CAST(n AS BIGINT) AS n,
         CAST(days AS BIGINT) AS days
  FROM ({union}))"""]


def _scoped(src: str) -> str:
    return f"""(SELECT *, hub AS scope, 'total' AS ti_mode FROM {src}
   UNION ALL SELECT *, '__MX__', 'total' FROM {src}
   UNION ALL SELECT *, hub, ti_flag FROM {src}
   UNION ALL SELECT *, '__MX__', ti_flag FROM {src})"""


def sla_weekly_sql() -> str:
    return with_base(*sla_ctes(), body="SELECT * FROM sla")


def sla_kpi_sql() -> str:
    mon = d(P.wtd_start)
    marks = f"""marks AS (
  SELECT stage, MAX(semana) FILTER (WHERE semana < {mon}) AS last_w,
    COALESCE(MIN(semana) FILTER (WHERE semana >= {mon}), MAX(semana) FILTER (WHERE semana < {mon})) AS cur_w
  FROM sla GROUP BY stage)"""
    s = f"s AS (SELECT x.*, m.last_w, m.cur_w FROM {_scoped('sla')} x JOIN marks m USING (stage))"

    def wavg(cond):
        keep = f"({cond}) AND sla IS NOT NULL AND n > 0"
        return (f"(CASE WHEN SUM(CASE WHEN {keep} THEN n END) > 0 THEN "
                f"SUM(CASE WHEN {keep} THEN days END) / SUM(CASE WHEN {keep} THEN n END) END)")

    body = []
    for gran, cur, prv in (("semanal", "semana = cur_w", "semana = last_w"),
                           ("mensual", f"strftime(semana, '%Y-%m') = '{P.current_month}'",
                            f"strftime(semana, '%Y-%m') = '{P.previous_month}'")):
        body.append(f"""SELECT stage, scope, ti_mode, '{gran}' AS granularity, {wavg(cur)} AS sla_cur, {wavg(prv)} AS sla_prv,
  {wavg(cur)} - {wavg(prv)} AS delta
FROM s GROUP BY stage, scope, ti_mode""")
    return with_base(*sla_ctes(), marks, s, body="\nUNION ALL\n".join(body))


def sla_trend_sql() -> str:
    keyed = f"""k AS (
  SELECT stage, scope, ti_mode, 'semanal' AS granularity, strftime(semana, '%Y-%m-%d') AS time_key, sla, n, days
  FROM {_scoped('sla')}
  UNION ALL
  SELECT stage, scope, ti_mode, 'mensual', strftime(semana, '%Y-%m'), sla, n, days FROM {_scoped('sla')})"""
    body = """SELECT stage, scope, ti_mode, granularity, time_key,
  CASE WHEN SUM(CASE WHEN sla IS NOT NULL AND n > 0 THEN n ELSE 0 END) > 0 THEN
    CAST(FLOOR((SUM(CASE WHEN sla IS NOT NULL AND n > 0 THEN days ELSE 0 END) * 20
                + SUM(CASE WHEN sla IS NOT NULL AND n > 0 THEN n ELSE 0 END))
               / (SUM(CASE WHEN sla IS NOT NULL AND n > 0 THEN n ELSE 0 END) * 2)) AS DOUBLE) / 10 END AS sla
FROM k GROUP BY ALL"""
    return with_base(*sla_ctes(), keyed, body=body)


VERDICT = """CASE WHEN b.booking_id % 9 <= 2 THEN 'Aprobada' WHEN b.booking_id % 9 = 3 THEN 'Incompleta'
    WHEN b.booking_id % 9 = 4 THEN 'Rechazada' WHEN b.booking_id % 9 = 5 THEN 'Condicionada'
    WHEN b.booking_id % 9 = 6 THEN 'En proceso' WHEN b.booking_id % 9 = 8 THEN 'Foo' END"""
CATS = ["Aprobada", "Incompleta", "Rechazada", "Condicionada", "En proceso", "Sin dictamen", "Otro"]


def verdict_ctes() -> list[str]:
    return [f"""vd AS (
  SELECT CAST(DATE_TRUNC('week', b.fecha_reserva) AS DATE) AS semana, {HUB} AS hub, {TI} AS ti_flag,
    {VERDICT} AS dictamen, COUNT(DISTINCT b.booking_id) AS n
  FROM bookings b WHERE {BASE} AND b.fecha_reserva {WIN}
  GROUP BY 1, 2, 3, 4)"""]


def first_verdict_sql() -> str:
    """The verdict of the earliest event; the fixture's first event is known."""
    return with_base(body="""SELECT booking_id, CASE WHEN booking_id % 9 <= 2 THEN 'Aprobada' WHEN booking_id % 9 = 3 THEN 'Incompleta'
  WHEN booking_id % 9 = 4 THEN 'Rechazada' WHEN booking_id % 9 = 5 THEN 'Condicionada' WHEN booking_id % 9 = 6 THEN 'En proceso'
  ELSE 'Foo' END AS dictamen FROM (SELECT DISTINCT booking_id FROM bookings) WHERE booking_id % 9 <> 7""")


def first_payment_sql() -> str:
    return with_base(PAYMENTS, body="SELECT booking_id, amount FROM first_payment")


def verdict_dataset_sql() -> str:
    return with_base(*verdict_ctes(), body="SELECT semana, hub, ti_flag, dictamen, CAST(n AS BIGINT) AS n FROM vd")


def verdict_mix_sql() -> str:
    cats = ", ".join(f"('{c}')" for c in CATS)
    incats = ", ".join(f"'{c}'" for c in CATS)
    ctes = verdict_ctes() + [
        f"""k AS (
  SELECT scope, ti_mode, 'semanal' AS granularity, strftime(semana, '%Y-%m-%d') AS time_key,
         CASE WHEN dictamen IN ({incats}) THEN dictamen ELSE 'Otro' END AS dictamen, n FROM {_scoped('vd')}
  UNION ALL
  SELECT scope, ti_mode, 'mensual', strftime(semana, '%Y-%m'),
         CASE WHEN dictamen IN ({incats}) THEN dictamen ELSE 'Otro' END, n FROM {_scoped('vd')})""",
        "cnt AS (SELECT scope, ti_mode, granularity, time_key, dictamen, SUM(n) AS n FROM k GROUP BY ALL)",
        f"cats AS (SELECT * FROM (VALUES {cats}) t(dictamen))",
        "keys AS (SELECT DISTINCT scope, ti_mode, granularity, time_key FROM cnt)",
        """grid AS (
  SELECT g.scope, g.ti_mode, g.granularity, g.time_key, g.dictamen, CAST(COALESCE(c.n, 0) AS BIGINT) AS n
  FROM (SELECT * FROM keys CROSS JOIN cats) g
  LEFT JOIN cnt c USING (scope, ti_mode, granularity, time_key, dictamen))""",
        """active AS (SELECT scope, ti_mode, granularity, dictamen FROM grid GROUP BY ALL HAVING MAX(n) > 0)""",
        "tot AS (SELECT scope, ti_mode, granularity, time_key, SUM(n) AS tot FROM grid GROUP BY ALL)",
    ]
    body = f"""SELECT g.scope, g.ti_mode, g.granularity, g.time_key, g.dictamen, g.n,
  COALESCE({rate('g.n', 't.tot')}, 0.0) AS pct
FROM grid g JOIN active a USING (scope, ti_mode, granularity, dictamen)
JOIN tot t USING (scope, ti_mode, granularity, time_key)"""
    return with_base(*ctes, body=body)


def verdict_approved_kpi_sql() -> str:
    mon = d(P.wtd_start)
    ctes = verdict_ctes() + [
        f"""marks AS (SELECT COALESCE(MIN(semana) FILTER (WHERE semana >= {mon}),
                                MAX(semana) FILTER (WHERE semana < {mon})) AS cur_w FROM vd)""",
        f"s AS (SELECT x.*, m.cur_w FROM {_scoped('vd')} x, marks m)",
    ]
    body = []
    for gran, cur in (("semanal", "semana = cur_w"), ("mensual", f"strftime(semana, '%Y-%m') = '{P.current_month}'")):
        tot = f"SUM(CASE WHEN {cur} THEN n ELSE 0 END)"
        apr = f"SUM(CASE WHEN {cur} AND dictamen = 'Aprobada' THEN n ELSE 0 END)"
        body.append(f"""SELECT scope, ti_mode, '{gran}' AS granularity, CAST({tot} AS BIGINT) AS n_total,
  CAST({apr} AS BIGINT) AS n_aprobada, {rate(apr, tot)} AS pct_aprobada
FROM s GROUP BY scope, ti_mode""")
    return with_base(*ctes, body="\nUNION ALL\n".join(body))


PSTAGES = ["n_ho", "n_cancel_no_ho", "n_app", "n_cancel_no_app", "n_vta", "n_cancel_after_app"]


def profile_ctes() -> list[str]:
    spec = [
        ("n_ho", "fecha_handoff", "b.fecha_handoff IS NOT NULL"),
        ("n_cancel_no_ho", "fecha_cancelacion_reserva", "b.fecha_handoff IS NULL"),
        ("n_app", "fecha_aprobacion", "b.fecha_aprobacion IS NOT NULL"),
        ("n_cancel_no_app", "fecha_cancelacion_reserva", "b.fecha_aprobacion IS NULL"),
        ("n_vta", "fecha_venta_declarada", "b.fecha_aprobacion IS NOT NULL"),
        ("n_cancel_after_app", "fecha_cancelacion_reserva", "b.fecha_aprobacion IS NOT NULL"),
    ]
    frames = []
    for name, col, cond in spec:
        frames.append(f"""{name}_q AS (
  SELECT CAST(DATE_TRUNC('week', b.{col}) AS DATE) AS semana, {HUB} AS hub, {TI} AS ti_flag, b.perfil,
         COUNT(DISTINCT b.booking_id) AS {name}
  FROM bookings b WHERE {BASE} AND {cond} AND b.{col} {WIN}
  GROUP BY 1, 2, 3, 4)""")
    keys = " UNION ".join(f"SELECT semana, hub, ti_flag, perfil FROM {n}_q" for n, _, _ in spec)
    joins = " ".join(
        f"LEFT JOIN {n}_q ON {n}_q.semana = kk.semana AND {n}_q.hub = kk.hub AND {n}_q.ti_flag = kk.ti_flag "
        f"AND {n}_q.perfil IS NOT DISTINCT FROM kk.perfil" for n, _, _ in spec
    )
    cols = ", ".join(f"CAST(COALESCE({n}_q.{n}, 0) AS BIGINT) AS {n}" for n, _, _ in spec)
    frames.append(f"pf AS (SELECT kk.semana, kk.hub, kk.ti_flag, kk.perfil, {cols} FROM ({keys}) kk {joins})")
    return frames


def profile_dataset_sql() -> str:
    return with_base(*profile_ctes(), body="SELECT * FROM pf")


def profile_funnel_sql() -> str:
    mon = d(P.wtd_start)
    ctes = profile_ctes() + [
        f"closed AS (SELECT DISTINCT semana FROM pf WHERE semana < {mon})",
        f"""curw AS (SELECT COALESCE(MIN(semana) FILTER (WHERE semana >= {mon}),
                             (SELECT MAX(semana) FROM closed)) AS semana FROM pf)""",
        """wkeys AS (
  SELECT DISTINCT strftime(semana, '%Y-%m-%d') AS time_key FROM (
    SELECT semana FROM (SELECT semana, ROW_NUMBER() OVER (ORDER BY semana DESC) AS rn FROM closed) WHERE rn <= 6
    UNION ALL SELECT semana FROM curw) WHERE semana IS NOT NULL)""",
        """mkeys AS (
  SELECT m AS time_key FROM (SELECT m, ROW_NUMBER() OVER (ORDER BY m DESC) AS rn
    FROM (SELECT DISTINCT strftime(semana, '%Y-%m') AS m FROM pf)) WHERE rn <= 4)""",
        """tk AS (SELECT 'semanal' AS granularity, time_key FROM wkeys UNION ALL
        SELECT 'mensual', time_key FROM mkeys)""",
        "scopes AS (SELECT DISTINCT hub AS scope FROM pf UNION SELECT '__MX__')",
        """grid AS (SELECT * FROM scopes CROSS JOIN tk
  CROSS JOIN (VALUES ('total'), ('sin_ti'), ('con_ti')) m(ti_mode)
  CROSS JOIN (VALUES ('X'), ('A'), ('B'), ('C')) p(perfil))""",
        f"""k AS (
  SELECT scope, ti_mode, perfil, 'semanal' AS granularity, strftime(semana, '%Y-%m-%d') AS time_key, {', '.join(PSTAGES)}
  FROM {_scoped("(SELECT * FROM pf WHERE perfil IN ('X','A','B','C'))")}
  UNION ALL
  SELECT scope, ti_mode, perfil, 'mensual', strftime(semana, '%Y-%m'), {', '.join(PSTAGES)}
  FROM {_scoped("(SELECT * FROM pf WHERE perfil IN ('X','A','B','C'))")})""",
        f"""sums AS (SELECT scope, ti_mode, granularity, time_key, perfil,
  {', '.join(f'SUM({c}) AS {c}' for c in PSTAGES)} FROM k GROUP BY ALL)""",
        f"""full_ AS (SELECT g.*, {', '.join(f'COALESCE(s.{c}, 0) AS {c}' for c in PSTAGES)}
  FROM grid g LEFT JOIN sums s USING (scope, ti_mode, granularity, time_key, perfil))""",
    ]
    body = f"""SELECT scope, ti_mode, granularity, time_key, perfil,
  {rate('n_ho', 'n_ho + n_cancel_no_ho')} AS cr_ho,
  {rate('n_app', 'n_app + n_cancel_no_app')} AS cr_app,
  {rate('n_vta', 'n_vta + n_cancel_after_app')} AS cr_vta
FROM full_"""
    return with_base(*ctes, body=body)
