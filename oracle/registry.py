"""Oracle SQL per registered key."""

from __future__ import annotations

from oracle import dims as OD
from oracle.dates import FIRST, LAST, MIDWEEK, MONDAY, WIDE

SQL: dict[str, str] = {}

_DIM_KEYS = {
    "region": "str_region",
    "aging": "str_aging",
    "price": "str_price",
    "coming_soon": "str_coming_soon",
    "pix": "str_pix",
    "stock_region": "str_stock_region",
}
for _dim, _key in _DIM_KEYS.items():
    SQL[f"{_key}_weekly"] = OD.report_sql(_dim, "week")
    SQL[f"{_key}_monthly"] = OD.report_sql(_dim, "month")

SQL["dim_report_all"] = OD.all_reports_sql()
SQL["dim_report_wide"] = OD.all_reports_sql(WIDE, ["week"])
SQL["dim_report_stored"] = SQL["dim_report_pruned"] = SQL["dim_report_all"]
SQL["str_payment_weekly"] = OD.report_sql("payment", "week")
SQL["str_payment_monthly"] = OD.report_sql("payment", "month")
SQL["payment_split"] = OD.payment_split_sql()
SQL["str_custom_periods"] = OD.custom_periods_sql()
SQL["dim_report_monday"] = OD.all_reports_sql(MONDAY)
SQL["str_region_weekly_first"] = OD.report_sql("region", "week", FIRST)
SQL["str_region_weekly_last"] = OD.report_sql("region", "week", LAST)

from oracle import kpis as OK  # noqa: E402

SQL["weekly_hub_str"] = OK.weekly_hub_str_sql()
SQL["bookings_weekly"] = OK.bookings_weekly_sql()
SQL["profile_mix_weekly"] = OK.profile_mix_weekly_sql()
SQL["kpi_mtd"] = OK.kpi_period_sql("mtd")
SQL["kpi_lmtd"] = OK.kpi_period_sql("lmtd")
SQL["daily_hub"] = OK.daily_hub_sql()
SQL["kpi_incremental"] = OK.daily_hub_sql()
SQL["last_month_hub"] = OK.last_month_hub_sql()

from oracle import funnel as OF  # noqa: E402

SQL["funnel_weekly"] = OF.funnel_weekly_sql()
SQL["funnel_app_sale_weekly"] = OF.funnel_app_sale_weekly_sql()
SQL["funnel_mtd"] = OF.funnel_period_sql("mtd")
SQL["funnel_lmtd"] = OF.funnel_period_sql("lmtd")
SQL["funnel_weekly_from_days"] = SQL["funnel_weekly"]
SQL["funnel_mtd_from_days"], SQL["funnel_lmtd_from_days"] = SQL["funnel_mtd"], SQL["funnel_lmtd"]
SQL["funnel_by_week_month"] = OF.funnel_by_week_month_sql()
SQL["funnel_kpi"] = OF.funnel_kpi_sql()
SQL["funnel_by_ti"] = OF.funnel_by_ti_sql()
SQL["funnel_trend"] = OF.funnel_trend_sql()

from oracle import funnel_extra as OX  # noqa: E402

SQL["sla_weekly"] = OX.sla_weekly_sql()
SQL["sla_kpi"] = OX.sla_kpi_sql()
SQL["sla_trend"] = OX.sla_trend_sql()
SQL["first_verdict"] = OX.first_verdict_sql()
SQL["first_payment"] = OX.first_payment_sql()
SQL["verdict_dataset"] = OX.verdict_dataset_sql()
SQL["verdict_mix"] = OX.verdict_mix_sql()
SQL["verdict_approved_kpi"] = OX.verdict_approved_kpi_sql()
SQL["profile_dataset"] = OX.profile_dataset_sql()
SQL["profile_funnel"] = OX.profile_funnel_sql()

from oracle import blocks as OB  # noqa: E402

SQL["src_bookings"] = OB.src_bookings_sql()
SQL["src_inventory"] = OB.src_inventory_sql()
SQL["method_norm"] = OB.method_norm_sql()
SQL["closed_rows"] = OB.closed_rows_sql()
SQL["weekly_str"] = OD.method_period_sql("week", False)
SQL["monthly_str"] = OD.method_period_sql("month", False)
SQL["str_method_fold"] = OD.method_period_sql("week", True)
SQL["dim_order"] = OD.dim_order_sql()
SQL["first_receipt"] = OB.first_receipt_sql()
SQL["latest_stock_region"] = OB.latest_stock_region_sql()
SQL["stock_region_asof"] = OB.stock_region_asof_sql()
SQL["mix_weekly"] = OD.mix_rows_sql("aging", "week")
SQL["mix_monthly"] = OD.mix_rows_sql("price", "month")
SQL["wow_delta"] = OD.last_two_sql("aging", "week")
SQL["mom_delta"] = OD.last_two_sql("region", "month")
SQL["str_deltas"] = OD.str_deltas_sql("region")
SQL["region_pivot"] = OD.region_pivot_sql()
SQL["region_pivot_midweek"] = OD.region_pivot_sql(MIDWEEK)
SQL["str_deltas_all"] = OD.str_deltas_all_sql()
SQL["mom_deltas_all"] = OD.mom_deltas_all_sql()
SQL["period_labels"] = OB.period_labels_sql()
SQL["qa_recent_weeks"] = OB.qa_recent_weeks_sql()
SQL["qa_period_totals"] = OB.qa_period_totals_sql()
SQL["qa_funnel_weeks"] = OB.qa_funnel_weeks_sql()
SQL["qa_funnel_expected"] = OB.qa_funnel_expected_sql()
SQL["qa_dim_row"] = OB.qa_dim_row_sql()
SQL["kpi_from_daily_events"] = "\nUNION ALL\n".join(
    f"SELECT '{kind}' AS period_kind, * FROM ({OK.kpi_period_sql(kind)})" for kind in ("mtd", "lmtd")
)
SQL["dataset_presence"] = f"""
SELECT 'weekly_hub_str' AS dataset, TRUE AS present, COUNT(*) AS n_rows FROM ({OK.weekly_hub_str_sql()}) WHERE ventas_total > 0
UNION ALL SELECT 'bookings_weekly', TRUE, COUNT(*) FROM ({OK.bookings_weekly_sql()})
UNION ALL SELECT 'daily_hub', TRUE, COUNT(*) FROM ({OK.daily_hub_sql()})
UNION ALL SELECT 'last_month_hub', FALSE, CAST(NULL AS BIGINT)"""

def _figures(name: str, query: str, day: str, passed: str) -> str:
    return f"""SELECT '{name}' AS dataset, TRUE AS present, COUNT(*) AS n_rows, CAST(0 AS BIGINT) AS n_null_keys,
  CAST(SUM(list_sum([*COLUMNS(* EXCLUDE ({day}, hub))])) AS BIGINT) AS total, MIN({day}) AS first_period, MAX({day}) AS last_period,
  {passed} AS passed FROM ({query})"""


SQL["dataset_checks"] = "\nUNION ALL ".join([
    _figures("weekly_hub_str", f"SELECT * FROM ({OK.weekly_hub_str_sql()}) WHERE ventas_total > 0", "semana",
             "COUNT(*) >= 10 AND MAX(semana) >= DATE '2001-04-09'"),
    _figures("bookings_weekly", OK.bookings_weekly_sql(), "semana", "FALSE"),
    _figures("daily_hub", OK.daily_hub_sql(), "fecha", "MAX(fecha) >= DATE '2001-04-18'"),
    "SELECT 'last_month_hub', FALSE, NULL, NULL, NULL, NULL, NULL, FALSE"])
