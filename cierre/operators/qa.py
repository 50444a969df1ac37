"""Run-time checks of the reference as reports (R26-R29): small frames that
summarise other reports; no driver-side loops."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cierre.functions import buckets as B
from cierre.functions.rates import delta_pp, rate


def _last_n(df: DataFrame, part: str, order: str, n: int) -> DataFrame:
    w = Window.partitionBy(part).orderBy(F.col(order).desc())
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def qa_recent_weeks(weekly_str: DataFrame, bookings_weekly: DataFrame, profile_mix: DataFrame) -> DataFrame:
    """R26 (O6): country totals of the last 3 weeks of each weekly KPI
    dataset: E (close-date STR), A (bookings), B (profiles)."""
    nul = F.lit(None).cast("bigint")
    e = weekly_str.groupBy("semana").agg(
        nul.alias("reservas"), F.sum("ventas_total").alias("ventas"), F.sum("cancel_total").alias("cancel"),
        nul.alias("n_x"), nul.alias("n_a"), nul.alias("n_sin_perfil"),
    ).withColumn("source", F.lit("E"))
    a = bookings_weekly.groupBy("semana").agg(
        F.sum("reservas_total").alias("reservas"), F.sum("ventas_total").alias("ventas"),
        F.sum("cancel_total").alias("cancel"), nul.alias("n_x"), nul.alias("n_a"), nul.alias("n_sin_perfil"),
    ).withColumn("source", F.lit("A"))
    b = profile_mix.groupBy("semana").agg(
        F.sum("reservas_total").alias("reservas"), nul.alias("ventas"), nul.alias("cancel"),
        F.sum("n_x").alias("n_x"), F.sum("n_a").alias("n_a"), F.sum("n_sin_perfil").alias("n_sin_perfil"),
    ).withColumn("source", F.lit("B"))
    u = e.unionByName(a).unionByName(b)
    out = _last_n(u, "source", "semana", 3)
    return out.select(
        "source", "semana",
        *[F.col(c).cast("bigint").alias(c) for c in ("reservas", "ventas", "cancel", "n_x", "n_a", "n_sin_perfil")],
        F.when(F.col("source") != "B", rate(F.col("ventas"), F.col("ventas") + F.col("cancel"))).alias("str"),
    )


def qa_period_totals(kpi_mtd: DataFrame, kpi_lmtd: DataFrame, last_month: DataFrame) -> DataFrame:
    """``__MX__`` totals of MTD, LMTD (bookings, sales, cancels, STR)
    and of last month (sales, net deliveries, captive deliveries)."""
    nul = F.lit(None).cast("bigint")

    def period(df, name):
        return df.filter(F.col("hub") == B.COUNTRY_HUB).select(
            F.lit(name).alias("period"), "reservas_total", "reservas_netas", "ventas_total", "cancel_total",
            rate(F.col("ventas_total"), F.col("ventas_total") + F.col("cancel_total")).alias("str"),
            nul.alias("entregas_netas"), nul.alias("entregas_captive"),
        )

    lm = last_month.filter(F.col("hub") == B.COUNTRY_HUB).select(
        F.lit("LM").alias("period"), nul.alias("reservas_total"), nul.alias("reservas_netas"), "ventas_total",
        nul.alias("cancel_total"), F.lit(None).cast("double").alias("str"), "entregas_netas", "entregas_captive",
    )
    return period(kpi_mtd, "MTD").unionByName(period(kpi_lmtd, "LMTD")).unionByName(lm)


def qa_funnel_weeks(weekly: DataFrame, vta_weekly: DataFrame) -> DataFrame:
    """Country funnel of the last 7 weeks: HO, App and the three rates."""
    f = weekly.groupBy("semana").agg(
        F.sum("ho_total").alias("ho"), F.sum("can_no_ho_total").alias("cnh"),
        F.sum("app_total").alias("app"), F.sum("can_no_app_total").alias("cna"),
    )
    v = vta_weekly.groupBy("semana").agg(F.sum("vta_app_total").alias("vta"), F.sum("cancel_app_total").alias("can"))
    f = _last_n(f.withColumn("_all", F.lit(1)), "_all", "semana", 7).drop("_all")
    j = f.join(v, "semana", "left").na.fill(0, ["vta", "can"])
    return j.select(
        "semana", *[F.col(c).cast("bigint").alias(c) for c in ("ho", "cnh", "app", "cna", "vta", "can")],
        rate(F.col("ho"), F.col("ho") + F.col("cnh")).alias("cr_ho"),
        rate(F.col("app"), F.col("app") + F.col("cna")).alias("cr_app"),
        rate(F.col("vta"), F.col("vta") + F.col("can")).alias("cr_vta"),
    )


#: Conversion rates that the country is known to have, in percent, and how far a week may be off.
CR_TARGETS = {"cr_ho": 83.0, "cr_app": 78.0}
CR_TOLERANCE = 10.0


def qa_funnel_expected(weeks: DataFrame, expected: DataFrame, targets: dict[str, float] = CR_TARGETS,
                       tolerance: float = CR_TOLERANCE) -> DataFrame:
    """R28 compared: for each week of ``qa_funnel_weeks`` or of ``expected`` (``semana,
    ho, app``) the handoffs and approvals found and expected, whether they are the
    same (a week that either side lacks is not), and whether each conversion rate lies
    within ``tolerance`` points of its target (null without a rate)."""
    found = weeks.select("semana", "ho", "app", *targets)
    wanted = expected.select("semana", F.col("ho").cast("bigint").alias("expected_ho"), F.col("app").cast("bigint").alias("expected_app"))
    near = [(F.abs(F.col(c) - t) <= tolerance).alias(f"{c}_near") for c, t in targets.items()]
    same = F.coalesce((F.col("ho") == F.col("expected_ho")) & (F.col("app") == F.col("expected_app")), F.lit(False))
    return found.join(wanted, "semana", "full").select("semana", "ho", "expected_ho", "app", "expected_app", same.alias("same"), *near)


def qa_dim_row(reports: DataFrame) -> DataFrame:
    """The country row (all methods) of the weekly region report - STR of the
    last 3 closed weeks, WoW, WTD, LWTD, delta - and the ``0-30d`` aging row, of the
    long ``dims.report``, in one aggregate."""
    shown = ((F.col("report") == "region") & (F.col("dim") == B.COUNTRY_DIM)) | ((F.col("report") == "aging") & (F.col("dim") == "0-30d"))
    rows = reports.filter((F.col("grain") == "week") & (F.col("method") == "all") & shown)
    of = lambda kind: F.max(F.when(F.col("period_kind") == kind, F.col("str")))
    weeks = F.reverse(F.sort_array(F.collect_list(F.when(F.col("period_kind") == "week", F.struct("period", "str")))))
    one = rows.groupBy("report").agg(weeks.alias("w"), of("wtd").alias("wtd"), of("lwtd").alias("lwtd"))
    week = lambda k: F.try_element_at("w", F.lit(k))["str"]
    item = lambda metric, period, value: F.struct(F.lit(metric).alias("metric"), period.alias("period"), value.alias("value"))
    nul = F.lit(None).cast("date")
    region = F.col("report") == "region"
    last = F.transform(F.slice("w", 1, 3), lambda x: item("str", x["period"], x["str"]))
    items = F.concat(
        F.when(region, F.concat(last, F.array(item("wow_delta", nul, delta_pp(week(1), week(2)))))).otherwise(F.slice(last, 1, 0)),
        F.array(item("wtd", nul, F.col("wtd")), item("lwtd", nul, F.col("lwtd")), item("delta", nul, delta_pp("wtd", "lwtd"))))
    return one.select(F.when(region, F.lit("mx_all")).otherwise(F.lit("aging_0_30d_all")).alias("check"), F.inline(items))
