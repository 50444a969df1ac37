"""SLA reports R21-R22: mean days per funnel stage, KPI and trend.

Stage names: ``res_ho`` (reservation -> handoff), ``ho_app`` (handoff ->
approval; the reference's tile id says "res-app", Q28), ``res_vta``
(reservation -> sale). The browser's filters (hub, TI mode, granularity)
become columns: every scope (each hub and ``__MX__``) and mode is computed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cierre.functions import buckets as B
from cierre.functions.dates import month_key
from cierre.functions.rates import mean_rounded, weighted_mean
from cierre.params import Params


def scoped(df: DataFrame) -> DataFrame:
    """Each row once per scope (its hub, ``__MX__``) and per TI mode it
    passes (``total`` always, plus its own ``ti_flag``)."""
    return df.withColumn("scope", F.explode(F.array(F.col("hub"), F.lit(B.COUNTRY_HUB)))).withColumn(
        "ti_mode", F.explode(F.array(F.lit("total"), F.col("ti_flag")))
    )


def week_marks(df: DataFrame, p: Params, by: list[str] | None = None) -> DataFrame:
    """W4 per group ``by`` (or globally): ``last_w`` and ``cur_w`` among the
    observed weeks. Weeks are bounded by the calendar window, so the arrays
    stay small."""
    mon = F.lit(p.wtd_start)
    weeks = F.sort_array(F.collect_set("semana"))
    g = df.groupBy(*by) if by else df
    return g.agg(weeks.alias("_w")).select(
        *(by or []),
        F.try_element_at(F.filter("_w", lambda w: w < mon), F.lit(-1)).alias("last_w"),
        F.coalesce(
            F.try_element_at(F.filter("_w", lambda w: w >= mon), F.lit(1)), F.try_element_at(F.filter("_w", lambda w: w < mon), F.lit(-1))
        ).alias("cur_w"),
    )


def sla_kpi(sla: DataFrame, p: Params) -> DataFrame:
    """R22 KPI: weighted mean days, current vs previous period, per stage,
    scope and TI mode. ``semanal``: current week (its own stage's weeks, W4)
    vs last closed week; ``mensual``: month of ``as_of`` vs the month before.
    """
    marks = week_marks(sla, p, ["stage"])
    s = scoped(sla).join(marks, "stage")
    mk = month_key("semana")
    periods = {"semanal": (F.col("semana") == F.col("cur_w"), F.col("semana") == F.col("last_w")),
               "mensual": (mk == p.current_month, mk == p.previous_month)}
    # One aggregate for both granularities; each row becomes one for each after it.
    g = s.groupBy("stage", "scope", "ti_mode").agg(*[
        weighted_mean(F.when(cond, F.col("days")), F.when(cond, F.col("n")), "sla").alias(f"{gran}_{k}")
        for gran, pair in periods.items() for k, cond in zip(("cur", "prv"), pair)])
    rows = F.array(*[F.struct(F.lit(gran).alias("granularity"), F.col(f"{gran}_cur").alias("sla_cur"),
                              F.col(f"{gran}_prv").alias("sla_prv")) for gran in periods])
    return g.select("stage", "scope", "ti_mode", F.inline(rows)).withColumn("delta", F.col("sla_cur") - F.col("sla_prv"))


def sla_trend(sla: DataFrame) -> DataFrame:
    """R22 trend: weighted mean days per time key, 1 decimal (half-up)."""
    s = scoped(sla)
    keyed = s.withColumn(
        "k",
        F.explode(F.array(
            F.named_struct(F.lit("granularity"), F.lit("semanal"), F.lit("time_key"), F.date_format("semana", "yyyy-MM-dd")),
            F.named_struct(F.lit("granularity"), F.lit("mensual"), F.lit("time_key"), month_key("semana")),
        )),
    ).select("stage", "scope", "ti_mode", "k.*", "sla", "n", "days")
    keep = F.col("sla").isNotNull() & (F.col("n") > 0)
    g = keyed.groupBy("stage", "scope", "ti_mode", "granularity", "time_key").agg(
        F.sum(F.when(keep, F.col("days")).otherwise(0)).alias("days"),
        F.sum(F.when(keep, F.col("n")).otherwise(0)).alias("n"),
    )
    return g.select("stage", "scope", "ti_mode", "granularity", "time_key", mean_rounded("days", "n").alias("sla"))
