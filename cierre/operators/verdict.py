"""Verdict reports R23-R24 (mix of first credit verdicts, approval KPI)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cierre.functions import buckets as B
from cierre.functions.dates import month_key
from cierre.functions.rates import rate
from cierre.params import Params
from cierre.operators.sla import scoped, week_marks
from cierre.plans.totals import attach_one_row


def _keyed(verdicts: DataFrame) -> DataFrame:
    return scoped(verdicts).withColumn(
        "k",
        F.explode(F.array(
            F.named_struct(F.lit("granularity"), F.lit("semanal"), F.lit("time_key"), F.date_format("semana", "yyyy-MM-dd")),
            F.named_struct(F.lit("granularity"), F.lit("mensual"), F.lit("time_key"), month_key("semana")),
        )),
    ).select("scope", "ti_mode", "k.*", B.verdict_category("dictamen").alias("dictamen"), "n")


def verdict_mix(verdicts: DataFrame) -> DataFrame:
    """R23 (P24, A16, W7, W8): share of each verdict per time key, 1 decimal.

    Every key gets a zero-filled row for each category that is non-zero in
    some key of the same (scope, mode, granularity); categories zero
    everywhere are dropped. The grid is an explode of the fixed category
    list on each key row, not a join.
    """
    k = _keyed(verdicts)
    grp = ["scope", "ti_mode", "granularity", "time_key"]
    counts = k.groupBy(*grp, "dictamen").agg(F.sum("n").cast("bigint").alias("n"))
    keys = counts.select(*grp).distinct()
    grid = keys.withColumn("dictamen", F.explode(F.array(*[F.lit(c) for c in B.VERDICT_CATEGORIES])))
    full = grid.join(counts, [*grp, "dictamen"], "left").na.fill(0, ["n"])
    series = Window.partitionBy("scope", "ti_mode", "granularity", "dictamen")
    per_key = Window.partitionBy(*grp)
    full = full.withColumn("_active", F.max("n").over(series)).withColumn("_tot", F.sum("n").over(per_key))
    return full.filter(F.col("_active") > 0).select(
        *grp, "dictamen", "n", F.coalesce(rate(F.col("n"), F.col("_tot")), F.lit(0.0)).alias("pct")
    )


def verdict_approved_kpi(verdicts: DataFrame, p: Params) -> DataFrame:
    """% Aprobada in the active period (current week of the dataset, W4,
    or the month of ``as_of``), per scope and TI mode; null without rows."""
    marks = week_marks(verdicts, p)
    s = attach_one_row(scoped(verdicts), marks)
    approved = F.col("dictamen") == B.VERDICT_APPROVED
    periods = {"semanal": F.col("semana") == F.col("cur_w"), "mensual": month_key("semana") == p.current_month}
    g = s.groupBy("scope", "ti_mode").agg(*[
        F.sum(F.when(cond, F.col("n")).otherwise(0)).cast("bigint").alias(f"{gran}_{k}")
        for gran, cur in periods.items() for k, cond in (("n", cur), ("a", cur & approved))])
    rows = F.array(*[F.struct(F.lit(gran).alias("granularity"), F.col(f"{gran}_n").alias("n_total"),
                              F.col(f"{gran}_a").alias("n_aprobada")) for gran in periods])
    return g.select("scope", "ti_mode", F.inline(rows)).withColumn("pct_aprobada", rate(F.col("n_aprobada"), F.col("n_total")))
