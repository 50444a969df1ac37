"""Conversion rates by credit profile (X, A, B, C) over recent periods."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cierre.functions import buckets as B
from cierre.functions.dates import month_key
from cierre.functions.rates import rate
from cierre.params import Params
from cierre.operators.sla import scoped
from cierre.plans.totals import attach_one_row
from cierre.sources.datasets import PROFILE_STAGES

TI_MODES = ["total", B.TI_WITHOUT, B.TI_WITH]


def profile_time_keys(profile: DataFrame, p: Params) -> DataFrame:
    """One row holding the time keys of the report as
    ``array<struct<granularity, time_key>>``: the last 6 closed weeks plus the
    current week (``yyyy-MM-dd``), and the last 4 observed months
    (``yyyy-MM``). Bounded by the calendar window."""
    mon = F.lit(p.wtd_start)
    g = profile.agg(
        F.sort_array(F.collect_set("semana")).alias("_w"),
        F.sort_array(F.collect_set(month_key("semana"))).alias("_m"),
    )
    closed = F.filter("_w", lambda w: w < mon)
    last_w = F.try_element_at(closed, F.lit(-1))
    cur_w = F.coalesce(F.try_element_at(F.filter("_w", lambda w: w >= mon), F.lit(1)), last_w)
    last6 = F.filter(closed, lambda x, i: i >= F.size(closed) - 6)
    wkeys = F.filter(F.array_distinct(F.concat(last6, F.array(cur_w))), lambda x: x.isNotNull())
    mkeys = F.filter("_m", lambda x, i: i >= F.size("_m") - 4)
    ws = F.transform(wkeys, lambda x: F.named_struct(F.lit("granularity"), F.lit("semanal"),
                                                      F.lit("time_key"), F.date_format(x, "yyyy-MM-dd")))
    ms = F.transform(mkeys, lambda x: F.named_struct(F.lit("granularity"), F.lit("mensual"), F.lit("time_key"), x))
    return g.select(F.concat(ws, ms).alias("keys"))


def profile_funnel(profile: DataFrame, p: Params) -> DataFrame:
    """Per scope (each hub, ``__MX__``), TI mode, granularity, profile and
    time key: CR Res->HO, Res->App and App->Sale at 1 decimal; a key with no
    rows is a zero cell, so its rates are null."""
    keys = profile_time_keys(profile, p)
    scopes = profile.select(F.explode(F.array(F.col("hub"), F.lit(B.COUNTRY_HUB))).alias("scope")).distinct()
    grid = (
        attach_one_row(scopes, keys)
        .select("scope", F.explode("keys").alias("k"))
        .select("scope", "k.granularity", "k.time_key",
                F.explode(F.array(*[F.lit(m) for m in TI_MODES])).alias("ti_mode"))
        .select("*", F.explode(F.array(*[F.lit(x) for x in B.PROFILE_FUNNEL_PROFILES])).alias("perfil"))
    )
    s = scoped(profile.filter(F.col("perfil").isin(B.PROFILE_FUNNEL_PROFILES)))
    s = s.withColumn(
        "k",
        F.explode(F.array(
            F.named_struct(F.lit("granularity"), F.lit("semanal"), F.lit("time_key"), F.date_format("semana", "yyyy-MM-dd")),
            F.named_struct(F.lit("granularity"), F.lit("mensual"), F.lit("time_key"), month_key("semana")),
        )),
    ).select("scope", "ti_mode", "perfil", "k.*", *PROFILE_STAGES)
    keys_ = ["scope", "ti_mode", "granularity", "time_key", "perfil"]
    sums = s.groupBy(*keys_).agg(*[F.sum(c).alias(c) for c in PROFILE_STAGES])
    full = grid.join(sums, keys_, "left").na.fill(0, PROFILE_STAGES)

    def cr(n, o):
        return rate(F.col(n), F.col(n) + F.col(o))

    return full.select(
        *keys_,
        cr("n_ho", "n_cancel_no_ho").alias("cr_ho"),
        cr("n_app", "n_cancel_no_app").alias("cr_app"),
        cr("n_vta", "n_cancel_after_app").alias("cr_vta"),
    )
