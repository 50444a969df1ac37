"""The daily refresh: every report of one ``as_of`` in one session.

The reference runs 49 separate warehouse queries per refresh. Here the heavy
work is done once and kept in the shared checkpoint folder: the bookings of the
reports' windows (the one scan of the bookings), and from them all dimension
reports as one long dataset, the KPI events counted by day, the funnel frames and
the derived datasets. This cuts the lineage (a lost executor recomputes from the
checkpoint, not from the raw tables). The reports on top are small and
latency-bound, so their jobs are submitted concurrently from a thread pool.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cierre.operators import dims as D
from cierre.operators import funnel as FN
from cierre.operators import kpis as K
from cierre.operators import profile as PF
from cierre.operators import qa as QA
from cierre.operators import sla as SL
from cierre.operators import verdict as VD
from cierre.params import Params
from cierre.plans import enrich as E
from cierre.session import cut_lineage
from cierre.sources import datasets as DS
from cierre.sources import io as IO


def build_reports(bookings: DataFrame, inventory: DataFrame, p: Params, verdicts: DataFrame | None = None,
                  payments: DataFrame | None = None, checkpoint: bool = True, parallelism: int = 8,
                  stored_by_car: bool = False) -> dict[str, DataFrame]:
    """All reports by name. ``verdicts`` (a log of verdict events) and ``payments``
    are inputs of their own: without verdicts their reports are left out, without
    payments the payment dimension is, and the payment split is empty (S4).
    ``stored_by_car``: ``inventory`` is a table of ``sources.layout``."""
    dims = [*D.DIMS, "payment"] if payments is not None else D.DIMS
    if checkpoint:
        # The one scan of the bookings: every frame below reads rows of these windows only.
        lo = min(p.weeks_start, p.months_start, *(w[0] for w in p.windows().values()))
        bookings = cut_lineage(E.recent_rows(bookings, lo, p.yesterday))
    shared = {
        "dims": D.report(bookings, inventory, p, dims, payments=payments, stored_by_car=stored_by_car),
        "events": K.daily_events(bookings, p),
        "fw": FN.funnel_weekly(bookings, p),
        "fv": FN.funnel_app_sale_weekly(bookings, p),
        "fp": FN.funnel_periods(bookings, p),
        "sla": DS.sla_dataset(bookings, p),
        "pf": DS.profile_dataset(bookings, p),
    }
    if verdicts is not None:
        shared["vd"] = DS.verdict_dataset(bookings, verdicts, p)
    if checkpoint:
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            shared = dict(zip(shared, pool.map(cut_lineage, shared.values())))
    dims, events, fw, fv, fp = (shared[k] for k in ("dims", "events", "fw", "fv", "fp"))
    out: dict[str, DataFrame] = {"str_dims": D.sorted_report(dims)}
    out["str_deltas"], out["str_mom_deltas"] = D.all_deltas(dims)
    region = dims.filter("report = 'region' AND grain = 'week'").drop("report", "grain")
    out["region_pivot"] = D.pivot_weeks(region, p)
    out["str_mix_rows"] = D.mix_rows(dims.filter(F.col("report").isin(sorted(D.MIX_DIMS))), ("report", "grain"))
    out["payment_dim"] = D.payment_split(bookings, payments, p) if payments is not None else IO.empty_dim(bookings.sparkSession)
    out["weekly_hub_str"] = K.weekly_hub_str_of(events, p)
    out["bookings_weekly"] = K.bookings_weekly_of(events, p)
    out["profile_mix_weekly"] = K.profile_mix_weekly_of(events, p)
    kp = K.kpi_periods_of(events, p)
    out["kpi_mtd"] = kp.filter("period_kind = 'mtd'").drop("period_kind")
    out["kpi_lmtd"] = kp.filter("period_kind = 'lmtd'").drop("period_kind")
    out["daily_hub"] = K.daily_hub_of(events, p).orderBy("fecha", "hub")
    out["last_month_hub"] = K.last_month_hub_of(events, p)
    mtd = fp.filter("period_kind = 'mtd'").drop("period_kind")
    lmtd = fp.filter("period_kind = 'lmtd'").drop("period_kind")
    out.update(funnel_weekly=fw, funnel_app_sale_weekly=fv, funnel_mtd=mtd, funnel_lmtd=lmtd,
               funnel_by_month=FN.funnel_by_week_month(fw))
    kpi = FN.funnel_kpi(fw, fv, fp, p)
    out["funnel_kpi"] = kpi
    out["funnel_by_ti"] = FN.funnel_by_ti(kpi)
    out["funnel_trend"] = FN.funnel_trend(fw, fv)
    out["sla_weekly"] = shared["sla"]
    out["sla_kpi"] = SL.sla_kpi(shared["sla"], p)
    out["sla_trend"] = SL.sla_trend(shared["sla"])
    if verdicts is not None:
        out["verdict_mix"] = VD.verdict_mix(shared["vd"])
        out["verdict_approved_kpi"] = VD.verdict_approved_kpi(shared["vd"], p)
    out["profile_funnel"] = PF.profile_funnel(shared["pf"], p)
    out["qa_recent_weeks"] = QA.qa_recent_weeks(out["weekly_hub_str"], out["bookings_weekly"], out["profile_mix_weekly"])
    out["qa_period_totals"] = QA.qa_period_totals(out["kpi_mtd"], out["kpi_lmtd"], out["last_month_hub"])
    out["qa_funnel_weeks"] = QA.qa_funnel_weeks(fw, fv)
    out["qa_dim_row"] = QA.qa_dim_row(dims)
    return out


def full_refresh(bookings: DataFrame, inventory: DataFrame, p: Params, root: str | None = None, fmt: str = "parquet",
                 verdicts: DataFrame | None = None, parallelism: int = 8, payments: DataFrame | None = None,
                 stored_by_car: bool = False) -> list[str]:
    """Compute every report and publish the set under ``root`` (without one the
    rows are computed and dropped, to time a refresh). Returns the reports' names."""
    reports = build_reports(bookings, inventory, p, verdicts, payments, parallelism=parallelism, stored_by_car=stored_by_car)
    if root is not None:
        return IO.publish(reports, root, fmt, parallelism)
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        list(pool.map(lambda df: df.write.format("noop").mode("overwrite").save(), reports.values()))
    return sorted(reports)
