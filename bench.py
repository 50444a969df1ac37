"""Benchmark: headline reports at $BENCH_SF_DIR on local[$BENCH_CPUS].

The two input tables are built once from the TPC-H-like tables and written
back with their declared schemas. Each query is ``collect()``-ed: one warm-up
timed its probe. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from datetime import date

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cierre.params import FIXTURE_PARAMS as P  # noqa: E402
from cierre.params import Params  # noqa: E402
from cierre.session import ensure_checkpoint_dir, local_session  # noqa: E402
from cierre.sources.fixtures import fixture_bookings, fixture_inventory  # noqa: E402
from cierre.sources.schema import read_bookings, read_inventory  # noqa: E402


def headline(b, i):
    from cierre.operators import dims as D
    from cierre.operators import funnel as FN
    from cierre.operators import kpis as K
    from cierre.operators import profile as PF
    from cierre.operators import sla as SL
    from cierre.sources import datasets as DS

    wide = Params(as_of=P.as_of, weeks_start=date(1995, 1, 2))
    return {
        "str_region_weekly": lambda: D.str_report(b, i, P, "region", "week"),
        "str_aging_weekly": lambda: D.str_report(b, i, P, "aging", "week"),
        "str_price_weekly": lambda: D.str_report(b, i, P, "price", "week"),
        "str_pix_weekly": lambda: D.str_report(b, i, P, "pix", "week"),
        "str_stock_region_weekly": lambda: D.str_report(b, i, P, "stock_region", "week"),
        "funnel_weekly": lambda: FN.funnel_weekly(b, P),
        "kpi_mtd": lambda: K.kpi_period(b, P, "mtd"),
        "daily_hub": lambda: K.daily_hub(b, P),
        # all twelve dimension reports (weekly and monthly) in one pass
        "dim_report_all": lambda: D.report(b, i, P),
        # every week of six years: nearly all bookings are closed rows
        "dim_report_wide": lambda: D.report(b, i, wide, grains=["week"]),
        "str_price_monthly": lambda: D.str_report(b, i, P, "price", "month"),
        "funnel_kpi": lambda: FN.funnel_kpi(FN.funnel_weekly(b, P), FN.funnel_app_sale_weekly(b, P), FN.funnel_periods(b, P), P),
        "sla_kpi": lambda: SL.sla_kpi(DS.sla_dataset(b, P), P),
        "profile_funnel": lambda: PF.profile_funnel(DS.profile_dataset(b, P), P),
    }


def timed_all(fns: dict, reps: int = 3) -> dict:
    """One warm-up round over every query, then per query the median of
    ``reps`` runs. Each run builds the DataFrame and collects it."""
    for fn in fns.values():
        fn().collect()
    out = {}
    for name, fn in fns.items():
        ts = []
        for _ in range(reps):
            t0 = time.perf_counter()
            fn().collect()
            ts.append(time.perf_counter() - t0)
        out[name] = round(statistics.median(ts), 4)
    return out


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores=cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus)))
    ensure_checkpoint_dir(spark)
    root = tempfile.mkdtemp(prefix="cierre-bench-")
    t0 = time.perf_counter()
    # Stored tables have many files; one per core keeps the local scans parallel.
    n_files = int(cpus)
    fixture_bookings(spark, sf_dir).repartition(n_files).write.mode("overwrite").parquet(f"{root}/bookings")
    fixture_inventory(spark, sf_dir).repartition(n_files).write.mode("overwrite").parquet(f"{root}/inventory_velocity")
    build = time.perf_counter() - t0
    b = read_bookings(spark, f"{root}/bookings")
    i = read_inventory(spark, f"{root}/inventory_velocity")

    queries = timed_all(headline(b, i))

    from cierre.refresh import full_refresh

    t0 = time.perf_counter()
    n_reports = len(full_refresh(b, i, P))
    refresh = time.perf_counter() - t0
    sf_name = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    try:
        sf = float(sf_name)
    except ValueError:
        sf = sf_name
    print(json.dumps({
        "metric": "headline_reports_total",
        "value": round(sum(queries.values()), 4),
        "unit": "sec",
        "queries": queries,
        "full_refresh_sec": round(refresh, 3),
        "full_refresh_reports": n_reports,
        "fixture_build_sec": round(build, 3),
        "sf": sf,
        "cpus": cpus,
    }))


if __name__ == "__main__":
    main()
