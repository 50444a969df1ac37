"""The daily refresh: every report in one session, published as a set."""

import os
import subprocess
import sys
import tempfile

import pytest
from pyspark.sql import functions as F

from cierre.__main__ import main
from cierre.sources.fixtures import fixture_bookings, fixture_inventory, fixture_payments, fixture_verdicts
from cierre.sources.io import dataset_presence, manifest, read_published
from cierre.sources.layout import write_snapshots
from tests.conftest import SF0001

REPORTS = [
    "bookings_weekly", "daily_hub", "funnel_app_sale_weekly", "funnel_by_month", "funnel_by_ti", "funnel_kpi", "funnel_lmtd",
    "funnel_mtd", "funnel_trend", "funnel_weekly", "kpi_lmtd", "kpi_mtd", "last_month_hub", "payment_dim", "profile_funnel",
    "profile_mix_weekly", "qa_dim_row", "qa_funnel_weeks", "qa_period_totals", "qa_recent_weeks", "region_pivot", "sla_kpi",
    "sla_trend", "sla_weekly", "str_deltas", "str_dims", "str_mix_rows", "str_mom_deltas", "weekly_hub_str",
]


@pytest.fixture(scope="module")
def tables(spark):
    root = tempfile.mkdtemp(prefix="cierre-refresh-")
    b = fixture_bookings(spark, SF0001)
    b.write.parquet(f"{root}/bookings")
    fixture_inventory(spark, SF0001).write.parquet(f"{root}/inventory")
    fixture_verdicts(b).write.parquet(f"{root}/verdicts")
    fixture_payments(spark, SF0001).write.parquet(f"{root}/payments")
    return root


def _args(root, out, *more):
    return ["--bookings", f"{root}/bookings", "--inventory", f"{root}/inventory", "--as-of", "2001-04-18",
            "--weeks-start", "2001-01-01", "--out", out, *more]


def test_refresh_without_verdicts_publishes_none(spark, tables):
    out = f"{tables}/published"
    assert main(_args(tables, out, "--verdicts", f"{tables}/not_there")) == 0
    assert sorted(r["dataset"] for r in manifest(spark, out).collect()) == REPORTS
    assert all(r["present"] for r in dataset_presence(spark, out, REPORTS).collect())
    dims = read_published(spark, out, "str_dims")
    assert {r["report"] for r in dims.select("report").distinct().collect()} == {
        "region", "aging", "price", "coming_soon", "pix", "stock_region"}
    deltas = {r["report"] for r in read_published(spark, out, "str_deltas").select("report").distinct().collect()}
    assert {"region", "stock_region"} <= deltas


def test_refresh_with_verdicts(spark, tables):
    out = f"{tables}/published_v"
    assert main(_args(tables, out, "--verdicts", f"{tables}/verdicts")) == 0
    assert sorted(r["dataset"] for r in manifest(spark, out).collect()) == sorted([*REPORTS, "verdict_mix", "verdict_approved_kpi"])
    assert read_published(spark, out, "verdict_mix").count() > 0


def test_refresh_with_payments_over_stored_snapshots(spark, tables):
    out, table = f"{tables}/published_p", "cierre_test_refresh_snapshots"
    write_snapshots(fixture_inventory(spark, SF0001), table, 4, path=f"{tables}/snapshots")
    try:
        args = _args(tables, out, "--payments", f"{tables}/payments", "--snapshots-by-car", "--keep", "2")
        args[args.index("--inventory") + 1] = table
        assert main(args) == 0
    finally:
        spark.sql(f"DROP TABLE {table}")
    dims, other = read_published(spark, out, "str_dims"), f"{tables}/published_plain"
    paid = {r.dim: r.n for r in dims.filter("report = 'payment' AND grain = 'month' AND method = 'all'").groupBy("dim").agg(
        F.sum(F.col("ventas") + F.col("cancelaciones")).alias("n")).collect()}
    assert paid["Con Pago"] > 0 < paid["Sin Pago"]
    # the other dimensions are as without payments, over plain snapshots
    assert main(_args(tables, other)) == 0
    plainly = read_published(spark, other, "str_dims")
    assert dims.filter("report <> 'payment'").exceptAll(plainly).count() == 0 and plainly.count() < dims.count()
    split = read_published(spark, out, "payment_dim")
    assert split.columns == ["semana", "metodo_de_pago", "pago_dim", "ventas", "cancelaciones"] and split.count() > 0
    assert read_published(spark, other, "payment_dim").count() == 0


def test_one_scan_of_the_bookings(spark, tables):
    """Every report reads the rows that the refresh kept, and they are the same."""
    from cierre.params import FIXTURE_PARAMS as P
    from cierre.refresh import build_reports
    from cierre.sources.schema import read_bookings, read_inventory

    b, i = read_bookings(spark, f"{tables}/bookings"), read_inventory(spark, f"{tables}/inventory")
    v = spark.read.parquet(f"{tables}/verdicts")
    kept, plain = build_reports(b, i, P, v), build_reports(b, i, P, v, checkpoint=False)
    assert set(kept) == set(plain)
    for name, df in kept.items():
        assert "bookings" not in df._jdf.queryExecution().optimizedPlan().toString()
        assert sorted(map(str, df.collect())) == sorted(map(str, plain[name].collect())), name


def test_submitted_job_keeps_the_submitters_settings(tables):
    """The command line in a driver of its own: master and partitions stay as submitted."""
    code = ("import sys; from cierre.__main__ import main; from pyspark.sql import SparkSession; "
            f"rc = main({_args(tables, tables + '/published_s')!r}); s = SparkSession.getActiveSession(); "
            "print('KEPT', rc, s.sparkContext.master, s.conf.get('spark.sql.shuffle.partitions'))")
    env = os.environ | {"PYSPARK_SUBMIT_ARGS": "--master local[2] --conf spark.sql.shuffle.partitions=3 --conf spark.ui.enabled=false pyspark-shell",
                        "PYTHONPATH": os.path.dirname(os.path.dirname(os.path.abspath(__file__)))}
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=600)
    assert "KEPT 0 local[2] 3" in out.stdout, out.stderr[-2000:]
