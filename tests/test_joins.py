"""As-of join, Bloom pruning, stored snapshots, range join: results and plans."""

import os
import random
import re
import tempfile
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from cierre.operators import dims as D
from cierre.params import FIXTURE_PARAMS as P
from cierre.plans import pruning
from cierre.plans.asof import as_of_join
from cierre.plans.periods import with_periods
from cierre.sources import layout as L
from cierre.sources.fixtures import fixture_bookings, fixture_inventory
from cierre.sources.schema import read_bookings, read_inventory
from tests.conftest import SF0001, days, empty_inventory, make_bookings, make_inventory

D0 = date(2001, 4, 2)


def _text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def plain(spark):
    """Plans as for large tables: no broadcast by size, no adaptive changes."""
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.fixture(scope="module")
def stored(spark):
    root = tempfile.mkdtemp(prefix="cierre-joins-")
    fixture_bookings(spark, SF0001).write.parquet(f"{root}/bookings")
    fixture_inventory(spark, SF0001).write.parquet(f"{root}/inventory")
    return read_bookings(spark, f"{root}/bookings"), read_inventory(spark, f"{root}/inventory"), root


# ------------------------------------------------------------ as-of join ----
LEFT, RIGHT = "key long, day date, n long", "k long, d date, v string, rank int"


def _asof_brute(left, right, lookback, latest):
    out = []
    for key, day, n in left:
        mine = [(d, r, v) for k, d, v, r in right if k is not None and k == key and d is not None and v is not None]
        near = [x for x in mine if day is not None and day - timedelta(days=lookback) <= x[0] <= day]
        best = max(near, default=None) or (max(mine, default=None) if latest else None)
        out.append((n, best and best[2]))
    return sorted(out)


@pytest.mark.parametrize("salt", [1, 3])
@pytest.mark.parametrize("latest", [True, False])
def test_as_of_join_equals_a_search(spark, salt, latest):
    rng = random.Random(8)
    day = lambda: rng.choice([None, *[days(D0, k) for k in range(9)]])
    left = [(rng.choice([None, 1, 2, 3, 9]), day(), n) for n in range(80)]
    right = [(rng.choice([None, 1, 2, 3, 4]), day(), rng.choice([None, "a", "b", "c"]), rng.randint(0, 1)) for _ in range(60)]
    for lookback in (0, 1, 4):
        got = as_of_join(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), ("key", "day"), ("k", "d"), "v",
                         lookback, "found", prefer=F.col("rank"), otherwise_latest=latest, salt=salt)
        assert got.columns == ["key", "day", "n", "found"]
        assert sorted((r.n, r.found) for r in got.collect()) == _asof_brute(left, right, lookback, latest)


def test_as_of_join_on_empty_sides(spark):
    l, r = spark.createDataFrame([(1, D0, 0), (None, None, 1)], LEFT), spark.createDataFrame([(1, D0, "a", 0)], RIGHT)
    join = lambda a, b: as_of_join(a, b, ("key", "day"), ("k", "d"), "v", 1, "v_found").collect()
    assert join(l.limit(0), r) == []
    assert {x.n: x.v_found for x in join(l, r.limit(0))} == {0: None, 1: None}


def test_as_of_join_shuffles_each_side_once(spark, stored, plain):
    from cierre.plans.enrich import closed_rows, stock_region_asof

    b, i, _ = stored
    plan = _text(stock_region_asof(closed_rows(b, P.weeks_start, P.yesterday), i, P.as_of))
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan  # of both sides together
    assert plan.count("FileScan") == 2


# --------------------------------------------------------------- pruning ----
def test_key_filter_lets_every_key_through(spark):
    keys = spark.createDataFrame([(k * 37 - 500,) for k in range(500)] + [(None,)], "k long")
    found = pruning.key_filter(keys, 64)
    assert found.count() <= 64
    rows = spark.range(-1000, 20000).withColumnRenamed("id", "bk")
    for words in (64, 1 << 14):
        kept = {r.bk for r in pruning.maybe_in(rows, "bk", pruning.key_filter(keys, words), words).collect()}
        assert kept >= {k * 37 - 500 for k in range(500)}
        if words > 64:
            assert len(kept) < 2500
    assert pruning.maybe_in(rows, "bk", pruning.key_filter(keys.limit(0), 64), 64).count() == 0


@pytest.mark.parametrize("words", [1, 1 << 16])
def test_pruning_changes_no_row(spark, stored, words):
    b, i, _ = stored
    for dims in (["stock_region"], ["aging"], ["price", "pix"], D.DIMS):
        plainly = D.report(b, i, P, dims)
        pruned = D.report(b, i, P, dims, prune=True, words=words)
        assert plainly.exceptAll(pruned).count() == 0 == pruned.exceptAll(plainly).count()


def test_pruned_report_reads_bookings_once(spark, stored, plain):
    b, i, _ = stored
    plan = _text(D.report(b, i, P, ["price"], prune=True))
    assert "fecha_venta_declarada" not in "".join(re.findall(r"FileScan.*", plan))  # read before, into the checkpoint
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 1 and "GreaterThanOrEqual(inv_date" in scans[0]                # range of days reaches the scan
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan
    semi = plan.index("LeftSemi")
    assert plan.find("Exchange hashpartitioning(bk_stock") < semi                        # cut before the shuffle


def test_dimension_reports_scan_each_table_once(spark, stored, plain):
    b, i, _ = stored
    for dim in D.DIMS:
        plan = _text(D.str_report(b, i, P, dim))
        assert plan.count("FileScan") == (1 if dim == "region" else 2)
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    plan = _text(D.report(b, i, P))
    assert plan.count("FileScan") == 2 and len(re.findall(r"Join \[", plan)) == 1


# ---------------------------------------------------------------- layout ----
@pytest.fixture(scope="module")
def table(spark, stored):
    _, i, root = stored
    name = "cierre_test_snapshots"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    L.write_snapshots(i, name, 12, path=f"{root}/stored")
    yield name
    spark.sql(f"DROP TABLE {name}")


def test_stored_snapshots_are_not_shuffled(spark, stored, table, plain):
    b, i, _ = stored
    whole = D.report(b, L.read_snapshots(spark, table), P, stored_by_car=True)
    lines = _text(whole).splitlines()
    scan = next(k for k, line in enumerate(lines) if "FileScan" in line and "bk_stock" in line)
    depth = lambda line: len(line) - len(line.lstrip(" :+-|"))
    join = max(k for k, line in enumerate(lines[:scan]) if "SortMergeJoin" in line)
    between = [line for line in lines[join:scan] if depth(line) > depth(lines[join])]
    below = between[max(k for k, line in enumerate(between) if "FileScan" in line) + 1 :]  # the join's other side
    assert not any("Exchange" in line for line in below)
    assert "Bucketed: true" in lines[scan]
    assert whole.exceptAll(D.report(b, i, P)).count() == 0


@pytest.mark.parametrize("dim", ["price", "pix", "aging", "stock_region"])
def test_single_reports_over_the_layout(spark, stored, table, dim):
    b, i, _ = stored
    got = D.str_report(b, L.read_snapshots(spark, table), P, dim, stored_by_car=True)
    want = D.str_report(b, i, P, dim)
    assert got.exceptAll(want).count() == 0 == want.exceptAll(got).count()


def test_stored_files_are_one_a_bucket_and_sorted(spark, stored, table):
    _, i, root = stored
    files = [f for f in os.listdir(f"{root}/stored") if f.endswith(".parquet")]
    assert len(files) == 12
    one = [(r.bk_stock, r.inv_date) for r in spark.read.parquet(f"{root}/stored/{files[0]}").collect()]
    assert one == sorted(one) and one
    assert L.read_snapshots(spark, table).exceptAll(i).count() == 0


def test_appended_snapshots(spark, stored):
    b, i, root = stored
    name, again = "cierre_test_appended", "cierre_test_rewritten"
    try:
        L.write_snapshots(i.filter("inv_date < DATE'2000-01-01'"), name, 4, path=f"{root}/appended")
        L.append_snapshots(i.filter("inv_date >= DATE'2000-01-01'"), name)
        L.rewrite_snapshots(spark, name, again)
        for t in (name, again):
            rows = L.read_snapshots(spark, t)
            assert rows.count() == i.count() and rows.exceptAll(i).count() == 0
            got = D.report(b, rows, P, stored_by_car=True)
            assert got.exceptAll(D.report(b, i, P)).count() == 0
        with pytest.raises(ValueError):
            L.rewrite_snapshots(spark, name, name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"DROP TABLE IF EXISTS {again}")


def test_repeated_snapshots_and_hot_cars(spark):
    """Duplicate snapshots keep one row a day (Q8), in every form of the join."""
    b = make_bookings(spark, [dict(stock="5", fecha_reserva=D0, fecha_venta_declarada=D0)] * 40 + [dict(stock="x", fecha_venta_declarada=D0)])
    i = make_inventory(spark, [dict(bk_stock=5, inv_date=D0, real_published_price=price, pix_cash=pix, stock_region=region)
                               for price, pix, region in ((300000.0, 0.5, "PUEBLA"), (200000.0, 0.99, "CDMX"), (200000.0, 0.9, None)) * 30])
    plainly = D.report(b, i, P)
    assert plainly.exceptAll(D.report(b, i, P, stored_by_car=True)).count() == 0
    assert plainly.exceptAll(D.report(b, i, P, prune=True)).count() == 0
    of = {(r.report, r.dim): r.ventas for r in plainly.filter("grain = 'month' AND method = 'Financing' AND ventas > 0").collect()}
    assert of["price", "0-250K"] == 40 and of["stock_region", "CDMX"] == 40 and of["region", "MX"] == 41


def test_no_snapshots(spark):
    b = make_bookings(spark, [dict(fecha_venta_declarada=D0)])
    for how in ({}, {"prune": True}, {"stored_by_car": True}):
        rows = D.report(b, empty_inventory(spark), P, **how)
        assert rows.filter("report = 'region' AND ventas > 0").count() and not rows.filter("report = 'price'").count()
    assert D.report(b.limit(0), empty_inventory(spark), P, prune=True).filter("ventas > 0").count() == 0


# ------------------------------------------------------------ range join ----
def test_range_join_equals_all_pairs(spark):
    rng = random.Random(3)
    periods = [(k, days(D0, rng.randint(-90, 90)), rng.randint(-2, 200)) for k in range(25)]
    periods = [(k, lo, days(lo, n)) for k, lo, n in periods] + [(98, None, D0), (99, D0, None)]
    rows = [(n, days(D0, rng.randint(-100, 260))) for n in range(300)] + [(777, None)]
    r = spark.createDataFrame(rows, "n long, day date")
    p = spark.createDataFrame(periods, "key long, lo date, hi date")
    want = sorted((n, k) for n, x in rows for k, lo, hi in periods if x and lo and hi and lo <= x <= hi)
    for bins in (1, 28, 1000):
        assert sorted((x.n, x.key) for x in with_periods(r, "day", p, bins).collect()) == want


def test_range_join_is_no_nested_loop(spark, plain):
    p = spark.createDataFrame([(1, D0, days(D0, 40))], "key long, lo date, hi date")
    plan = _text(with_periods(spark.createDataFrame([(1, D0)], "n long, day date"), "day", p))
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "SortMergeJoin [_bin" in plan


def test_period_report(spark):
    b = make_bookings(spark, [dict(fecha_venta_declarada=D0), dict(fecha_venta_declarada=days(D0, 3), metodo_de_pago=None),
                              dict(fecha_cancelacion_reserva=D0, metodo_de_pago="Cash payment"), dict(fecha_venta_declarada=P.as_of)])
    p = spark.createDataFrame([("c", "one", D0, D0), ("c", "all", days(D0, -9), days(D0, 99)), ("c", "none", D0, days(D0, -1))],
                              "period_kind string, period_key string, lo date, hi date")
    got = {(r.period_key, r.method): (r.ventas, r.cancelaciones) for r in D.period_report(b, p, P).collect()}
    assert got == {("one", "all"): (1, 1), ("one", "Financing"): (1, 0), ("one", "Cash payment"): (0, 1),
                   ("all", "all"): (2, 1), ("all", "Financing"): (1, 0), ("all", "Cash payment"): (0, 1)}
    assert D.period_report(b, p.limit(0), P).count() == 0
