"""Joins dealt out by rows."""

from __future__ import annotations

from functools import partial

from cierre.plans import spread
from cierre.sources import fixtures
from tests.conftest import SF0001


def test_partitions_grow_with_rows():
    assert spread.partitions_for(10**6, 8) is None and spread.partitions_for(0, 8) is None
    for n_rows in (3_600_000, 36_000_000, 216_000_000):
        assert n_rows / spread.partitions_for(n_rows, 12) <= spread.ROWS


def test_snapshots_of_many_rows(spark, monkeypatch):
    """A task has a bounded number of lines, whatever merges small partitions; the rows stay the same."""
    usual = fixtures.fixture_inventory(spark, SF0001)
    cores = spark.sparkContext.defaultParallelism
    lines = spark.read.parquet(f"{SF0001}/lineitem.parquet").count()
    rows = lines // (3 * cores)
    monkeypatch.setattr(fixtures, "deal_out", partial(spread.deal_out, rows=rows))
    dealt = fixtures.fixture_inventory(spark, SF0001)
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    assert dealt.rdd.getNumPartitions() >= 3 * cores > usual.rdd.getNumPartitions()
    assert dealt.exceptAll(usual).isEmpty() and usual.exceptAll(dealt).isEmpty()
    assert plan.count("Exchange hashpartitioning") == 2  # one for each side, none for the aggregate


def test_keys_without_rows(spark):
    left = spark.createDataFrame([(i % 7 or None, i) for i in range(200)], "k long, v int")
    right = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (9, "d")], "j long, w string")
    a, b = spread.deal_out(left, "k", right, "j", rows=2)
    assert a.rdd.getNumPartitions() == b.rdd.getNumPartitions() == 100
    joined = lambda x, y: sorted((r["v"], r["w"]) for r in x.join(y, x.k == y.j).collect())
    assert joined(a, b) == joined(left, right) and len(joined(a, b)) == 2 * len(range(1, 200, 7))


def test_dealt_joins_hash_the_other_side(spark):
    """No sort, whose first page is most of what a task holds; the other side's rows in a task are bounded too."""
    keys = [*range(50), 7, 7, None]
    left = spark.createDataFrame([(k, n) for n, k in enumerate(keys * 2)], "k long, v int")
    right = spark.createDataFrame([(k, n) for n, k in enumerate(keys * 8)], "j long, w int")
    a, b = spread.deal_out(left, "k", right, "j", rows=4)
    joined = a.join(b, a.k == b.j)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "Sort" not in plan
    assert a.rdd.getNumPartitions() == b.rdd.getNumPartitions() == -(-len(keys) * 8 // 4)
    usual = left.join(right.hint("merge"), left.k == right.j)
    assert joined.exceptAll(usual).isEmpty() and usual.exceptAll(joined).isEmpty()
    assert joined.count() == 49 * 2 * 8 + 6 * 24


def test_snapshots_of_many_rows_need_no_sort(spark, monkeypatch):
    monkeypatch.setattr(fixtures, "deal_out", partial(spread.deal_out, rows=100))
    plan = fixtures.fixture_inventory(spark, SF0001)._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "Sort" not in plan
