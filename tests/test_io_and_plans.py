"""Sources/sinks (S3-S6, R30), plan checks (survey 5.4) and the driver contract."""

import os
import tempfile
from datetime import date

import pytest

from cierre.operators import dims as D
from cierre.operators import kpis as K
from cierre.params import FIXTURE_PARAMS as P
from cierre.sources import io as IO
from cierre.sources.fixtures import fixture_bookings, fixture_inventory
from cierre.sources.schema import read_bookings
from tests.conftest import SF0001, make_bookings


def test_read_or_empty_and_empty_dim(spark):
    missing = os.path.join(tempfile.mkdtemp(prefix="cierre-test-"), "nope")
    df = IO.read_or_empty(spark, missing, "a int, b string")
    assert df.count() == 0 and df.columns == ["a", "b"]
    e = IO.empty_dim(spark)
    assert e.count() == 0 and "pago_dim" in e.columns


def test_read_or_empty_raises_other_errors(spark):
    with pytest.raises(Exception, match="no_such_format"):
        IO.read_or_empty(spark, tempfile.mkdtemp(prefix="cierre-test-"), "a int", "no_such_format").count()


def test_publish_replace_and_presence(spark):
    root = tempfile.mkdtemp(prefix="cierre-pub-")
    b = make_bookings(spark, [dict(fecha_venta_declarada=date(2001, 4, 3))])
    IO.publish({"a": b.select("booking_id"), "b": b.select("stock")}, root)
    IO.publish({"a": b.select("booking_id").union(b.select("booking_id"))}, root)  # replace one dataset only
    pres = {r["dataset"]: (r["present"], r["n_rows"]) for r in IO.dataset_presence(spark, root, ["a", "b", "c"]).collect()}
    assert pres == {"a": (True, 2), "b": (True, 1), "c": (False, None)}
    assert IO.read_published(spark, root, "b").columns == ["stock"]


def test_failed_publish_leaves_the_set(spark):
    root = tempfile.mkdtemp(prefix="cierre-pub-")
    good = spark.range(3)
    IO.publish({"a": good, "b": good}, root)
    with pytest.raises(Exception):
        IO.publish({"a": spark.range(7), "b": good.selectExpr("assert_true(id < 0)")}, root)
    assert IO.read_published(spark, root, "a").count() == 3


def test_runs_at_the_same_time_lose_nothing(spark):
    root = tempfile.mkdtemp(prefix="cierre-pub-")
    IO.publish({"a": spark.range(1)}, root)
    slow = IO.write_all({"b": spark.range(2)}, root)          # written, not yet named
    IO.publish({"a": spark.range(5), "c": spark.range(3)}, root)
    assert IO.commit(spark, root, slow) == 3
    assert {n: IO.read_published(spark, root, n).count() for n in "abc"} == {"a": 5, "b": 2, "c": 3}


def test_commit_on_an_old_manifest_is_tried_again(spark, monkeypatch):
    """Two runs that both have read version 1: the second to create version 2 fails
    and builds on the first."""
    root = tempfile.mkdtemp(prefix="cierre-pub-")
    IO.publish({"a": spark.range(1)}, root)
    first, second = IO.write_all({"b": spark.range(2)}, root), IO.write_all({"c": spark.range(3)}, root)
    real, calls = IO.manifest, []

    def late(s, r):
        calls.append(1)
        seen = real(s, r)
        if len(calls) == 1:
            seen.collect()
            rows = s.createDataFrame(seen.collect(), seen.schema)   # as it was before the other run's commit
            monkeypatch.setattr(IO, "manifest", real)
            IO.commit(s, r, first)
            monkeypatch.setattr(IO, "manifest", late)
            return rows
        return seen

    monkeypatch.setattr(IO, "manifest", late)
    assert IO.commit(spark, root, second) == 3 and len(calls) == 2
    monkeypatch.setattr(IO, "manifest", real)
    assert {n: IO.read_published(spark, root, n).count() for n in "abc"} == {"a": 1, "b": 2, "c": 3}
    rows = IO.manifest(spark, root).collect()
    assert {(r.version, r.parent) for r in rows} == {(3, 2)}


def test_a_number_is_given_once(spark):
    root = tempfile.mkdtemp(prefix="cierre-pub-")
    os.mkdir(f"{root}/manifest")
    path = f"{root}/manifest/000000000001.json"
    assert IO._create(spark, path, "one") and not IO._create(spark, path, "two")
    assert open(path).read() == "one" and [f for f in os.listdir(f"{root}/manifest") if not f.startswith(".")] == ["000000000001.json"]
    fs, draft = IO._file_system(spark, f"{root}/manifest/_draft")
    fs.create(draft, False).close()
    assert not IO._renamed(spark, draft, path) and IO._renamed(spark, draft, f"{root}/manifest/000000000002.json")


def test_vacuum_keeps_what_is_named(spark):
    root = tempfile.mkdtemp(prefix="cierre-pub-")
    for n in range(1, 5):
        IO.publish({"a": spark.range(n)} | ({"b": spark.range(9)} if n == 1 else {}), root)
    pending = IO.write_all({"c": spark.range(2)}, root)
    assert IO.vacuum(spark, root, keep=2) == []                     # all runs are young
    gone = IO.vacuum(spark, root, keep=2, grace_hours=0)
    assert len(gone) == 2 and pending[0]["run"] in gone            # run 2, and the one that never committed
    assert IO.read_published(spark, root, "a").count() == 4 and IO.read_published(spark, root, "b").count() == 9
    assert len([f for f in os.listdir(f"{root}/manifest") if f.endswith(".json")]) == 2


def test_checks_read_no_dataset_again(spark):
    root = tempfile.mkdtemp(prefix="cierre-pub-")
    rows = [(date(2001, 4, 2), "h", 3, 1.0), (date(2001, 4, 9), None, 4, None), (None, "h", None, 2.0)]
    IO.publish({"a": spark.createDataFrame(rows, "semana date, hub string, n bigint, x double"),
                "none": spark.createDataFrame([], "semana date, n bigint")}, root)
    wanted = [("a", 3, date(2001, 4, 9)), ("none", None, None), ("missing", None, None)]
    checks = IO.dataset_checks(spark, root, wanted)
    got = {r["dataset"]: tuple(r)[1:] for r in checks.collect()}
    assert got["a"] == (True, 3, 2, 7, date(2001, 4, 2), date(2001, 4, 9), True)
    assert got["none"] == (True, 0, 0, 0, None, None, True)
    assert got["missing"] == (False, None, None, None, None, None, False)
    assert "versions" not in _plan(checks)
    for limits, passed in (((4, None), False), ((None, date(2001, 4, 10)), False), ((3, date(2001, 4, 9)), True)):
        assert IO.dataset_checks(spark, root, [("a", *limits)]).first()["passed"] is passed
    assert not IO.dataset_checks(spark, root, [("none", None, date(2001, 1, 1))]).first()["passed"]


def test_other_labels_give_the_same_counts(spark):
    from cierre.sources.schema import Labels, standardize_bookings

    rows = [dict(metodo_de_pago=m, financing_provider=f, fecha_venta_declarada=date(2001, 4, 3), fecha_entrega=date(2001, 4, 5))
            for m, f in (("Financing", "Captive"), ("Financing Inhouse", "Bank"), ("Cash payment", None), (None, None), ("Other", None))]
    own = {"Financing": "credito", "Financing Inhouse": "credito propio", "Cash payment": "contado"}
    renamed = [dict(r, metodo_de_pago=own.get(r["metodo_de_pago"], r["metodo_de_pago"]),
                    financing_provider={"Captive": "la casa"}.get(r["financing_provider"], r["financing_provider"])) for r in rows]
    labels = Labels("credito", "contado", "credito propio", "la casa")
    other = standardize_bookings(make_bookings(spark, renamed), labels)
    for report in (K.weekly_hub_str, K.daily_hub, K.last_month_hub):
        assert report(other, P).collect() == report(make_bookings(spark, rows), P).collect()
    # a method that only shares a name with the reports' own is another one
    assert standardize_bookings(make_bookings(spark, rows[:1]), labels).first()["metodo_de_pago"] == "other: Financing"


@pytest.fixture(scope="module")
def stored(spark):
    root = tempfile.mkdtemp(prefix="cierre-tbl-")
    fixture_bookings(spark, SF0001).write.parquet(f"{root}/bookings")
    return read_bookings(spark, f"{root}/bookings"), fixture_inventory(spark, SF0001)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_close_date_filter_pushed_to_parquet(stored):
    b, _ = stored
    from cierre.plans.enrich import closed_rows

    plan = closed_rows(b, P.weeks_start, P.yesterday)._jdf.queryExecution().sparkPlan().toString()
    assert "PushedFilters" in plan and "fecha_venta_declarada" in plan.split("PushedFilters")[1][:400]


def test_dim_report_has_no_cartesian_or_nested_loop(stored):
    b, i = stored
    for dim in ("region", "aging", "stock_region"):
        plan = _plan(D.str_report(b, i, P, dim, "week"))
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_country_total_expand_stays_off_raw_rows(stored):
    b, _ = stored
    plan = K.kpi_period(b, P, "mtd")._jdf.queryExecution().optimizedPlan().toString()
    # The Expand of the grouping sets sits above the hub-level aggregate.
    expand_at = plan.find("Expand")
    assert expand_at != -1 and plan.find("Aggregate", expand_at) != -1


def test_entry_and_registry_contract(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0
    assert set(df.columns) == {"method", "dim", "period_kind", "period", "ventas", "cancelaciones", "str", "mix"}
    q, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(q)
    from cierre.registry import REGISTRY
    from oracle.registry import SQL

    assert set(REGISTRY) == set(SQL) and set(REGISTRY) <= set(q)


def _formatted(spark, df) -> str:
    import contextlib
    import io

    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        return buf.getvalue()
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)


def test_funnel_event_dates_pushed_to_parquet(spark, stored):
    from cierre.operators import funnel as FN

    b, _ = stored
    plan = _formatted(spark, FN.funnel_weekly(b, P))
    pushed = [line for line in plan.splitlines() if "PushedFilters" in line]
    assert pushed and "fecha_handoff" in pushed[0] and "fecha_cancelacion_reserva" in pushed[0]


def test_rows_without_a_car_are_spread(spark):
    from cierre.plans.enrich import spread_key

    b = make_bookings(spark, [dict(stock="none") for _ in range(20)])
    keys = {r[0] for r in b.alias("b").selectExpr(spread_key("b")).collect()}
    assert len(keys) == 20


def test_kpi_reports_scan_bookings_once(spark, stored):
    b, _ = stored
    events = K.daily_events(b, P)
    plan = events._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1
    for df in (K.weekly_hub_str_of(events, P), K.bookings_weekly_of(events, P), K.kpi_periods_of(events, P),
               K.daily_hub_of(events, P), K.last_month_hub_of(events, P), K.profile_mix_weekly_of(events, P)):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
    assert K.daily_hub_of(events, P).exceptAll(K.daily_hub(b, P)).count() == 0


def test_kpis_of_both_granularities_come_from_one_aggregate(spark):
    from cierre.operators import sla as SL

    sla = spark.createDataFrame([], "stage string, semana date, hub string, ti_flag string, sla double, n long, days long")
    assert "Union" not in SL.sla_kpi(sla, P)._jdf.queryExecution().optimizedPlan().toString()


def test_pivot_columns_are_mondays(spark, stored):
    from cierre.params import Params

    b, i = stored
    p = Params(as_of=P.as_of, weeks_start=date(2001, 1, 3))
    wide = D.pivot_weeks(D.str_report(b, i, p, "region"), p)
    assert wide.columns[2] == "2001-01-01"
    row = wide.filter("method = 'all' AND dim = 'MX'").first()
    assert any(row[c] is not None for c in wide.columns if c.startswith("2001"))


def test_checkpoint_folder_is_required_on_a_cluster(monkeypatch):
    from types import SimpleNamespace

    from cierre import session

    sc = SimpleNamespace(getCheckpointDir=lambda: None, master="yarn")
    with pytest.raises(ValueError):
        session.ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda k, d=None: d)))
