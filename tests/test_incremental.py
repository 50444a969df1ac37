"""KPI state from changed bookings: equal to a full run, reading what changed."""

import random
import tempfile
from datetime import date

import pytest

from cierre import incremental as INC
from cierre.operators import kpis as K
from cierre.params import FIXTURE_PARAMS as P
from cierre.sources import io as IO
from tests.conftest import days, make_bookings

D0 = date(2001, 3, 20)
HUBS = ["CDMX Centro", "GDL Sur", None]


def _row(rng, booking_id):
    day = lambda n: rng.choice([None, days(D0, rng.randint(0, n))])
    return dict(booking_id=booking_id, b2b=int(rng.random() < 0.1), estimate_flag=rng.randint(0, 1), perfil=rng.choice(["A", "X", None]),
                metodo_de_pago=rng.choice(["Financing", "Cash payment", "Other", None]), reservation_hub_name=rng.choice(HUBS),
                financing_provider=rng.choice(["Captive", "Bank"]), fecha_reserva=day(20), fecha_origen=day(20),
                fecha_venta_declarada=day(40), fecha_cancelacion_reserva=day(40), fecha_entrega=day(45), devolucion_date=day(50))


def _same_as_full(spark, root, table):
    full = K.daily_events(make_bookings(spark, [r for rows in table.values() for r in rows]), P)
    for name, got in INC.reports(spark, root, P).items():
        want = {"weekly_hub_str": K.weekly_hub_str_of, "bookings_weekly": K.bookings_weekly_of, "daily_hub": K.daily_hub_of,
                "profile_mix_weekly": K.profile_mix_weekly_of, "last_month_hub": K.last_month_hub_of}.get(name)
        if want is None:
            kind = name.removeprefix("kpi_")
            expected = K.kpi_periods_of(full, P).filter(f"period_kind = '{kind}'").drop("period_kind")
        else:
            expected = want(full, P)
        assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect())), name


@pytest.mark.parametrize("max_runs", [30, 2])
def test_runs_of_changes_equal_a_full_run(spark, monkeypatch, max_runs):
    monkeypatch.setattr(INC, "MAX_RUNS", max_runs)
    monkeypatch.setattr(INC, "RANGE_IDS", 10)
    rng, root = random.Random(5), tempfile.mkdtemp(prefix="cierre-state-")
    # several rows a booking, as a history table has
    table = {n: [_row(rng, n) for _ in range(rng.randint(1, 2))] for n in range(40)}
    INC.update(spark, root, make_bookings(spark, [r for rows in table.values() for r in rows]))
    _same_as_full(spark, root, table)
    for step in range(3):
        touched = rng.sample(sorted(table), 6) + [100 + step]
        removed = [n for n in rng.sample(sorted(table), 3) if n not in touched] + [5000]
        for n in touched:
            table[n] = [_row(rng, n) for _ in range(rng.randint(1, 3))]
        for n in removed:
            table.pop(n, None)
        INC.update(spark, root, make_bookings(spark, [r for n in touched for r in table[n]]),
                   spark.createDataFrame([(n,) for n in removed], "booking_id long"))
    _same_as_full(spark, root, table)
    logs = [r.dataset for r in IO.manifest(spark, root).collect() if r.dataset.startswith("versions-")]
    assert len(logs) == (4 if max_runs == 30 else 2)


def test_late_cancel_and_correction(spark):
    root = tempfile.mkdtemp(prefix="cierre-state-")
    sold = dict(booking_id=1, fecha_venta_declarada=date(2001, 4, 3))
    INC.update(spark, root, make_bookings(spark, [sold, dict(booking_id=2)]))
    INC.update(spark, root, make_bookings(spark, [dict(sold, reservation_hub_name="GDL Sur"), dict(booking_id=2, fecha_cancelacion_reserva=date(2001, 4, 4))]))
    weekly = {r.hub: (r.ventas_total, r.cancel_total) for r in INC.reports(spark, root, P)["weekly_hub_str"].collect()}
    assert weekly == {"GDL Sur": (1, 0), "CDMX Centro": (0, 1)}
    assert all(r.n > 0 for r in INC.events(spark, root).collect())


def test_only_the_ranges_that_changed_are_read(spark, monkeypatch):
    monkeypatch.setattr(INC, "RANGE_IDS", 100)
    root = tempfile.mkdtemp(prefix="cierre-state-")
    INC.update(spark, root, make_bookings(spark, [dict(booking_id=n) for n in range(0, 1000, 10)]))
    logs = [r for n, r in INC._stored(spark, root).items() if n.startswith("versions-")]
    part = INC.versions(spark, logs, [3])
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(id_range" in plan or "PartitionFilters: [id_range" in plan
    assert part.count() == 10 and all("id_range=3" in f for f in part.select("booking_id", "_metadata.file_path").toPandas()["file_path"])


def test_two_runs_at_once(spark, monkeypatch):
    root = tempfile.mkdtemp(prefix="cierre-state-")
    INC.update(spark, root, make_bookings(spark, [dict(booking_id=1)]))
    real = IO.commit

    def other_first(*a, **k):
        monkeypatch.setattr(IO, "commit", real)
        INC.update(spark, root, make_bookings(spark, [dict(booking_id=2)]))
        return real(*a, **k)

    monkeypatch.setattr(IO, "commit", other_first)
    with pytest.raises(INC.StateMoved):
        INC.update(spark, root, make_bookings(spark, [dict(booking_id=3)]))
    assert INC.update(spark, root, make_bookings(spark, [dict(booking_id=3)])) == 3
    total = INC.events(spark, root).filter("leg = 'r'").agg({"n": "sum"}).first()[0]
    assert total == 3


def test_empty_change(spark):
    root = tempfile.mkdtemp(prefix="cierre-state-")
    INC.update(spark, root, make_bookings(spark, [dict(booking_id=1, fecha_venta_declarada=date(2001, 4, 3))]))
    INC.update(spark, root, make_bookings(spark, []))
    assert INC.reports(spark, root, P)["weekly_hub_str"].count() == 1


def test_command_line(spark, tmp_path):
    from cierre.__main__ import main

    rng = random.Random(11)
    table = {n: [_row(rng, n)] for n in range(30)}
    make_bookings(spark, [r for rows in table.values() for r in rows]).write.parquet(f"{tmp_path}/all")
    table[3], table[40] = [_row(rng, 3)], [_row(rng, 40)]
    gone = table.pop(7)
    make_bookings(spark, table[3] + table[40]).write.parquet(f"{tmp_path}/changed")
    spark.createDataFrame([(gone[0]["booking_id"],)], "booking_id long").write.parquet(f"{tmp_path}/removed")
    common = ["--state", f"{tmp_path}/state", "--as-of", P.as_of.isoformat(), "--weeks-start", P.weeks_start.isoformat(),
              "--out", f"{tmp_path}/out"]
    assert main([*common, "--changed", f"{tmp_path}/all"]) == 0
    assert main([*common, "--changed", f"{tmp_path}/changed", "--removed", f"{tmp_path}/removed"]) == 0
    _same_as_full(spark, f"{tmp_path}/state", table)
    assert sorted(r.dataset for r in IO.manifest(spark, f"{tmp_path}/out").collect()) == sorted(INC.reports(spark, f"{tmp_path}/state", P))
    with pytest.raises(SystemExit):
        main([*common, "--changed", ""])
