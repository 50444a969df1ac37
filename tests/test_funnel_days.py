"""The funnel from daily bitmaps equals the one counted from the bookings."""

import random
from datetime import date

import pytest

from cierre.operators import funnel as FN
from cierre.operators import funnel_days as FD
from cierre.params import FIXTURE_PARAMS as P
from cierre.params import Params
from cierre.sources.fixtures import fixture_bookings
from tests.conftest import SF0001, days, make_bookings


def _rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def _random_bookings(spark, seed):
    rng = random.Random(seed)
    day = lambda: rng.choice([None, days(date(2001, 2, 20), rng.randint(0, 70))])
    ids = [rng.choice([0, 1, -1, -40000, 32768, 32769, 10**12, rng.randint(1, 10**6)]) for _ in range(120)]
    return make_bookings(spark, [dict(
        booking_id=rng.choice(ids), trade_in=rng.choice([0, 1, None]), reservation_hub_name=rng.choice(["A", "B", None]),
        estimate_flag=rng.choice([1, 1, 1, 0]), metodo_de_pago=rng.choice(["Financing", "Financing Inhouse", "Cash payment"]),
        fecha_handoff=day(), fecha_aprobacion=day(), fecha_venta_declarada=day(), fecha_cancelacion_reserva=day()) for _ in range(400)])


@pytest.mark.parametrize("as_of", [P.as_of, date(2001, 4, 1), date(2001, 3, 31), date(2001, 4, 16)])
def test_equal_to_the_counted_funnel(spark, as_of):
    p = Params(as_of=as_of, weeks_start=P.weeks_start)
    for b in (_random_bookings(spark, 4), fixture_bookings(spark, SF0001)):
        d = FD.days_of(b, p)
        assert _rows(FD.funnel_weekly_of(d, p)) == _rows(FN.funnel_weekly(b, p))
        for kind in ("mtd", "lmtd"):
            assert _rows(FD.funnel_period_of(d, p, kind)) == _rows(FN.funnel_period(b, p, kind)), kind


def test_frames_merge(spark):
    """Halves of the bookings, with some in both, merge to the whole."""
    b = _random_bookings(spark, 9)
    one, two = b.filter("booking_id % 3 <> 0"), b.filter("booking_id % 3 <> 1")
    d = FD.merged(FD.days_of(one, P), FD.days_of(two, P))
    assert _rows(FD.funnel_weekly_of(d, P)) == _rows(FN.funnel_weekly(b, P))


def test_one_scan_and_no_expand(spark):
    b = fixture_bookings(spark, SF0001)
    plan = FD.funnel_weekly_of(FD.days_of(b, P), P)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("orders.parquet") <= 1 and "Expand" not in plan and plan.count("o_orderkey") > 0


def test_empty(spark):
    d = FD.days_of(make_bookings(spark, []), P)
    assert FD.funnel_weekly_of(d, P).collect() == [] and FD.funnel_period_of(d, P, "mtd").collect() == []
