"""Empty inputs (survey 5.2): every report plans and returns without error;
bounded scaffolds still show where the reference shows them."""

from datetime import date

from cierre.operators import dims as D
from cierre.operators import funnel as FN
from cierre.operators import kpis as K
from cierre.params import Params
from cierre.sources import datasets as DS
from cierre.sources.schema import BOOKINGS_SCHEMA, standardize_bookings
from tests.conftest import empty_inventory

P = Params(as_of=date(2001, 4, 18), weeks_start=date(2001, 3, 26))


def _empty_bookings(spark):
    return standardize_bookings(spark.createDataFrame([], BOOKINGS_SCHEMA))


def test_empty_bookings_reports(spark):
    b, i = _empty_bookings(spark), empty_inventory(spark)
    region = D.str_report(b, i, P, "region", "week").collect()
    # no observed week: only the WTD/LWTD scaffold rows remain, all with null rates
    assert {r["period_kind"] for r in region} == {"wtd", "lwtd"}
    assert all(r["str"] is None and r["ventas"] == 0 for r in region)
    assert D.str_report(b, i, P, "aging", "week").count() == 0          # no observed buckets
    assert len(D.str_report(b, i, P, "region", "month").collect()) == 7 * 3 * 4
    for df in (K.kpi_period(b, P, "mtd"), K.daily_hub(b, P), K.last_month_hub(b, P), K.weekly_hub_str(b, P),
               FN.funnel_weekly(b, P), FN.funnel_periods(b, P), DS.sla_dataset(b, P)):
        assert df.count() == 0
