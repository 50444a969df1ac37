"""Column functions: rates (Q1), deltas (Q2), buckets and edges."""

from datetime import date

from pyspark.sql import functions as F

from cierre.functions import buckets as B
from cierre.functions.rates import delta_pp, mean_rounded, rate, raw_rate


def _one(spark, expr, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr).collect()]


def test_rate_half_up_and_null_on_zero(spark):
    got = _one(spark, rate("n", "d"), [(1, 16), (1, 8), (0, 0), (5, 5), (2, 3), (1, 80)], "n long, d long")
    # 6.25 -> 6.3 (half-up, where Python's round gives 6.2), 12.5, null, 100, 66.7, 1.25 -> 1.3
    assert got == [6.3, 12.5, None, 100.0, 66.7, 1.3]


def test_rate_two_decimals_and_raw(spark):
    assert _one(spark, rate("n", "d", 2), [(1, 3)], "n long, d long") == [33.33]
    assert _one(spark, raw_rate("n", "d"), [(1, 4), (1, 0)], "n long, d long") == [25.0, None]


def test_delta_pp_exact_in_tenths(spark):
    got = _one(spark, delta_pp("a", "b"), [(66.7, 50.0), (None, 1.0), (0.3, 0.1)], "a double, b double")
    assert got == [16.7, None, 0.2]


def test_mean_rounded(spark):
    assert _one(spark, mean_rounded("t", "n"), [(5, 2), (1, 3), (0, 0), (-1, 20), (-5, 2)], "t long, n long") == [
        2.5, 0.3, None, -0.1, -2.5]


def test_method_norm_and_fold(spark):
    data = [("Financing Inhouse",), ("Financing",), ("Cash payment",), (None,), ("Other",)]
    assert _one(spark, B.method_norm("m"), data, "m string") == ["Financing", "Financing", "Cash payment", None, "Other"]
    folded = _one(spark, B.method_fold("m"), data, "m string")
    assert folded == [["Financing", "all"], ["Financing", "all"], ["Cash payment", "all"], ["all"], ["~other"]]


def test_region_prefixes_case_insensitive(spark):
    data = [("CDMX Sur",), ("edomex Norte",), ("gdl centro",), ("QRO 1",), ("MTY",), ("PUE x",), ("CUE y",),
            ("TIJ z",), (None,)]
    got = _one(spark, F.expr(B.region_sql("h")), data, "h string")
    assert got == ["CDMX", "CDMX", "GDL", "QRO", "MTY", "PUE", "CUE", None, None]


def test_aging_edges(spark):
    r = date(2001, 4, 1)
    data = [(date(2001, 3, 3), r), (date(2001, 3, 2), r), (date(2001, 4, 5), r), (date(2001, 1, 31), r),
            (date(2001, 1, 1), r), (None, r)]
    got = _one(spark, F.expr(B.aging_sql("rc", "rs")), data, "rc date, rs date")
    # 29 days, 30 days, negative, 60 days, 90 days, null
    assert got == ["0-30d", "30-60d", "0-30d", "60-90d", "90+d", "90+d"]


def test_price_edges(spark):
    data = [(249999.99,), (250000.0,), (349999.0,), (350000.0,), (500000.0,), (None,)]
    got = _one(spark, F.expr(B.price_sql("p")), data, "p double")
    assert got == ["0-250K", "250-350K", "250-350K", "350-500K", "500K+", "500K+"]


def test_pix_value_by_method_and_null_top_bucket(spark):
    data = [("Financing", 0.87, 0.99), ("Financing Inhouse", 0.90, 0.80), ("Cash payment", 0.80, 0.95),
            ("Other", None, 0.93), (None, None, None), ("Cash payment", 0.5, None)]
    data += [("Cash payment", None, x) for x in (0.8799, 0.88, 0.93, 0.98)]
    got = _one(spark, F.expr(B.pix_sql("m", "f", "c")), data, "m string, f double, c double")
    assert got == ["< 0.88", "0.88-0.93", "0.93-0.98", "0.93-0.98", "≥ 0.98", "≥ 0.98",
                   "< 0.88", "0.88-0.93", "0.93-0.98", "≥ 0.98"]


def test_coming_soon_and_stock_region(spark):
    assert _one(spark, F.expr(B.coming_soon_sql("f")), [(1,), (0,), (None,)], "f int") == [
        "Coming Soon", "Sin Coming Soon", "Sin Coming Soon"]
    data = [("CDMX",), ("GUADALAJARA",), ("MONTERREY",), ("PUEBLA",), ("QUERETARO",), ("CUERNAVACA",), ("TIJUANA",)]
    assert _one(spark, B.stock_region_code("r"), data, "r string") == ["CDMX", "GDL", "MTY", "PUE", "QRO", "CUE", None]


def test_verdict_recode_and_profile(spark):
    data = [("Aprobada",), ("Sin dictamen",), ("Foo",), (None,)]
    assert _one(spark, B.verdict_category("d"), data, "d string") == ["Aprobada", "Sin dictamen", "Otro", "Otro"]
    data = [("X",), ("Revisar",), (None,)]
    assert _one(spark, B.is_profiled("p"), data, "p string") == [True, False, False]
