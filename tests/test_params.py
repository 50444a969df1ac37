"""Period windows from one as_of date (survey 2.9, Q3, Q12, Q13)."""

from datetime import date

from cierre.params import FIXTURE_PARAMS, Params


def test_fixture_windows_match_fixtures_md():
    w = FIXTURE_PARAMS.windows()
    assert w["wtd"] == (date(2001, 4, 16), date(2001, 4, 17))
    assert w["lwtd"] == (date(2001, 4, 9), date(2001, 4, 10))
    assert w["mtd"] == (date(2001, 4, 1), date(2001, 4, 17))
    assert w["lmtd"] == (date(2001, 3, 1), date(2001, 3, 17))
    assert w["last_month"] == (date(2001, 3, 1), date(2001, 3, 31))
    assert w["daily"] == (date(2001, 3, 4), date(2001, 4, 17))
    assert FIXTURE_PARAMS.month_keys == ["2001-01", "2001-02", "2001-03", "2001-04"]


def test_monday_has_empty_wtd_and_lwtd():
    p = Params(date(2001, 4, 16), date(2001, 1, 1))
    assert p.wtd_empty
    lo, hi = p.windows()["wtd"]
    assert hi < lo
    lo, hi = p.windows()["lwtd"]
    assert hi < lo


def test_first_of_month_mtd_and_lmtd_empty():
    p = Params(date(2001, 5, 1), date(2001, 1, 1))
    for k in ("mtd", "lmtd"):
        lo, hi = p.windows()[k]
        assert hi < lo, k
    assert p.windows()["last_month"] == (date(2001, 4, 1), date(2001, 4, 30))


def test_lmtd_clamps_to_month_end():
    p = Params(date(2001, 3, 31), date(2001, 1, 1))
    assert p.windows()["lmtd"] == (date(2001, 2, 1), date(2001, 2, 28))
    p = Params(date(2000, 3, 31), date(2000, 1, 1))  # leap year
    assert p.windows()["lmtd"] == (date(2000, 2, 1), date(2000, 2, 29))


def test_january_rolls_back_a_year():
    p = Params(date(2001, 1, 10), date(2000, 12, 1))
    assert p.windows()["lmtd"] == (date(2000, 12, 1), date(2000, 12, 9))
    assert p.month_keys == ["2000-10", "2000-11", "2000-12", "2001-01"]
    assert p.months_start == date(2000, 10, 1)
