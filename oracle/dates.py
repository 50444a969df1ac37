"""The dates of the oracle queries, as literals (FIXTURES.md), so that the engine's
own windows are checked and not merely repeated."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date


@dataclass(frozen=True)
class Dates:
    as_of: date = date(2001, 4, 18)
    yesterday: date = date(2001, 4, 17)
    weeks_start: date = date(2001, 1, 1)
    wtd_start: date = date(2001, 4, 16)
    lwtd_start: date = date(2001, 4, 9)
    lwtd_end: date = date(2001, 4, 10)
    mtd: tuple = (date(2001, 4, 1), date(2001, 4, 17))
    lmtd: tuple = (date(2001, 3, 1), date(2001, 3, 17))
    last_month: tuple = (date(2001, 3, 1), date(2001, 3, 31))
    daily: tuple = (date(2001, 3, 4), date(2001, 4, 17))
    month_starts: tuple = (date(2001, 1, 1), date(2001, 2, 1), date(2001, 3, 1), date(2001, 4, 1))
    current_month: str = "2001-04"
    previous_month: str = "2001-03"
    #: Closed weeks of the pivot, by their Mondays.
    pivot_weeks: tuple = field(default=(
        "2001-01-01", "2001-01-08", "2001-01-15", "2001-01-22", "2001-01-29", "2001-02-05", "2001-02-12", "2001-02-19",
        "2001-02-26", "2001-03-05", "2001-03-12", "2001-03-19", "2001-03-26", "2001-04-02", "2001-04-09"))

    @property
    def months_start(self) -> date:
        return self.month_starts[0]

    @property
    def last_month_start(self) -> date:
        return self.last_month[0]

    @property
    def last_month_end(self) -> date:
        return self.last_month[1]

    @property
    def daily_start(self) -> date:
        return self.daily[0]

    @property
    def daily_end(self) -> date:
        return self.daily[1]

    def windows(self) -> dict:
        return {"wtd": (self.wtd_start, self.yesterday), "lwtd": (self.lwtd_start, self.lwtd_end), "mtd": self.mtd,
                "lmtd": self.lmtd, "last_month": self.last_month, "daily": self.daily}


FIXTURE = Dates()
#: The fixture with a weeks_start on a Wednesday; the first pivot column is its Monday.
MIDWEEK = Dates(weeks_start=date(2001, 1, 3))
#: Every week of the orders' years before, on the same as_of.
WIDE = Dates(weeks_start=date(1995, 1, 2))
#: A Monday: the week to date is empty, the month to date ends on the 22nd.
MONDAY = Dates(as_of=date(2001, 4, 23), yesterday=date(2001, 4, 22), wtd_start=date(2001, 4, 23), lwtd_start=date(2001, 4, 16),
               lwtd_end=date(2001, 4, 15), mtd=(date(2001, 4, 1), date(2001, 4, 22)), lmtd=(date(2001, 3, 1), date(2001, 3, 22)),
               daily=(date(2001, 3, 9), date(2001, 4, 22)))
#: The first of a month: month to date and its comparison are empty.
FIRST = Dates(as_of=date(2001, 4, 1), yesterday=date(2001, 3, 31), wtd_start=date(2001, 3, 26), lwtd_start=date(2001, 3, 19),
              lwtd_end=date(2001, 3, 24), mtd=(date(2001, 4, 1), date(2001, 3, 31)), lmtd=(date(2001, 3, 1), date(2001, 2, 28)),
              daily=(date(2001, 2, 15), date(2001, 3, 31)))
#: The 31st: the comparison is cut at the shorter month's end.
LAST = Dates(as_of=date(2001, 3, 31), yesterday=date(2001, 3, 30), wtd_start=date(2001, 3, 26), lwtd_start=date(2001, 3, 19),
             lwtd_end=date(2001, 3, 23), mtd=(date(2001, 3, 1), date(2001, 3, 30)), lmtd=(date(2001, 2, 1), date(2001, 2, 28)),
             last_month=(date(2001, 2, 1), date(2001, 2, 28)), daily=(date(2001, 2, 14), date(2001, 3, 30)),
             month_starts=(date(2000, 12, 1), date(2001, 1, 1), date(2001, 2, 1), date(2001, 3, 1)),
             current_month="2001-03", previous_month="2001-02")
