"""Report parameters: one ``as_of`` date and the derived period windows.

Only dates live on the driver; the data never does. Every window is a closed
range ``[lo, hi]`` of DATEs; an empty window has ``hi < lo``.
"""

from __future__ import annotations

import calendar
from dataclasses import dataclass
from datetime import date, timedelta


def monday_of(d: date) -> date:
    return d - timedelta(days=d.weekday())


def first_of_month(d: date) -> date:
    return d.replace(day=1)


def add_months(d: date, n: int) -> date:
    """First day of the month ``n`` months after the month of ``d``."""
    m = d.year * 12 + (d.month - 1) + n
    return date(m // 12, m % 12 + 1, 1)


def last_day_of_month(d: date) -> date:
    return d.replace(day=calendar.monthrange(d.year, d.month)[1])


@dataclass(frozen=True)
class Params:
    """``as_of`` is "today": reports read complete days before it.

    ``weeks_start`` bounds the weekly series from below. The monthly series
    covers the calendar month of ``as_of`` and the three before it; its start
    is derived from that list, not a parameter (survey Q24).
    """

    as_of: date
    weeks_start: date

    # -- day and week windows ------------------------------------------------
    @property
    def yesterday(self) -> date:
        return self.as_of - timedelta(days=1)

    @property
    def wtd_start(self) -> date:
        return monday_of(self.as_of)

    @property
    def wtd_end(self) -> date:
        return self.yesterday

    @property
    def lwtd_start(self) -> date:
        return self.wtd_start - timedelta(days=7)

    @property
    def lwtd_end(self) -> date:
        return self.wtd_end - timedelta(days=7)

    @property
    def wtd_empty(self) -> bool:
        return self.wtd_end < self.wtd_start

    # -- month windows (KPI rule, also used by the funnel, see Q12/Q13) -------
    @property
    def mtd_start(self) -> date:
        return first_of_month(self.as_of)

    @property
    def mtd_end(self) -> date:
        return self.yesterday

    @property
    def lmtd_start(self) -> date:
        return add_months(self.as_of, -1)

    @property
    def lmtd_end(self) -> date:
        """Same day number as ``mtd_end``, clamped to the month end.

        On the 1st, MTD is empty and so is LMTD.
        """
        if self.mtd_end < self.mtd_start:
            return self.lmtd_start - timedelta(days=1)
        last = last_day_of_month(self.lmtd_start)
        return min(self.lmtd_start.replace(day=min(self.mtd_end.day, last.day)), last)

    @property
    def last_month_start(self) -> date:
        return add_months(self.as_of, -1)

    @property
    def last_month_end(self) -> date:
        return self.mtd_start - timedelta(days=1)

    @property
    def daily_start(self) -> date:
        return self.as_of - timedelta(days=45)

    @property
    def daily_end(self) -> date:
        return self.yesterday

    # -- monthly series: the month of as_of and the three before it ----------
    @property
    def month_starts(self) -> list[date]:
        return [add_months(self.as_of, k) for k in (-3, -2, -1, 0)]

    @property
    def month_keys(self) -> list[str]:
        return [m.strftime("%Y-%m") for m in self.month_starts]

    @property
    def months_start(self) -> date:
        return self.month_starts[0]

    @property
    def current_month(self) -> str:
        return self.as_of.strftime("%Y-%m")

    @property
    def previous_month(self) -> str:
        return add_months(self.as_of, -1).strftime("%Y-%m")

    def windows(self) -> dict[str, tuple[date, date]]:
        return {
            "wtd": (self.wtd_start, self.wtd_end),
            "lwtd": (self.lwtd_start, self.lwtd_end),
            "mtd": (self.mtd_start, self.mtd_end),
            "lmtd": (self.lmtd_start, self.lmtd_end),
            "last_month": (self.last_month_start, self.last_month_end),
            "daily": (self.daily_start, self.daily_end),
        }


# The fixture parameters (FIXTURES.md): a Wednesday.
FIXTURE_PARAMS = Params(as_of=date(2001, 4, 18), weeks_start=date(2001, 1, 1))
