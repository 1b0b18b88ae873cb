"""Date windows as Column expressions (no driver-side date loops).

The original jobs compute their weekly windows from ``date.today()``. Here
the reference day ``as_of`` is explicit, and windows never run past it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# variant -> days from as_of back to the window's first day, added to the
# weekday (Monday = 0): KPI uses Monday-Sunday of last week, eNB coverage starts
# on the Saturday before this week's Monday, gNB coverage on the Sunday before.
WEEK_START_OFFSET = {"kpi": 7, "enb": 2, "gnb": 1}


def _day(as_of) -> Column:
    if isinstance(as_of, Column):
        return as_of.cast("date")
    if isinstance(as_of, (dt.date, dt.datetime)):
        return F.lit(as_of.strftime("%Y-%m-%d")).cast("date")
    return F.to_date(F.lit(str(as_of)))


def day_str(d) -> Column:
    """``yyyyMMdd`` text of a date or timestamp column."""
    c = F.col(d) if isinstance(d, str) else d
    return F.date_format(c, "yyyyMMdd")


def weekly_window(as_of, variant: str = "kpi") -> Column:
    """Array of the (up to) seven dates of a job's weekly window, cut at as_of."""
    if variant not in WEEK_START_OFFSET:
        raise ValueError(f"variant must be one of {sorted(WEEK_START_OFFSET)}")
    d = _day(as_of)
    start = F.date_sub(d, F.weekday(d) + WEEK_START_OFFSET[variant])
    end = F.least(F.date_add(start, 6), d)
    return F.sequence(start, end, F.expr("INTERVAL 1 DAY"))


def trailing_days(as_of, n: int) -> Column:
    """Array of the ``n`` dates ending at (and including) as_of."""
    d = _day(as_of)
    return F.sequence(F.date_sub(d, n - 1), d, F.expr("INTERVAL 1 DAY"))


def window_bounds(as_of, variant: str = "kpi") -> tuple[str, str]:
    """First and last ``yyyyMMdd`` day of a weekly window, computed locally.

    For building scan paths and output stamps before any Spark job runs.
    """
    d = as_of if isinstance(as_of, dt.date) else dt.date.fromisoformat(str(as_of))
    start = d - dt.timedelta(days=d.weekday() + WEEK_START_OFFSET[variant])
    end = min(start + dt.timedelta(days=6), d)
    return start.strftime("%Y%m%d"), end.strftime("%Y%m%d")
