"""Date arithmetic as Spark column expressions (no UDFs).

The reports count calendar boundaries, not elapsed time:

* ``day_diff(a, b)``  - midnights crossed from ``a`` to ``b`` (both cast to date).
* ``week_diff(a, b)`` - Sundays crossed from ``a`` to ``b``: a Saturday -> Sunday step
  is one week, a Sunday -> Saturday step is zero weeks.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a Sunday, used as the origin of the week count.
SUNDAY_ORIGIN = "1970-01-04"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lit_date(d) -> Column:
    """Date literal from ``datetime.date`` or ISO text."""
    if isinstance(d, str):
        d = _dt.date.fromisoformat(d)
    return F.lit(d)


def day_diff(start, end) -> Column:
    """Day boundaries crossed from ``start`` to ``end`` (may be negative)."""
    return F.datediff(F.to_date(_col(end)), F.to_date(_col(start)))


def sunday_week_number(d) -> Column:
    """Index of the Sunday-started week holding ``d``."""
    return F.floor(F.datediff(F.to_date(_col(d)), F.lit(SUNDAY_ORIGIN).cast("date")) / F.lit(7))


def week_diff(start, end) -> Column:
    """Sunday boundaries crossed from ``start`` to ``end``."""
    return sunday_week_number(end) - sunday_week_number(start)


def month_start(d) -> Column:
    """First day of the month of ``d`` as DATE."""
    return F.trunc(F.to_date(_col(d)), "MM")


def eomonth(d) -> Column:
    """Last day of the month of ``d`` as DATE (compares as 00:00 of that day)."""
    return F.last_day(F.to_date(_col(d)))


def month_end_midnight(d) -> Column:
    """Timestamp of 00:00 on the last day of the month of ``d``."""
    return F.to_timestamp_ntz(eomonth(d))


def next_month_start(d) -> Column:
    return F.add_months(month_start(d), 1)


def as_timestamp(d) -> Column:
    """DATE -> zone-less timestamp at 00:00."""
    return F.to_timestamp_ntz(F.to_date(_col(d)))


def month_label(d, fmt: str = "MMM") -> Column:
    """Month label such as ``Jan`` or ``Jan-2024``."""
    return F.date_format(_col(d), fmt)


def first_month_start_on_or_after(ts) -> Column:
    """Smallest month start (as DATE) that is >= ``ts``."""
    c = _col(ts)
    ms = month_start(c)
    return F.when(as_timestamp(ms) >= c, ms).otherwise(F.add_months(ms, 1))


def last_month_start_before(ts) -> Column:
    """Largest month start (as DATE) that is < ``ts``."""
    c = _col(ts)
    ms = month_start(c)
    return F.when(as_timestamp(ms) < c, ms).otherwise(F.add_months(ms, -1))


def last_month_start_on_or_before(ts) -> Column:
    """Largest month start (as DATE) that is <= ``ts``."""
    return month_start(_col(ts))


def ntz_micros(ts) -> Column:
    """Microseconds since 1970-01-01 00:00 of a zone-less timestamp, independent of the
    session time zone (no detour through an instant-based timestamp)."""
    c = _col(ts)
    day_us = F.unix_date(F.to_date(c)).cast("long") * F.lit(86_400_000_000)
    clock_us = (F.hour(c).cast("long") * F.lit(3_600_000_000) + F.minute(c).cast("long") * F.lit(60_000_000)
                + (F.date_part(F.lit("SECOND"), c) * F.lit(1_000_000)).cast("long"))
    return day_us + clock_us
