"""Run parameters used by the registered benchmark queries.

The benchmark orders span 1995-01 to 2001-08 (ship dates to 2001-11), so a run
as of mid-December 2001 starting in 1995 covers every month that holds data.
"""

import datetime as _dt

from shelterlens.operators.spine import MonthSpine

AS_OF = _dt.date(2001, 12, 15)
START_YEAR = 1995
END_YEAR = 2001
SPINE = MonthSpine.for_run(START_YEAR, END_YEAR, AS_OF)
# P11 window for AS_OF: [first of month - 13 months, first of month)
TRAILING_START = _dt.date(2000, 11, 1)
TRAILING_END = _dt.date(2001, 12, 1)
# Look-back start of the wait-time as-of join (the report's own default is 2019-01-01).
WAIT_HISTORY_START = _dt.date(1995, 1, 1)
# Look-back start of the kitten cohort (the report's own default is 2017-01-01).
KITTEN_START = _dt.date(1995, 1, 1)
# Kitten mortality run: births in the data fall around 1995, so the percent table
# is reported as of January 1996 (the January rule then yields the months of 1995).
KITTEN_AS_OF = _dt.date(1996, 1, 15)
KITTEN_SPINE = MonthSpine.for_run(1995, 1996, KITTEN_AS_OF)
