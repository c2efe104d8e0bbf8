import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelterlens.functions.dates import day_diff, week_diff
from week_reference import python_week_diff
from shelterlens.operators.spine import MonthSpine, report_months

dates = st.dates(min_value=dt.date(1900, 1, 1), max_value=dt.date(2100, 12, 31))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(dates, dates), min_size=1, max_size=30))
def test_week_diff_counts_sundays(spark, pairs):
    df = spark.createDataFrame(pairs, "a date, b date")
    got = [r.w for r in df.select(week_diff("a", "b").alias("w")).collect()]
    assert got == [python_week_diff(a, b) for a, b in pairs]


def test_week_diff_fixed_rows(spark):
    rows = [(dt.date(2024, 1, 6), dt.date(2024, 1, 7), 1),   # Sat -> Sun
            (dt.date(2024, 1, 7), dt.date(2024, 1, 13), 0),  # Sun -> Sat
            (dt.date(1969, 12, 27), dt.date(1970, 1, 4), 2),  # before 1970
            (dt.date(2024, 2, 29), dt.date(2023, 2, 28), -52)]  # Thu -> Tue a year back
    df = spark.createDataFrame([r[:2] for r in rows], "a date, b date")
    got = [r.w for r in df.select(week_diff("a", "b").alias("w")).collect()]
    assert got == [r[2] for r in rows]


def test_day_diff_counts_midnights(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 23, 59), dt.datetime(2024, 1, 2, 0, 1))],
                               "a timestamp_ntz, b timestamp_ntz")
    assert df.select(day_diff("a", "b").alias("d")).first().d == 1


def _loop_rule(start_year, end_year, today):
    out = []
    for year in range(start_year, end_year + 1):
        if year > today.year:
            break
        for month in range(1, 13):
            if year == today.year and month > today.month:
                break
            if today.month == 1 and year == today.year:
                out.extend(dt.date(year - 1, m, 1) for m in range(1, 13))
                break
            out.append(dt.date(year, month, 1))
    return out


@settings(max_examples=60, deadline=None)
@given(st.integers(2015, 2026), st.integers(0, 3), st.dates(dt.date(2015, 1, 1), dt.date(2027, 12, 31)))
def test_report_months_follow_loop_rule(start, span, today):
    assert report_months(start, start + span, today) == _loop_rule(start, start + span, today)


def test_spine_frame_is_a_set(spark):
    spine = MonthSpine.for_run(2023, 2024, dt.date(2024, 1, 20))  # January rule repeats 2023
    got = [r.reference_date for r in spine.frame(spark).orderBy("reference_date").collect()]
    assert got == [dt.date(2023, m, 1) for m in range(1, 13)]
    assert spine.contiguous
    assert spine.frame(spark).where(F.col("reference_date").isNull()).count() == 0


def test_ntz_micros_ignores_session_zone(spark):
    from shelterlens.functions.dates import ntz_micros
    rows = [(dt.datetime(2024, 3, 10, 2, 30, 0, 123456),),   # inside a US DST gap
            (dt.datetime(1969, 12, 31, 23, 59, 59, 999999),), (dt.datetime(2001, 11, 4, 1, 30),)]
    df = spark.createDataFrame(rows, "t timestamp_ntz")
    epoch = dt.datetime(1970, 1, 1)
    want = [((r[0] - epoch) // dt.timedelta(microseconds=1)) for r in rows]
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            assert [r.u for r in df.select(ntz_micros("t").alias("u")).collect()] == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
