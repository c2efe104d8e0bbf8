"""Plain-Python week difference that the Spark function is held against."""
import datetime as dt


def python_week_diff(a: dt.date, b: dt.date) -> int:
    origin = dt.date(1970, 1, 4)
    return ((b - origin).days // 7) - ((a - origin).days // 7)
