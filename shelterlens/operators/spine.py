"""Report months: the month spine, month assignment and month-window filters.

The reference runs one query per month. Here the month list is computed from the
run arguments (a handful of values, never data) and every fact row is given the
months it belongs to with a bounded ``explode`` - no range join against the spine.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelterlens.functions.dates import as_timestamp, lit_date, month_start


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _add_months(d: _dt.date, n: int) -> _dt.date:
    y, m = divmod(d.year * 12 + (d.month - 1) + n, 12)
    return _dt.date(y, m + 1, 1)


def report_months(start_year: int, end_year: int, as_of: _dt.date) -> list[_dt.date]:
    """Month starts a run covers, in run order.

    Years after ``as_of`` are skipped, months after the as-of month are skipped;
    in a January run the as-of year yields the twelve months of the previous
    year instead (which can repeat months an earlier year already gave; the
    spine is used as a set, see ``month_spine``).
    """
    out: list[_dt.date] = []
    for year in range(start_year, end_year + 1):
        if year > as_of.year:
            break
        if as_of.month == 1 and year == as_of.year:
            out.extend(_dt.date(year - 1, m, 1) for m in range(1, 13))
            continue
        for month in range(1, 13):
            if year == as_of.year and month > as_of.month:
                break
            out.append(_dt.date(year, month, 1))
    return out


class MonthSpine:
    """The set of report months of a run plus its bounds (plain Python values).

    ``first``/``last`` go into filters as literals so that parquet / JDBC scans
    prune rows before any shuffle.
    """

    def __init__(self, months: Sequence[_dt.date]):
        ms = sorted(set(months))
        if not ms:
            raise ValueError("empty month spine")
        self.months = ms
        self.first = ms[0]
        self.last = ms[-1]
        self.contiguous = len(ms) == (self.last.year * 12 + self.last.month
                                      - self.first.year * 12 - self.first.month + 1)

    @classmethod
    def for_run(cls, start_year: int, end_year: int, as_of: _dt.date) -> "MonthSpine":
        return cls(report_months(start_year, end_year, as_of))

    @classmethod
    def between(cls, first: _dt.date, last: _dt.date) -> "MonthSpine":
        out, d = [], _dt.date(first.year, first.month, 1)
        while d <= last:
            out.append(d)
            d = _add_months(d, 1)
        return cls(out)

    def trailing(self, as_of: _dt.date, n: int = 13) -> "MonthSpine | None":
        """The report months inside the trailing window of P11 (none: no such month)."""
        end = _dt.date(as_of.year, as_of.month, 1)
        kept = [d for d in self.months if _add_months(end, -n) <= d < end]
        return MonthSpine(kept) if kept else None

    def in_spine(self, month_col) -> Column:
        """Predicate: month (a month-start DATE) is a report month."""
        c = _col(month_col)
        if self.contiguous:
            return c.between(lit_date(self.first), lit_date(self.last))
        return c.isin(self.months)

    def frame(self, spark: SparkSession, name: str = "reference_date") -> DataFrame:
        """The spine as a one-column DataFrame (bounded by the run arguments)."""
        return (spark.range(1)
                .select(F.explode(F.sequence(lit_date(self.first), lit_date(self.last),
                                             F.expr("INTERVAL 1 MONTH"))).alias(name))
                .where(self.in_spine(name)))


def month_spine(spark: SparkSession, start_year: int, end_year: int, as_of: _dt.date,
                name: str = "reference_date") -> DataFrame:
    """DataFrame of report months."""
    return MonthSpine.for_run(start_year, end_year, as_of).frame(spark, name)


def months_between_cols(first_month, last_month) -> Column:
    """Array of month starts from ``first_month`` to ``last_month`` (DATEs).

    Empty when ``last_month < first_month``; callers bound the span so the
    explode stays linear (a few months per row).
    """
    f, l = _col(first_month), _col(last_month)
    return F.when(l >= f, F.sequence(f, l, F.expr("INTERVAL 1 MONTH"))).otherwise(
        F.array().cast("array<date>"))


def explode_months(df: DataFrame, first_month, last_month, spine: MonthSpine,
                   name: str = "reference_date") -> DataFrame:
    """Give every row each report month in ``[first_month, last_month]``.

    Bounds are clipped to the spine first, so the fan-out per row is at most the
    number of months the rule allows (12-13 for a one-year look-back).
    """
    lo = F.greatest(_col(first_month), lit_date(spine.first))
    hi = F.least(_col(last_month), lit_date(spine.last))
    out = df.withColumn(name, F.explode(months_between_cols(lo, hi)))
    if not spine.contiguous:
        out = out.where(spine.in_spine(name))
    return out


def trailing_months(df: DataFrame, date_col, as_of: _dt.date, n: int = 13) -> DataFrame:
    """Rows with ``date`` in ``[first of as-of month - n months, first of as-of month)``."""
    end = _dt.date(as_of.year, as_of.month, 1)
    start = _add_months(end, -n)
    c = _col(date_col)
    return df.where((c >= as_timestamp(lit_date(start))) & (c < as_timestamp(lit_date(end))))


def current_year(df: DataFrame, date_col, as_of: _dt.date) -> DataFrame:
    """Rows with ``date`` in the calendar year of ``as_of``."""
    c = _col(date_col)
    start = _dt.date(as_of.year, 1, 1)
    end = _dt.date(as_of.year + 1, 1, 1)
    return df.where((c >= as_timestamp(lit_date(start))) & (c < as_timestamp(lit_date(end))))


def observed_month_range(df: DataFrame, month_col, name: str = "month") -> DataFrame:
    """D10 over A11: every month start in ``[min(month), max(month)]`` of ``df``.

    One aggregate row, exploded - the result is bounded by the spine length.
    """
    c = _col(month_col)
    bounds = df.agg(F.min(c).alias("_lo"), F.max(c).alias("_hi"))
    return bounds.select(F.explode(months_between_cols(month_start("_lo"), F.col("_hi"))).alias(name))


def fill_missing_months(observed: DataFrame, month_col: str, months: DataFrame,
                        grid: Sequence[dict], fill: dict) -> DataFrame:
    """Rows to add for (month, grid cell) pairs with no observed row.

    ``months`` holds the month column to densify over, ``grid`` the fixed group
    cells (list of ``{column: value}``), ``fill`` constant columns for the new
    rows. ``observed`` holds the rows whose presence counts. The grid is a literal
    array exploded per month (no join); presence is a left-anti equi-join.
    """
    keys = list(grid[0].keys())
    cells = F.array(*[F.struct(*[F.lit(cell[k]).alias(k) for k in keys]) for cell in grid])
    candidates = (months.select(F.col(month_col), F.explode(cells).alias("_cell"))
                  .select(month_col, *[F.col("_cell." + k).alias(k) for k in keys]))
    present = observed.select(month_col, *keys).distinct()
    missing = candidates.join(present, [month_col] + keys, "left_anti")
    for k, v in fill.items():
        missing = missing.withColumn(k, v if isinstance(v, Column) else F.lit(v))
    return missing


DOMAIN_BOUND = 10_000       # most values of one report dimension
GRID_BOUND = 1_000_000      # most cells of a product of dimensions


def domain(df: DataFrame, column: str, bound: int = DOMAIN_BOUND) -> list:
    """A11 as a checked domain: the distinct non-null values of a report dimension, in order.

    At most ``bound`` of them come to the driver; more raise, since the column is no report dimension then.
    """
    c = F.col(column)
    values = [r[0] for r in df.where(c.isNotNull()).select(c).distinct().limit(bound + 1).collect()]
    if len(values) > bound:
        raise ValueError(f"{column}: more than {bound} values, no report dimension")
    return sorted(values)


def product_of(spark: SparkSession, domains: dict, types: dict, bound: int = GRID_BOUND) -> DataFrame:
    """Product of checked domains ``{column: values}`` as literal arrays, exploded one
    after another (as in G1), so there is no join at all; ``types``: the columns' data types."""
    cells = 1
    for values in domains.values():
        cells *= len(values)
    if cells > bound:
        raise ValueError(f"a grid of {cells} cells is over the bound of {bound}")
    out = spark.range(1).select()
    for name, values in domains.items():
        kind = types[name].simpleString()
        held = F.array(*[F.lit(v).cast(kind) for v in values]) if values else F.array().cast(f"array<{kind}>")
        out = out.select("*", F.explode(held).alias(name))
    return out


def observed_grid(df: DataFrame, cols: Sequence[str], bound: int = DOMAIN_BOUND) -> DataFrame:
    """Product of the observed values of ``cols`` (report dimensions: groups, categories, months)."""
    return product_of(df.sparkSession, {c: domain(df, c, bound) for c in cols},
                      {c: df.schema[c].dataType for c in cols})
