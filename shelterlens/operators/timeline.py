"""Running values over the events of many keys, hot keys cut into time ranges.

A ``Timeline`` writes its events once and counts them per key. An ordinary key is a window partition.
A key with more than 1 / ranges of all rows - there are at most ``ranges`` of them - would make one
long task, so the rows of such keys are sorted by (key, time, ...) into ranges of equal size, wherever that
cuts, also within one month or instant. Inside a range every (range, key) is a window; what it
takes over from the key's other ranges - the last value, a sum so far - is one row per (range, key), at
most two a range and key, which is broadcast with that bound.

Three operators are built on it: the latest earlier row (``asof_ranged``), the next event of a key
(``next_event_ranged``) and interval containment by a sweep line (``cover_counts``), in which an
interval is two signed events however long it is.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelterlens.functions.dates import as_timestamp, day_diff
from shelterlens.operators.joins import deal
from shelterlens.session import materialize


class Timeline:
    """Events in the order of ``by`` and ``order`` with running values (``last``, ``next``, ``total``).

    ``order`` has to tell events apart wherever a running value depends on their order. ``dealt``: the events are dealt
    by ``by`` already and no key is hot (``joins.crowded``), so they are neither counted nor stored nor shuffled.
    """

    def __init__(self, events: DataFrame, by: Sequence[str], order: Sequence[str], ranges: int | None = None,
                 dealt: bool = False):
        spark = events.sparkSession
        self.by, self.order = list(by), list(order)
        if dealt:
            self.plain, self.cut = events, None
            return
        self.ranges = ranges or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
        stored = materialize(events)
        sizes = stored.groupBy(*self.by).count()
        total, most = sizes.agg(F.sum("count"), F.max("count")).first()
        share = max((total or 0) // self.ranges, 1)
        hot = sizes.filter(F.col("count") > share).select(*self.by).collect() if (most or 0) > share else []  # <= ranges
        # as many tasks as keep the sorted windows of each small, however many rows there are
        self.plain, self.cut = deal(stored, self.by, total or 0), None
        if hot:
            keys = F.broadcast(spark.createDataFrame(hot, stored.select(*self.by).schema))
            same = [stored[c].eqNullSafe(keys[c]) for c in self.by]
            self.plain = deal(stored.join(keys, same, "left_anti"), self.by, total)
            # written once, so that every use sees the same ranges
            ranged = (stored.join(keys, same, "left_semi").repartitionByRange(self.ranges, *self.by, *self.order)
                      .withColumn("_range", F.spark_partition_id()))
            self.cut = materialize(ranged).repartitionById(self.ranges, "_range")

    def _with(self, name: str, window, inside: Callable, fold: Column, later: bool, joined: Callable) -> "Timeline":
        """Adds ``inside`` over the window of a key; in a cut key ``joined`` with the folds of its other ranges."""
        out = Timeline.__new__(Timeline)
        out.__dict__.update(self.__dict__)
        out.plain = self.plain.withColumn(name, joined(inside(window(self.by)), None))
        if self.cut is not None:
            direction = F.col("_range").desc() if later else F.col("_range")
            others = Window.partitionBy(*self.by).orderBy(direction).rowsBetween(Window.unboundedPreceding, -1)
            over = (self.cut.groupBy("_range", *self.by).agg(fold.alias("_fold"))
                    .select(F.col("_range").alias("_r"), *[F.col(c).alias(f"_k_{c}") for c in self.by],
                            F.collect_list("_fold").over(others).alias("_over")))
            over = F.broadcast(materialize(over))
            held = self.cut.withColumn("_inside", inside(window(["_range", *self.by])))
            same = [held["_range"] == over["_r"]] + [held[c].eqNullSafe(over[f"_k_{c}"]) for c in self.by]
            out.cut = (held.join(over, same, "left").withColumn(name, joined(F.col("_inside"), F.col("_over")))
                       .select(*self.cut.columns, name))
        return out

    def _latest(self, name: str, value: Column, later: bool) -> "Timeline":
        order = [F.col(c).desc() for c in self.order] if later else self.order
        until = -1 if later else Window.currentRow
        best = (F.min if later else F.max)(F.when(value.isNotNull(), F.struct(*self.order, value.alias("_value"))))

        def window(keys):
            return Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, until)

        def joined(inside, over):
            return inside if over is None else F.coalesce(inside, F.get(over, F.size(over) - 1)["_value"])
        return self._with(name, window, lambda w: F.last(value, ignorenulls=True).over(w), best, later, joined)

    def last(self, name: str, value: Column) -> "Timeline":
        """Adds the latest value that is not null, at each event or before it."""
        return self._latest(name, value, later=False)

    def next(self, name: str, value: Column) -> "Timeline":
        """Adds the first value that is not null after each event."""
        return self._latest(name, value, later=True)

    def total(self, name: str, value: Column) -> "Timeline":
        """Adds the sum of the values of each event and those before it."""
        def window(keys):
            return Window.partitionBy(*keys).orderBy(*self.order).rowsBetween(Window.unboundedPreceding, Window.currentRow)

        def joined(inside, over):
            if over is None:
                return inside
            return inside + F.aggregate(F.coalesce(over, F.array().cast("array<bigint>")), F.lit(0).cast("bigint"),
                                        lambda a, x: a + x)
        return self._with(name, window, lambda w: F.coalesce(F.sum(value).over(w), F.lit(0)), F.sum(value), False, joined)

    def rows(self, *columns: str) -> DataFrame:
        names = list(columns) or self.plain.columns
        out = self.plain.select(*names)
        return out if self.cut is None else out.unionByName(self.cut.select(*names))


def _tie(df: DataFrame) -> Column:
    """Tells rows of one time apart, so that many of them can lie in several ranges."""
    return F.xxhash64(*[F.col(c) for c in df.columns])


def asof_ranged(left: DataFrame, right: DataFrame, by: Sequence[str], left_ts: str, right_ts: str,
                right_cols: Sequence[str], strict: bool = True, ranges: int | None = None) -> DataFrame:
    """Each left row with the latest right row of its key before it (``strict``: not at its time).

    Ties in time go to the largest ``right_cols``. Left rows without a key or time find nothing.
    """
    keys = list(by)
    found = F.struct(F.col(right_ts).alias(right_ts), *[F.col(c) for c in right_cols])
    queries = left.select(*keys, F.col(left_ts).alias("_t"), F.lit(1 if strict else 2).alias("_kind"),
                          F.struct(*[F.col(c) for c in left.columns]).alias("_left"), _tie(left).alias("_tie"))
    events = right.select(*keys, F.col(right_ts).alias("_t"), F.lit(2 if strict else 1).alias("_kind"), found.alias("_right"))
    events = events.filter(" and ".join(f"`{c}` is not null" for c in [*keys, "_t"]))
    line = Timeline(queries.unionByName(events, allowMissingColumns=True), keys, ["_t", "_kind", "_right", "_tie"], ranges)
    out = line.last("_found", F.col("_right")).rows("_left", "_found").filter("_left is not null")
    named = [c for c in dict.fromkeys([right_ts, *right_cols])]
    return out.select("_left.*", *[F.col(f"_found.{c}").alias(c) for c in named])


def next_event_ranged(df: DataFrame, by: Sequence[str], ts: str, name: str, tie_break: Sequence[str] = (),
                      ranges: int | None = None) -> DataFrame:
    """Day boundaries from each event to the next one of its key (by time, then ``tie_break``);
    null for the last event."""
    events = df.withColumn("_tie", _tie(df))
    line = Timeline(events, by, [ts, *tie_break, "_tie"], ranges).next("_next", F.col(ts))
    return line.rows().withColumn(name, day_diff(F.col(ts), F.col("_next"))).drop("_next", "_tie")


def cover_counts(points: DataFrame, intervals: DataFrame, by: Sequence[str], point_ts: str, start: str, end: str,
                 name: str = "n_intervals", ranges: int | None = None) -> DataFrame:
    """The number of intervals of its key that each point lies in, ``start < ts < end``.

    Sweep line: a start adds one after its time, an end takes one away before it, and the running
    sum at a point is what covers it. An interval is two events however long it is; an interval
    without a start or end, or whose end is not after its start, holds nothing.
    """
    keys = list(by)
    held = intervals.select(*keys, as_timestamp(start).alias("_s"), as_timestamp(end).alias("_e")).filter("_s < _e")
    signed = (held.select(*keys, F.col("_s").alias("_t"), F.lit(2).alias("_kind"), F.lit(1).alias("_sign"))
              .unionByName(held.select(*keys, F.col("_e").alias("_t"), F.lit(0).alias("_kind"), F.lit(-1).alias("_sign"))))
    asked = points.select(*keys, F.col(point_ts).alias("_t"), F.lit(1).alias("_kind"), F.lit(0).alias("_sign"),
                          F.struct(*[F.col(c) for c in points.columns]).alias("_point"), _tie(points).alias("_tie"))
    events = asked.unionByName(signed, allowMissingColumns=True)
    line = Timeline(events, keys, ["_t", "_kind", "_tie"], ranges).total("_cover", F.col("_sign"))
    known = " and ".join(f"`{c}` is not null" for c in [*keys, "_t"])
    return (line.rows(*keys, "_t", "_point", "_cover").filter("_point is not null")
            .select("_point.*", F.when(F.expr(known), F.col("_cover")).otherwise(0).cast("bigint").alias(name)))


def islands(intervals: DataFrame, by: Sequence[str], start: str, end: str) -> DataFrame:
    """(by, start, end): the intervals of each key joined where they overlap (``start < ts < end`` each).

    Intervals that only touch stay apart: the time between them is in neither. For keys with few
    intervals each, such as the stays of an animal that end in one month.
    """
    w = Window.partitionBy(*by).orderBy(start, end)
    before = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    held = intervals.select(*by, start, end).filter(F.col(start) < F.col(end)).distinct()
    opened = held.withColumn("_new", F.when(before.isNull() | (F.col(start) >= before), 1).otherwise(0))
    numbered = opened.withColumn("_island", F.sum("_new").over(w))
    return (numbered.groupBy(*by, "_island").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("_island"))
