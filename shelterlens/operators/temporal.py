"""Ordered-event operators (J7, J8, J9, W2, W4) without pair explosion.

The reference writes these as theta joins (``b.ts > a.ts AND DATEDIFF(...)``),
which emit every pair of events per animal. Here each one is a combining
aggregate plus equi-joins on (key, day) or (key, bucket), so the output and the
shuffle stay linear in the input even for a key holding a third of the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelterlens.functions.dates import day_diff
from shelterlens.operators.joins import NARROW_ROWS, deal, join_large


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def exists_prior_within_days(targets: DataFrame, sources: DataFrame, by: Sequence[str], target_ts: str,
                             source_ts: str, lo: int, hi: int, rows: int | None = None) -> DataFrame:
    """Target rows with a source row of the same key ``lo..hi`` day boundaries
    earlier and strictly earlier in time (semi join; for short windows).

    Sources are first reduced to one row per (key, day) holding the earliest
    time, then offset by each allowed day difference (``hi - lo + 1`` rows) and
    equi-joined on (key, day). ``rows``: about how many rows a side has, where that is known.
    """
    if hi < lo:
        raise ValueError("empty window")
    if hi - lo > SHORT_WINDOW_DAYS:
        return _exists_in_long_window(targets, sources, by, target_ts, source_ts, lo, hi)
    per_day = (sources.groupBy(*by, F.to_date(source_ts).alias("_sday"))
               .agg(F.min(source_ts).alias("_sfirst")))
    shifted = (per_day.withColumn("_k", F.explode(F.sequence(F.lit(lo), F.lit(hi))))
               .select(*[F.col(c).alias("_s_" + c) for c in by],
                       F.date_add("_sday", F.col("_k")).alias("_tday"), "_k", "_sfirst"))
    t = targets.withColumn("_tday", F.to_date(target_ts))
    if rows is not None:
        t = deal(t, [*by, "_tday"], rows, joined=True)
        shifted = deal(shifted, [*["_s_" + c for c in by], "_tday"], rows, joined=True)
    cond = [t[c] == shifted["_s_" + c] for c in by] + [t["_tday"] == shifted["_tday"]]
    residual = (shifted["_k"] >= 1) | (shifted["_sfirst"] < t[target_ts])
    cond_all = cond[0]
    for c in cond[1:]:
        cond_all = cond_all & c
    return join_large(t, shifted, cond_all & residual, "left_semi").drop("_tday")


SHORT_WINDOW_DAYS = 62   # up to here each source day is offset; longer windows look up the latest day


def _exists_in_long_window(targets: DataFrame, sources: DataFrame, by: Sequence[str], target_ts: str,
                           source_ts: str, lo: int, hi: int) -> DataFrame:
    """``exists_prior_within_days`` for any window: the latest source day at or before the
    window's end is in the window iff any source day is; one row per (key, target time) is
    looked up. A window from day 0 on also holds an earlier source of the same day."""
    from shelterlens.functions.dates import as_timestamp
    keys = [*by, target_ts]
    asked = targets.select(*keys).distinct().withColumn(
        "_until", as_timestamp(F.date_sub(F.to_date(target_ts), max(lo, 1) - 1)))
    days = sources.select(*by, as_timestamp(F.to_date(source_ts)).alias("_day")).distinct()
    found = (asof_backward_bucketed(asked, days, by, "_until", "_day", [])
             .where(F.datediff(F.to_date(target_ts), F.to_date("_day")) <= hi).select(*keys))
    if lo <= 0:
        same = (sources.groupBy(*by, F.to_date(source_ts).alias("_sd")).agg(F.min(source_ts).alias("_sf"))
                .withColumnRenamed("_sd", "_td"))
        found = found.union(asked.withColumn("_td", F.to_date(target_ts)).join(same, [*by, "_td"], "inner")
                            .where(F.col("_sf") < F.col(target_ts)).select(*keys)).distinct()
    return targets.join(found, keys, "left_semi")


def asof_backward(left: DataFrame, right: DataFrame, by: Sequence[str], left_ts: str, right_ts: str,
                  right_cols: Sequence[str], strict: bool = True, partition_extra: Sequence[str] = (),
                  left_id: Sequence[str] | None = None) -> DataFrame:
    """Attach to each left row the latest right row of the same key
    before it (``right_ts < left_ts`` when strict, ``<=`` otherwise).

    Union of both sides sorted per key; ``last(..., ignorenulls)`` over a running
    frame carries the latest right row forward. ``partition_extra`` splits a key
    further (e.g. by month, with right rows replicated into the buckets they
    can serve) so no single window partition holds a hot key's whole history.
    Ties on the right side are broken by ``right_cols`` order (largest last).
    """
    keys = list(by) + list(partition_extra)
    lcols = [c for c in left.columns]
    l = left.select(*[F.col(c) for c in lcols],
                    F.col(left_ts).alias("_t"), F.lit(1 if strict else 2).alias("_kind"))
    r = right.select(*[F.col(c) for c in keys],
                     *[F.col(c).alias("_r_" + c) for c in right_cols],
                     F.col(right_ts).alias("_t"), F.lit(2 if strict else 1).alias("_kind"),
                     F.lit(True).alias("_is_r"))
    u = l.unionByName(r, allowMissingColumns=True)
    w = (Window.partitionBy(*keys)
         .orderBy(F.col("_t"), F.col("_kind"), *[F.col("_r_" + c).asc_nulls_first() for c in right_cols])
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # carry the struct of right values as one unit so all columns come from the same row
    carried = F.last(F.when(F.col("_is_r"), F.struct(*[F.col("_r_" + c).alias(c) for c in right_cols])),
                     ignorenulls=True).over(w)
    out = u.withColumn("_m", carried).where(F.col("_is_r").isNull())
    return out.select(*lcols, *[F.col("_m." + c).alias(c) for c in right_cols])


def next_event_days(df: DataFrame, by: Sequence[str], ts: str, name: str,
                    tie_break: Sequence[str] = ()) -> DataFrame:
    """Day boundaries from each event to the next event of the same key
    (ordered by time, then ``tie_break``); NULL for the last event.

    Two levels so that no window partition holds a key's whole history: ``lead``
    inside (key, month) partitions, and for the last event of a month the first
    event of the key's next month, from one row per (key, month) and a ``lead``
    over those rows (a partition of at most one row per month).
    """
    d = next_event_time(df, by, ts, "_next_event", tie_break)
    return d.withColumn(name, day_diff(F.col(ts), F.col("_next_event"))).drop("_next_event")


def next_event_time(df: DataFrame, by: Sequence[str], ts: str, name: str, tie_break: Sequence[str] = ()) -> DataFrame:
    """Time of the next event of the same key (see ``next_event_days``)."""
    from shelterlens.functions.dates import month_start
    keys = list(by)
    order = [F.col(ts)] + [F.col(c) for c in tie_break]
    d = df.withColumn("_nb", month_start(ts))
    w_in = Window.partitionBy(*keys, "_nb").orderBy(*order)
    d = d.withColumn("_next", F.lead(ts).over(w_in))
    firsts = d.groupBy(*keys, "_nb").agg(F.min(ts).alias("_first"))
    w_m = Window.partitionBy(*keys).orderBy("_nb")
    firsts = firsts.select(*keys, "_nb", F.lead("_first").over(w_m).alias("_next_month_first"))
    d = d.join(firsts, keys + ["_nb"], "left")
    nxt = F.coalesce(F.col("_next"), F.col("_next_month_first"))
    return d.withColumn(name, nxt).drop("_nb", "_next", "_next_month_first")


def running_total_before(df: DataFrame, by: Sequence[str], ts: str, value: str, name: str,
                         tie_break: Sequence[str] = ()) -> DataFrame:
    """Sum of ``value`` over the earlier events of the same key (ordered by time, then ``tie_break``).

    Two levels like ``next_event_days``: inside (key, month), and over one row per month of a key.
    """
    from shelterlens.functions.dates import month_start
    keys = list(by)
    d = df.withColumn("_nb", month_start(ts))
    w_in = (Window.partitionBy(*keys, "_nb").orderBy(F.col(ts), *[F.col(c) for c in tie_break])
            .rowsBetween(Window.unboundedPreceding, -1))
    w_m = Window.partitionBy(*keys).orderBy("_nb").rowsBetween(Window.unboundedPreceding, -1)
    months = (d.groupBy(*keys, "_nb").agg(F.sum(value).alias("_s"))
              .select(*keys, "_nb", F.coalesce(F.sum("_s").over(w_m), F.lit(0)).alias("_before")))
    d = d.withColumn("_in", F.coalesce(F.sum(value).over(w_in), F.lit(0))).join(months, [*keys, "_nb"], "inner")
    return d.withColumn(name, F.col("_before") + F.col("_in")).drop("_nb", "_in", "_before")


def latest_before_months(left: DataFrame, right: DataFrame, by: Sequence[str], month: str,
                         right_cols: Sequence[str], name: str) -> DataFrame:
    """Struct of the right row that is last in ``right_cols`` order (its time first) before 00:00 of
    each left row's ``month`` (a month start): one maximum per (key, month), then a running maximum
    over one row per month of a key."""
    from shelterlens.functions.dates import month_start
    keys = list(by)
    packed = F.struct(*[F.col(c) for c in right_cols])
    per_month = (right.withColumn("_m", month_start(right_cols[0])).groupBy(*keys, "_m").agg(F.max(packed).alias("_best"))
                 .withColumn("_l", F.lit(0)))
    asked = left.select(*keys, F.col(month).alias("_m")).distinct().select(
        *keys, "_m", F.lit(None).cast(per_month.schema["_best"].dataType).alias("_best"), F.lit(1).alias("_l"))
    w = Window.partitionBy(*keys).orderBy(F.col("_m"), F.col("_l").desc()).rowsBetween(Window.unboundedPreceding, -1)
    found = (asked.unionByName(per_month).withColumn(name, F.max("_best").over(w)).where(F.col("_l") == 1)
             .select(*keys, F.col("_m").alias(month), name))
    return left.join(found, [*keys, month], "left")


def asof_backward_bucketed(left: DataFrame, right: DataFrame, by: Sequence[str], left_ts: str, right_ts: str,
                           right_cols: Sequence[str], strict: bool = True) -> DataFrame:
    """J9 for unbounded look-back: latest right row strictly before each left row.

    Two levels so that no window partition holds a key's whole history:
    (1) inside the left row's own month, a running ``last`` over both sides
    partitioned by (key, month); (2) otherwise the latest right row of any earlier
    month: per (key, month) maxima, then a running max over one row per month of
    the key. Ties in time go to the largest ``right_cols``.
    """
    from shelterlens.functions.dates import month_start
    keys = list(by)
    rcols = list(right_cols)
    r = right.select(*keys, F.col(right_ts).alias("_rt"), *rcols).withColumn("_b", month_start("_rt"))
    l = left.withColumn("_b", month_start(left_ts))
    in_month = asof_backward(l, r, keys, left_ts, "_rt", ["_rt"] + rcols, strict=strict, partition_extra=["_b"])
    packed = F.struct(F.col("_rt").alias("ts"), *[F.col(c) for c in rcols])
    per_month = r.groupBy(*keys, "_b").agg(F.max(packed).alias("_best"))
    best_type = per_month.schema["_best"].dataType
    left_months = l.select(*keys, "_b").distinct()
    u = (left_months.select(*keys, "_b", F.lit(None).cast(best_type).alias("_best"), F.lit(1).alias("_is_l"))
         .unionByName(per_month.withColumn("_is_l", F.lit(0))))
    # left rows sort before the same month's right row, so the frame holds earlier months only
    w = (Window.partitionBy(*keys).orderBy(F.col("_b"), F.col("_is_l").desc())
         .rowsBetween(Window.unboundedPreceding, -1))
    earlier = (u.withColumn("_earlier", F.max("_best").over(w)).where(F.col("_is_l") == 1)
               .select(*keys, "_b", "_earlier"))
    out = in_month.join(earlier, keys + ["_b"], "left")
    pick = F.when(F.col("_rt").isNotNull(), F.struct(F.col("_rt").alias("ts"), *[F.col(c) for c in rcols])) \
        .otherwise(F.col("_earlier"))
    out = out.withColumn("_pick", pick)
    return out.select(*left.columns, F.col("_pick.ts").alias(right_ts),
                      *[F.col("_pick." + c).alias(c) for c in rcols])


def interval_contains_bucketed(points: DataFrame, intervals: DataFrame, by: Sequence[str], point_ts: str,
                               start: str, end: str) -> DataFrame:
    """(point, interval) pairs of the same key with ``start < ts < end``.

    Intervals are exploded into the months they span and points carry their own
    month, so the equi-join on (key, month) only meets intervals that can hold
    the point: work is linear in interval months plus output, not in the product
    of a key's points and intervals.
    """
    from shelterlens.functions.dates import month_start
    from shelterlens.operators.spine import months_between_cols
    iv = intervals.withColumn("_m", F.explode(months_between_cols(month_start(start), month_start(end))))
    pt = points.withColumn("_m", month_start(point_ts))
    return (pt.join(iv, list(by) + ["_m"], "inner")
            .where((F.col(point_ts) > F.col(start)) & (F.col(point_ts) < F.col(end))).drop("_m"))


def asof_at_month_starts(left: DataFrame, right: DataFrame, by: Sequence[str], month: str, right_ts: str,
                         name: str, strict: bool = True) -> DataFrame:
    """Latest ``right_ts`` before 00:00 of each left row's ``month`` (a month-start DATE),
    or at/before it when ``strict`` is False.

    For month-start lookups no per-row pass is needed: right rows are reduced to
    one maximum per (key, month) (plus the maximum exactly at the month's first
    instant), and a running max over one row per (key, month) answers every left
    month of the key.
    """
    from shelterlens.functions.dates import as_timestamp, month_start
    keys = list(by)
    r = right.select(*keys, F.col(right_ts).alias("_rt")).withColumn("_m", month_start("_rt"))
    per_month = r.groupBy(*keys, "_m").agg(
        F.max("_rt").alias("_mx"),
        F.max(F.when(F.col("_rt") == as_timestamp("_m"), F.col("_rt"))).alias("_at_start"))
    lm = left.select(*keys, F.col(month).alias("_m")).distinct()
    u = (lm.select(*keys, "_m", F.lit(None).cast(per_month.schema["_mx"].dataType).alias("_mx"), F.lit(1).alias("_l"))
         .unionByName(per_month.select(*keys, "_m", "_mx", F.lit(0).alias("_l"))))
    # left rows sort before the same month's right row: the frame holds earlier months only
    w = Window.partitionBy(*keys).orderBy(F.col("_m"), F.col("_l").desc()).rowsBetween(Window.unboundedPreceding, -1)
    earlier = u.withColumn("_before", F.max("_mx").over(w)).where(F.col("_l") == 1).select(*keys, "_m", "_before")
    if not strict:
        earlier = (earlier.join(per_month.select(*keys, "_m", "_at_start"), keys + ["_m"], "left")
                   .select(*keys, "_m", F.greatest("_before", "_at_start").alias("_before")))
    out = left.join(earlier.withColumnRenamed("_m", month), keys + [month], "left")
    return out.withColumnRenamed("_before", name)


def latest_at_month_starts(asked: DataFrame, by: Sequence[str], month: str, sources: dict, rows: int,
                           until: str | None = None, asked_months: int = 0, tasks: int | None = None) -> DataFrame:
    """Of each (key, ``month``) in ``asked`` (a month-start DATE) the latest time of every source before
    00:00 of it: ``sources`` is ``{name: (frame, time column, strict)}``, ``strict`` leaving out that instant.
    With ``until`` a row asks for every month from ``month`` to ``until``, ``asked_months`` of them in all rows.

    Each source row counts from one month start on, so the sources, of about ``rows`` rows together, fold into
    one row per (key, month), dealt by both - a hot key spreads over its months and shrinks to them. These rows
    and the asked ones are then dealt by key, the months are written out only there, and one running
    maximum over the months of a key answers all of them: two shuffles for any number of sources. ``tasks``, for
    keys none of which is hot: all rows are dealt by key over so many tasks and fold there, which is one shuffle.
    """
    from shelterlens.functions.dates import as_timestamp, month_start
    from shelterlens.operators.spine import months_between_cols
    keys, names, events = list(by), list(sources), None
    for name, (frame, ts, strict) in sources.items():
        start, next_start = month_start(ts), F.add_months(month_start(ts), 1)
        since = next_start if strict else F.when(F.col(ts) == as_timestamp(start), start).otherwise(next_start)
        found = frame.select(*keys, since.alias("_m"), F.col(ts).alias(name))
        events = found if events is None else events.unionByName(found, allowMissingColumns=True)
    if tasks is None:
        events = deal(events, [*keys, "_m"], rows, NARROW_ROWS).groupBy(*keys, "_m").agg(*[F.max(c).alias(c) for c in names])
    wanted = asked.select(*keys, F.col(month).alias("_m"), F.col(until or month).alias("_to"), F.lit(1).alias("_asked"))
    both = events.unionByName(wanted, allowMissingColumns=True)
    both = both.repartition(tasks, *keys) if tasks else deal(both, keys, rows + asked_months, NARROW_ROWS)
    each = F.when(F.col("_asked") == 1, months_between_cols("_m", "_to")).otherwise(F.array("_m"))
    months = (both.withColumn("_m", F.explode(each)).groupBy(*keys, "_m")
              .agg(F.max("_asked").alias("_asked"), *[F.max(c).alias(c) for c in names]))
    w = Window.partitionBy(*keys).orderBy("_m").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (months.select(*keys, F.col("_m").alias(month), "_asked", *[F.max(c).over(w).alias(c) for c in names])
            .filter("_asked = 1").drop("_asked"))
