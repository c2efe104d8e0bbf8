"""Equi-joins of two tables that both grow with the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


ROWS_A_TASK = 100_000   # wide rows that a task sorts several times in a row
NARROW_ROWS = 250_000   # rows of a few numbers, sorted or hashed once or twice
CROWDED = 4             # times that many rows in one task: a hot key is among them


def deal(df: DataFrame, by: Sequence[str], rows: int, a_task: int | None = None, joined: bool = False) -> DataFrame:
    """``df``, of about ``rows`` rows, dealt over tasks by the hash of ``by``: as many tasks as keep each small.

    Aggregates, windows and rank filters on keys that hold ``by`` then need no further shuffle, nor do joins on
    exactly ``by`` with a frame dealt by it over as many tasks. Left to AQE, a shuffle's tasks are only cut at
    64 MB of compressed files, which unpack to many times that where rows are sorted or hashed. ``joined``: for
    both sides of a join, which would raise a smaller number of tasks to that of all shuffles and fix it: then the
    rows are few enough for the planner to deal them.
    """
    tasks = rows // (a_task or ROWS_A_TASK) + 1
    if joined and tasks < int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return df
    return df.repartition(tasks, *by)


def join_large(left: DataFrame, right: DataFrame, on: str | Sequence[str] | Column, how: str = "inner") -> DataFrame:
    """Equi-join that deals both sides over the tasks, whatever their size.

    Left to the planner, a side whose compressed shuffle files are under the broadcast limit goes
    to the driver, where its hash table takes ten times that and several of them meet. A sort-merge join
    passes nothing through the driver, and what follows on the same key finds its rows in place.
    """
    return left.join(right.hint("merge"), on, how)


def crowded(frames: Sequence[DataFrame], by: Sequence[str], tasks: int, a_task: int | None = None) -> bool:
    """Whether a task would get over ``CROWDED`` times its rows if the (stored) ``frames`` were dealt by ``by``: a
    hot key. The rows are counted by task, so no more than a count a task is shuffled."""
    task = F.pmod(F.hash(*by), F.lit(tasks)).alias("_task")     # as ``deal`` and buckets place a row
    counts = None
    for df in frames:
        own = df.groupBy(task).count()
        counts = own if counts is None else counts.unionByName(own)
    most = counts.groupBy("_task").agg(F.sum("count").alias("_n")).agg(F.max("_n")).first()[0]
    return (most or 0) > CROWDED * (a_task or ROWS_A_TASK)


def join_in_place(left: DataFrame, right: DataFrame, by: Sequence[str], also: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``by`` and ``also`` of two frames that are dealt by ``by`` over as many tasks, without a shuffle.

    Spark shuffles both sides of a join by all its keys unless they are dealt by all of them. Here only ``by`` is
    a key, and ``also``, columns that are equal where each is not under or over the other, are compared among the
    rows of one key: for few rows a key, such as one animal's.
    """
    keys = [*by, *also]     # come first, as in a join on names
    held = right.select(*[F.col(c).alias(f"_r_{c}") for c in right.columns])
    cond = F.lit(True)
    for c in by:
        cond = cond & (left[c] == held[f"_r_{c}"])
    for c in also:
        cond = cond & left[c].between(held[f"_r_{c}"], held[f"_r_{c}"])
    return join_large(left, held, cond, how).select(
        *keys, *[c for c in left.columns if c not in keys],
        *[F.col(f"_r_{c}").alias(c) for c in right.columns if c not in keys])
