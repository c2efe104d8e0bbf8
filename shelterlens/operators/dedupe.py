"""Order-safe de-duplication.

``dropDuplicates`` keeps an arbitrary row, so every keep-first / keep-last here
takes an explicit total order. When the order can be encoded as an ascending
struct the work is a hash aggregate (``min(struct(order..., row...))``), which
combines map-side: a key holding a third of the table shrinks to one row per
input partition before the shuffle. Other orders fall back to ``row_number``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelterlens.functions.dates import ntz_micros


@dataclass(frozen=True)
class Ord:
    """One sort key: column name, direction and null placement."""
    col: str
    asc: bool = True
    nulls_last: bool = True


def _norm(order: Sequence) -> list[Ord]:
    return [o if isinstance(o, Ord) else Ord(o) for o in order]


_NEGATABLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
              T.DoubleType, T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _asc_key(df: DataFrame, o: Ord) -> list[Column] | None:
    """Ascending struct fields that sort like ``o``; None if not encodable."""
    c = F.col(o.col)
    dtype = df.schema[o.col].dataType
    null_flag = c.isNull() if o.nulls_last else c.isNotNull()
    if o.asc:
        return [null_flag, c]
    if not isinstance(dtype, _NEGATABLE):
        return None
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        v = -ntz_micros(c) if isinstance(dtype, T.TimestampNTZType) else -F.unix_micros(c)
    elif isinstance(dtype, T.DateType):
        v = -F.unix_date(c)
    else:
        v = -c
    return [null_flag, v]


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence, method: str = "auto") -> DataFrame:
    """One row per ``keys``: the first in ``order`` (ties broken by all columns)."""
    order = _norm(order)
    named = {o.col for o in order}
    rest = [Ord(c) for c in df.columns if c not in named and c not in keys]
    full = order + rest
    fields = []
    if method in ("auto", "agg"):
        for o in full:
            k = _asc_key(df, o)
            if k is None:
                fields = None
                break
            fields.extend(k)
    if fields is not None and method != "window":
        # an ascending order column is its own key, so the row is read back from the keys; only the others come along
        turned = [o.col for o in full if not o.asc and o.col not in keys]
        payload = [F.struct(*[F.col(c).alias(c) for c in turned]).alias("_row")] if turned else []
        best = F.min(F.struct(*[f.alias(f"_k{i}") for i, f in enumerate(fields)], *payload))
        held = {o.col: f"_best._row.{o.col}" if o.col in turned else f"_best._k{2 * i + 1}" for i, o in enumerate(full)}
        return (df.groupBy(*keys).agg(best.alias("_best"))
                .select(*[F.col(c) if c in keys else F.col(held[c]).alias(c) for c in df.columns]))
    w = Window.partitionBy(*keys).orderBy(*[_sort_col(o) for o in full])
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence, method: str = "auto") -> DataFrame:
    """One row per ``keys``: the last in ``order`` (= first in the reversed order)."""
    rev = [Ord(o.col, not o.asc, not o.nulls_last) for o in _norm(order)]
    return keep_first(df, keys, rev, method)


def _sort_col(o: Ord) -> Column:
    c = F.col(o.col)
    if o.asc:
        return c.asc_nulls_last() if o.nulls_last else c.asc_nulls_first()
    return c.desc_nulls_last() if o.nulls_last else c.desc_nulls_first()


def keep_min_ties(df: DataFrame, keys: Sequence[str], value_col: str, method: str = "rank") -> DataFrame:
    """All rows whose ``value_col`` equals the group minimum (ties kept; null values never).

    ``rank``: rows of rank 1 by the value. The filter on the rank becomes a group limit that also runs
    before the shuffle, so each map task sends only the ties of its own minimum and a hot key
    shrinks to those; the input is read once. ``window``: a window minimum over whole groups bounded by
    the data's grain. ``join``: a combining aggregate matched back by an equi-join on (keys, value), for
    inputs that are stored.
    """
    if method == "join":
        mins = df.groupBy(*keys).agg(F.min(value_col).alias(value_col))
        return df.join(mins, list(keys) + [value_col], "left_semi")
    if method == "rank":
        w = Window.partitionBy(*keys).orderBy(value_col)
        return df.where(F.col(value_col).isNotNull()).withColumn("_rank", F.rank().over(w)).where("_rank = 1").drop("_rank")
    w = Window.partitionBy(*keys)
    return df.withColumn("_min", F.min(value_col).over(w)).where(F.col(value_col) == F.col("_min")).drop("_min")


def flag_group_size(df: DataFrame, keys: Sequence[str], name: str = "num_in_group") -> DataFrame:
    """Size of each row's group (window count; the reference's outer
    merge with indicator needs no join because its right side derives from the left)."""
    return df.withColumn(name, F.count(F.lit(1)).over(Window.partitionBy(*keys)))
