"""Predicates and CASE builders with the reference's null semantics."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINARY = "UTF8_BINARY"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def isin_or_null(c, values: Iterable) -> Column:
    """``c IN (...) OR c IS NULL`` - keeps unmatched rows of a left join."""
    col = _col(c)
    return col.isin(list(values)) | col.isNull()


def ne_keep_null(c, value) -> Column:
    """pandas-style ``!=``: NULL counts as different (IS DISTINCT FROM)."""
    return ~_col(c).eqNullSafe(F.lit(value))


def ne_sql(c, value) -> Column:
    """SQL ``<>``: NULL rows are dropped by a filter."""
    return _col(c) != F.lit(value)


def regex_exclude(c, pattern: str) -> Column:
    """True for rows to keep: text not matching ``pattern``; NULL text kept."""
    return ~F.coalesce(_col(c).rlike(pattern), F.lit(False))


def contains_regex(c, pattern: str) -> Column:
    """Unanchored regex search, NULL -> False."""
    return F.coalesce(_col(c).rlike(pattern), F.lit(False))


def case_map(c, mapping: Mapping, default=None) -> Column:
    """Simple CASE ``c WHEN k THEN v ... ELSE default``."""
    col = _col(c)
    expr = None
    for key, value in mapping.items():
        expr = (F.when(col == F.lit(key), F.lit(value)) if expr is None
                else expr.when(col == F.lit(key), F.lit(value)))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default)) if default is not None else expr


def case_in_lists(c, groups: Sequence[tuple[Sequence, object]], default=None) -> Column:
    """Searched CASE ``WHEN c IN (...) THEN label`` in the given order."""
    col = _col(c)
    expr = None
    for values, label in groups:
        cond = col.isin(list(values))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default)) if default is not None else expr


def last_rule_wins(rules: Sequence[tuple[Column, object]], default) -> Column:
    """Masked assignments applied in order, the last matching one winning.

    Equivalent to a CASE over the rules in reverse order.
    """
    expr = None
    for cond, value in reversed(list(rules)):
        v = value if isinstance(value, Column) else F.lit(value)
        expr = F.when(cond, v) if expr is None else expr.when(cond, v)
    d = default if isinstance(default, Column) else F.lit(default)
    return d if expr is None else expr.otherwise(d)


def concat_null(*cols) -> Column:
    """SQL ``a + ' ' + b`` on strings: NULL if any part is NULL."""
    return F.concat(*[_col(c) for c in cols])


def flag(cond: Column) -> Column:
    """0/1 integer flag; NULL condition -> 0."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def collation_of(df: DataFrame, column: str) -> str:
    """Name of a text column's collation (``UTF8_BINARY``: plain byte order)."""
    return getattr(df.schema[column].dataType, "collation", BINARY)


def _ranked(values, collation: str) -> Column:
    """The fixed list in the order of the collation, as a constant array (equal values once, the first in byte order)."""
    texts = F.array(*[F.collate(F.lit(v), collation) for v in sorted(set(values))])
    return F.sort_array(F.array_distinct(texts))


def rank_code(c, values, collation: str = BINARY) -> Column:
    """Integer code of ``c`` within a fixed list, ordered like the strings (byte order or
    ``collation``), so min / max over it equal min / max over the text. Values outside the
    list get NULL. Lets aggregations keep fixed-width (hash-aggregatable) buffers."""
    if collation != BINARY:
        found = F.array_position(_ranked(values, collation), F.collate(_col(c), collation))
        return F.when(found > 0, (found - 1).cast("int"))
    ordered = sorted(set(values))
    return case_map(c, {v: i for i, v in enumerate(ordered)})


def rank_decode(code, values, collation: str = BINARY) -> Column:
    """Inverse of ``rank_code``, as plain text. A null code is null (asked for outright, since under ANSI
    ``element_at`` with a null place in a constant array gives the last element)."""
    code = _col(code)
    if collation != BINARY:
        return F.when(code.isNotNull(), F.collate(F.element_at(_ranked(values, collation), code + 1), BINARY))
    ordered = sorted(set(values))
    return F.when(code.isNotNull(), F.element_at(F.array(*[F.lit(v) for v in ordered]), code + 1))
