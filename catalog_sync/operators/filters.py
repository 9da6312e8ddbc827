"""Filters and predicates (TREATAS, blank tests, text search, point lookups).

All are plain ``filter`` / semi-join plans, so predicates reach the Parquet
scan (``PushedFilters``) and Catalyst merges stacked filters.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _blank(c: Column) -> Column:
    """DAX ISBLANK on a column value: NULL (empty text is a value)."""
    return c.isNull()


def filter_by_dim(fact: DataFrame, dim: DataFrame, on: str | list[str], filters: dict[str, list]) -> DataFrame:
    """TREATAS: keep fact rows whose dimension row matches every value list (lists ANDed).

    The filtered dimension becomes a ``left_semi`` build side; Spark broadcasts
    it only when its estimated size is under ``autoBroadcastJoinThreshold``
    (a checked size), else it shuffles both sides.
    """
    cond = reduce(lambda a, b: a & b, [F.col(c).isin(v) for c, v in filters.items()])
    on_cols = [on] if isinstance(on, str) else list(on)
    d = dim.filter(cond).select(*on_cols)
    return fact.join(d, on_cols, "left_semi")


def keep_any_not_blank(df: DataFrame, cols: list[str]) -> DataFrame:
    """Keep a row when at least one of ``cols`` is not blank."""
    return df.filter(reduce(lambda a, b: a | b, [~_blank(F.col(c)) for c in cols]))


def key_and_any_not_blank(df: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Key not blank AND at least one of ``cols`` not blank."""
    any_nb = reduce(lambda a, b: a | b, [~_blank(F.col(c)) for c in cols])
    return df.filter(~_blank(F.col(key)) & any_nb)


def key_not_blank(df: DataFrame, key: str) -> DataFrame:
    return df.filter(F.col(key).isNotNull())


def measure_equals_zero(df: DataFrame, col: str) -> DataFrame:
    """``[flag] = 0`` with DAX blank semantics: BLANK = 0 is true."""
    return df.filter(F.coalesce(F.col(col), F.lit(0)) == 0)


def search_text(df: DataFrame, text: str, col: str = "description", flag_col: str | None = "is_vector",
                limit: int | None = 5, order_by: str = "id") -> DataFrame:
    """Case-insensitive substring search (``ILIKE '%text%'``), only rows with a current
    embedding, first ``limit`` by ``order_by`` (``%`` and ``_`` in the text act as wildcards)."""
    cond = F.col(col).ilike(f"%{text}%")
    if flag_col:
        cond = cond & (F.col(flag_col) == F.lit(True))
    out = df.filter(cond)
    if limit is not None:
        out = out.orderBy(order_by).limit(limit)
    return out


def lookup_item(df: DataFrame, col: str, value) -> DataFrame:
    """Point lookup; an equality on a plain column pushes down to Parquet row groups."""
    return df.filter(F.col(col) == F.lit(value))


def range_filter(df: DataFrame, col: str, low=None, high=None, low_inclusive: bool = False,
                 high_inclusive: bool = True) -> DataFrame:
    cond = F.lit(True)
    if low is not None:
        cond = cond & ((F.col(col) >= low) if low_inclusive else (F.col(col) > low))
    if high is not None:
        cond = cond & ((F.col(col) <= high) if high_inclusive else (F.col(col) < high))
    return df.filter(cond)
