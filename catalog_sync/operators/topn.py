"""Sort / limit / top-k (TOPN shapes).

``orderBy(...).limit(n)`` plans as TakeOrderedAndProject: every partition
keeps its own n best rows and only those meet in one task, so the cost is
n x partitions rows, not the table. Ties at the cut are resolved without a
global window (which would pull the whole table into one partition).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _orders(keys: list[str], desc: bool | list[bool]) -> list[tuple[str, bool]]:
    flags = [desc] * len(keys) if isinstance(desc, bool) else list(desc)
    return list(zip(keys, flags))


def _sort_cols(spec) -> list[Column]:
    # DAX blank sorts lowest: first when ascending, last when descending (Spark's defaults).
    return [F.col(k).desc_nulls_last() if d else F.col(k).asc_nulls_first() for k, d in spec]


def topn(df: DataFrame, n: int, keys: list[str], desc: bool | list[bool] = False) -> DataFrame:
    """First ``n`` rows by ``keys`` (make the keys unique for a deterministic cut)."""
    return df.orderBy(*_sort_cols(_orders(keys, desc))).limit(n)


def _before_or_at(spec, cut: dict) -> Column:
    """Row sorts at or before ``cut`` under ``spec`` (lexicographic, nulls as in _sort_cols)."""

    def le(k, d, v, strict):
        c = F.col(k)
        if v is None:
            if d:  # descending, NULLs last: every row is at or before a NULL cut
                return c.isNotNull() if strict else F.lit(True)
            return F.lit(False) if strict else c.isNull()  # ascending, NULLs first
        lit = F.lit(v)
        better = (c > lit) if d else (c.isNull() | (c < lit))
        return better if strict else (better | (c == lit))

    def eq(k, v):
        return F.col(k).eqNullSafe(F.lit(v))

    terms = []
    for i, (k, d) in enumerate(spec):
        prefix = [eq(kk, cut[kk]) for kk, _ in spec[:i]]
        last = i == len(spec) - 1
        terms.append(reduce(lambda a, b: a & b, prefix + [le(k, d, cut[k], strict=not last)]))
    return reduce(lambda a, b: a | b, terms)


def topn_with_ties(df: DataFrame, n: int, keys: list[str], desc: bool | list[bool] = True) -> DataFrame:
    """TOPN(n, table, keys): every row tied with the n-th row is kept.

    The n-th row is found with a TakeOrderedAndProject (one small row to the
    driver); the table is then filtered by a literal predicate, which prunes
    Parquet row groups. DAX's default direction is descending.
    """
    return df.filter(ties_cut(df, n, keys, desc))


def ties_cut(df: DataFrame, n: int, keys: list[str], desc: bool | list[bool] = True) -> Column:
    """The TOPN-with-ties cut of ``df`` as a literal predicate on ``keys``.

    Runs one job to fetch the n-th row (one row reaches the driver). The
    predicate can filter ``df`` or any other plan with the same key columns,
    e.g. the raw table under a join, where it is pushed into the scan.
    """
    spec = _orders(keys, desc)
    cut = df.select(*keys).orderBy(*_sort_cols(spec)).limit(n).tail(1)
    if not cut:
        return F.lit(False)
    return _before_or_at(spec, cut[0].asDict())


def topn_per_group(df: DataFrame, group: str | list[str], n: int, order: str, desc: bool = True,
                   ties: bool = True, tie_break: list[str] | None = None) -> DataFrame:
    """Top ``n`` rows by ``order`` inside each group (ties at the cut kept with ``ties``).

    ``rank``/``row_number`` <= n is planned with a WindowGroupLimit that also runs
    before the shuffle, so a hot group is already cut to n rows per map task.
    """
    o = F.col(order).desc_nulls_last() if desc else F.col(order).asc_nulls_first()
    extra = [F.col(c) for c in (tie_break or [])]
    w = Window.partitionBy(*([group] if isinstance(group, str) else group)).orderBy(o, *extra)
    fn = F.rank() if ties else F.row_number()
    return df.withColumn("__r", fn.over(w)).filter(F.col("__r") <= n).drop("__r")
