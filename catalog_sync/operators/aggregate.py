"""Aggregates: profiles, backlog, run report, SUMMARIZECOLUMNS, ordered concatenation.

Every statistic set is one ``agg`` (one pass, map-side partial aggregation).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The columns a load's profile counts.
PROFILED = ["description", "brand", "category", "item_number"]


def completeness_columns(cols: list[str], total_name: str = "total_products", prefix: str = "products_with_") -> list[Column]:
    """The aggregates of :func:`profile_completeness`."""
    return [F.count(F.lit(1)).alias(total_name), *[F.count(F.col(f"`{c}`")).alias(f"{prefix}{c}") for c in cols]]


def profile_completeness(df: DataFrame, cols: list[str] | None = None, total_name: str = "total_products",
                         prefix: str = "products_with_") -> DataFrame:
    """``COUNT(*)`` and the non-null count of each column, one row, one pass."""
    cols = cols if cols is not None else PROFILED
    return df.agg(*completeness_columns(cols, total_name, prefix))


def profile_uniqueness(df: DataFrame, key: str = "id", text_col: str = "description", approx: bool = False) -> DataFrame:
    """``COUNT(*)``, ``COUNT(DISTINCT key)`` and non-null ``text_col``.

    ``approx=True`` uses HyperLogLog (no shuffle of distinct keys) for huge tables.
    """
    distinct = F.approx_count_distinct(key) if approx else F.count_distinct(F.col(key))
    return df.agg(
        F.count(F.lit(1)).alias("total_count"),
        distinct.alias("unique_ids"),
        F.count(F.col(text_col)).alias("with_description"),
    )


def embedding_backlog(df: DataFrame, flag_col: str = "is_vector") -> DataFrame:
    """Total rows and rows waiting for an embedding (flag = FALSE; NULL not counted)."""
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col(flag_col) == F.lit(False)).alias("need_vectorization"),
    )


def etl_report(ops: DataFrame) -> DataFrame:
    """Run report over operation records (source, target, total_rows, updated_rows, status).

    One summary row: operations, ok, failed, and row sums over the ok ones.
    """
    ok = F.col("status") == "success"
    return ops.agg(
        F.count(F.lit(1)).alias("operations"),
        F.count_if(ok).alias("successful"),
        F.count_if(~ok | F.col("status").isNull()).alias("failed"),
        F.coalesce(F.sum(F.when(ok, F.col("total_rows"))), F.lit(0)).cast("bigint").alias("total_rows"),
        F.coalesce(F.sum(F.when(ok, F.col("updated_rows"))), F.lit(0)).cast("bigint").alias("updated_rows"),
    )


def etl_report_lines(ops: DataFrame) -> DataFrame:
    """Per-operation lines of the run report (``source -> target``, status, rows)."""
    return ops.select(
        F.concat_ws(" -> ", "source", "target").alias("operation"),
        "status",
        F.coalesce("total_rows", F.lit(0)).alias("total_rows"),
        F.coalesce("updated_rows", F.lit(0)).alias("updated_rows"),
        "error",
    )


def summarize(df: DataFrame, keys: list[str], measures: dict[str, Column] | None = None,
              ignore: tuple[str, ...] = (), count_name: str | None = None) -> DataFrame:
    """SUMMARIZECOLUMNS: group by ``keys`` with named measures.

    A group whose non-ignored measures are all blank is dropped; with no
    measures the result is the distinct key combinations. ``count_name`` adds a
    COUNTROWS measure. Joins to related tables are done by the caller with
    explicit keys.
    """
    measures = dict(measures or {})
    if count_name:
        measures[count_name] = F.count(F.lit(1))
    if not measures:
        return df.select(*keys).distinct()
    out = df.groupBy(*keys).agg(*[m.alias(n) for n, m in measures.items()])
    kept = [F.col(n).isNotNull() for n in measures if n not in ignore]
    if kept:
        out = out.filter(reduce(lambda a, b: a | b, kept))
    return out


def at_most_per_key(rows: DataFrame, key: str, most: int, what: str) -> DataFrame:
    """``rows``, failing the job if a key has more than ``most`` of them: bounds what a
    later collect gathers for one key without dropping anything."""
    n = F.row_number().over(Window.partitionBy(key).orderBy(F.lit(0)))
    check = F.assert_true(F.col("__n") <= most, F.lit(f"more than {most} {what} for one {key}"))
    return rows.withColumn("__n", n).filter(check.isNull()).drop("__n")


def concat_ordered(df: DataFrame, key: str, name: str, value: str, order: str, limit: int | None = None,
                   sep: str = " | ", pair_sep: str = ": ", top_desc: bool = True, concat_desc: bool = False,
                   tie_break: str | None = None, out_col: str = "properties", max_items: int | None = None) -> DataFrame:
    """Per ``key``: ``name: value`` joined by ``sep`` in ``order`` order.

    All rows of a key are concatenated, or with ``limit`` (a TOPN) the top
    ones by ``order`` (descending when ``top_desc``), ties at the cut kept
    (``rank``). The TOPN runs as a window group limit, partial before the
    shuffle, so a hot key is cut down map-side. A key's text is one value by
    nature; ``max_items`` fails the job where a key would gather more (see
    :func:`at_most_per_key`). A NULL value concatenates as empty text.
    """
    tie = tie_break or name
    item = F.concat(F.col(name), F.lit(pair_sep), F.coalesce(F.col(value), F.lit("")))
    rows = df
    if limit is not None:
        o = F.col(order).desc() if top_desc else F.col(order).asc()
        rows = rows.withColumn("__r", F.rank().over(Window.partitionBy(key).orderBy(o))).filter(F.col("__r") <= limit)
    if max_items is not None:
        rows = at_most_per_key(rows, key, max_items, "items")
    # sort key packed with the text so array_sort orders by (order, tie) and transform takes the text
    packed = F.struct((-F.col(order) if concat_desc else F.col(order)).alias("o"), F.col(tie).alias("t"), item.alias("v"))
    return rows.groupBy(key).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(packed)), lambda s: s["v"]), sep).alias(out_col)
    )


def selected_value(df: DataFrame, key: str, col: str, default: str | None = None, out_col: str | None = None) -> DataFrame:
    """SELECTEDVALUE per ``key``: the single distinct value of ``col``, else ``default``."""
    n = F.count_distinct(F.col(col))
    return df.groupBy(key).agg(
        F.when(n == 1, F.min(F.col(col))).otherwise(F.lit(default)).alias(out_col or col)
    )
