"""Constraint and referential jobs: the checks a database would enforce, run
as Spark jobs over files (one aggregate pass, anti/semi joins)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rule_violation(rule: dict) -> tuple[str, str, Column]:
    kind, col = rule["kind"], rule["col"]
    c = F.col(col)
    if kind == "not_null":
        return kind, col, c.isNull()
    if kind == "max_length":
        return kind, col, F.length(c) > F.lit(int(rule["max"]))
    if kind == "allowed":
        return kind, col, c.isNotNull() & ~c.isin(*rule["values"])
    raise ValueError(f"unknown rule kind {kind!r}")


def check_constraints(df: DataFrame, rules: list[dict]) -> DataFrame:
    """One row per rule: (rule, column, violations), all counted in one pass.

    Rules: ``{"kind": "not_null", "col": c}``, ``{"kind": "max_length", "col": c,
    "max": n}`` (VARCHAR(n)), ``{"kind": "allowed", "col": c, "values": [...]}``
    (NULL passes, as a CHECK does).
    """
    parts = [rule_violation(r) for r in rules]
    counts = df.agg(*[F.count_if(v).alias(f"__v{i}") for i, (_, _, v) in enumerate(parts)])
    rows = F.array(*[
        F.struct(F.lit(kind).alias("rule"), F.lit(col).alias("column"), F.col(f"__v{i}").alias("violations"))
        for i, (kind, col, _) in enumerate(parts)
    ])
    return counts.select(F.inline(rows))


def check_unique(df: DataFrame, keys: list[str] | str) -> DataFrame:
    """Key values that occur more than once (NULL keys are exempt, as in SQL)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    nn = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return df.filter(nn).groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences")).filter(F.col("occurrences") > 1)


def check_foreign_key(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Child rows whose non-null ``fk`` has no parent row."""
    keys = parent.select(F.col(pk).alias(fk)).distinct()
    return child.filter(F.col(fk).isNotNull()).join(keys, fk, "left_anti")


def cascade_delete(child: DataFrame, deleted_parent_keys: DataFrame, fk: str, pk: str) -> DataFrame:
    """ON DELETE CASCADE: drop children of deleted parents (NULL ``fk`` rows stay)."""
    gone = deleted_parent_keys.select(F.col(pk).alias(fk)).distinct()
    return child.join(gone, fk, "left_anti")


def set_null_on_delete(child: DataFrame, deleted_parent_keys: DataFrame, fk: str, pk: str) -> DataFrame:
    """ON DELETE SET NULL: keep every child, NULL its ``fk`` when the parent is gone."""
    gone = deleted_parent_keys.select(F.col(pk).alias("__fk")).distinct().withColumn("__gone", F.lit(True))
    j = child.join(gone, F.col(fk) == F.col("__fk"), "left")
    cols = [F.when(F.col("__gone").isNotNull(), F.lit(None).cast(dict(child.dtypes)[fk])).otherwise(F.col(fk)).alias(fk)
            if c == fk else F.col(c) for c in child.columns]
    return j.select(*cols)


def apply_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Column defaults for columns the insert did not supply; an explicit NULL stays NULL."""
    add = {}
    for c, v in defaults.items():
        if c in df.columns:
            continue
        add[c] = v if isinstance(v, Column) else F.lit(v)
    return df.withColumns(add) if add else df


def month_cycle_rollup(tasks: DataFrame, month_col: str = "month_cycle", status_col: str = "status") -> DataFrame:
    """Per month cycle: total tasks, completed tasks and tasks created (not yet started)."""
    s = F.col(status_col)
    return tasks.groupBy(month_col).agg(
        F.count(F.lit(1)).alias("total_tasks"),
        F.count_if(s == "completed").alias("tasks_completed"),
        F.count_if(s == "pending").alias("tasks_created"),
    )
