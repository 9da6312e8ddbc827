"""Types of the columns of arriving JSON rows, per file and over all files.

What is known of a column's values is a handful of flags and maxima, so states merge in any order (a join-semilattice):
partial aggregates run before the shuffle and files can be added later (:func:`merge`). The type follows from the state::

    no value -> NULL     boolean, bigint < decimal(p,s), timestamp  -> all below string

Mixed kinds, numbers beyond 38 digits and numbers with an exponent are ``string``; ``true`` can't be cast to a number, so a mix of them is ``string``
as well. JSON nulls and missing keys are no values; rows without keys and empty files give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_STATE = ["n_rows", "n_values", "booleans", "numbers", "times", "texts", "whole_digits", "scale"]


def column_states(rows: DataFrame, json_col: str = "value", file_col: str | None = None) -> DataFrame:
    """``file, column`` and the state of its values; a row per file and column."""
    file = F.col(file_col) if file_col else F.col("_metadata.file_path")
    pairs = rows.select(file.alias("file"), F.explode(F.from_json(F.col(json_col), "map<string,string>")).alias("column", "v"))
    v = F.col("v")
    number = v.rlike(r"^[+-]?[0-9]+(\.[0-9]+)?$")
    digits = F.regexp_extract(v, r"^[+-]?0*([0-9]*)", 1)
    fraction = F.regexp_extract(v, r"\.([0-9]+)$", 1)
    time = v.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?)?$") & F.try_to_timestamp(v).isNotNull()
    kind = F.when(v.isin("true", "false"), "b").when(number, "n").when(time, "t").when(v.isNotNull(), "x")
    typed = pairs.select("file", "column", kind.alias("k"), F.when(number, F.length(digits)).alias("d"), F.when(number, F.length(fraction)).alias("s"))
    count = lambda c: F.count_if(F.col("k") == c)
    return typed.groupBy("file", "column").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("k").alias("n_values"), count("b").alias("booleans"), count("n").alias("numbers"),
        count("t").alias("times"), count("x").alias("texts"), F.coalesce(F.max("d"), F.lit(0)).alias("whole_digits"), F.coalesce(F.max("s"), F.lit(0)).alias("scale"))


def merge(states: DataFrame, by: list[str]) -> DataFrame:
    """The states of ``by`` (``["column"]``: over all files) from finer ones."""
    return states.groupBy(*by).agg(*[F.max(c).alias(c) if c in ("whole_digits", "scale") else F.sum(c).alias(c) for c in _STATE])


def type_of() -> Column:
    """The SQL type that a state stands for."""
    only = lambda c: F.col(c) == F.col("n_values")
    precision = F.greatest(F.col("whole_digits") + F.col("scale"), F.lit(1))
    number = F.when((F.col("scale") == 0) & (F.col("whole_digits") <= 18), "bigint").when(
        precision <= 38, F.concat(F.lit("decimal("), precision.cast("string"), F.lit(","), F.col("scale").cast("string"), F.lit(")"))).otherwise("string")
    return F.when(F.col("n_values") == 0, F.lit(None).cast("string")).when(only("booleans"), "boolean").when(only("numbers"), number).when(
        only("times"), "timestamp").otherwise("string")


def discover_types(rows: DataFrame, json_col: str = "value", file_col: str | None = None) -> DataFrame:
    """``file, column, n_rows, n_values, type`` per file, and with a NULL file over all files."""
    states = column_states(rows, json_col, file_col)
    whole = merge(states, ["column"]).withColumn("file", F.lit(None).cast("string"))
    return states.unionByName(whole).select("file", "column", "n_rows", "n_values", type_of().alias("type"))


def proposed_types(rows: DataFrame, json_col: str = "value", file_col: str | None = None) -> dict[str, str]:
    """Arguments for :func:`~catalog_sync.operators.schema.migrate_types`: the type of each column that has values (a row per column reaches the driver)."""
    states = merge(column_states(rows, json_col, file_col), ["column"])
    return {r["column"]: r["type"] for r in states.select("column", type_of().alias("type")).collect() if r["type"]}
