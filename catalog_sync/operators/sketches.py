"""Mergeable sketches of a table version: distinct ids and set relations (theta), length quantiles (KLL).

A version's sketches are one row made in one pass and stored beside it; versions are then compared, and parts merged,
without reading their rows again. Up to ``2 ** lg_k`` ids a theta sketch is exact; beyond, its standard error is about
``1 / sqrt(2 ** lg_k)`` of the larger set (1.6 % at 12), that of a set difference relative to the union. A quantile's rank is off by about 1.3 % at most at the
default size.
NULL ids and texts are in no sketch; an empty table has empty ones.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LG_K = 12


def sketch(df: DataFrame, key: str = "id", texts: list[str] | None = None, lg_k: int = LG_K) -> DataFrame:
    """One row: ``n_rows``, ``ids`` (theta sketch of the keys) and ``len_<text>`` (KLL sketch of each text's length)."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.theta_sketch_agg(F.col(key), lg_k).alias("ids"),
        *[F.kll_sketch_agg_bigint(F.length(t).cast("long")).alias(f"len_{t}") for t in texts or []],
    )


def merge(sketches: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """The row of :func:`sketch` of all parts together, from theirs."""
    lengths = [c for c in sketches.columns if c.startswith("len_")]
    return sketches.agg(F.sum("n_rows").alias("n_rows"), F.theta_union_agg("ids", lg_k).alias("ids"), *[F.kll_merge_agg_bigint(c).alias(c) for c in lengths])


def write_sketch(df: DataFrame, base: str, version: str, key: str = "id", texts: list[str] | None = None) -> None:
    """Store the sketches of a version's rows under ``base``, named after the version."""
    sketch(df, key, texts).write.mode("overwrite").parquet(os.path.join(base, "_sketches", version))


def read_sketch(spark: SparkSession, base: str, version: str) -> DataFrame:
    return spark.read.parquet(os.path.join(base, "_sketches", version))


def compare(old: DataFrame, new: DataFrame) -> DataFrame:
    """One row: distinct ids of both, of their union and overlap, and of those that vanished and came; from two rows of :func:`sketch`."""
    sides = old.select("ids", F.lit(True).alias("o")).union(new.select("ids", F.lit(False)))
    both = sides.agg(F.max(F.when(F.col("o"), F.col("ids"))).alias("a"), F.max(F.when(~F.col("o"), F.col("ids"))).alias("b"))

    def size(c: Column) -> Column:
        return F.theta_sketch_estimate(c)

    return both.select(
        size(F.col("a")).alias("old_ids"), size(F.col("b")).alias("new_ids"), size(F.theta_union("a", "b")).alias("all_ids"),
        size(F.theta_intersection("a", "b")).alias("common"), size(F.theta_difference("a", "b")).alias("vanished"),
        size(F.theta_difference("b", "a")).alias("came"),
    )


def length_quantiles(sketches: DataFrame, text: str, ranks: list[float]) -> DataFrame:
    """``rank, length``: the length that a share ``rank`` of the texts has at most (NULL without texts)."""
    c = F.col(f"len_{text}")
    known = F.kll_sketch_get_n_bigint(c) > 0
    found = F.array(*[F.struct(F.lit(r).alias("rank"), F.when(known, F.kll_sketch_get_quantile_bigint(c, F.lit(r))).alias("length")) for r in ranks])
    return sketches.select(F.inline(found))
