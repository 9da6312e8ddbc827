"""Differences between two table versions that read only the key ranges that differ.

A version is stored by key range (``leaf``, a hash of the key) with a table of digests: per leaf the number of rows
and two order-free sums over their hashes, in two levels (``top`` ranges of leaves). A diff compares the tops, then the
leaves of differing tops, and runs :func:`~catalog_sync.operators.sync.diff_snapshots` on the partitions of differing leaves alone.
Digests are as many rows as leaves, a parameter; which leaves differ (their numbers) reaches the driver. Rows are told apart by 64-bit hashes in two independent sums; two ranges with different rows and equal digests are as likely as
a collision of those. Rows with a NULL key lie in one
leaf and match nothing, so they show as new and deleted wherever that leaf differs, and not where it is equal.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import sync

LEAVES, FAN = 256, 16


def _leaf(keys: list[str], leaves: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(leaves)).cast("int")


def digests(rows: DataFrame, fan: int = FAN) -> DataFrame:
    """``top, leaf, n, mixed, added`` of rows with a ``leaf`` column; columns count in the order of their names."""
    cols = [F.col(f"`{c}`") for c in sorted(rows.columns) if c != "leaf"]
    # a NULL leaves a hash as it is, so where NULLs are goes in as well
    nulls = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in cols])
    h = F.xxhash64(*cols, nulls)
    return rows.withColumn("__h", h).groupBy("leaf").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor("__h").alias("mixed"), F.sum(F.xxhash64("__h", F.lit(7)).cast("decimal(38,0)")).alias("added"),
    ).select((F.col("leaf") / fan).cast("int").alias("top"), "leaf", "n", "mixed", "added")


def write_ranged_version(df: DataFrame, base: str, version: str, keys: list[str] | str = "id", leaves: int = LEAVES, fan: int = FAN) -> None:
    """Store ``df`` as ``<base>/<version>``, a partition per key range, and its digests beside it."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    path = os.path.join(base, version)
    df.withColumn("leaf", _leaf(keys, leaves)).repartition("leaf").write.mode("errorifexists").partitionBy("leaf").parquet(path)
    digests(df.sparkSession.read.parquet(path), fan).coalesce(1).write.mode("overwrite").parquet(os.path.join(base, "_digests", version))


def read_ranged_version(spark: SparkSession, base: str, version: str) -> DataFrame:
    return spark.read.parquet(os.path.join(base, version)).drop("leaf")


def differing_leaves(spark: SparkSession, base: str, old: str, new: str) -> list[int]:
    """Numbers of the key ranges whose digests differ, found through the differing tops."""
    a, b = (spark.read.parquet(os.path.join(base, "_digests", v)) for v in (old, new))
    facts = ["n", "mixed", "added"]

    def differ(x: DataFrame, y: DataFrame, by: str) -> DataFrame:
        left, right = (d.select(by, F.struct(*facts).alias(name)) for d, name in ((x, "l"), (y, "r")))
        return left.join(right, by, "full_outer").filter(~F.col("l").eqNullSafe(F.col("r"))).select(by)

    def tops(d: DataFrame) -> DataFrame:
        return d.groupBy("top").agg(F.sum("n").alias("n"), F.bit_xor("mixed").alias("mixed"), F.sum("added").alias("added"))

    open_tops = [r[0] for r in differ(tops(a), tops(b), "top").collect()]
    if not open_tops:
        return []
    return sorted(r[0] for r in differ(a.filter(F.col("top").isin(open_tops)), b.filter(F.col("top").isin(open_tops)), "leaf").collect())


def diff_versions(spark: SparkSession, base: str, old: str, new: str, keys: list[str] | str = "id", compare_cols: list[str] | None = None) -> DataFrame:
    """The rows of ``diff_snapshots`` of two ranged versions whose status is not ``unchanged``; equal ranges are not read."""
    leaves = differing_leaves(spark, base, old, new)
    a, b = (spark.read.parquet(os.path.join(base, v)).filter(F.col("leaf").isin(leaves) if leaves else F.lit(False)).drop("leaf") for v in (old, new))
    return sync.diff_snapshots(a, b, keys, compare_cols).filter("status != 'unchanged'")
