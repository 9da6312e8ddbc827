"""A bitmap index of properties: one bitmap of product ids per (key, value) and id range.

Spark's bitmap functions number ids in ranges of 32,768; a row of the index is
a range's bitmap (4 KB) of one pair. A search of several pairs is an AND of their bitmaps per
range, and facets are counts of each pair's bitmap ANDed with the hits, so neither
reads the property rows. Groups are (key, value, range) and hold two bitmaps at most after the partial
aggregation, so a pair that a third of all products have is many small groups.

The index is stored partitioned by ``part`` (a number of consecutive ranges). Products that changed are updated
by building their parts again and replacing just those partitions. Ids must be integers, NULL ids, keys and values are no pairs.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import release
from ..sources.files import path_exists

#: Ranges per stored part.
RANGES_PER_PART = 32
RANGE_IDS = 32_768


def _range(product_id: Column) -> Column:
    return F.bitmap_bucket_number(product_id)


def _part(range_id: Column, ranges_per_part: int) -> Column:
    return F.floor(range_id / F.lit(ranges_per_part)).cast("long")


def build_index(props: DataFrame) -> DataFrame:
    """``prop_key, prop_value, range_id, bitmap`` of property rows (``product_id, prop_key, prop_value``)."""
    rows = props.select(F.col("product_id").cast("long").alias("p"), "prop_key", "prop_value").dropna()
    rows = rows.select("prop_key", "prop_value", _range(F.col("p")).alias("range_id"), F.bitmap_bit_position("p").alias("at"))
    return rows.groupBy("prop_key", "prop_value", "range_id").agg(F.bitmap_construct_agg("at").alias("bitmap"))


def write_index(props: DataFrame, base: str, ranges_per_part: int = RANGES_PER_PART) -> None:
    """Build the index of all ``props`` and store it at ``base``."""
    index = build_index(props).withColumn("part", _part(F.col("range_id"), ranges_per_part))
    index.repartition("part").write.mode("overwrite").partitionBy("part").parquet(base)


def read_index(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.schema("prop_key string, prop_value string, range_id long, bitmap binary, part long").parquet(base)


def update_index(base: str, props: DataFrame, changed: DataFrame, ranges_per_part: int = RANGES_PER_PART) -> list[int]:
    """Bring the stored index up to date with ``props`` (all of them) for the products ``changed`` (column ``product_id``).

    Only the parts of changed products are built and replaced (a re-run after a failure replaces them again);
    a part that has no property any more is deleted. Returns those parts' numbers.
    """
    spark = props.sparkSession
    touched = sorted(r[0] for r in changed.filter("product_id IS NOT NULL").select(
        _part(_range(F.col("product_id").cast("long")), ranges_per_part)).distinct().collect())  # a number per part
    if not touched:
        return []
    span = RANGE_IDS * ranges_per_part
    own = _part(_range(F.col("product_id").cast("long")), ranges_per_part)
    # bounds on the id itself as well, which reach the scan
    lows, highs = (min(touched) - 1) * span, (max(touched) + 1) * span
    rows = props.filter(F.col("product_id").between(lows, highs)).filter(own.isin(*touched))
    index = build_index(rows).withColumn("part", _part(F.col("range_id"), ranges_per_part))
    index.repartition("part").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(base)
    full = {r["part"] for r in rows.dropna(subset=["prop_key", "prop_value"]).select(own.alias("part")).distinct().collect()}
    for part in set(touched) - full:
        where = os.path.join(base, f"part={part}")
        if path_exists(spark, where):
            release(spark, where)
    return touched


def hits(index: DataFrame, filters: dict[str, str]) -> DataFrame:
    """``range_id, hits``: the products having all the pairs, as bitmaps per range; without pairs no row."""
    wanted = F.lit(False)
    for k, v in filters.items():
        wanted = wanted | ((F.col("prop_key") == k) & (F.col("prop_value") == v))
    both = index.filter(wanted).groupBy("range_id").agg(F.bitmap_and_agg("bitmap").alias("hits"), F.count(F.lit(1)).alias("n"))
    return both.filter((F.col("n") == len(filters)) & (F.bitmap_count("hits") > 0)).drop("n")


def facets(index: DataFrame, filters: dict[str, str]) -> DataFrame:
    """``prop_key, prop_value, products``: every pair that a hit has, with the number of hits that have it."""
    found = hits(index, filters)
    pairs = index.join(found, "range_id").select("prop_key", "prop_value", "range_id", F.explode(F.array("bitmap", "hits")).alias("b"))
    shared = pairs.groupBy("prop_key", "prop_value", "range_id").agg(F.bitmap_count(F.bitmap_and_agg("b")).alias("n"))
    return shared.groupBy("prop_key", "prop_value").agg(F.sum("n").alias("products")).filter("products > 0")


def hit_ids(index: DataFrame, filters: dict[str, str]) -> DataFrame:
    """``product_id`` of the products having all the pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, bitmap in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                bits = np.flatnonzero(np.unpackbits(np.frombuffer(bitmap, np.uint8), bitorder="little"))
                yield pa.RecordBatch.from_arrays([pa.array(start + bits, pa.int64())], names=["product_id"])

    # positive ids: range 1 starts at 1; ids from 0 down count from 0 downwards in range 0, -1, ...
    positive = hits(index, filters).select(((F.col("range_id") - 1) * RANGE_IDS + 1).alias("start"), "hits").filter("start > 0")
    others = hits(index, filters).filter("range_id <= 0").select((F.col("range_id") * RANGE_IDS).alias("start"), "hits")
    up = positive.mapInArrow(run, "product_id long")

    def down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, bitmap in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                bits = np.flatnonzero(np.unpackbits(np.frombuffer(bitmap, np.uint8), bitorder="little"))
                yield pa.RecordBatch.from_arrays([pa.array(start - bits, pa.int64())], names=["product_id"])

    return up.union(others.mapInArrow(down, "product_id long"))
