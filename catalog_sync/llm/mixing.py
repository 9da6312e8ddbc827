"""Mixing sources to target weights by Poisson replication (DataFrame operations only).

A source with ``n`` documents and target share ``w`` of ``total`` rows has the
mean repetition rate ``w * total / n``. Each document's own count is drawn from
the Poisson distribution of that mean by inverting its distribution function
at a uniform number hashed from the seed and the document id, so the draw
needs no state, no order and no coordination, is the same on every retry, and
a document costs the same whatever its source. Documents are exploded by their
counts and dealt out by a second hash: a global shuffle.

Defined cases: a null source is a source of its own; a null id hashes like the
text ``null``; repeated rows with the same id draw the same count; sources
without a weight (when weights are given) have rate 0 and vanish; weights of
absent sources, null or negative weights count nothing; an empty table stays
empty; a very large rate costs the rows it asks for, but no long table or array; input columns named like a result column give way to it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalog_sync.llm.tables import bounded_broadcast, replace_columns

SEED = "mix-1"


def hash_uniform(seed: str, *parts: Column) -> Column:
    """Uniform number in (0, 1) from the first 52 bits of an MD5 digest."""
    text = F.concat_ws(":", F.lit(seed), *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    bits = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")
    return (bits.cast("double") + 0.5) / F.lit(float(2**52))


def repetition_rates(docs: DataFrame, weights: DataFrame | None = None, *, source: str = "source", power: float = 0.5,
                     size_ratio: float = 1.0) -> DataFrame:
    """One row per source: ``source, n_docs, weight`` (share of the mix) and ``rate`` (mean copies per document).

    Without ``weights`` (columns ``source, weight``) the share is proportional
    to ``n_docs ** power``: 1 keeps the given mix, 0 makes all sources equal.
    The mix has ``size_ratio`` times as many rows as ``docs``, on average.
    """
    n = docs.groupBy(F.col(f"`{source}`").alias("source")).agg(F.count(F.lit(1)).alias("n_docs"))
    if weights is None:
        n = n.withColumn("raw", F.pow(F.col("n_docs").cast("double"), F.lit(float(power))))
    else:
        given = weights.groupBy(F.col("source").alias("__llm_s")).agg(F.sum("weight").cast("double").alias("__llm_w"))
        n = n.join(given, F.col("source").eqNullSafe(F.col("__llm_s")), "left")
        n = n.withColumn("raw", F.greatest(F.coalesce("__llm_w", F.lit(0.0)), F.lit(0.0))).drop("__llm_s", "__llm_w")
    all_raw, all_docs = n.agg(F.sum("raw"), F.sum("n_docs")).first()
    n = n.withColumn("weight", F.col("raw") / F.lit(all_raw) if all_raw else F.lit(0.0))
    return n.select("source", "n_docs", "weight", (F.col("weight") * F.lit((all_docs or 0) * float(size_ratio)) / F.col("n_docs")).alias("rate"))


#: Numbers up to which the sources' distributions are broadcast (8 bytes each); more are joined by a shuffle.
BROADCAST_NUMBERS = 1_000_000
#: Copies that one generated array lists.
COPIES_AT_ONCE = 4_096


def _span(rate: Column) -> tuple[Column, Column]:
    """The counts between which the distribution function leaves 0 and reaches 1 in double precision; from 0 where that is near."""
    low = F.floor(rate - 12 * F.sqrt(rate) - 30)
    return F.when(low >= 200, low).otherwise(F.lit(0)).cast("long"), F.ceil(rate + 12 * F.sqrt(rate) + 30).cast("long")


def _log_factorial(n: Column) -> Column:
    """ln n! by Stirling's series, in double precision from 200 on; 0 for n = 0."""
    x = n.cast("double")
    return F.when(n == 0, 0.0).otherwise(x * F.log(x) - x + 0.5 * F.log(2 * math.pi * x) + 1 / (12 * x) - 1 / (360 * x * x * x))


def with_distribution(rates: DataFrame) -> DataFrame:
    """``rates`` with ``first`` and ``cdf``: the Poisson distribution function at ``first, first + 1, ...`` to where it is 1 in
    double precision; below ``first`` it is 0. About 24 standard deviations are kept, so a large rate has a short table."""
    low, high = _span(F.col("rate"))
    by_k = rates.filter("rate > 0").select("source", "rate", low.alias("first"), F.explode(F.sequence(low, high)).alias("k"))
    up_to = Window.partitionBy("source").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    step = F.when(F.col("k") == F.col("first"), _log_factorial(F.col("first"))).otherwise(F.log(F.col("k").cast("double")))
    by_k = by_k.withColumn("pmf", F.exp(-F.col("rate") + F.col("k") * F.log("rate") - F.sum(step).over(up_to)))
    by_k = by_k.withColumn("at_most", F.sum("pmf").over(up_to))
    cdf = by_k.groupBy("source").agg(F.min("first").alias("first"), F.sort_array(F.collect_list("at_most")).alias("cdf"))
    left, right = rates.alias("a"), cdf.alias("b")
    return left.join(right, F.col("a.source").eqNullSafe(F.col("b.source")), "left").select(
        "a.*", F.coalesce("b.first", F.lit(0)).alias("first"), F.coalesce("b.cdf", F.array(F.lit(2.0))).alias("cdf"))


def _few_numbers(rates: DataFrame) -> bool:
    low, high = _span(F.col("rate"))
    return (rates.filter("rate > 0").agg(F.sum(high - low + 1)).first()[0] or 0) <= BROADCAST_NUMBERS


def mix(docs: DataFrame, rates: DataFrame, *, source: str = "source", doc_id: str = "doc_id", seed: str = SEED) -> DataFrame:
    """Every copy of every document: the columns of ``docs`` with ``n_copies, copy`` (from 1) and ``shuffle_key``.

    ``rates`` is the output of :func:`repetition_rates`. Rows are dealt over
    the shuffle partitions by the hash of ``shuffle_key`` and sorted by it
    inside: a random permutation that is the same for the same seed.
    """
    side = with_distribution(rates).select(F.col("source").alias("__llm_s"), F.col("first").alias("__llm_f"), F.col("cdf").alias("__llm_cdf"))
    # few sources with short tables are broadcast; others never, whatever size Spark sees
    side = bounded_broadcast(side) if _few_numbers(rates) else side.hint("merge")
    rows = docs.join(side, F.col(f"`{source}`").eqNullSafe(F.col("__llm_s")))
    rows = rows.withColumn("__llm_u", hash_uniform(seed, F.col(f"`{doc_id}`")))
    n = F.col("__llm_f") + F.size(F.filter("__llm_cdf", lambda c: c <= F.col("__llm_u"))).cast("long")
    rows = rows.withColumn("__llm_n", n).drop("__llm_s", "__llm_f", "__llm_cdf", "__llm_u").filter("__llm_n > 0")
    # two steps, so that no array lists more than a few thousand copies of a document
    rows = rows.withColumn("__llm_b", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("__llm_n") - 1) / COPIES_AT_ONCE))))
    at = F.col("__llm_b") * COPIES_AT_ONCE
    rows = rows.withColumn("__llm_k", F.explode(F.sequence(at + 1, F.least(F.col("__llm_n"), at + COPIES_AT_ONCE)))).drop("__llm_b")
    key = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("null")), F.col("__llm_k").cast("string")))
    rows = replace_columns(rows, {"n_copies": F.col("__llm_n"), "copy": F.col("__llm_k"), "shuffle_key": key}).drop("__llm_n", "__llm_k")
    return rows.repartition("shuffle_key").sortWithinPartitions("shuffle_key")
