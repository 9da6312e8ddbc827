"""Violations of constraints with witnesses: how many rows break each rule, and a few keys of rows that do.

The witnesses of a rule are the ``k`` keys with the smallest MD5 digest among its violations, so the same rows give the same
witnesses whatever the partitions, retries or order, and samples of parts merge into the sample of the whole. The pass that counts
also keeps them: each task holds ``k`` keys per rule and emits one row per rule, which are merged
in two levels, so no group holds more than ``k`` keys for every ``FAN_IN``-th part of the tasks. No window, no second scan.

A witness is its key as text: of one column the value cast to text, of several a JSON array of those texts; NULL is ``null``. A key that breaks a
rule in many rows counts in every one of them and is one witness. A rule that nothing breaks, and every rule of an empty table, has 0 violations and no witnesses.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import quality

FAN_IN = 128
_PART = "i int, n long, best array<struct<h:string,key:string>>"


def _key_text(keys: list[str]) -> Column:
    texts = [F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("null")) for k in keys]
    return texts[0] if len(texts) == 1 else F.to_json(F.array(*texts))


def _smallest(k: int):
    """Arrow function over ``h, key, broken`` (the numbers of the rules a row breaks): per rule its count and ``k`` smallest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, int] = {}
        best: dict[int, dict[str, str]] = {}
        for batch in batches:
            h, key, broken = batch.column(0), batch.column(1), batch.column(2)
            parents = np.repeat(np.arange(len(broken)), broken.value_lengths().to_numpy(zero_copy_only=False))
            rules = broken.flatten().to_numpy(zero_copy_only=False)
            for i in np.unique(rules).tolist():
                rows = pa.array(parents[rules == i])
                counts[i] = counts.get(i, 0) + len(rows)
                new = pa.table({"h": h.take(rows), "key": key.take(rows)}).group_by(["h", "key"]).aggregate([])
                new = new.sort_by("h").slice(0, k)
                merged = best.get(i, {}) | dict(zip(new["h"].to_pylist(), new["key"].to_pylist(), strict=True))
                best[i] = dict(sorted(merged.items())[:k])
        out = [{"i": i, "n": n, "best": [{"h": h, "key": x} for h, x in best[i].items()]} for i, n in sorted(counts.items())]
        schema = pa.schema([("i", pa.int32()), ("n", pa.int64()), ("best", pa.list_(pa.struct([("h", pa.string()), ("key", pa.string())])))])
        yield pa.RecordBatch.from_pylist(out, schema=schema)

    return run


def _sample(rows: DataFrame, keys: list[str], broken: Column, rules: list[tuple[str, str]], k: int) -> DataFrame:
    """``rule, column, violations, witnesses`` for each of ``rules``; ``broken`` gives the numbers of those that a row breaks."""
    if k < 1:
        raise ValueError("k must be at least 1")
    text = _key_text(keys)
    bad = rows.select(F.md5(text.cast("binary")).alias("h"), text.alias("key"), broken.alias("broken")).filter(F.size("broken") > 0)
    parts = bad.mapInArrow(_smallest(k), _PART)

    def merge(d: DataFrame, *by: str) -> DataFrame:
        few = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("best")))), 1, k)
        return d.groupBy(*by).agg(F.sum("n").alias("n"), few.alias("best"))

    halfway = merge(parts.withColumn("salt", F.spark_partition_id() % FAN_IN), "i", "salt")
    found = merge(halfway, "i")
    # every rule has its row, so the counts are joined to the list of rules (both a handful of rows)
    names = F.array(*[F.struct(F.lit(kind).alias("rule"), F.lit(col).alias("column")) for kind, col in rules])
    none = rows.sparkSession.range(len(rules)).select(F.col("id").cast("int").alias("i"))
    full = none.join(found, "i", "left")
    at = F.get(names, F.col("i"))
    keys_of = F.coalesce(F.transform("best", lambda b: b["key"]), F.array().cast("array<string>"))
    return full.select(at["rule"].alias("rule"), at["column"].alias("column"), F.coalesce("n", F.lit(0)).cast("long").alias("violations"), keys_of.alias("witnesses"))


def check_constraints(df: DataFrame, rules: list[dict], keys: list[str] | str, k: int = 5) -> DataFrame:
    """:func:`quality.check_constraints` (the same rules and counts) with up to ``k`` witnesses a rule, in one pass."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    parts = [quality.rule_violation(r) for r in rules]
    broken = F.filter(F.array(*[F.when(v, F.lit(i)) for i, (_, _, v) in enumerate(parts)]), lambda x: x.isNotNull())
    return _sample(df, keys, broken, [(kind, col) for kind, col, _ in parts], k)


def check_unique(df: DataFrame, keys: list[str] | str, k: int = 5) -> DataFrame:
    """Key values that occur more than once (:func:`quality.check_unique`), counted, with up to ``k`` of them."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return _sample(quality.check_unique(df, keys), keys, F.array(F.lit(0)), [("unique", ",".join(keys))], k)


def check_foreign_key(child: DataFrame, parent: DataFrame, fk: str, pk: str, keys: list[str] | str, k: int = 5) -> DataFrame:
    """Child rows without a parent (:func:`quality.check_foreign_key`), counted, with the ``keys`` of up to ``k`` of them."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return _sample(quality.check_foreign_key(child, parent, fk, pk), keys, F.array(F.lit(0)), [("foreign_key", fk)], k)
