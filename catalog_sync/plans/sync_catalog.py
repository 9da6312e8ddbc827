"""One sync run: map the export, type it, upsert with change detection,
validate, delete orphans. Returns the new table and a run report.

:func:`sync_version` is the run of a recurring sync: one join, whose rows are
written once as the table's new version, while statistics, profile and guard counts are observed on
them. :func:`sync_catalog` gives the table as a lazy plan instead."""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..operators import aggregate, schema, sync
from ..session import materialize_at, release
from ..sources import files


@dataclass
class SyncRun:
    table: DataFrame
    merge_stats: DataFrame
    validation: DataFrame
    cleanup: sync.CleanupResult
    operations: DataFrame
    scratch: str | None = None
    version: str | None = None

    def release(self) -> None:
        """Delete the merged copy in the checkpoint folder. Call it after the
        table and reports have been written: they are read from that copy."""
        if self.scratch:
            release(self.table.sparkSession, self.scratch)
            self.scratch = None


def sync_catalog(target: DataFrame, export_rows: DataFrame, now, mapping: dict[str, str] | None = None,
                 types: dict[str, str] | None = None, key: str = "id", change_cols=None,
                 ignore_absent: bool = False, min_overlap: float = 0.1, checkpoint: bool = False,
                 partitions: int | None = None, key_rule: str | None = None) -> SyncRun:
    """extract -> map -> cast -> upsert -> validate -> cleanup as one lazy job.

    The guard is decided from the two key columns alone, before anything is
    written; the returned table is one plan (the upsert's join and a filter
    for the deleted rows), so a caller that writes it as the new version
    writes the rows once. Statistics and validation are aggregates over the
    same plan, pruned to the columns they need. ``checkpoint=True`` writes
    the merged table once to ``spark.checkpoint.dir`` and reads all from that copy instead: for
    an export that is costly to compute. ``partitions``: the bucket count of
    a bucketed target (see :func:`sync.upsert`). ``key_rule``: see
    :func:`sync.key_expr`; unless told otherwise text keys are compared as UUIDs where all look
    like UUIDs, else as they are.
    """
    typed, key_rule = _typed(target, export_rows, now, mapping, types, key, ignore_absent, key_rule)
    merged = sync.upsert(target, typed, key, change_cols=change_cols, now=now, with_action=True, partitions=partitions, key_rule=key_rule)
    scratch = counts = None
    if checkpoint:
        merged, scratch = materialize_at(merged, "sync-merged")
    else:
        counts = sync.cleanup_stats(target, typed.withColumn(key, F.col(key).cast(dict(target.dtypes)[key])), key, key_rule).first()
    stats = sync.merge_stats(merged)
    validation = sync.validate_load(aggregate.profile_completeness(merged.drop("_action"), _profiled(merged)), "A")
    cleaned = sync.cleanup_after_upsert(merged, min_overlap=min_overlap, keys=key, counts=counts)
    return SyncRun(cleaned.table, stats, validation, cleaned, _operations(stats, cleaned.stats), scratch)


def sync_version(target: DataFrame, export_rows: DataFrame, base: str, now, mapping: dict[str, str] | None = None,
                 types: dict[str, str] | None = None, key: str = "id", change_cols=None, ignore_absent: bool = False,
                 min_overlap: float = 0.1, partitions: int | None = None, key_rule: str | None = None) -> SyncRun:
    """The same run, its table written as the new current version under ``base``.

    The plan that writes the version is the only one with the join: the guard's counts, the
    statistics and the profile are observed on the merged rows while those without a
    source row are left out of what is written. The observed node is in the stage that writes, so each finished task
    counts once, whatever was retried. If the counts then say that the guard holds (a snapshot that
    shares next to nothing with the table, an error state), the written folder
    is deleted and all rows are written instead; the pointer moves only after that decision, so
    a run that dies leaves the old version current. Arguments as in :func:`sync_catalog`.
    """
    spark = target.sparkSession
    typed, key_rule = _typed(target, export_rows, now, mapping, types, key, ignore_absent, key_rule)
    merged = sync.upsert(target, typed, key, change_cols=change_cols, now=now, with_action=True, partitions=partitions, key_rule=key_rule)
    cols, seen, orphan = _profiled(merged), Observation(), sync.orphan_row([key])
    profile = aggregate.completeness_columns(cols)
    guard = [F.count_if(orphan).alias("orphans"), F.count_if(F.col(key).isNull()).alias("unkeyed")]
    watched = merged.observe(seen, *sync.stat_columns(), *profile, *guard)
    version = files.write_snapshot(watched.filter(~orphan).drop("_action"), base, point=False)
    found = seen.get
    counts = {"total_new": found["source_rows"], "orphans": found["orphans"], "unkeyed": found["unkeyed"]}
    cleaned = sync.cleanup_after_upsert(merged, min_overlap=min_overlap, keys=key, counts=counts)
    if cleaned.status == "error":
        release(spark, os.path.join(base, version))
        version = files.write_snapshot(cleaned.table, base, point=False)
    files.set_current(spark, base, version)

    def row(names: list[str]) -> DataFrame:
        return spark.createDataFrame([tuple(found[n] for n in names)], ", ".join(f"`{n}` long" for n in names))

    stats = row(sync.STAT_NAMES)
    validation = sync.validate_load(row(["total_products", *[f"products_with_{c}" for c in cols]]), "A")
    table = files.read_snapshot(spark, base, version)
    cleaned = sync.CleanupResult(table, cleaned.stats, cleaned.status, cleaned.deleted)
    return SyncRun(table, stats, validation, cleaned, _operations(stats, cleaned.stats), version=version)


def _typed(target: DataFrame, export_rows: DataFrame, now, mapping, types, key: str, ignore_absent: bool, key_rule: str | None) -> tuple[DataFrame, str]:
    """The export under its catalog names and types, and how its keys are compared."""
    mapped = schema.map_columns(export_rows, mapping or schema.PRODUCT_MAPPING, extracted_at=now, ignore_absent=ignore_absent)
    casts = types if types is not None else {c: t for c, t in {"count_rows": "int"}.items() if c in mapped.columns}
    typed = schema.cast_columns(mapped, casts)
    return typed, key_rule or sync.detect_key_rule(target, typed, key)


def _profiled(merged: DataFrame) -> list[str]:
    """The profile's columns that the table has."""
    return [c for c in aggregate.PROFILED if c in merged.columns]


def _operations(stats: DataFrame, cleanup: DataFrame) -> DataFrame:
    """Operation records of the load and of the cleanup."""
    loaded = F.col("source_rows") > 0
    return stats.select(
        F.lit("export").alias("source"), F.lit("catalog").alias("target"),
        F.col("source_rows").alias("total_rows"), F.col("source_rows").alias("processed_rows"),
        F.col("updated_rows"), F.when(loaded, F.lit("success")).otherwise(F.lit("failed")).alias("status"),
        F.when(~loaded, F.lit("empty export")).alias("error"),
    ).unionByName(
        cleanup.select(
            F.lit("catalog").alias("source"), F.lit("catalog").alias("target"),
            F.col("total_existing").alias("total_rows"), F.col("total_existing").alias("processed_rows"),
            F.col("deleted_records").alias("updated_rows"), F.col("status"),
            F.when(F.col("status") != "success", F.col("message")).alias("error"),
        )
    )
