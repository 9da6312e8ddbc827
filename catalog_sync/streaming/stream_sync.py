"""Incremental sync over arriving snapshots with Structured Streaming.

A snapshot is the whole catalog as one export wrote it: a folder of files
(``unit="folder"``, the default; complete when its ``_SUCCESS`` marker is
there) or one file (``unit="file"``). ``readStream`` notices what arrives; a
batch's files only name the snapshots, each of which is then read whole, so a
snapshot of many files that the stream sees in several batches is still one
sync. Files may lie in partition folders of their snapshot: it is the nearest folder upward that
holds a ``_SUCCESS`` marker. Snapshots are applied in order
as ``foreachBatch`` -> upsert with change detection and guarded orphan
cleanup -> ``write_snapshot``.

The order is that of ``order(name)``, a function of the snapshot's name that the caller may give; by default
the natural order of names (``export-9`` before ``export-10``; UUIDs in file names don't count). Where it ties,
the marker's (or file's) modification time decides. The same order alone says
what is stale. Characters of names other than letters, digits and ``=._-`` are seen as ``_``.

Versions are named after their snapshot, not after the batch, so the same
holds under a new streaming checkpoint: a snapshot whose version was
committed and pointed to is not applied again and never becomes current
again; one whose version was committed but not yet pointed to (a crash in between) is pointed to; one
whose version was left half-written is written again; one that is older than the newest applied one is left out as stale.
A batch that meets an unfinished folder fails, and the stream repeats it at its next start.
"""

from __future__ import annotations

import os
import re
import urllib.parse
import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators import sync
from ..sources.files import applied_versions, current_version, is_committed, modified_at, qualified, read_note, read_snapshot, set_current, write_note, write_snapshot

_UUID = re.compile("[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}", re.IGNORECASE)


class UnfinishedSnapshotError(RuntimeError):
    pass


def version_name(snapshot: str) -> str:
    """Version of a snapshot path: its name, for reading, and a checksum of the path, for telling apart."""
    name = os.path.basename(snapshot.rstrip("/"))
    return f"snapshot-{re.sub(r'[^0-9A-Za-z=._-]', '_', name)}-{zlib.crc32(snapshot.encode()):08x}"


def natural_order(name: str) -> tuple:
    """Sort key of a snapshot name: its digit runs count as numbers, UUIDs not at all."""
    return tuple(int(part) if i % 2 else part for i, part in enumerate(re.split(r"([0-9]+)", _UUID.sub("", name))))


def _snapshot_name(version: str) -> str | None:
    found = re.fullmatch(r"snapshot-(.*)-[0-9a-f]{8}", version)
    return found[1] if found else None


def _before_globs(path: str) -> list[str]:
    """The leading components of a path that hold no glob signs."""
    parts = path.rstrip("/").split("/")
    return parts[: next((i for i, p in enumerate(parts) if re.search(r"[*?\[{]", p)), len(parts))]


def apply_snapshot(current: DataFrame, snapshot: DataFrame, key: str, now, change_cols=None, min_overlap: float = 0.1,
                   key_rule: str | None = None) -> tuple[DataFrame, sync.CleanupResult]:
    """One snapshot onto the current table: upsert, then guarded orphan cleanup.

    The guard is decided from the key columns of both sides; the kept rows are
    a filter of the upsert's own plan, so writing them is the only pass over
    the whole table. Returns the merged table and the cleanup.
    """
    rule = key_rule or sync.detect_key_rule(current, snapshot, key)
    merged = sync.upsert(current, snapshot, key, change_cols=change_cols, now=now, with_action=True, key_rule=rule)
    counts = sync.cleanup_stats(current, snapshot, key, rule).first()
    return merged.drop("_action"), sync.cleanup_after_upsert(merged, min_overlap=min_overlap, keys=key, counts=counts)


def stream_sync(spark: SparkSession, snapshot_dir: str, schema: T.StructType, table_base: str, checkpoint: str,
                key: str = "id", now: Callable[[str], str] | str | None = None, change_cols=None,
                min_overlap: float = 0.1, file_format: str = "parquet", await_seconds: float | None = None,
                unit: str = "folder", key_rule: str | None = None, order: Callable[[str], object] = natural_order) -> list[dict]:
    """Sync all snapshots that arrived since the last run; returns one report per snapshot seen.

    ``now`` is a timestamp string or a function of the snapshot's name
    (repeatable results). The table at ``table_base`` must already have a
    current version. ``order``: see the module. ``key_rule``: see :func:`~catalog_sync.operators.sync.detect_key_rule`.
    """
    if unit not in ("folder", "file"):
        raise ValueError(f"unknown unit {unit!r}")
    reports: list[dict] = []
    committed: dict[str, bool] = {}
    fixed = qualified(spark, "/".join(_before_globs(snapshot_dir)) or "/")

    def has_marker(folder: str) -> bool:
        if not committed.get(folder):  # an unfinished one may be finished by the next batch
            committed[folder] = is_committed(spark, folder)
        return committed[folder]

    def snapshot_of(file: str) -> str:
        """The nearest marked folder upward, below the folder that the stream watches; else the file's own."""
        own = at = os.path.dirname(file)
        while not has_marker(at):
            up = os.path.dirname(at)
            if not up.startswith(fixed + "/"):
                return own
            at = up
        return at

    def arrived(snapshot: str) -> int:
        return modified_at(spark, snapshot if unit == "file" else os.path.join(snapshot, "_SUCCESS"))

    def rank_of(version: str, modified: int) -> tuple:
        return order(_snapshot_name(version)), modified

    def newest_applied(applied: set[str]) -> tuple | None:
        named = [v for v in applied if _snapshot_name(v) is not None]
        if not named:
            return None
        last = max(order(_snapshot_name(v)) for v in named)
        return max(rank_of(v, int(read_note(spark, os.path.join(table_base, v)) or 0)) for v in named if order(_snapshot_name(v)) == last)

    def sync_one(snapshot: str, batch_id: int) -> dict:
        name, version = os.path.basename(snapshot), version_name(snapshot)
        report = {"batch_id": batch_id, "snapshot": name, "version": version}
        applied = applied_versions(spark, table_base)
        if version in applied:
            return report | {"status": "already applied"}
        if unit == "folder" and not has_marker(snapshot):
            raise UnfinishedSnapshotError(f"snapshot {snapshot} has no _SUCCESS marker yet")
        modified, newest = arrived(snapshot), newest_applied(applied)
        if newest is not None and rank_of(version, modified) < newest:
            return report | {"status": "stale"}
        where = os.path.join(table_base, version)
        if is_committed(spark, where):
            write_note(spark, where, str(modified))
            set_current(spark, table_base, version)  # written before a crash, not yet pointed to
            return report | {"status": "replayed"}
        rows = spark.read.schema(schema).format(file_format).load(snapshot)
        ts = now(name) if callable(now) else now
        _, cleaned = apply_snapshot(read_snapshot(spark, table_base), rows, key, ts, change_cols, min_overlap, key_rule)
        write_snapshot(cleaned.table, table_base, version, note=str(modified))
        return report | {"status": cleaned.status, "deleted": cleaned.deleted}

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        files = batch.select("_metadata.file_path").distinct()
        if unit == "folder":  # one row per folder
            files = files.selectExpr("regexp_replace(file_path, '[^/]*$', '_') AS file_path").distinct()
        paths = [urllib.parse.unquote(r["file_path"]) for r in files.collect()]
        seen = {path if unit == "file" else snapshot_of(path) for path in paths}
        ready = [(order(_snapshot_name(version_name(s))), arrived(s) if unit == "file" or has_marker(s) else 0, s) for s in seen]
        for _, _, s in sorted(ready):
            reports.append(sync_one(s, batch_id))

    # only the files' names are used: partition folders of several snapshots are no partitions of one table
    files = spark.readStream.schema(schema).format(file_format).option("recursiveFileLookup", True).load(snapshot_dir)
    stream = files.select("*", "_metadata")
    query = (
        stream.writeStream.foreachBatch(run_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination(await_seconds) if await_seconds else query.awaitTermination()
    return reports


__all__ = ["UnfinishedSnapshotError", "apply_snapshot", "current_version", "natural_order", "stream_sync", "version_name"]
