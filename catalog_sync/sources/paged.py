"""Paged exports as a Spark data source (``bi_export_pages``), for batch and streaming reads.

The pages are those of :func:`~catalog_sync.sources.export.write_export`: files of lines, each line one whole envelope. Files are cut into
ranges of pages (``split_bytes``; a page belongs to the range in which it starts), so tasks do not depend on how many pages a file has, and a task holds
one page at a time. The schema given to the reader names the columns that are read; the others are not converted.

``spark.dataSource.register(ExportPages)`` once, then
``spark.read.format("bi_export_pages").schema("`T[id]` long").load(path)`` or ``spark.readStream``… likewise.

* A page is read whole or fails the job, naming its file and byte: text that is not JSON, an envelope without results, tables or rows, a row that is no object, and a value
  that its column's type cannot hold. No row of such a page is returned. Blank lines are no pages.
* A key that a row lacks, and an explicit null, are NULL. Text columns hold other JSON values as their JSON text. Timestamps need a zone, ``timestamp_ntz`` must have none.
* A folder without files gives no rows. Files and folders whose names start with ``_`` or ``.`` are not read.
* The offset of a stream is a number of files, in the natural order of their paths (``run-9`` before ``run-10``), with the last one's path. It counts files of folders that hold
  the marker (option ``marker``, by default ``_SUCCESS``; empty: all files). A file that arrives later but sorts before the offset, or one gone from before it, fails the
  stream: rows are neither lost nor read twice.

Paths are those that pyarrow's file systems open (local, ``file:``, ``hdfs://``, ``s3://``, ``gs://``). Only names and sizes of files reach the driver.
"""

from __future__ import annotations

import decimal
import io
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

from .export import ExportFormatError

SPLIT_BYTES = 64 * 1024 * 1024


@dataclass
class PageRange(InputPartition):
    """The pages of a file that start at a byte from ``start`` up to before ``stop``."""

    path: str
    start: int
    stop: int


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path.removeprefix("file:")


def _natural(name: str) -> list:
    return [(int(p), "") if p.isdigit() else (-1, p) for p in re.split(r"(\d+)", name)]


def _list_files(path: str, marker: str = "") -> list[tuple[str, int]]:
    """``(path below the folder, bytes)`` of its files in natural order; with a marker only of folders that hold it."""
    fs, root = _open(path)
    infos = fs.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True))
    names = {os.path.relpath(i.path, root): i.size for i in infos if i.is_file}
    whole = {os.path.dirname(n) for n in names if os.path.basename(n) == marker}
    kept = [n for n in names if not any(p.startswith(("_", ".")) for p in n.split("/")) and (not marker or os.path.dirname(n) in whole)]
    return [(n, names[n]) for n in sorted(kept, key=_natural)]


def _ranges(path: str, files: list[tuple[str, int]], split: int) -> list[PageRange]:
    return [PageRange(f"{path.rstrip('/')}/{name}", at, min(at + split, size)) for name, size in files for at in range(0, size, split)]


def _page_rows(page: bytes, exact: bool) -> list[dict]:
    try:
        envelope = json.loads(page, parse_float=decimal.Decimal if exact else None)
    except ValueError as e:
        raise ExportFormatError(f"not JSON ({e})") from e
    for level in ("results", "tables", "rows"):
        found = envelope.get(level) if isinstance(envelope, dict) else None
        if not isinstance(found, list) or (level != "rows" and not found):
            raise ExportFormatError(f"without {level}")
        envelope = found if level == "rows" else found[0]
    if not all(isinstance(row, dict) for row in envelope):
        raise ExportFormatError("a row is no object")
    return envelope


def _column(values: list, kind: pa.DataType) -> pa.Array:
    if pa.types.is_string(kind):
        return pa.array([v if v is None or isinstance(v, str) else json.dumps(v, ensure_ascii=False, default=str) for v in values], kind)
    if pa.types.is_temporal(kind):
        return pa.array(values, pa.string()).cast(kind)
    if any(isinstance(v, bool) for v in values) != pa.types.is_boolean(kind) and any(v is not None for v in values):
        raise pa.ArrowInvalid(f"true or false and {kind} do not go together")
    if pa.types.is_integer(kind) and any(isinstance(v, (float, decimal.Decimal)) for v in values):
        raise pa.ArrowInvalid(f"a fraction is no {kind}")
    return pa.array(values, kind)


class _PageReader:
    """Reads page ranges; shared by the batch and the streaming reader."""

    def __init__(self, schema: T.StructType, options: dict):
        if not options.get("path"):
            raise ValueError("bi_export_pages needs a path")
        self.path, self.schema = options["path"], schema
        self.split = int(options.get("split_bytes", SPLIT_BYTES))
        self.marker = options.get("marker", "_SUCCESS")

    def read(self, partition: PageRange | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # Spark's one task of a source without partitions
            return
        kinds = to_arrow_schema(self.schema)
        exact = any(pa.types.is_decimal(k) for k in kinds.types)
        fs, name = _open(partition.path)
        with io.BufferedReader(fs.open_input_file(name), 1 << 20) as file:
            at = partition.start
            if at:  # the page that began before belongs to the range before
                file.seek(at - 1)
                at += len(file.readline()) - 1
            while at < partition.stop and (page := file.readline()):
                if page.strip():
                    try:
                        rows = _page_rows(page, exact)
                        columns = [_column([r.get(f.name) for r in rows], f.type) for f in kinds]
                    except (ExportFormatError, pa.ArrowException, TypeError, OverflowError) as e:
                        raise ExportFormatError(f"page at byte {at} of {partition.path}: {e}") from e
                    if rows:
                        yield pa.RecordBatch.from_arrays(columns, schema=kinds)
                at += len(page)


class _BatchReader(_PageReader, DataSourceReader):
    def partitions(self) -> list[PageRange]:
        return _ranges(self.path, _list_files(self.path), self.split)


class _StreamReader(_PageReader, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {"files": 0, "last": ""}

    def latestOffset(self) -> dict:
        files = _list_files(self.path, self.marker)
        return {"files": len(files), "last": files[-1][0] if files else ""}

    def partitions(self, start: dict, end: dict) -> list[PageRange]:
        files = _list_files(self.path, self.marker)
        for offset in (start, end):
            n = offset["files"]
            if n and (n > len(files) or files[n - 1][0] != offset["last"]):
                raise ExportFormatError(f"{self.path}: file {n} was {offset['last']!r}; a file before it arrived late or is gone")
        return _ranges(self.path, files[start["files"] : end["files"]], self.split)

    def commit(self, end: dict) -> None:
        pass


class ExportPages(DataSource):
    """Envelope pages under a folder; the schema of the columns to read must be given."""

    @classmethod
    def name(cls) -> str:
        return "bi_export_pages"

    def schema(self):
        raise ValueError("bi_export_pages needs the schema of the columns to read")

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _BatchReader(schema, self.options)

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return _StreamReader(schema, self.options)
