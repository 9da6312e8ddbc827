"""Catalog files and tables: snapshot CSV, ad-hoc reads, versioned snapshots,
backups. All paths should live on shared storage (e.g. under the cluster's
``spark.checkpoint.dir`` in tests); nothing here uses a machine-local folder."""

from __future__ import annotations

import datetime as _dt
import os
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CATALOG_CSV_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("brand", T.StringType()),
    T.StructField("withdrawn_from_range", T.BooleanType()),
    T.StructField("category", T.StringType()),
    T.StructField("unique_key", T.LongType()),
    T.StructField("updated_at", T.TimestampType()),
])


#: A line that ends within a quoted field: whole fields and their commas, then a quote that no other closes.
OPEN_QUOTE = r'^(?:(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+|[^",][^,]*+|),)*+"[^"]*+(?:""[^"]*+)*+$'


def read_catalog_csv(spark: SparkSession, path: str, schema: T.StructType = CATALOG_CSV_SCHEMA,
                     multi_line: bool = False) -> DataFrame:
    """Snapshot CSV: header, UTF-8, RFC-4180 doubled quotes; an empty field is NULL.

    Files are split into byte ranges across tasks, and a line is a record. A record that a quoted
    newline cuts in two fails the read, whatever columns the query asks for: each physical line is read whole, checked for an open quote,
    parsed with all its columns (``FAILFAST``) and only then projected. Only for such files pass ``multi_line=True``, which reads
    each file in one task, so large exports should then arrive as many files.
    """
    how = {"quote": '"', "escape": '"', "mode": "FAILFAST"}
    if multi_line:
        return spark.read.schema(schema).options(header=True, multiLine=True, encoding="UTF-8", columnPruning=False, **how).csv(path)
    # the CSV source with signs that no text holds: it drops each file's header and blank lines, and splits files
    lines = spark.read.schema("line string").options(header=True, encoding="UTF-8", sep="\x01", quote="", escape="\x02", mode="FAILFAST").csv(path)
    line = F.col("line")
    cut = F.assert_true(~(line.contains('"') & line.rlike(OPEN_QUOTE)), F.lit("a quoted newline cuts a record in two: read with multi_line=True"))
    whole = lines.filter(cut.isNull())
    # a generator is evaluated once a row and never pruned
    return whole.select(F.inline(F.array(F.from_csv(line, _ddl(schema), how))))


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def write_catalog_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"').csv(path)


def read_table(spark: SparkSession, name_or_query: str) -> DataFrame:
    """A table / view by name, or the rows of an ad-hoc SELECT."""
    text = name_or_query.strip()
    if text.lower().startswith(("select", "with")):
        return spark.sql(text)
    return spark.table(text)


_POINTERS = "_pointers"
_POINTER_SCHEMA = "switched_at string, version string"


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop_path(spark, path)
    return bool(fs.exists(p))


def is_committed(spark: SparkSession, path: str) -> bool:
    """A folder a Spark write job finished: the committer's ``_SUCCESS`` marker is there."""
    fs, p = _hadoop_path(spark, path)
    return bool(fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its scheme, as Spark names the files it reads."""
    fs, p = _hadoop_path(spark, path)
    return fs.makeQualified(p).toString()


def modified_at(spark: SparkSession, path: str) -> int:
    """Modification time of a file in milliseconds."""
    fs, p = _hadoop_path(spark, path)
    return fs.getFileStatus(p).getModificationTime()


_NOTE = "_note"  # a name that Spark's readers pass over


def write_note(spark: SparkSession, path: str, text: str) -> None:
    """A short text beside the data of a version folder."""
    fs, p = _hadoop_path(spark, os.path.join(path, _NOTE))
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_note(spark: SparkSession, path: str) -> str | None:
    """The text of :func:`write_note`; None for a folder without one."""
    fs, p = _hadoop_path(spark, os.path.join(path, _NOTE))
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_snapshot(df: DataFrame, base: str, version: str | None = None, note: str | None = None, point: bool = True) -> str:
    """Write ``df`` as a new version under ``base`` and switch the pointer to it.

    The data lands in its own folder first; only then the small pointer is
    replaced, so readers see the old or the new version, never a mix, and a
    table can be rewritten from a plan that reads its current version. A
    committed version is never overwritten; the leftovers of a failed attempt
    at the same version (no ``_SUCCESS`` marker) are replaced. ``note``: see :func:`write_note`.
    ``point=False`` leaves the pointer where it is.
    """
    spark = df.sparkSession
    version = version or f"v-{_dt.datetime.now(_dt.timezone.utc).strftime('%Y%m%dT%H%M%S')}-{uuid.uuid4().hex[:8]}"
    path = os.path.join(base, version)
    partial = path_exists(spark, path) and not is_committed(spark, path)
    df.write.mode("overwrite" if partial else "errorifexists").parquet(path)
    if note is not None:
        write_note(spark, path, note)
    if point:
        set_current(spark, base, version)
    return version


def set_current(spark: SparkSession, base: str, version: str) -> None:
    """Point ``base`` at ``version``: append one line to the pointer log.

    An append becomes visible only when its job commits, and nothing is
    deleted, so a crash during the switch leaves the previous pointer in force
    (an overwrite would delete the old pointer before writing the new one).
    """
    entry = (f"{time.time_ns():020d}", version)
    spark.createDataFrame([entry], _POINTER_SCHEMA).coalesce(1).write.mode("append").json(os.path.join(base, _POINTERS))


def current_version(spark: SparkSession, base: str) -> str | None:
    """The version of the latest committed pointer entry (the log is tiny)."""
    path = os.path.join(base, _POINTERS)
    if not path_exists(spark, path):
        return None
    latest = spark.read.schema(_POINTER_SCHEMA).json(path).orderBy(F.col("switched_at").desc()).limit(1).collect()
    return latest[0]["version"] if latest else None


def applied_versions(spark: SparkSession, base: str) -> set[str]:
    """All versions that were ever current (the pointer log holds one small line per switch)."""
    path = os.path.join(base, _POINTERS)
    if not path_exists(spark, path):
        return set()
    return {r["version"] for r in spark.read.schema(_POINTER_SCHEMA).json(path).select("version").distinct().collect()}


def prune_versions(spark: SparkSession, base: str, keep: int = 3) -> list[str]:
    """Delete version folders under ``base`` except the ``keep`` most recently
    pointed-to versions (the current one always among them). Folders never
    pointed to (a failed attempt's leftovers) go too. Run it between syncs:
    a version being written at the same time has no pointer yet. Returns the
    deleted version names.
    """
    if keep < 1:
        raise ValueError("keep must be >= 1: the current version is never deleted")
    path = os.path.join(base, _POINTERS)
    if not path_exists(spark, path):
        return []
    log = spark.read.schema(_POINTER_SCHEMA).json(path).orderBy(F.col("switched_at").desc()).collect()
    kept: list[str] = []
    for r in log:  # the log holds one small line per switch
        if r["version"] not in kept:
            kept.append(r["version"])
        if len(kept) == keep:
            break
    fs_, root = _hadoop_path(spark, base)
    deleted = []
    for st in fs_.listStatus(root):
        name = st.getPath().getName()
        if st.isDirectory() and not name.startswith(("_", ".")) and name not in kept:
            fs_.delete(st.getPath(), True)
            deleted.append(name)
    return sorted(deleted)


def read_snapshot(spark: SparkSession, base: str, version: str | None = None) -> DataFrame:
    version = version or current_version(spark, base)
    if version is None:
        raise FileNotFoundError(f"no snapshot under {base}")
    return spark.read.parquet(os.path.join(base, version))


def write_bucketed_version(df: DataFrame, table: str, keys: list[str] | str, buckets: int, base: str,
                           version: str | None = None) -> str:
    """Write ``df`` as a new version of catalog table ``table``, bucketed and sorted by ``keys``.

    The data goes to ``<base>/<version>`` (shared storage) as table
    ``<table>__<version>``; then the view ``<table>`` is re-pointed to it, so
    readers see the old or the new version. A recurring upsert that reads
    ``spark.table(table)`` as its target and passes ``partitions=buckets``
    joins without shuffling the target: only the new snapshot is shuffled,
    once. Returns the physical table name.
    """
    spark = df.sparkSession
    keys = [keys] if isinstance(keys, str) else list(keys)
    version = version or f"v{_dt.datetime.now(_dt.timezone.utc).strftime('%Y%m%dT%H%M%S')}_{uuid.uuid4().hex[:8]}"
    physical = f"{table}__{version}"
    (df.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", os.path.join(base, version))
     .mode("errorifexists").saveAsTable(physical))
    spark.sql(f"CREATE OR REPLACE VIEW `{table}` AS SELECT * FROM `{physical}`")
    return physical


def backup(df: DataFrame, base: str, name: str, ts: str | _dt.datetime) -> str:
    """Copy a table to ``<base>/<name>_backup_<YYYYmmdd_HHMMSS>`` and return that path."""
    stamp = ts.strftime("%Y%m%d_%H%M%S") if isinstance(ts, _dt.datetime) else _dt.datetime.fromisoformat(str(ts)).strftime("%Y%m%d_%H%M%S")
    path = os.path.join(base, f"{name}_backup_{stamp}")
    df.write.mode("errorifexists").parquet(path)
    return path


def restore(spark: SparkSession, backup_path: str, base: str | None = None) -> DataFrame:
    """Read a backup; with ``base`` it also becomes the current snapshot version there."""
    df = spark.read.parquet(backup_path)
    if base is not None:
        write_snapshot(df, base)
        return read_snapshot(spark, base)
    return df


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict[str, str] | None = None,
              partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
              num_partitions: int = 64, fetch_size: int = 10_000) -> DataFrame:
    """Read a database table in parallel: ``num_partitions`` range slices of a
    numeric/date ``partition_column`` between ``lower`` and ``upper`` (bounds
    only set the stride; no row is dropped). Filters and projections on the
    result are pushed into the database query by Spark's JDBC source.
    Needs a reachable database and its driver jar; not exercised in the tests.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).option("fetchsize", fetch_size)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column is not None:
        reader = (reader.option("partitionColumn", partition_column).option("lowerBound", lower)
                  .option("upperBound", upper).option("numPartitions", num_partitions))
    return reader.load()
