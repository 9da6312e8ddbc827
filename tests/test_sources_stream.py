import os

import pytest
from pyspark.sql import functions as F

from catalog_sync.session import scratch_path
from catalog_sync.sources import export as exp
from catalog_sync.sources import files as fs
from catalog_sync.streaming.stream_sync import stream_sync, version_name


def test_export_roundtrip_keeps_nulls(spark):
    rows = spark.createDataFrame([(1, "a", None), (2, None, "x")], "`T[ID]` long, `T[Name]` string, `[M]` string")
    path = scratch_path(spark, "t-export")
    exp.write_export(rows, path, rows_per_page=1)
    back = exp.read_export(spark, path)
    assert sorted(back.columns) == sorted(rows.columns)
    assert sorted(tuple(r) for r in back.select(*[F.col(f"`{c}`") for c in rows.columns]).collect()) == [(1, "a", None), (2, None, "x")]
    raw = [r[0] for r in spark.read.text(path).collect()]  # one page per row; file order is not fixed
    assert any('"[M]":null' in line for line in raw) and any('"T[Name]":null' in line for line in raw)


def test_export_pages_are_bounded_and_complete(spark):
    import json

    from catalog_sync import fixtures as fx

    rows = fx.table(spark, "/root/testdata/sf0.001", "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    rows = rows.unionByName(rows.limit(700))  # repeated rows must still split into bounded pages
    path = scratch_path(spark, "t-pages")
    exp.write_export(rows, path, rows_per_page=64)
    pages = [json.loads(r[0])["results"][0]["tables"][0]["rows"] for r in spark.read.text(path).collect()]
    assert max(len(p) for p in pages) <= 64
    assert sum(len(p) for p in pages) == rows.count()
    back = exp.read_export(spark, path)
    assert sorted(map(tuple, back.select("l_orderkey", "l_linenumber", "l_returnflag").collect())) == sorted(map(tuple, rows.collect()))


def test_export_missing_level_raises(spark):
    path = scratch_path(spark, "t-bad")
    spark.createDataFrame([('{"results": [{"other": 1}]}',)], "value string").write.text(path)
    with pytest.raises(exp.ExportFormatError):
        exp.read_export(spark, path)


def test_csv_quotes_and_empty(spark, tmp_path):
    path = scratch_path(spark, "t-csv")
    os.makedirs(path)
    with open(os.path.join(path, "x.csv"), "w", encoding="utf-8") as f:
        f.write('id,description,brand,withdrawn_from_range,category,unique_key,updated_at\n')
        f.write('u1,"""Q"" item, with comma",,True,Cat,-5,2025-03-28 03:00:15.594682+00:00\n')
    r = fs.read_catalog_csv(spark, path).first()
    assert r["description"] == '"Q" item, with comma' and r["brand"] is None and r["unique_key"] == -5


def test_snapshot_versions_and_backup(spark):
    base = scratch_path(spark, "t-table")
    df = spark.range(3).withColumnRenamed("id", "k")
    fs.write_snapshot(df, base, "v1")
    fs.write_snapshot(fs.read_snapshot(spark, base).filter("k > 0"), base, "v2")
    assert fs.current_version(spark, base) == "v2" and fs.read_snapshot(spark, base).count() == 2
    p = fs.backup(df, base, "t", "2024-06-01 00:00:00")
    assert p.endswith("t_backup_20240601_000000") and fs.restore(spark, p).count() == 3


def test_stream_sync_once_per_file(spark):
    root = scratch_path(spark, "t-stream")
    tgt = spark.createDataFrame([(1, "a", True), (2, "b", True), (3, "c", True)], "id long, description string, is_vector boolean")
    base = os.path.join(root, "table")
    fs.write_snapshot(tgt, base, "initial")
    snaps = os.path.join(root, "snaps")
    spark.createDataFrame([(1, "a"), (2, "B"), (4, "d")], "id long, description string").coalesce(1).write.parquet(os.path.join(snaps, "d=1"))
    schema = spark.read.parquet(os.path.join(snaps, "d=1")).schema
    ck = os.path.join(root, "ck")
    rep = stream_sync(spark, os.path.join(snaps, "d=*"), schema, base, ck, now="2024-06-01 00:00:00")
    assert len(rep) == 1
    got = {r["id"]: (r["description"], r["is_vector"]) for r in fs.read_snapshot(spark, base).collect()}
    assert got == {1: ("a", True), 2: ("B", False), 4: ("d", False)}
    again = stream_sync(spark, os.path.join(snaps, "d=*"), schema, base, ck, now="2024-06-02 00:00:00")
    assert again == []
    spark.createDataFrame([(1, "a"), (4, "d")], "id long, description string").coalesce(1).write.parquet(os.path.join(snaps, "d=2"))
    third = stream_sync(spark, os.path.join(snaps, "d=*"), schema, base, ck, now="2024-06-02 00:00:00")
    assert len(third) == 1 and sorted(r["id"] for r in fs.read_snapshot(spark, base).collect()) == [1, 4]


def test_half_written_version_is_replaced_committed_one_kept(spark):
    base = scratch_path(spark, "t-partial")
    os.makedirs(os.path.join(base, "v1", "_temporary", "0"))  # a failed attempt's leftovers
    df = spark.range(4).withColumnRenamed("id", "k")
    fs.write_snapshot(df, base, "v1")
    assert fs.is_committed(spark, os.path.join(base, "v1")) and fs.read_snapshot(spark, base).count() == 4
    with pytest.raises(Exception):
        fs.write_snapshot(df.filter("k > 1"), base, "v1")  # never clobber a committed version
    assert fs.read_snapshot(spark, base).count() == 4


def snapshot_run(spark, name):
    """A table with two rows and a first snapshot of many files; paths and a function that syncs."""
    root = scratch_path(spark, name)
    base, snaps = os.path.join(root, "table"), os.path.join(root, "snaps")
    fs.write_snapshot(spark.createDataFrame([(1, "a", True), (2, "b", True)], "id long, description string, is_vector boolean"), base, "initial")
    schema = "id long, description string"

    def arrive(folder, rows, files=3):
        spark.createDataFrame(rows, schema).repartition(files).write.mode("append").parquet(os.path.join(snaps, folder))

    def run(checkpoint="ck"):
        reports = stream_sync(spark, os.path.join(snaps, "d=*"), spark.createDataFrame([], schema).schema, base, os.path.join(root, checkpoint), now="2024-06-01 00:00:00")
        return [r["status"] for r in reports]

    def table():
        return {r["id"]: (r["description"], r["is_vector"]) for r in fs.read_snapshot(spark, base).collect()}

    return arrive, run, table, base, snaps


def test_stream_replay_after_a_crash_mid_write(spark):
    arrive, run, table, base, snaps = snapshot_run(spark, "t-stream-crash")
    arrive("d=1", [(1, "a"), (2, "B")])
    version = version_name(f"file:{snaps}/d=1")
    # an attempt died while writing its version
    os.makedirs(os.path.join(base, version, "_temporary", "0"))
    assert run() == ["success"]
    assert fs.current_version(spark, base) == version
    assert table() == {1: ("a", True), 2: ("B", False)}
    # an attempt died between its write and the switch of the pointer
    arrive("d=2", [(1, "x")])
    later = version_name(f"file:{snaps}/d=2")
    fs.read_snapshot(spark, base).filter("id = 1").write.parquet(os.path.join(base, later))
    assert run() == ["replayed"] and fs.current_version(spark, base) == later


def test_snapshot_of_many_files_is_one_sync(spark):
    arrive, run, table, base, _ = snapshot_run(spark, "t-stream-files")
    arrive("d=1", [(i, f"p{i}") for i in range(1, 201)], files=7)
    assert run() == ["success"]
    assert len(table()) == 200 and table()[1] == ("p1", False)
    arrive("d=2", [(i, f"p{i}") for i in range(1, 199)], files=4)
    assert run() == ["success"] and len(table()) == 198 and run() == []


def test_new_streaming_checkpoint_never_goes_back(spark):
    arrive, run, table, base, _ = snapshot_run(spark, "t-stream-checkpoint")
    arrive("d=1", [(1, "a"), (2, "b")])
    arrive("d=2", [(1, "a2"), (3, "c")])
    assert run() == ["success", "success"]
    current, rows = fs.current_version(spark, base), table()
    assert run("other") == ["already applied", "already applied"]
    assert fs.current_version(spark, base) == current and table() == rows == {1: ("a2", False), 3: ("c", False)}
    arrive("d=3", [(3, "c")])
    assert run("third") == ["already applied", "already applied", "success"] and set(table()) == {3}
    arrive("d=0", [(9, "old")])  # an older snapshot that arrives late
    assert run("third") == ["stale"] and set(table()) == {3}


def test_unfinished_snapshot_waits(spark):
    arrive, run, table, base, snaps = snapshot_run(spark, "t-stream-unfinished")
    arrive("d=1", [(1, "a"), (2, "B")])
    os.remove(os.path.join(snaps, "d=1", "_SUCCESS"))
    with pytest.raises(Exception, match="_SUCCESS"):
        run()
    assert fs.current_version(spark, base) == "initial"
    arrive("d=1", [(3, "c")])  # the rest of the export and its marker
    assert run()[0] == "success" and set(table()) == {1, 2, 3}


def test_stream_of_single_files(spark):
    root = scratch_path(spark, "t-stream-file-unit")
    base, snaps = os.path.join(root, "table"), os.path.join(root, "snaps")
    fs.write_snapshot(spark.createDataFrame([(1, "a")], "id long, description string"), base, "initial")
    spark.createDataFrame([(1, "a"), (5, "e")], "id long, description string").coalesce(1).write.parquet(snaps)
    schema = spark.read.parquet(snaps).schema
    rep = stream_sync(spark, snaps, schema, base, os.path.join(root, "ck"), now="2024-06-01 00:00:00", unit="file")
    assert [r["status"] for r in rep] == ["success"] and sorted(r["id"] for r in fs.read_snapshot(spark, base).collect()) == [1, 5]


def test_stream_sync_leaves_no_merged_copies(spark):
    import glob

    ck = spark.conf.get("spark.checkpoint.dir")
    before = set(glob.glob(os.path.join(ck, "stream-merged-*")))
    root = scratch_path(spark, "t-stream-release")
    base = os.path.join(root, "table")
    fs.write_snapshot(spark.createDataFrame([(1, "a"), (2, "b")], "id long, description string"), base, "initial")
    snaps = os.path.join(root, "snaps")
    spark.createDataFrame([(1, "a"), (3, "c")], "id long, description string").coalesce(1).write.parquet(os.path.join(snaps, "d=1"))
    schema = spark.read.parquet(os.path.join(snaps, "d=1")).schema
    rep = stream_sync(spark, os.path.join(snaps, "d=*"), schema, base, os.path.join(root, "ck"), now="2024-06-01 00:00:00")
    assert [r["status"] for r in rep] == ["success"]
    assert set(glob.glob(os.path.join(ck, "stream-merged-*"))) == before
    assert sorted(r["id"] for r in fs.read_snapshot(spark, base).collect()) == [1, 3]


def test_prune_versions_keeps_the_latest_pointed_ones(spark):
    base = scratch_path(spark, "t-prune")
    df = spark.range(3).withColumnRenamed("id", "k")
    for v in ("v1", "v2", "v3", "v4"):
        fs.write_snapshot(df, base, v)
    fs.set_current(spark, base, "v2")  # a roll-back: v2 is current again
    os.makedirs(os.path.join(base, "v5", "_temporary"))  # a failed attempt, never pointed to
    assert fs.prune_versions(spark, base, keep=2) == ["v1", "v3", "v5"]
    assert fs.current_version(spark, base) == "v2" and fs.read_snapshot(spark, base).count() == 3
    assert sorted(d for d in os.listdir(base) if not d.startswith("_")) == ["v2", "v4"]
