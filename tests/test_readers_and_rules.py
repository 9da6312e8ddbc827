"""Readers that refuse broken input, key rules, mappings, bounds, and what a run leaves behind."""

import os
import subprocess
import sys
import types

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog_sync import fixtures as fx
from catalog_sync import session
from catalog_sync.functions.names import normalize_name, normalize_names
from catalog_sync.operators import aggregate as agg
from catalog_sync.operators import props as pr
from catalog_sync.operators import schema as sch
from catalog_sync.operators import sync
from catalog_sync.plans.export import as_bi_rows, export_lookup, product_export
from catalog_sync.plans.sync_catalog import sync_catalog
from catalog_sync.session import scratch_path
from catalog_sync.sources import export as exp
from catalog_sync.sources import files as fs

SF = "/root/testdata/sf0.001"
PAGE = '{"results":[{"tables":[{"rows":[{"a":1,"b":"x"},{"a":2,"b":null}]}]}]}'
ROW = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("schema", [None, ROW])
@pytest.mark.parametrize("bad", ['{"error":{"code":"x"}}', PAGE[:40], "not json", '{"results":[]}', '{"results":[{"tables":[]}]}', '{"results":[{"tables":[{}]}]}', '{"results":[{}]}'])
def test_a_broken_page_fails_the_export(spark, tmp_path, schema, bad):
    (tmp_path / "e.json").write_text(PAGE + "\n" + bad + "\n" + PAGE + "\n")
    with pytest.raises(Exception):
        exp.read_export(spark, str(tmp_path), schema).collect()
    with pytest.raises(Exception):
        exp.read_export(spark, str(tmp_path), schema).count()


@pytest.mark.parametrize("schema", [None, ROW])
def test_whole_pages_are_read(spark, tmp_path, schema):
    (tmp_path / "e.json").write_text(PAGE + "\n\n" + PAGE.replace('{"a":1,"b":"x"},{"a":2,"b":null}', "") + "\n" + PAGE + "\n")
    assert sorted((r["a"], r["b"]) for r in exp.read_export(spark, str(tmp_path), schema).collect()) == [(1, "x"), (1, "x"), (2, None), (2, None)]
    one = tmp_path / "whole"
    one.mkdir()
    (one / "p.json").write_text(PAGE.replace("[{", "[\n{"))
    assert exp.read_export(spark, str(one), schema, multi_line=True).count() == 2
    only_error = tmp_path / "error"
    only_error.mkdir()
    (only_error / "e.json").write_text('{"error":1}')
    with pytest.raises(Exception):
        exp.read_export(spark, str(only_error), schema).collect()


def test_csv_with_newlines_is_refused_unless_asked_for(spark, tmp_path):
    (tmp_path / "c.csv").write_text('id,description,brand,withdrawn_from_range,category,unique_key,updated_at\n1,"two\nlines",B,true,C,5,\n')
    with pytest.raises(Exception):
        fs.read_catalog_csv(spark, str(tmp_path)).collect()
    assert fs.read_catalog_csv(spark, str(tmp_path), multi_line=True).first()["description"] == "two\nlines"


def test_mapping_last_source_wins_with_null(spark):
    df = spark.createDataFrame([(1, 2)], "`T[a]` int, `T.x[b.c]` int")
    assert sch.map_columns(df, {"T[a]": "v", "T[gone]": "v"}).first()["v"] is None
    assert sch.map_columns(df, {"T[gone]": "v", "T[a]": "v"}).first()["v"] == 1
    assert sch.map_columns(df, {"T[a]": "v", "T[gone]": "v"}, ignore_absent=True).first()["v"] == 1
    assert sch.map_columns(df, {"T.x[b.c]": "v"}).first()["v"] == 2


def test_names():
    assert normalize_name("A[b c][d]", bracket=True) == "b_c" and normalize_name("A[open", bracket=True) == "aopen"
    assert normalize_names(["a", "A", "a_1", "a", "!!!", "?"]) == ["a", "a_1", "a_1_1", "a_2", "column", "column_1"]


def test_uuid_keys(spark):
    cols = "id string, description string, is_vector boolean"
    target = spark.createDataFrame([(" AB-1", "x", True), ("cd-2", "y", True), ("ef-3", "z", True)], cols)
    source = spark.createDataFrame([("ab-1 ", "x"), ("CD-2", "new")], "id string, description string")
    got = {r["id"]: (r["description"], r["is_vector"]) for r in sync.upsert(target, source, "id", now=fx.NOW, key_rule="uuid").collect()}
    assert got == {" AB-1": ("x", True), "cd-2": ("new", False), "ef-3": ("z", True)}
    assert [r["id"] for r in sync.find_orphans(target, source, "id", key_rule="uuid").collect()] == ["ef-3"]
    assert sync.cleanup_orphans(target, source, "id", key_rule="uuid").deleted == 1
    with pytest.raises(Exception, match="duplicate source key"):
        sync.upsert(target, source.union(spark.createDataFrame([("AB-1", "q")], "id string, description string")), "id", key_rule="uuid").collect()
    assert sync.upsert(target, source, "id", now=fx.NOW).count() == 5  # exact keys: nothing matches
    with pytest.raises(ValueError):
        sync.key_expr("id", "other")


def test_sync_deletes_only_what_vanished(spark):
    # the export has more rows than the old default cap would have let through
    target = spark.range(1, 16_002).select("id", F.concat(F.lit("p"), "id").alias("description"), F.lit(True).alias("is_vector"))
    rows = spark.range(1, 16_001).select("id", F.concat(F.lit("p"), "id").alias("description"), F.lit("B").alias("brand"), F.lit("C").alias("category"),
                                         F.lit(False).alias("withdrawn_from_range"), F.col("id").cast("string").alias("item_number"))
    lines = rows.select(F.col("item_number").alias("article"), F.lit(1).alias("sort_order"), F.lit("Brand").alias("name"), F.lit("B").alias("value"))
    run = sync_catalog(target, as_bi_rows(product_export(rows, lines)), now=fx.NOW)
    assert run.cleanup.deleted == 1 and run.table.count() == 16_000 and run.scratch is None
    assert run.cleanup.stats.first()["final_count"] == 16_000
    again = sync_catalog(target, as_bi_rows(product_export(rows, lines)), now=fx.NOW, checkpoint=True)
    assert again.cleanup.stats.first() == run.cleanup.stats.first()
    again.release()


def test_sync_is_one_plan_to_write(spark):
    export = as_bi_rows(product_export(fx.catalog(spark, SF), fx.characteristics(spark, SF)))
    text = plan(sync_catalog(fx.cat_target(spark, SF), export, now=fx.NOW).table)
    assert text.count("FullOuter") == 1 and "sync-merged" not in text


def test_stamp_covers_unchanged_matches(spark):
    merged = sync.upsert(fx.cat_target(spark, SF), fx.cat_source(spark, SF), "id", now=fx.NOW, with_action=True)
    out = sch.stamp(merged, "upload_timestamp", fx.NOW, when=F.col("_action") != sync.ACTION_KEEP)
    by = {r["_action"]: r["n"] for r in out.filter("upload_timestamp IS NULL").groupBy("_action").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert set(by) == {sync.ACTION_KEEP} and out.filter(F.col("_action") == sync.ACTION_SAME).count() > 0


def test_repair_counts_what_still_starts_with_a_pipe(spark):
    rows = [(1, "| Size", "L"), (1, "a|b", "x"), (2, "||", "only pipes"), (3, "Fine", "y")]
    props = spark.createDataFrame(rows, "product_id long, prop_key string, prop_value string").withColumn("updated_at", F.lit(fx.TARGET_LOADED_AT).cast("timestamp_ntz"))
    table, stats = pr.repair_property_keys(props, fx.NOW)
    assert sorted((r["product_id"], r["prop_key"]) for r in table.collect()) == [(1, "Size"), (1, "a|b"), (2, ""), (3, "Fine")]
    assert tuple(stats.first()) == (2, 2, 0)


def test_property_map_keeps_the_last_of_a_repeated_key(spark):
    props = spark.createDataFrame([(1, "k", "old", 1), (1, "k", "new", 2), (1, "j", "z", 1), (2, "k", None, 1)], "product_id long, prop_key string, prop_value string, pos int")
    assert {r["product_id"]: r["properties"] for r in pr.property_map(props, "pos").collect()} == {1: {"j": "z", "k": "new"}, 2: {"k": None}}
    assert pr.property_map(props).filter("product_id = 1").first()["properties"]["k"] == "old"
    with pytest.raises(Exception, match="more than 1 properties"):
        pr.property_map(props, "pos", max_items=1).collect()


def test_concat_bounds_fail_instead_of_dropping(spark):
    df = spark.createDataFrame([("a", "n", str(i), 1) for i in range(50)] + [("b", "n", "v", 1)], "article string, name string, value string, o int")
    text = {r["article"]: r["properties"] for r in agg.concat_ordered(df, "article", "name", "value", "o").collect()}
    assert text["a"].count("n: ") == 50
    with pytest.raises(Exception, match="more than 49 items"):
        agg.concat_ordered(df, "article", "name", "value", "o", max_items=49).collect()
    assert agg.concat_ordered(df, "article", "name", "value", "o", max_items=50).count() == 2


def test_schema_drift_keeps_files_of_one_name_apart(spark, tmp_path):
    for day, line in ((1, '{"k":1,"x":2}'), (2, '{"k":1,"y":2}'), (3, "{}")):
        (tmp_path / f"day={day}").mkdir()
        (tmp_path / f"day={day}" / "a.json").write_text(line + "\n" + line + "\n")
    rows = spark.read.text(str(tmp_path / "day=*" / "a.json"))
    got = {(r["file"].split("/")[-2], r["action"], r["column"]) for r in sch.schema_drift(rows, [("k", "bigint")]).collect()}
    assert got == {("day=1", "extra", "x"), ("day=2", "extra", "y"), ("day=3", "add", "k")}


def test_property_stats_does_not_expand(spark):
    assert "Expand" not in plan(pr.property_stats(fx.props(spark, SF)))
    empty = pr.property_stats(spark.createDataFrame([], "product_id long, prop_key string, prop_value string")).first()
    assert tuple(empty) == (0, 0, 0)


def test_lookup_reaches_both_scans(spark):
    base = scratch_path(spark, "t-lookup")
    fx.catalog(spark, SF).write.parquet(f"{base}/c")
    fx.characteristics(spark, SF).write.parquet(f"{base}/x")
    out = export_lookup(spark.read.parquet(f"{base}/c"), spark.read.parquet(f"{base}/x"), "IT-42")
    assert out.count() == 1 and "Brand: " in out.first()["product_properties"]
    text = plan(out)
    assert "EqualTo(item_number,IT-42)" in text and "EqualTo(article,IT-42)" in text
    assert export_lookup(fx.catalog(spark, SF), fx.characteristics(spark, SF), "IT-9").count() == 0  # no characteristics


def test_checkpoint_folder_must_be_set_on_a_cluster():
    def fake(master):
        context = types.SimpleNamespace(master=master, getCheckpointDir=lambda: None)
        return types.SimpleNamespace(conf=types.SimpleNamespace(get=lambda *_: None), sparkContext=context)

    for master in ("spark://host:7077", "yarn", "k8s://x", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.ensure_checkpoint_dir(fake(master))


def test_nothing_is_left_after_a_run(tmp_path):
    code = f"""
import sys
sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", "file://{tmp_path}/ck").getOrCreate()
from catalog_sync.plans import registered
for name in ("write_snapshot", "stream_sync", "similar_for_all_lsh"):
    assert registered.QUERIES[name](spark, {SF!r}).count() > 0
"""
    (tmp_path / "ck").mkdir()
    subprocess.run([sys.executable, "-c", code], check=True, timeout=300, capture_output=True)
    left = [os.path.join(d, f) for d, _, names in os.walk(tmp_path / "ck") for f in names]
    assert left == []
