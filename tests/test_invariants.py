"""Invariants over the TESTDATA-derived fixtures (smallest scale)."""

from pyspark.sql import functions as F

from catalog_sync import fixtures as fx
from catalog_sync.operators import aggregate as agg
from catalog_sync.operators import props as pr
from catalog_sync.operators.topn import topn_with_ties
from catalog_sync.plans.export import as_bi_rows, product_export
from catalog_sync.plans.sync_catalog import sync_catalog

SF = "/root/testdata/sf0.001"


def test_sync_leaves_exactly_the_snapshot_keys(spark):
    export = product_export(fx.catalog(spark, SF).filter(F.col("id") % 7 != 0), fx.characteristics(spark, SF), top=None)
    run = sync_catalog(fx.cat_target(spark, SF), as_bi_rows(export), now=fx.NOW)
    assert run.cleanup.status == "success"
    got = {r[0] for r in run.table.select("id").collect()}
    want = {r[0] for r in export.select("id").collect()}
    assert got == want
    st = run.merge_stats.first()
    assert st["inserted"] + st["matched"] == st["source_rows"] == len(want)


def test_concat_then_parse_round_trips(spark):
    ch = fx.characteristics(spark, SF)
    text = agg.concat_ordered(ch, "article", "name", "value", "sort_order", out_col="product_properties")
    parsed = {(r["product_id"], r["prop_key"], r["prop_value"]) for r in pr.parse_properties(text, "article").collect()}
    original = {(r["article"], r["name"], r["value"]) for r in ch.collect()}
    assert parsed == original


def test_guard_keeps_table_when_snapshot_is_mostly_foreign(spark):
    tgt = fx.cat_target(spark, SF)
    foreign = fx.cat_source(spark, SF, guard_case=True)  # only every 20th id
    run = sync_catalog(tgt, as_bi_rows(foreign.withColumn("product_properties", F.lit("a: b"))), now=fx.NOW)
    assert run.cleanup.status == "error" and run.cleanup.deleted == 0
    assert run.table.count() == tgt.join(foreign, "id", "full_outer").count()


def test_export_cut_before_text_equals_naive_order(spark):
    # naive: join every product's text, drop blanks, then TOPN; the plan cuts first
    products, ch = fx.catalog(spark, SF), fx.characteristics(spark, SF)
    dup = products.filter(F.col("id") <= 3).withColumn("id", F.lit(150).cast("long"))  # ties at a cut
    products = products.unionByName(dup)
    text = agg.concat_ordered(ch, "article", "name", "value", "sort_order", out_col="product_properties")
    naive_all = products.select("id", "description", "brand", "category", "withdrawn_from_range", "item_number").join(
        text.withColumnRenamed("article", "item_number"), "item_number", "left")
    for drop_blank in (True, False):
        naive = naive_all.filter(F.col("product_properties").isNotNull()) if drop_blank else naive_all
        for top in (5, 51, None):
            want = topn_with_ties(naive, top, ["id"], desc=True) if top else naive
            got = product_export(products, ch, top=top, drop_blank=drop_blank)
            assert sorted(map(tuple, got.collect())) == sorted(tuple(r[c] for c in got.columns) for r in want.collect())


def test_sync_cuts_lineage_into_the_checkpoint_folder(spark):
    export = product_export(fx.catalog(spark, SF).filter(F.col("id") % 7 != 0), fx.characteristics(spark, SF), top=None)
    run = sync_catalog(fx.cat_target(spark, SF), as_bi_rows(export), now=fx.NOW, checkpoint=True)
    plan = run.table._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan  # reads the written copy, not the upsert
    assert spark.conf.get("spark.checkpoint.dir") in run.table.inputFiles()[0]


def test_sync_run_releases_its_copy_after_the_write(spark):
    import os

    from catalog_sync.session import scratch_path
    from catalog_sync.sources import files as fs

    export = product_export(fx.catalog(spark, SF).filter(F.col("id") % 7 != 0), fx.characteristics(spark, SF), top=None)
    run = sync_catalog(fx.cat_target(spark, SF), as_bi_rows(export), now=fx.NOW, checkpoint=True)
    copy = run.scratch
    assert copy and os.path.isdir(copy)
    base = scratch_path(spark, "t-released")
    fs.write_snapshot(run.table, base)
    n = fs.read_snapshot(spark, base).count()
    run.release()
    assert not os.path.exists(copy) and run.scratch is None
    assert fs.read_snapshot(spark, base).count() == n > 0
