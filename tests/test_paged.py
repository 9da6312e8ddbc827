"""Paged exports as a data source: equal to read_export, page ranges, errors by page, streams that resume."""

import datetime as dt
import decimal
import os

import pytest

from catalog_sync import fixtures as fx
from catalog_sync.session import scratch_path
from catalog_sync.sources import export, paged
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def load(spark, path, schema, **options):
    spark.dataSource.register(paged.ExportPages)
    return spark.read.format("bi_export_pages").options(**options).schema(schema).load(path)


def lines(path, name, *pages):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w", encoding="utf-8") as f:
        f.write("\n".join(pages))


def page(rows):
    return export.ENVELOPE_HEAD + ",".join(rows) + export.ENVELOPE_TAIL


@pytest.mark.parametrize("split", [311, 997, 10**9])
def test_equal_to_read_export_for_any_split(spark, split):
    path = scratch_path(spark, "t-pages")
    rows = fx.catalog(spark, SF).select("id", "description", F.col("brand").alias("T[Бренд]"), (F.col("id") / 3).alias("x"), "withdrawn_from_range").limit(60)
    export.write_export(rows.repartition(2), path, rows_per_page=7)
    got = load(spark, path, "withdrawn_from_range boolean, `T[Бренд]` string, id long, x double", split_bytes=split)
    want = export.read_export(spark, path).select(*[F.col(f"`{c}`") for c in got.columns])
    assert sorted(map(tuple, got.collect()), key=lambda r: r[2]) == sorted(map(tuple, want.collect()), key=lambda r: r[2]) and got.count() == 60
    if split == 997:
        assert got.rdd.getNumPartitions() > 2
    assert load(spark, path, "id long").agg(F.sum("id")).first()[0] == rows.agg(F.sum("id")).first()[0]


def test_types_nulls_and_empty(spark):
    path = scratch_path(spark, "t-pages")
    os.makedirs(path)
    assert load(spark, path, "a long").count() == 0
    lines(path, "p.txt", page(['{"a": 1, "d": 0.10, "t": "2024-01-02T03:04:05Z", "s": {"k": [1]}}', '{"a": null}']), "", page([]), page(['{"s": "", "day": "2024-02-29"}']))
    lines(path, "_part.txt", "not a page")
    got = load(spark, path, "a long, d decimal(10,2), t timestamp, s string, day date").orderBy("day", F.col("a").desc()).collect()
    assert [r["a"] for r in got] == [1, None, None] and got[0]["d"] == decimal.Decimal("0.10") and got[0]["s"] == '{"k": [1]}'
    assert got[2]["s"] == "" and got[2]["day"] == dt.date(2024, 2, 29) and got[1]["s"] is None and got[0]["t"].minute == 4
    with pytest.raises(Exception, match="needs the schema"):
        spark.read.format("bi_export_pages").load(path)


@pytest.mark.parametrize("bad,says", [
    ('{"results":[{"tables":[{"rows":[{"a":1}', "not JSON"), ('{"error":"x"}', "without results"), ('{"results":[{"tables":[]}]}', "without tables"),
    ('{"results":[{"tables":[{}]}]}', "without rows"), (page(["7"]), "no object"), (page(['{"a": 1}', '{"a": "x"}']), "page at byte"), (page(['{"a": true}']), "page at byte"), (page(['{"a": 1.5}']), "page at byte"),
])
def test_a_broken_page_fails_whole(spark, bad, says):
    path = scratch_path(spark, "t-pages")
    good = page(['{"a": 3}'])
    lines(path, "p.txt", good, bad, good)
    with pytest.raises(Exception, match=says) as e:
        load(spark, path, "a long").collect()
    assert f"byte {len(good) + 1} of" in str(e.value)


def test_stream_resumes_by_offset_and_loses_nothing(spark):
    spark.dataSource.register(paged.ExportPages)
    path, state = scratch_path(spark, "t-pages"), scratch_path(spark, "t-pages-state")

    def run():
        stream = spark.readStream.format("bi_export_pages").schema("id long").load(path)
        stream.writeStream.option("checkpointLocation", state + "/ck").format("parquet").option("path", state + "/out").trigger(availableNow=True).start().awaitTermination()
        return sorted(r[0] for r in spark.read.schema("id long").parquet(state + "/out").collect())

    def export_run(name, low, high):
        export.write_export(spark.range(low, high), os.path.join(path, name), rows_per_page=3)

    export_run("run-9", 0, 10)
    assert run() == list(range(10))
    export_run("run-10", 10, 25)
    lines(os.path.join(path, "run-11"), "part-0.txt", page(['{"id": 99}']))  # not finished: no marker
    assert run() == list(range(25)) == run()
    lines(os.path.join(path, "run-11"), "_SUCCESS")
    assert run() == [*range(25), 99]
    export_run("run-2", 50, 55)  # sorts before what was read
    with pytest.raises(Exception, match="arrived late or is gone"):
        export_run("run-12", 60, 61)
        run()
