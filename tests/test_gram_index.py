"""The gram index against the scan: wildcards, other scripts, short patterns, updates, and what a search reads."""

import os
import random

import pytest

from catalog_sync import fixtures as fx
from catalog_sync.operators import filters, gram_index
from catalog_sync.session import scratch_path
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
WORDS = ["Кран", "шаровой", "VALVE", "Straße", "ΑΣΟΣ", "ΟΔΟΣ", "İstanbul", "100%", "a_b", "c\\d", "😀😁😂", "x", "1/2\"", "水龙头阀", "KKelvin"]
PATTERNS = ["%кран%", "%КРАН ш%", "%va_ve%", "%strasse%", "%STRAßE%", "%ασος%", "%ΟΔΟΣ%", "%οδος%", "%istanbul%", "%İst%", "%100\\%%", "%100%%", "%a\\_b%", "%a_b%",
            "%c\\\\d%", "%😀😁😂%", "%龙头阀%", "%x%", "%", "", "___", "%no such%", "кран%", "%kkelvin", "%\"%", "%ан ша%ова_%"]


def texts(seed, n):
    rnd = random.Random(seed)
    return [(i, rnd.choice([None, "", "ab"]) if i % 9 == 0 else " ".join(rnd.choices(WORDS, k=rnd.randint(1, 6)))) for i in range(n)]


def ids(df):
    return sorted((r["id"] is not None, r["id"]) for r in df.collect())


def test_equal_to_the_scan_for_every_pattern_and_after_an_update(spark):
    rows = texts(1, 300) + [(None, "Кран без номера"), (7, "второй кран"), (7, "второй кран")]
    df = spark.createDataFrame(rows, "id long, t string").withColumn("gram", F.lit("own column"))
    base = scratch_path(spark, "t-gram")
    gram_index.write_index(df, base, "id", "t", blocks=64)
    for p in PATTERNS:
        assert ids(gram_index.search(spark, base, p, "t")) == ids(df.filter(F.col("t").ilike(p))), p
    assert gram_index.search(spark, base, "%", "t").columns == df.columns
    # texts changed, rows gone and rows new
    new = [(i, "заменён VALVE" if (i or 1) % 50 == 0 else t) for i, t in rows if (i or 0) % 77 != 3] + [(1000, "совсем новый")]
    changed = [(i,) for i, _ in rows if i is not None and ((i or 1) % 50 == 0 or i % 77 == 3)] + [(1000,)]
    df2 = spark.createDataFrame(new, "id long, t string").withColumn("gram", F.lit("own column"))
    touched = gram_index.update_index(df2, base, spark.createDataFrame(changed, "id long"), "id", "t", blocks=64)
    assert 0 < len(touched) < 64
    for p in [*PATTERNS[::4], "%valve%", "%заменён%", "%новый%"]:
        assert ids(gram_index.search(spark, base, p, "t")) == ids(df2.filter(F.col("t").ilike(p))), p
    assert gram_index.update_index(df2, base, spark.createDataFrame([], "id long"), "id", "t", blocks=64) == []


def test_empty_table_long_text_and_bounds(spark):
    base = scratch_path(spark, "t-gram-long")
    gram_index.write_index(spark.createDataFrame([], "id long, t string"), base, "id", "t", blocks=4)
    assert gram_index.candidate_blocks(spark, base, "%abc%") == []
    assert gram_index.search(spark, base, "%abc%", "t").count() == 0 and gram_index.search(spark, base, "%", "t").columns == ["id", "t"]
    filled = spark.createDataFrame([(5, "was empty")], "id long, t string")
    assert len(gram_index.update_index(filled, base, filled, "id", "t", blocks=4)) == 1
    assert gram_index.search(spark, base, "%EMPTY%", "t").count() == 1
    gram_index.update_index(filled.limit(0), base, filled, "id", "t", blocks=4)
    assert gram_index.search(spark, base, "%", "t").count() == 0
    long = spark.createDataFrame([(1, "ab " * 700_000 + "needle")], "id long, t string")
    base = scratch_path(spark, "t-gram-long")
    gram_index.write_index(long, base, "id", "t", blocks=4)
    assert gram_index.search(spark, base, "%NEEDLE", "t").count() == 1 and gram_index.search(spark, base, "%needles%", "t").count() == 0
    with pytest.raises(ValueError):
        gram_index.write_index(long, base, "id", "t", blocks=gram_index.MAX_BLOCKS + 1)


def test_a_search_reads_candidate_blocks_only(spark):
    v = fx.vectors(spark, SF).select("id", "description", "brand", "is_vector")
    base = scratch_path(spark, "t-gram-plan")
    gram_index.write_index(v, base, blocks=64)
    rare = v.orderBy("id").first()["description"]
    blocks = gram_index.candidate_blocks(spark, base, f"%{rare}%")
    hit = gram_index.search(spark, base, f"%{rare}%")
    plan = hit._jdf.queryExecution().executedPlan().toString()
    assert 0 < len(blocks) < 64 and "PartitionFilters" in plan and ids(hit) == ids(v.filter(F.col("description").ilike(f"%{rare}%")))
    read = {os.path.basename(os.path.dirname(r[0])) for r in hit.select(F.input_file_name()).distinct().collect()}
    assert read <= {f"__block={b}" for b in blocks}
    assert [tuple(r) for r in gram_index.search_text(spark, base, "re", limit=5).select("id").collect()] == [tuple(r) for r in filters.search_text(v, "re", limit=5).select("id").collect()]
