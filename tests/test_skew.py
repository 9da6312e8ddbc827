"""Hot keys: one key holds a third of all rows.

Each operator that groups, windows or joins on a key is run on such input
(derived from TESTDATA lineitem) and compared with a plain-Python brute force;
the plan is checked to cut or pre-aggregate the hot key *before* its shuffle.
"""

from collections import defaultdict

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from catalog_sync import fixtures as fx
from catalog_sync.operators import aggregate as agg
from catalog_sync.operators import props as pr
from catalog_sync.operators import quality as qa
from catalog_sync.operators import similar as sim
from catalog_sync.operators import sync
from catalog_sync.operators import topn as tn

SF = "/root/testdata/sf0.001"
HOT = 0


def hot_lines(spark):
    """(article, sort_order, name, value): every third order's lines share article 0."""
    li = fx.table(spark, SF, "lineitem")
    return li.select(
        F.when(F.col("l_orderkey") % 3 == 0, F.lit(HOT).cast("long")).otherwise(F.col("l_partkey")).alias("article"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("sort_order"),
        F.concat(F.lit("k"), F.col("l_linenumber").cast("string")).alias("name"),
        F.col("l_quantity").cast("string").alias("value"),
    )


def top_by_rank(rs, n):
    """Rows with rank() <= n by sort_order descending (ties at the cut kept)."""
    ordered = sorted(rs, key=lambda r: -r["sort_order"])
    if len(ordered) <= n:
        return ordered
    cut = ordered[n - 1]["sort_order"]
    return [r for r in ordered if r["sort_order"] >= cut]


def grouped(rows, key):
    out = defaultdict(list)
    for r in rows:
        out[r[key]].append(r)
    return out


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def below_exchange(df, marker: str) -> bool:
    """``marker`` appears under (printed after) the first hash exchange of the plan."""
    p = plan(df)
    ex = p.find("Exchange hashpartitioning")
    return ex != -1 and p.find(marker, ex) != -1


def test_fixture_is_hot(spark):
    rows = hot_lines(spark).collect()
    share = sum(r["article"] == HOT for r in rows) / len(rows)
    assert share > 0.3


def test_concat_cap_runs_before_the_shuffle(spark):
    lines = hot_lines(spark)
    got = {r["article"]: r["properties"] for r in agg.concat_ordered(lines, "article", "name", "value", "sort_order", limit=50).collect()}
    want = {}
    for art, rs in grouped(lines.collect(), "article").items():
        items = sorted((r["sort_order"], r["name"], f"{r['name']}: {r['value']}") for r in top_by_rank(rs, 50))
        want[art] = " | ".join(t for _, _, t in items)
    assert got == want
    assert below_exchange(agg.concat_ordered(lines, "article", "name", "value", "sort_order", limit=50), "Partial")


def test_topn_per_hot_group(spark):
    lines = hot_lines(spark)
    df = tn.topn_per_group(lines, "article", 3, "sort_order")
    got = sorted((r["article"], r["sort_order"]) for r in df.collect())
    want = sorted(
        (a, r["sort_order"]) for a, rs in grouped(lines.collect(), "article").items()
        for r in top_by_rank(rs, 3)
    )
    assert got == want
    assert below_exchange(df, "Partial")


def test_hot_duplicate_key_last_wins_and_error_fails(spark):
    lines = hot_lines(spark)
    df = sync.dedupe_source(lines, ["article"], "last", "sort_order")
    got = {r["article"]: r["sort_order"] for r in df.collect()}
    want = {a: max(r["sort_order"] for r in rs) for a, rs in grouped(lines.collect(), "article").items()}
    assert got == want
    assert below_exchange(df, "Partial")
    with pytest.raises(PySparkException):
        sync.upsert(lines.limit(0), lines, "article", now=fx.NOW).collect()


def test_hot_key_counts_are_partial_aggregates(spark):
    lines = hot_lines(spark)
    dup = qa.check_unique(lines, "article")
    got = {r["article"]: r["occurrences"] for r in dup.collect()}
    want = {a: len(rs) for a, rs in grouped(lines.collect(), "article").items() if len(rs) > 1}
    assert got == want
    assert below_exchange(dup, "partial_count")
    props = lines.select(F.col("article").alias("product_id"), F.col("name").alias("prop_key"), F.col("value").alias("prop_value"))
    dp = pr.duplicate_properties(props)
    assert below_exchange(dp, "partial_count")
    want_dp = defaultdict(int)
    for r in lines.collect():
        want_dp[(r["article"], r["name"])] += 1
    assert {(r["product_id"], r["prop_key"]): r["n"] for r in dp.collect()} == {k: v for k, v in want_dp.items() if v > 1}


def test_product_with_most_properties_is_reduced_before_anti_join(spark):
    lines = hot_lines(spark)
    props = lines.select(F.col("article").alias("product_id"), F.col("name").alias("prop_key"), F.col("value").alias("prop_value"))
    products = fx.table(spark, SF, "part").select(F.col("p_partkey").alias("id")).unionByName(spark.range(0, 1))
    out = pr.products_without_properties(products, props)
    have = {r["article"] for r in lines.select("article").collect()}
    want = sorted(r["id"] for r in products.collect() if r["id"] not in have)
    assert sorted(r["id"] for r in out.collect()) == want
    assert plan(out).count("HashAggregate(keys=[id") >= 2  # distinct ids: partial (map side) + final


def test_property_search_groups_by_product_not_key(spark):
    props = fx.props(spark, SF)  # four keys hold every row
    hits = pr.search_by_properties(fx.catalog(spark, SF), props, {"Brand": "Brand#2", "Type": "SMALL"})
    p = plan(hits)
    assert "hashpartitioning(product_id" in p and "hashpartitioning(prop_key" not in p
    rows = props.collect()
    per = defaultdict(dict)
    for r in rows:
        per[r["product_id"]][r["prop_key"]] = r["prop_value"]
    want = sorted(i for i, kv in per.items() if kv.get("Brand") == "Brand#2" and kv.get("Type") == "SMALL")
    assert sorted(r["id"] for r in hits.collect()) == want


def test_hot_parent_delete_rules(spark):
    lines = hot_lines(spark).withColumn("task_id", F.monotonically_increasing_id())
    gone = spark.createDataFrame([(HOT,), (1,), (2,)], "supplier_id long")
    kept = qa.cascade_delete(lines, gone, "article", "supplier_id")
    nulled = qa.set_null_on_delete(lines, gone, "article", "supplier_id")
    all_rows = lines.collect()
    dead = {HOT, 1, 2}
    assert kept.count() == sum(r["article"] not in dead for r in all_rows)
    got = nulled.groupBy(F.col("article").isNull().alias("n")).count().collect()
    assert {r["n"]: r["count"] for r in got} == {True: sum(r["article"] in dead for r in all_rows),
                                                   False: sum(r["article"] not in dead for r in all_rows)}


@pytest.mark.parametrize("block_rows", [32, 37, 45, 64])
def test_hot_vector_ties_fall_to_the_smaller_id(spark, block_rows):
    # a third of the vectors are one point: they share every LSH bucket (a hot bucket)
    e = fx.table(spark, SF, "embeddings").orderBy("vec_id").collect()
    same = [float(x) for x in e[0]["embedding"]]
    rows = [(r["vec_id"], f"p{r['vec_id']}", "B", "C", True, same if i % 3 == 0 else [float(x) for x in r["embedding"]])
            for i, r in enumerate(e)]
    df = spark.createDataFrame(rows, "id long, description string, brand string, category string, is_vector boolean, vector array<float>")
    hot_ids = sorted(r[0] for i, r in enumerate(rows) if i % 3 == 0)
    exact = sim.similar_for_all(df, k=3, w=0.0, block_rows=block_rows, chunk_rows=20)
    approx = sim.similar_for_all_lsh(df, k=3, w=0.0, bands=4, rows_per_bucket=16, block_rows=block_rows)
    for out in (exact, approx):
        got = defaultdict(list)
        for r in out.filter(F.col("id").isin(hot_ids)).orderBy("id", "rank").collect():
            got[r["id"]].append(r["neighbor_id"])
        for i in hot_ids:  # distance 0 to every other copy; ties by id
            assert got[i] == [j for j in hot_ids if j != i][:3]
        assert out.filter(F.col("id").isin(hot_ids)).agg(F.max("vector_distance")).first()[0] == 0.0


def test_diff_spreads_null_keys(spark):
    # a third of both exports have a blank key: they never match and must not share one reducer
    c = fx.catalog(spark, SF).select("id", "description", "brand")
    blank = F.when(F.col("id") % 3 == 0, F.lit(None).cast("long")).otherwise(F.col("id")).alias("id")
    old = c.filter(F.col("id") % 5 != 0).select(blank, "description", "brand")
    new = c.filter(F.col("id") % 7 != 0).select(blank, F.concat("description", F.lit("!")).alias("description"), "brand")
    d = sync.diff_snapshots(old, new, "id")
    assert "__salt" in plan(d) and "hashpartitioning(id" in plan(d)
    got = {}
    for r in d.groupBy("status").count().collect():
        got[r["status"]] = r["count"]
    o, n = old.collect(), new.collect()
    ok, nk = {r["id"] for r in o if r["id"] is not None}, {r["id"] for r in n if r["id"] is not None}
    want = {
        "new": len(nk - ok) + sum(r["id"] is None for r in n),
        "deleted": len(ok - nk) + sum(r["id"] is None for r in o),
        "changed": len(ok & nk),
    }
    assert got == want
