"""Delete closure, bitmap index, discovered types, digest tree and sketches against plain Python."""

import json
import os
import random

import pytest

from catalog_sync import fixtures as fx
from catalog_sync.operators import closure, digest_tree, discover, prop_index, schema, sketches, sync
from catalog_sync.plans import registered
from catalog_sync.session import scratch_path
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
FK = closure.ForeignKey


def plain_closure(tables, keys, references, deleted):
    gone = {t: {k for k in deleted.get(t, ()) if k in {r[keys[t]] for r in tables[t]}} for t in tables}
    while True:
        before = sum(map(len, gone.values()))
        for r in references:
            if r.on_delete == "cascade":
                gone[r.child] |= {x[keys[r.child]] for x in tables[r.child] if x[r.column] in gone[r.parent] and x[keys[r.child]] is not None}
        if sum(map(len, gone.values())) == before:
            break
    out = {}
    for t, rows in tables.items():
        kept = [dict(x) for x in rows if x[keys[t]] not in gone[t] and not any(r.child == t and r.on_delete == "cascade" and x[r.column] in gone[r.parent] for r in references)]
        for r in references:
            if r.child == t and r.on_delete == "set_null":
                for x in kept:
                    x[r.column] = None if x[r.column] in gone[r.parent] else x[r.column]
        out[t] = sorted(map(str, (tuple(x.values()) for x in kept)))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_closure_over_random_graphs_with_cycles(spark, seed):
    rng = random.Random(seed)
    pick = lambda n: rng.choice([None, rng.randrange(n)])
    tables = {"a": [{"id": i, "up": pick(40), "b_id": pick(30)} for i in range(40)], "b": [{"id": i, "a_id": pick(45), "c_id": pick(30)} for i in range(30)],
              "c": [{"id": rng.choice([i, None]), "b_id": pick(30), "a_id": 3 if i % 3 == 0 else pick(40)} for i in range(30)]}  # a third reference one row
    references = [FK("a", "up", "a"), FK("a", "b_id", "b", "set_null"), FK("b", "a_id", "a"), FK("b", "c_id", "c", "set_null"), FK("c", "b_id", "b"), FK("c", "a_id", "a", "set_null")]
    keys = dict.fromkeys(tables, "id")
    frames = {t: spark.createDataFrame([tuple(r.values()) for r in rows], ", ".join(f"{c} long" for c in rows[0])) for t, rows in tables.items()}
    for deleted in ({"a": [1, 3, 999]}, {"b": [2], "c": [5]}, {"a": []}):
        gone = {t: spark.createDataFrame([(k,) for k in ks], "id long") for t, ks in deleted.items()}
        got = closure.delete_closure(frames, keys, references, gone)
        assert {t: sorted(str(tuple(r)) for r in df.collect()) for t, df in got.items()} == plain_closure(tables, keys, references, deleted)


def test_closure_of_a_cycle_a_chain_and_a_restriction(spark):
    ring = spark.createDataFrame([(i, (i + 1) % 5) for i in range(5)] + [(9, None)], "id long, next long")
    assert [r["id"] for r in closure.delete_closure({"t": ring}, {"t": "id"}, [FK("t", "next", "t")], {"t": spark.createDataFrame([(3,)], "k int")})["t"].collect()] == [9]
    with pytest.raises(RuntimeError, match="longer than 2"):
        closure.delete_closure({"t": ring}, {"t": "id"}, [FK("t", "next", "t")], {"t": spark.createDataFrame([(3,)], "k int")}, max_rounds=2)
    child = spark.createDataFrame([(1, 9)], "id long, t_id long")
    both, keys = {"t": ring, "child": child}, {"t": "id", "child": "id"}
    with pytest.raises(closure.RestrictError):
        closure.delete_closure(both, keys, [FK("child", "t_id", "t", "restrict")], {"t": spark.createDataFrame([(9,)], "k int")})
    assert closure.delete_closure(both, keys, [FK("child", "t_id", "t", "restrict")], {"t": spark.createDataFrame([(1,)], "k int")})["child"].count() == 1
    with pytest.raises(ValueError):
        closure.delete_closure(both, keys, [FK("child", "t_id", "t", "other")], {})


IDS = [-70_000, -32_768, -32_767, -1, 0, 1, 2, 32_768, 32_769, 100_000, 5_000_000]


def plain_facets(rows, filters):
    of = {}
    for p, k, v in rows:
        if None not in (p, k, v):
            of.setdefault(p, set()).add((k, v))
    found = [p for p in of if filters and set(filters.items()) <= of[p]]
    out = {}
    for p in found:
        for pair in of[p]:
            out[pair] = out.get(pair, 0) + 1
    return sorted(found), out


def index_says(index, filters):
    return sorted(r[0] for r in prop_index.hit_ids(index, filters).collect()), {(r["prop_key"], r["prop_value"]): r["products"] for r in prop_index.facets(index, filters).collect()}


def test_index_searches_facets_and_updates(spark):
    rng = random.Random(4)
    schema_ = "product_id long, prop_key string, prop_value string"
    make = lambda ids: [(p, k, rng.choice("xyz")) for p in ids for k in "ABC" if rng.random() < 0.8]
    rows = make(IDS + list(range(200, 400))) + [(None, "A", "x"), (1, None, "x"), (2, "A", None), (7, "A", "x"), (7, "A", "x")]
    base = scratch_path(spark, "t-index")
    prop_index.write_index(spark.createDataFrame(rows, schema_).repartition(5), base, ranges_per_part=2)
    searches = [{"A": "x"}, {"A": "x", "B": "y"}, {"A": "x", "B": "y", "C": "z"}, {"A": "none"}, {"A": "x", "Q": "y"}, {}]
    for f in searches:
        assert index_says(prop_index.read_index(spark, base), f) == plain_facets(rows, f)
    stamps = {d: os.path.getmtime(os.path.join(base, d)) for d in os.listdir(base) if d.startswith("part=")}
    changed = {1, 250, 5_000_000, -70_000}
    rows = [r for r in rows if r[0] not in changed] + make([1, 250])  # two products lost all their pairs
    touched = prop_index.update_index(base, spark.createDataFrame(rows, schema_), spark.createDataFrame([(c,) for c in changed] + [(None,)], "product_id long"), ranges_per_part=2)
    for f in searches:
        assert index_says(prop_index.read_index(spark, base), f) == plain_facets(rows, f)
    after = {d: os.path.getmtime(os.path.join(base, d)) for d in os.listdir(base) if d.startswith("part=")}
    assert {d for d in stamps if after.get(d) != stamps[d]} <= {f"part={p}" for p in touched} and len(touched) == 3 < len(stamps)
    assert "part=76" not in after  # nothing left there
    assert prop_index.update_index(base, spark.createDataFrame(rows, schema_), spark.createDataFrame([], "product_id long"), ranges_per_part=2) == []


def test_facets_read_the_index_alone_and_aggregate_map_side(spark):
    base = scratch_path(spark, "t-index-plan")
    prop_index.write_index(fx.props(spark, SF), base)
    out = prop_index.facets(prop_index.read_index(spark, base), {"Brand": "Brand#23"})
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_bitmap_and_agg" in plan and "Python" not in plan and set(os.path.dirname(os.path.dirname(f)) for f in out.inputFiles()) == {"file://" + base}


def lattice(values):
    import re

    values = [v for v in values if v is not None]
    if not values:
        return None
    if all(v in ("true", "false") for v in values):
        return "boolean"
    if all(re.fullmatch(r"[+-]?\d+(\.\d+)?", v) for v in values):
        whole = max(len(re.match(r"[+-]?0*(\d*)", v)[1]) for v in values)
        scale = max(len((re.search(r"\.(\d+)$", v) or [0, ""])[1]) for v in values)
        return "bigint" if not scale and whole <= 18 else f"decimal({max(1, whole + scale)},{scale})" if whole + scale <= 38 else "string"
    if all(re.fullmatch(r"\d{4}-\d\d-\d\d([T ]\d\d:\d\d(:\d\d(\.\d{1,6})?)?)?", v) and v[5:7] <= "12" for v in values):
        return "timestamp"
    return "string"


def test_types_follow_the_lattice_in_any_order(spark):
    cells = ["true", "false", "1", "007", "-12", "3.50", "1e5", "2024-01-02", "2024-01-02 03:04:05.678", "2024-13-01", "x", "", "9" * 18, "9" * 19, "1" * 40, "0.000", None]
    rng = random.Random(6)
    rows = []
    for f in range(60):
        own = rng.sample(cells, rng.randint(1, 2))
        rows += [(f"f{f}", json.dumps({"c": rng.choice(own), "only_null": None}), ) for _ in range(6)]
    rows += [("empty", "{}"), ("empty", None), ("nested", json.dumps({"c": {"a": 1}}))]
    df = spark.createDataFrame(rows, "file string, value string")
    got = {(r["file"], r["column"]): r["type"] for r in discover.discover_types(df, file_col="file").collect()}
    by = {}
    for f, v in rows:
        for k, x in (json.loads(v) if v else {}).items():
            by.setdefault((f, k), []).append(json.dumps(x) if isinstance(x, dict) else x)
            by.setdefault((None, k), []).append(json.dumps(x) if isinstance(x, dict) else x)
    assert got == {k: lattice(v) for k, v in by.items()} and not any(f == "empty" for f, _ in got)
    halves = [discover.column_states(df.filter(c), file_col="file") for c in ("file < 'f3'", "file >= 'f3'")]
    merged = lambda x, y: {r["column"]: r["t"] for r in discover.merge(x.union(y), ["column"]).select("column", discover.type_of().alias("t")).collect()}
    assert merged(*halves) == merged(*halves[::-1]) == {c: t for (f, c), t in got.items() if f is None}


def test_proposed_types_migrate(spark):
    rows = spark.createDataFrame([("a", '{"n": "12", "p": "1.25", "d": "2024-01-02", "b": "true", "t": "x"}'), ("b", '{"n": null, "p": "10", "d": "2024-01-03 04:05:06"}')], "file string, value string")
    types = discover.proposed_types(rows, file_col="file")
    assert types == {"n": "bigint", "p": "decimal(4,2)", "d": "timestamp", "b": "boolean", "t": "string"}
    table = rows.select(F.from_json("value", "n string, p string, d string, b string, t string").alias("j")).select("j.*")
    out = schema.migrate_types(table, types)
    assert dict(out.dtypes) == types | {"d": "timestamp_ntz"} and out.filter("n IS NOT NULL AND p = 1.25 AND b").count() == 1


def test_digest_tree_reads_differing_ranges_alone(spark):
    base = scratch_path(spark, "t-tree")
    old = spark.range(4000).select("id", F.concat(F.lit("p"), "id").alias("description"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("n"))
    old = old.union(spark.createDataFrame([(None, "no key", 1), (None, "no key", 1)], "id long, description string, n long"))
    new = old.withColumn("description", F.when(F.col("id") == 17, "changed").otherwise(F.col("description"))).filter("id != 40 OR id IS NULL").union(spark.createDataFrame([(9999, "new", None)], "id long, description string, n long"))
    for name, df in (("old", old), ("new", new), ("same", old.repartition(9))):
        digest_tree.write_ranged_version(df, base, name, leaves=64, fan=8)
    leaves = digest_tree.differing_leaves(spark, base, "old", "new")
    assert 1 <= len(leaves) <= 3 and digest_tree.differing_leaves(spark, base, "old", "same") == []
    got = digest_tree.diff_versions(spark, base, "old", "new")
    want = sync.diff_snapshots(old, new).filter("status != 'unchanged'")
    differing = lambda df: sorted(map(str, df.filter("id IS NOT NULL").collect()))  # noqa: E731  a NULL key never matches itself, changed or not
    assert differing(got) == differing(want) and {r["status"] for r in got.collect()} >= {"new", "deleted", "changed"}
    scans = [x for x in got._jdf.queryExecution().executedPlan().toString().splitlines() if "PartitionFilters" in x]
    assert scans and all("PartitionFilters: [leaf#" in x for x in scans)
    assert digest_tree.diff_versions(spark, base, "old", "same").count() == 0
    assert sorted(map(str, digest_tree.read_ranged_version(spark, base, "old").collect())) == sorted(map(str, old.collect()))
    # a value that moves to another column, and a NULL that moves, are differences
    a = spark.createDataFrame([(1, "x", None)], "id long, a string, b string")
    b = spark.createDataFrame([(1, None, "x")], "id long, a string, b string")
    d = [digest_tree.digests(t.withColumn("leaf", F.lit(0))).first() for t in (a, b)]
    assert d[0] != d[1]


def test_sketches_of_large_versions_and_merges(spark):
    old, new = spark.range(60_000), spark.range(20_000, 90_000)
    a, b = sketches.sketch(old), sketches.sketch(new.repartition(7))
    got = sketches.compare(a, b).first()
    for name, n in (("old_ids", 60_000), ("new_ids", 70_000), ("all_ids", 90_000), ("common", 40_000), ("vanished", 20_000), ("came", 30_000)):
        assert abs(got[name] - n) < 4 / 64 * 90_000, name
    parts = sketches.sketch(new.filter("id % 3 = 0")).union(sketches.sketch(new.filter("id % 3 != 0")))
    assert abs(sketches.compare(sketches.merge(parts), b).first()["old_ids"] - got["new_ids"]) <= 4 / 64 * 70_000
    texts = spark.range(1, 1001).select("id", F.repeat(F.lit("a"), F.col("id").cast("int")).alias("t"))
    q = {r["rank"]: r["length"] for r in sketches.length_quantiles(sketches.sketch(texts, texts=["t"]), "t", [0.1, 0.5, 0.9]).collect()}
    assert all(abs(v - 1000 * k) < 30 for k, v in q.items())
    none = sketches.sketch(texts.limit(0), texts=["t"])
    assert sketches.compare(none, none).first()["all_ids"] == 0


@pytest.mark.parametrize("name", ["delete_closure", "property_facets", "discover_types", "diff_versions", "version_sketches"])
def test_queries_run(spark, name):
    assert registered.QUERIES[name](spark, SF).count() > 0
