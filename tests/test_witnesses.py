"""Witnesses of violations against plain Python: counts, the defined keys, and one scan."""

import hashlib
import random

import pytest

from catalog_sync import fixtures as fx
from catalog_sync.operators import quality, witnesses

SF = "/root/testdata/sf0.001"
RULES = [
    {"kind": "not_null", "col": "name"},
    {"kind": "max_length", "col": "name", "max": 4},
    {"kind": "allowed", "col": "kind", "values": ["a", "b"]},
    {"kind": "not_null", "col": "id"},
]


def smallest(texts, k):
    return sorted(set(texts), key=lambda t: hashlib.md5(t.encode()).hexdigest())[:k]


def rows_of(seed, n):
    rnd = random.Random(seed)
    return [(rnd.choice([None, 7, i, i]), rnd.choice([None, "ab", "abcde", "Ω" * 5]), rnd.choice([None, "a", "b", "c"])) for i in range(n)]


@pytest.mark.parametrize("parts", [1, 7])
def test_counts_and_witnesses_equal_brute_force(spark, parts):
    rows = rows_of(3, 700)
    df = spark.createDataFrame(rows, "id long, name string, kind string").repartition(parts)
    got = {(r["rule"], r["column"]): (r["violations"], r["witnesses"]) for r in witnesses.check_constraints(df, RULES, "id", k=4).collect()}
    broken = {
        ("not_null", "name"): [r for r in rows if r[1] is None],
        ("max_length", "name"): [r for r in rows if r[1] is not None and len(r[1]) > 4],
        ("allowed", "kind"): [r for r in rows if r[2] is not None and r[2] not in ("a", "b")],
        ("not_null", "id"): [r for r in rows if r[0] is None],
    }
    text = {None: "null"}
    assert got == {rule: (len(b), smallest([text.get(r[0], str(r[0])) for r in b], 4)) for rule, b in broken.items()}
    assert got["not_null", "id"][1] == ["null"]  # hundreds of rows, one key
    plain = {(r["rule"], r["column"]): r["violations"] for r in quality.check_constraints(df, RULES).collect()}
    assert plain == {rule: n for rule, (n, _) in got.items()}


def test_empty_clean_and_several_keys(spark):
    schema = "id long, name string, kind string"
    for rows in ([], [(1, "ab", "a")]):
        got = witnesses.check_constraints(spark.createDataFrame(rows, schema), RULES, ["id", "name"]).collect()
        assert [(r["violations"], r["witnesses"]) for r in got] == [(0, [])] * 4
    got = witnesses.check_constraints(spark.createDataFrame([(1, "abcde", None), (None, "x", None)], schema), RULES, ["id", "name"]).collect()
    assert {r["rule"] + r["column"]: r["witnesses"] for r in got} == {"not_nullname": [], "max_lengthname": ['["1","abcde"]'], "allowedkind": [], "not_nullid": ['["null","x"]']}
    with pytest.raises(ValueError):
        witnesses.check_constraints(spark.createDataFrame([], schema), RULES, "id", k=0)


def test_unique_and_foreign_key(spark):
    rows = [(i, i % 40 if i % 3 else None) for i in range(200)]
    child = spark.createDataFrame(rows, "id long, p long").repartition(5)
    parent = spark.createDataFrame([(i,) for i in range(0, 40, 2)], "pid long")
    [u] = witnesses.check_unique(child, "p", k=3).collect()
    dup = [str(p) for p in {p for _, p in rows if p is not None and sum(q == p for _, q in rows) > 1}]
    assert (u["rule"], u["column"], u["violations"], u["witnesses"]) == ("unique", "p", len(dup), smallest(dup, 3))
    [f] = witnesses.check_foreign_key(child, parent, "p", "pid", "id", k=6).collect()
    orphans = [str(i) for i, p in rows if p is not None and p % 2]
    assert (f["violations"], f["witnesses"]) == (len(orphans), smallest(orphans, 6))


def test_one_scan_and_no_window(spark):
    out = witnesses.check_constraints(fx.table(spark, SF, "orders"), [{"kind": "not_null", "col": "o_orderstatus"}, {"kind": "allowed", "col": "o_orderpriority", "values": ["1-URGENT"]}], "o_orderkey")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "Window" not in plan and "o_totalprice" not in plan
