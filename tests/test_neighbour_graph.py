"""The neighbour graph against exact neighbours: recall, equal vectors, text ids, brands, missing categories, plans."""

import numpy as np
import pandas as pd
import pytest

from catalog_sync.operators import neighbour_graph as ng
from catalog_sync.operators import similar as sim

SCHEMA = "id long, description string, brand string, category string, is_vector boolean, vector array<double>"
SMALL = {"degree": 20, "sample": 14, "trees": 2, "leaf_rows": 24}


def rows_of(n, dim=12, seed=3):
    rng = np.random.default_rng(seed)
    return [(i, f"p{i}", f"B{i % 5}" if i % 9 else None, f"C{i % 3}" if i % 4 else None, True, [float(x) for x in rng.normal(size=dim)]) for i in range(n)]


def pairs(df):
    return {(r["id"], r["neighbor_id"]): r for r in df.collect()}


@pytest.mark.parametrize("w", [0.0, 0.5, 1.0])
def test_recall_and_exact_scores(spark, w):
    df = spark.createDataFrame(rows_of(700), SCHEMA)
    report = ng.GraphReport()
    exact = pairs(sim.similar_for_all(df, k=4, w=w))
    got = pairs(ng.similar_for_all_graph(df, k=4, w=w, report=report, **SMALL))
    assert len(got) == 4 * 700 and len(exact.keys() & got.keys()) >= 0.9 * len(exact)
    for p in exact.keys() & got.keys():
        assert got[p]["combined_score"] == pytest.approx(exact[p]["combined_score"], abs=1e-9)
    ranks = {}
    for (i, _), r in got.items():
        ranks.setdefault(i, []).append(r["rank"])
    assert all(sorted(x) == [1, 2, 3, 4] for x in ranks.values())
    assert report.nodes == 700 and report.scored > 0 and report.rounds[0] == 1.0 and report.rounds[-1] <= 0.05


def test_brand_rule(spark):
    df = spark.createDataFrame(rows_of(300), SCHEMA)
    exact = pairs(sim.similar_for_all(df, k=3, w=0.5, exclude_same_brand=True))
    got = pairs(ng.similar_for_all_graph(df, k=3, w=0.5, exclude_same_brand=True, **SMALL))
    assert len(got) == len(exact) and len(exact.keys() & got.keys()) >= 0.9 * len(exact)


@pytest.mark.parametrize("w", [0.0, 0.5])
def test_a_vector_that_a_third_of_all_share(spark, w):
    rows = rows_of(300)
    hot = rows[7][5]
    rows = [(*r[:5], hot) if r[0] % 3 == 0 else r for r in rows]
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    report = ng.GraphReport()
    exact = pairs(sim.similar_for_all(df, k=4, w=w))
    got = pairs(ng.similar_for_all_graph(df, k=4, w=w, report=report, **SMALL))
    assert report.nodes <= 200 + 1 + 3  # one node (per category), not a hundred
    assert len(got) == 4 * 300 and len(exact.keys() & got.keys()) >= 0.9 * len(exact)
    same = {p for p in exact if p[0] % 3 == 0}  # ties by id: exactly the smallest ids
    assert same <= got.keys()


def test_few_rows_text_ids_and_odd_vectors(spark):
    odd = [(f"id-{r[0]:03d}", *r[1:]) for r in rows_of(30)] + [("id-null", "x", "B0", "C0", True, None), ("id-off", "x", "B0", "C0", False, [1.0] * 12)]
    df = spark.createDataFrame(odd, SCHEMA.replace("id long", "id string", 1))
    assert pairs(ng.similar_for_all_graph(df, k=3, w=0.5)).keys() == pairs(sim.similar_for_all(df, k=3, w=0.5)).keys()  # one leaf: exact
    assert ng.similar_for_all_graph(df.limit(1), k=3).count() == 0 and ng.similar_for_all_graph(df.limit(0), k=3).count() == 0
    assert ng.similar_for_all_graph(df.limit(3), k=7, w=0.0).count() == 6
    zero = spark.createDataFrame([(1, "a", "B", "C", True, [0.0, 0.0]), (2, "b", "B", "C", True, [1.0, 0.0]), (3, "c", "B", "C", True, [2.0, 0.0])], SCHEMA)
    assert {(r["id"], r["neighbor_id"]) for r in ng.similar_for_all_graph(zero, k=2, w=0.0).collect()} == {(i, j) for i in (1, 2, 3) for j in (1, 2, 3) if i != j}


def test_cuts_run_before_their_shuffles(spark):
    edges = spark.range(1000).selectExpr("id % 7 AS v", "id AS u", "cast(id AS float) AS d", "true AS fresh")
    plan = ng._kept(edges, 5, 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "partial_min" in plan and "Cartesian" not in plan
    kept = ng._kept(edges.union(edges.selectExpr("v", "u", "d", "false")), 5, 3).collect()
    assert all([e["u"] for e in r["edges"]] == [r["v"] + 7 * i for i in range(5)] and not any(e["fresh"] for e in r["edges"]) for r in kept)


def test_trees_split_at_medians_and_local_joins_emit_what_improves():
    x = np.random.default_rng(1).normal(size=(4096, 8))
    planes, levels = ng._grow(x, 6, 1)
    leaf = np.bincount(ng._leaves(x, planes, levels, 6), minlength=64)
    assert len(levels) == 6 and leaf.min() >= 60 and leaf.max() <= 68
    assert len(ng._grow(x[:100], 6, 1)[1]) == 1  # deeper nodes hold too few sampled vectors
    deep = ng._leaves(x, *ng._grow(x[:100], 6, 1), 6)
    assert np.bincount(deep, minlength=64).max() < 400


def test_categories_that_fit_are_exact_and_move_through_no_round(spark, monkeypatch):
    df = spark.createDataFrame(rows_of(600), SCHEMA)
    joined, join = [], ng._counted

    def counted(session, edges, name, report):
        out = join(session, edges, name, report)
        if name == "graph-found":
            joined.append(out[0].filter("v % 2 = 1").count())
        return out

    monkeypatch.setattr(ng, "_counted", counted)
    exact = pairs(sim.similar_for_all(df, k=4, w=0.5))
    got = pairs(ng.similar_for_all_graph(df, k=4, w=0.5, **SMALL))
    own = {p for p, r in exact.items() if r["category_match"] == 1.0}
    assert joined and not any(joined) and own <= got.keys()
    monkeypatch.setattr(ng, "EXACT_ROWS", 0)  # larger ones do
    got = pairs(ng.similar_for_all_graph(df, k=4, w=0.5, **SMALL))
    assert any(joined) and len(got) == 4 * 600 and len(exact.keys() & got.keys()) >= 0.9 * len(exact)


def test_rounds_move_packed_parts_not_a_row_per_edge(spark, monkeypatch):
    df = spark.createDataFrame(rows_of(600), SCHEMA)
    rows, write = {}, ng.materialize_at

    def written(df, name):
        out = write(df, name)
        rows.setdefault(name, []).append(out[0].count())
        return out

    monkeypatch.setattr(ng, "materialize_at", written)
    monkeypatch.setattr(ng, "EXACT_ROWS", 0)
    monkeypatch.setattr(ng, "PART_ROWS", 40, raising=False)
    exact = pairs(sim.similar_for_all(df, k=4, w=0.5))
    got = pairs(ng.similar_for_all_graph(df, k=4, w=0.5, **SMALL))
    assert len(got) == 4 * 600 and len(exact.keys() & got.keys()) >= 0.9 * len(exact)
    parts = rows["graph"][0]
    assert len(rows["graph"]) >= 2 and set(rows["graph"]) == {parts} and 20 <= parts <= 60  # a row per part, not per node
    assert 0 < max(rows["graph-found"]) <= parts * parts + parts < 600 * SMALL["degree"]


def test_the_graph_does_not_depend_on_its_parts(spark, monkeypatch):
    df = spark.createDataFrame(rows_of(500), SCHEMA)
    wide = {**SMALL, "sample": 200, "max_rounds": 2}  # no reverse edge is left out
    whole, many = ng.GraphReport(), ng.GraphReport()
    one = pairs(ng.similar_for_all_graph(df, k=4, w=0.0, report=whole, **wide))
    monkeypatch.setattr(ng, "PART_ROWS", 30, raising=False)
    other = pairs(ng.similar_for_all_graph(df, k=4, w=0.0, report=many, **wide))
    assert len(one) == len(other) == 4 * 500 and len(one.keys() & other.keys()) >= 0.995 * len(one)
    assert whole.rounds[:1] == many.rounds[:1] == [1.0] and abs(whole.scored - many.scored) <= 0.02 * whole.scored


def test_merged_lists_and_joined_pairs_against_brute_force():
    rng = np.random.default_rng(5)
    degree, dim, rows, own = 4, 8, 6, 1 << ng.PLACE_BITS
    at, u, d = rng.integers(0, rows, 80), rng.integers(0, 30, 80), rng.random(30).astype(np.float32)
    found = ng._packed(np.sort(at) + own, u[np.argsort(at, kind="stable")], d[u[np.argsort(at, kind="stable")]], 7)
    names = [c.split()[0] for c in ng.STATE.split(", ")]
    q = rng.integers(-127, 128, (rows, dim)).astype(np.int8)
    empty = pd.DataFrame([(1, np.arange(rows).tobytes(), q.tobytes(), *[None] * 4, 0, 0, 0)], columns=names)
    state = ng._merge(degree, 2)((1,), found, empty)
    lists = np.frombuffer(state["u"][0], np.int64).reshape(rows, degree)
    for i in range(rows):
        best = sorted({int(x) for x in u[at == i]}, key=lambda x: (d[x], x))[:degree]
        assert [x for x in lists[i] if x >= 0] == best
    assert state["scored"][0] == 7 and state["used"][0] == state["new"][0] == sum(min(2, (x >= 0).sum()) for x in lists)
    again = ng._merge(degree, 2)((1,), found, state)  # nothing new: what was in use is old, the rest stays new
    assert again["u"][0] == state["u"][0] and again["new"][0] == 0
    assert np.frombuffer(again["fresh"][0], bool).reshape(rows, degree)[:, 2:].any()


def test_reverse_edges_chosen_twice_are_those_chosen_once():
    rng = np.random.default_rng(2)
    u, v = rng.integers(0, 9, 900), rng.permutation(900)
    once = ng._chosen(u, v, 10, 3)
    halves = np.concatenate([np.flatnonzero(v % 2 == h)[ng._chosen(u[v % 2 == h], v[v % 2 == h], 10, 3)] for h in (0, 1)])
    twice = halves[ng._chosen(u[halves], v[halves], 10, 3)]
    assert sorted(once) == sorted(twice) and np.bincount(u[once]).tolist() == [10] * 9
