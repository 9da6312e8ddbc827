import numpy as np
import pandas as pd
import pytest

from catalog_sync.operators import similar as sim
from catalog_sync.plans import registered


def frame(spark, n=60, d=8, seed=3):
    rng = np.random.default_rng(seed)
    vecs = rng.normal(size=(n, d))
    rows = []
    for i in range(n):
        rows.append((i, f"item {i}", None if i % 7 == 0 else f"B{i % 4}", None if i % 11 == 0 else f"C{i % 3}",
                     i % 9 != 0, [float(x) for x in vecs[i]]))
    return spark.createDataFrame(rows, "id long, description string, brand string, category string, is_vector boolean, vector array<double>"), rows


def brute(rows, ref, k, w, excl):
    r = rows[ref]
    rv = np.array(r[5])
    out = []
    for row in rows:
        if not row[4] or row[0] == ref:
            continue
        if excl and (row[2] is None or r[2] is None or row[2] == r[2]):
            continue
        v = np.array(row[5])
        dist = 1 - v @ rv / (np.linalg.norm(v) * np.linalg.norm(rv))
        match = 1.0 if (row[3] is not None and row[3] == r[3]) else 0.0
        out.append((-((1 - dist) * (1 - w) + match * w), dist, row[0]))
    return [x[2] for x in sorted(out)[:k]]


def test_find_similar_matches_brute_force(spark):
    df, rows = frame(spark)
    for w, excl, k in [(1.0, False, 4), (0.5, True, 7), (0.0, False, 5)]:
        for engine in ("arrow", "hof"):
            got = [r["id"] for r in sim.find_similar(df, 1, k=k, exclude_same_brand=excl, w=w, engine=engine).collect()]
            assert got == brute(rows, 1, k, w, excl)


def test_unknown_or_unvectorised_reference_is_empty(spark):
    df, _ = frame(spark)
    assert sim.find_similar(df, 9, k=3).count() == 0  # id 9 has is_vector false
    assert sim.find_similar(df, 10_000, k=3).count() == 0


def test_similar_for_all_exact_across_blocks(spark):
    df, rows = frame(spark, n=80)
    got = sim.similar_for_all(df, k=3, w=0.5, exclude_same_brand=True, block_rows=16)
    by = {}
    for r in got.orderBy("id", "rank").collect():
        by.setdefault(r["id"], []).append(r["neighbor_id"])
    for row in rows:
        if row[4]:
            assert by.get(row[0], []) == brute(rows, row[0], 3, 0.5, True)


def test_similar_for_all_exact_in_chunks(spark):
    # several chunks per block: the reverse direction is merged from partial per-chunk cuts
    df, rows = frame(spark, n=90)
    got = sim.similar_for_all(df, k=4, w=0.3, exclude_same_brand=False, block_rows=20, chunk_rows=6)
    by = {}
    for r in got.orderBy("id", "rank").collect():
        by.setdefault(r["id"], []).append(r["neighbor_id"])
    for row in rows:
        if row[4]:
            assert by.get(row[0], []) == brute(rows, row[0], 4, 0.3, False)


def test_search_then_similar_formats(spark):
    df, _ = frame(spark)
    out = sim.search_then_similar(df, "item 1", k=2, w=0.5).collect()
    assert len(out) == 2 and all(len(r["combined_score"].split(".")[1]) == 2 for r in out)
    assert sim.search_then_similar(df, "nothing like this", k=2).count() == 0
    pct = sim.search_then_similar(df, "item 1", k=2, w=0.5, style="percent").collect()
    raw = sim.find_similar(df, 1, k=2, w=0.5).collect()
    for p, r in zip(pct, raw):
        assert p["vector_similarity"] == f"{1 - r['vector_distance']:.2%}" and p["combined_score"] == f"{r['combined_score']:.2%}"
        assert p["category_match"] == ("Yes" if r["category_match"] == 1.0 else "No")


def test_block_cut_is_bounded_under_ties(spark):
    # category weight 1.0 makes scores 0/1 only: each query must still emit <= k rows per block
    import numpy as np

    from catalog_sync.operators.similar import _exact_topk_mask

    score = np.ones((3, 50))
    dist = np.tile(np.linspace(1.0, 0.0, 50), (3, 1))
    ids = np.arange(50)
    mask = _exact_topk_mask(score, dist, ids, np.ones((3, 50), bool), 4)
    assert (mask.sum(axis=1) == 4).all() and mask[0, -4:].all()
    df, rows = frame(spark, n=70)
    got = sim.similar_for_all(df, k=3, w=1.0, block_rows=10)
    by = {}
    for r in got.orderBy("id", "rank").collect():
        by.setdefault(r["id"], []).append(r["neighbor_id"])
    for row in rows:
        if row[4]:
            assert by.get(row[0], []) == brute(rows, row[0], 3, 1.0, False)


def test_lsh_recall_on_clustered_vectors(spark):
    rng = np.random.default_rng(5)
    centers = rng.normal(size=(8, 16)) * 4
    rows = []
    for i in range(240):
        v = centers[i % 8] + rng.normal(size=16) * 0.3
        rows.append((i, f"p{i}", f"B{i % 5}", f"C{i % 8}", True, [float(x) for x in v]))
    df = spark.createDataFrame(rows, "id long, description string, brand string, category string, is_vector boolean, vector array<double>")
    exact = {(r["id"], r["neighbor_id"]) for r in sim.similar_for_all(df, k=5, w=0.0, block_rows=64).collect()}
    approx = sim.similar_for_all_lsh(df, k=5, w=0.0, bands=8, rows_per_bucket=4, block_rows=32).collect()
    assert len({r["id"] for r in approx}) == 240 and len(approx) == 5 * 240  # none is left with fewer than k
    recall = len(exact & {(r["id"], r["neighbor_id"]) for r in approx}) / len(exact)
    assert recall >= 0.8, recall
    # every pair found carries its exact distance and distinct neighbours ranked 1..n
    vec = {row[0]: np.array(row[5]) for row in rows}
    for r in approx:
        a, b = vec[r["id"]], vec[r["neighbor_id"]]
        assert np.isclose(r["vector_distance"], 1 - a @ b / (np.linalg.norm(a) * np.linalg.norm(b)), atol=1e-9)
    ranks = {}
    for r in approx:
        ranks.setdefault(r["id"], []).append((r["rank"], r["neighbor_id"]))
    for got in ranks.values():
        assert sorted(x for x, _ in got) == list(range(1, len(got) + 1)) and len({n for _, n in got}) == len(got)


def vector_rows(n=60, dim=6):
    rng = np.random.default_rng(8)
    return [(f"id-{i:03d}", f"p{i}", f"B{i % 5}", f"C{i % 4}", True, [float(x) for x in rng.normal(size=dim)]) for i in range(n)]


VECTOR_SCHEMA = "id string, description string, brand string, category string, is_vector boolean, vector array<double>"


def test_text_ids_and_null_vectors(spark):
    rows = vector_rows()
    odd = [("id-null", "x", "B0", "C0", True, None), ("id-off", "x", "B0", "C0", False, [1.0] * 6)]
    df = spark.createDataFrame(rows + odd, VECTOR_SCHEMA)
    for out in (sim.similar_for_all(df, k=3, w=0.0, block_rows=16), sim.similar_for_all_lsh(df, k=3, w=0.0, bands=24, rows_per_bucket=30, block_rows=16)):
        got = {}
        for r in out.collect():
            got.setdefault(r["id"], []).append((r["rank"], r["neighbor_id"]))
        assert got.keys() == {r[0] for r in rows}
        vec = {r[0]: np.array(r[5]) for r in rows}
        hit = 0
        for i, found in got.items():
            d = {j: 1 - vec[i] @ v / (np.linalg.norm(vec[i]) * np.linalg.norm(v)) for j, v in vec.items() if j != i}
            hit += len({n for _, n in found} & set(sorted(d, key=lambda j: (round(d[j], 10), j))[:3]))
            assert sorted(x for x, _ in found) == [1, 2, 3]
        assert hit >= 0.9 * 3 * len(rows)
    assert sim.find_similar(df, "id-003", k=4, w=0.0).count() == 4
    assert sim.find_similar(df, "id-null", k=4).count() == 0


def test_products_with_poor_buckets_are_scanned_against_all(spark):
    df = spark.createDataFrame(vector_rows(50), VECTOR_SCHEMA)
    out = sim.similar_for_all_lsh(df, k=7, w=0.0, bands=1, rows_per_bucket=1, block_rows=8)
    n = {r["id"]: r["n"] for r in out.groupBy("id").count().withColumnRenamed("count", "n").collect()}
    assert len(n) == 50 and set(n.values()) == {7}
    few = sim.similar_for_all_lsh(df.limit(3), k=7, w=0.0)
    assert few.count() == 6 and sim.similar_for_all_lsh(df.limit(0), k=7).count() == 0


def test_vectors_of_another_length_fail(spark):
    df = spark.createDataFrame(vector_rows(5) + [("z", "x", "B", "C", True, [1.0])], VECTOR_SCHEMA)
    for scan in (sim.similar_for_all, sim.similar_for_all_lsh):
        with pytest.raises(Exception, match="components"):
            scan(df, k=2).collect()


def test_lsh_codes_are_computed_once(spark):
    df = spark.createDataFrame(vector_rows(40), VECTOR_SCHEMA)
    out = sim.similar_for_all_lsh(df, k=2, w=0.0, rows_per_bucket=8)
    assert "codes(" not in out._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("w, costs", [(0.0, None), (0.0, (0.0, 0.0)), (0.5, (0.0, 0.0)), (1.0, None)])
def test_lsh_recall_holds_where_buckets_are_poor(spark, monkeypatch, w, costs):
    # vectors without clusters; some products have no category. Without costs of groups and copies the buckets are small ones.
    if costs:
        monkeypatch.setattr(sim, "GROUP_S", costs[0])
        monkeypatch.setattr(sim, "COPY_S", costs[1])
    rng = np.random.default_rng(3)
    rows = [(i, f"p{i}", f"B{i % 5}", f"C{i % 3}" if i % 4 else None, True, [float(x) for x in rng.normal(size=32)]) for i in range(900)]
    df = spark.createDataFrame(rows, "id long, description string, brand string, category string, is_vector boolean, vector array<double>")
    exact = {(r["id"], r["neighbor_id"]) for r in sim.similar_for_all(df, k=4, w=w).collect()}
    got = {(r["id"], r["neighbor_id"]) for r in sim.similar_for_all_lsh(df, k=4, w=w, bands=4, rows_per_bucket=16, block_rows=128).collect()}
    assert len(got) == 4 * 900
    for none in (False, True):  # with and without a category
        want = {p for p in exact if (p[0] % 4 == 0) == none}
        assert len(want & got) >= 0.9 * len(want), (none, len(want & got) / len(want))


def test_registered_lsh_returns_blended_neighbours(spark):
    sf = "/root/testdata/sf0.001"
    got = {(r["id"], r["neighbor_id"]): r["combined_score"] for r in registered.QUERIES["similar_for_all_lsh_neighbours"](spark, sf).collect()}
    true = {(r["id"], r["neighbor_id"]): r["combined_score"] for r in registered.QUERIES["similar_for_all"](spark, sf).collect()}  # w=0.5, exact
    assert len(got) == len(true) and len(got.keys() & true.keys()) >= 0.9 * len(true)
    assert all(abs(got[p] - true[p]) < 1e-6 for p in got.keys() & true.keys())


def shuffled_rows(monkeypatch):
    """Rows that block pairs are made of, summed over the scans to come."""
    seen, dealt = [], sim._pair_groups

    def spread(*a):
        out = dealt(*a)
        seen.append(out.count())
        return out

    monkeypatch.setattr(sim, "_pair_groups", spread)
    return seen


def test_a_row_is_shuffled_a_bounded_number_of_times(spark, monkeypatch):
    df, rows = frame(spark, n=700)
    seen = shuffled_rows(monkeypatch)
    got = {(r["id"], r["neighbor_id"]) for r in sim.similar_for_all(df, k=4, w=0.5, block_rows=4).collect()}
    n = sum(r[4] for r in rows)
    assert seen[0] <= sim.BLOCKS * n  # not a copy per block of four rows
    assert all({b for a, b in got if a == i} == set(brute(rows, i, 4, 0.5, False)) for i in (1, 8, 350, 699))


def test_buckets_shuffle_a_row_about_once_per_band(spark, monkeypatch):
    df, rows = frame(spark, n=700)
    seen = shuffled_rows(monkeypatch)
    out = sim.similar_for_all_lsh(df, k=4, w=0.5, block_rows=4, setting=sim.Buckets(2, 10, 1 << 30, 1, 0.0))
    n = sum(r[4] for r in rows)
    assert out.count() == 4 * n and seen[0] <= 2 * 11 * n


@pytest.mark.parametrize("exclude", [False, True])
@pytest.mark.parametrize("w", [0.0, 0.5, 1.0])
def test_tiles_leave_out_nothing(monkeypatch, w, exclude):
    # equal, zero, non-finite and extreme vectors, missing categories and brands, in small and in large tiles
    rng = np.random.default_rng(1)
    vecs = [v for v in rng.normal(size=(90, 8))]
    vecs[::3] = [vecs[0]] * 30
    vecs[1::20] = [np.zeros(8)] * 5
    vecs[5], vecs[7], vecs[8] = np.full(8, np.nan), np.full(8, 1e-150), np.full(8, 1e200)
    pdf = pd.DataFrame({"id": range(90), "vector": vecs, "category": [f"C{i % 5}" if i % 11 else None for i in range(90)],
                        "brand": [f"B{i % 4}" if i % 7 else None for i in range(90)]})
    v = np.vstack(vecs)
    with np.errstate(all="ignore"):
        norm = np.linalg.norm(v, axis=1)
        cos = v @ v.T / np.outer(norm, norm)
    cos[~np.isfinite(cos)] = np.nan
    dist = np.round(1 - cos, sim.DIGITS) + 0.0
    want = set()
    for i, a in pdf.iterrows():
        ranked = []
        for j, b in pdf.iterrows():
            if i != j and not (exclude and (a["brand"] is None or b["brand"] is None or a["brand"] == b["brand"])):
                score = (1 - dist[i, j]) * (1 - w) + w * (a["category"] is not None and a["category"] == b["category"])
                ranked.append((-np.inf if np.isnan(score) else -score, np.inf if np.isnan(dist[i, j]) else dist[i, j], j))
        want |= {(i, j) for _, _, j in sorted(ranked)[:4]}
    for chunk, tile in ((7, 16), (1024, 4096)):
        monkeypatch.setattr(sim, "TILE_ROWS", tile)
        scan = sim._block_pair_topk(4, w, exclude, chunk)
        whole = scan((0, 0), pdf.assign(__b=0))
        assert set(zip(whole["id"], whole["neighbor_id"], strict=True)) == want
        halves = pdf.assign(__b=pdf["id"] % 2)
        parts = pd.concat([scan((0, 1), halves), *(scan((b, b), halves[halves["__b"] == b]) for b in (0, 1))])
        parts["s"] = np.where(np.isnan(parts["combined_score"]), -np.inf, -parts["combined_score"])
        best = parts.sort_values(["id", "s", "vector_distance", "neighbor_id"]).groupby("id").head(4)
        assert set(zip(best["id"], best["neighbor_id"], strict=True)) == want
