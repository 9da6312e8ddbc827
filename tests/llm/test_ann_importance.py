import math
from collections import Counter

import numpy as np
import pytest

from catalog_sync.llm import ann, importance, registered
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def exact(rows, q_id, q, k):
    best = {}
    for i, v in rows:
        if i != q_id:
            d = float(np.sqrt(((v - q) ** 2).sum()))
            best[i] = min(d, best.get(i, math.inf))
    return sorted((d, i) for i, d in best.items())[:k]


def recall(got, rows, queries, k=10):
    by = {}
    for r in got:
        by.setdefault(r["query_id"], []).append(r)
    hit = total = 0
    for q_id, q in queries:
        found = sorted(by.get(q_id, []), key=lambda r: r["rank"])
        want = exact(rows, q_id, q, k)
        assert [r["rank"] for r in found] == list(range(1, len(want) + 1))
        true = {i: d for d, i in exact(rows, q_id, q, len(rows))}
        assert [r["score"] for r in found] == pytest.approx([true[r["vec_id"]] for r in found], rel=1e-12)
        assert [(r["score"], r["vec_id"]) for r in found] == sorted((r["score"], r["vec_id"]) for r in found)
        hit += len({r["vec_id"] for r in found} & {i for _, i in want})
        total += len(want)
    return hit / total


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_query_recall(spark, sf):
    rows = [(r["vec_id"], np.array(r["embedding"], float)) for r in spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").collect()]
    got = registered.op3_adaptive_ann(spark, f"/root/testdata/{sf}").collect()
    assert recall(got, rows, [(i, v) for i, v in rows if i % 100 == 0]) >= 0.9


def test_hot_vector_ties_and_odd_rows(spark, scratch):
    rng = np.random.default_rng(0)
    points = [(i, rng.standard_normal(8).round(2).tolist()) for i in range(300)]
    hot = [1.0, -0.0] + [0.5] * 6
    points += [(1000 + i, hot) for i in range(400)]
    odd = [(2000, None), (2001, [0.0] * 8), (2002, [float("nan")] + [1.0] * 7), (2003, [float("inf")] + [1.0] * 7), (2004, [None] + [1.0] * 7), (2005, [1.0]), (None, hot),
           (1000, hot), (7, rng.standard_normal(8).round(2).tolist())]
    frame = spark.createDataFrame(points + odd, "vec_id long, embedding array<double>").withColumn("score", F.lit("clash"))
    queries = frame.filter("vec_id % 50 = 0")
    got = ann.nearest_neighbours(frame, queries, scratch, k=10, recall=1.0, tune_queries=500, block_rows=16).collect()
    usable = [(i, np.array(v)) for i, v in points] + [(7, np.array(odd[-1][1]))]
    assert {r["query_id"] for r in got} == {i for i, _ in points if i % 50 == 0}
    assert recall(got, usable, [(i, np.array(v)) for i, v in points if i % 50 == 0]) == 1.0


@pytest.mark.parametrize("block_rows", [16, 4096])
def test_ids_shared_by_many_vectors(spark, scratch, block_rows):
    # 60 vectors near the queries share the query's id, 200 more share three ids, and lie in lists of their own
    rng = np.random.default_rng(1)
    rows = [(0, (1 + rng.standard_normal(8) / 100).tolist()) for _ in range(60)]
    rows += [(1 + i % 3, (1.1 + rng.standard_normal(8) / 100).tolist()) for i in range(200)]
    rows += [(10 + i, (9 + rng.standard_normal(8)).tolist()) for i in range(100)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    queries = spark.createDataFrame([rows[0], rows[60], rows[300]], "vec_id long, embedding array<double>")
    got = ann.nearest_neighbours(frame, queries, scratch, k=10, recall=1.0, tune_queries=500, block_rows=block_rows).collect()
    assert recall(got, [(i, np.array(v)) for i, v in rows], [(i, np.array(v)) for i, v in (rows[0], rows[60], rows[300])]) == 1.0


def test_few_and_no_vectors(spark, scratch):
    schema = "vec_id long, embedding array<float>"
    few = spark.createDataFrame([(100 * i, [float(i + 1), 1.0]) for i in range(4)], schema)
    got = ann.nearest_neighbours(few, few, scratch, k=10).collect()
    assert Counter(r["query_id"] for r in got) == {0: 3, 100: 3, 200: 3, 300: 3}
    assert ann.nearest_neighbours(few.limit(1), few.limit(1), scratch).count() == 0
    assert ann.nearest_neighbours(few.limit(0), few.limit(0), scratch).count() == 0
    assert ann.nearest_neighbours(few, few.limit(0), scratch).count() == 0
    assert ann.nearest_neighbours(few.withColumn("embedding", F.lit(None).cast("array<float>")), few, scratch).count() == 0


def test_queries_in_chunks_give_the_same(spark, scratch, monkeypatch):
    rng = np.random.default_rng(6)
    frame = spark.createDataFrame([(i, rng.standard_normal(8).tolist()) for i in range(400)], "vec_id long, embedding array<double>")
    ask = lambda: sorted(map(tuple, ann.nearest_neighbours(frame, frame.filter("vec_id % 20 = 0"), scratch, k=5, recall=1.0, block_rows=64).collect()))
    whole = ask()
    monkeypatch.setattr(ann, "CHUNK_QUERIES", 3)
    assert ask() == whole and len(whole) == 100


def test_short_lists_share_a_shard_and_long_ones_have_their_own():
    n = np.array([3, 4, 0, 9, 25, 2, 10, 1])
    first, spread = ann.place_lists(n, 10)
    assert spread.tolist() == [1, 1, 1, 1, 3, 1, 1, 1]
    assert first.tolist() == [0, 0, 0, 1, 2, 5, 6, 7]
    held = Counter()
    for at, rows, wide in zip(first, n, spread, strict=True):
        held[at] += rows if wide == 1 else 10
    assert max(held.values()) <= 10 and not set(range(2, 5)) & {int(a) for a, w in zip(first, spread, strict=True) if w == 1}


def test_scan_takes_the_rows_given_and_tells_its_work():
    rng = np.random.default_rng(5)
    points, q = rng.standard_normal((3000, 64)), rng.standard_normal(64)
    turn = np.linalg.qr(rng.standard_normal((64, 64)))[0]
    laid, work, rows = np.ascontiguousarray((points @ turn).T.astype(np.float32)), np.zeros(2, np.int64), np.arange(0, 3000, 2)
    got = ann.scan_block(q, (q @ turn).astype(np.float32), points, laid, [[i] for i in range(3000)], 10, math.inf, rows, work)
    assert got == sorted(zip(np.sqrt(((points[rows] - q) ** 2).sum(axis=1)).tolist(), rows.tolist(), strict=True))[:10]
    assert work[0] == 1500 * 64 and 512 * 64 < work[1] < work[0]


def test_scan_abandons_but_keeps_the_nearest():
    rng = np.random.default_rng(4)
    points, q = rng.standard_normal((4000, 64)), rng.standard_normal(64)
    turn = np.linalg.qr(rng.standard_normal((64, 64)))[0]
    got = ann.scan_block(q, (q @ turn).astype(np.float32), points, np.ascontiguousarray((points @ turn).T.astype(np.float32)), [[i] for i in range(4000)], 10, math.inf)
    want = sorted(zip(np.sqrt(((points - q) ** 2).sum(axis=1)).tolist(), range(4000), strict=True))[:10]
    assert len({i for _, i in got} & {i for _, i in want}) >= 9 and [d for d, _ in got] == sorted(d for d, _ in got)


def plain_buckets(text):
    import re

    import xxhash

    h = [xxhash.xxh64_intdigest(w) for w in re.findall(rb"[0-9a-z_\x80-\xff]+|[^0-9a-z_\x80-\xff\s]+", (text or "").encode().lower())]
    m = 2**64 - 1
    pairs = [((a * 0x9E3779B97F4A7C15 & m) ^ b) * 0xD6E8FEB86659FD93 & m for a, b in zip(h, h[1:], strict=False)]
    return [x % importance.N_BUCKETS for x in h] + [(x ^ x >> 32) % importance.N_BUCKETS for x in pairs]


def test_query_equals_plain_models(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good = [r["doc_id"] for r in importance.good_labels(labels).collect() if r["doc_id"] in docs]
    h = {r["doc_id"]: r for r in labels.select("doc_id").distinct().withColumn("fit", F.pmod(F.xxhash64(F.xxhash64("doc_id")), F.lit(2)) == 0).collect()}
    raw, target = Counter(), Counter()
    for i, t in docs.items():
        b = plain_buckets(t)
        raw.update(b)
        if i in good and h[i]["fit"]:
            target.update(b)
    n_raw, n_target = (sum(c.values()) + importance.N_BUCKETS for c in (raw, target))
    ratio = [math.log((target[k] + 1) / n_target) - math.log((raw[k] + 1) / n_raw) for k in range(importance.N_BUCKETS)]
    weight = {i: sum(ratio[b] for b in plain_buckets(t)) for i, t in docs.items()}
    rows = registered.op7_importance_resampling(spark, SF).collect()
    assert {r["doc_id"] for r in rows} == docs.keys()
    for r in rows:
        assert r["log_weight"] == pytest.approx(weight[r["doc_id"]], abs=1e-6)
    held = [weight[i] for i in good if not h[i]["fit"]]
    cutoff = np.quantile(held, 0.002)
    k = sum(r["log_weight"] >= cutoff for r in rows)
    best = sorted((r["gumbel_score"] for r in rows), reverse=True)[k - 1]
    assert all(r["kept"] == (r["gumbel_score"] >= best) for r in rows) and sum(r["kept"] for r in rows) == k


def test_classifier_separates_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    out = labels.join(registered.op7_importance_resampling(spark, sf), "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    kept = {r["quality"]: r["kept"] for r in out}
    assert kept[1] >= 0.99 and kept[0] <= 0.3


def test_kth_largest(spark):
    rng = np.random.default_rng(1)
    for values in (rng.standard_normal(3000) * 100, np.repeat(rng.standard_normal(7), 400), np.full(500, 2.5), np.concatenate((rng.standard_normal(2000), [1e9, -1e9]))):
        frame = spark.createDataFrame([(float(v),) for v in values], "x double")
        ranked = np.sort(values)[::-1]
        for k in (1, 2, 137, len(values)):
            assert importance.kth_largest(frame, "x", k, n_bins=16, most_rows=20) == ranked[k - 1]


def test_resample_odd_rows(spark, scratch, odd_docs, no_docs):
    labels = spark.createDataFrame([(3, 1, 0), (4, 1, None), (4, 1, 0), (5, 1, 0), (5, 0, 0), (6, 1, 1), (None, 1, 0), (7, None, 0), (999, 1, 0)], "doc_id long, quality int, toxic int")
    assert {r["doc_id"] for r in importance.good_labels(labels).collect()} == {3, 4, 999}
    clash = odd_docs.withColumn("kept", F.lit("clash"))
    for lab in (labels, labels.limit(0)):
        out = importance.resample(clash, lab, scratch)
        assert out.count() == odd_docs.count() and out.columns.count("kept") == 1 and out.filter("kept").count() > 0
        assert importance.resample(no_docs, lab, scratch).count() == 0
    assert importance.resample(clash, labels.limit(0), scratch).filter("NOT kept").count() == 0
    null = [r["log_weight"] for r in importance.resample(odd_docs, labels, scratch).filter("doc_id IN (0, 1, 2)").collect()]
    assert null == [0.0] * 3
