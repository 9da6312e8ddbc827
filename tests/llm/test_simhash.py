import random

import numpy as np
import pytest
import xxhash

from catalog_sync.llm import registered, simhash
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def plain_fingerprint(text, shingle):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(c, " ")
    words = [w for w in lowered.split(" ") if w]
    grams = [" ".join(words[i:i + shingle]) for i in range(len(words) - shingle + 1)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(fps, most):
    root = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= most:
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    return root


def test_query_equals_brute_force(spark, scratch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    fps = [plain_fingerprint(r["text"], 3) for r in docs]
    roots = components(fps, 2)
    want = {r["doc_id"]: (f"{fps[i]:016x}", docs[roots[i]]["doc_id"]) for i, r in enumerate(docs)}
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in registered.op1_simhash_near_dedup(spark, SF).collect()}
    assert got == want


def test_odd_rows(spark, scratch, odd_docs):
    rows = simhash.near_duplicates(odd_docs, shingle=3, max_distance=2, scratch=scratch).collect()
    assert len(rows) == odd_docs.count()
    texts = {r["doc_id"]: r["text"] for r in odd_docs.collect()}
    for r in rows:
        if r["doc_id"] is not None:
            assert r["simhash"] & (2**64 - 1) == plain_fingerprint(texts[r["doc_id"]], 3)
    by = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert by[0]["component_id"] == by[1]["component_id"] == by[2]["component_id"] == 0  # no words: fingerprint zero
    assert by[5]["component_id"] == by[6]["component_id"] == 5
    kept = simhash.drop_near_duplicates(odd_docs, shingle=3, max_distance=2, scratch=scratch)
    assert kept.columns == odd_docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted({str(r["component_id"]) for r in rows})


@pytest.mark.parametrize("most", [1, 2, 3, 4])
def test_ball_hashing_loses_no_pair(spark, scratch, most):
    rng = random.Random(most)
    base = [rng.getrandbits(64) for _ in range(12)]
    fps = {0, 2**64 - 1, *base}
    for b in base:
        for _ in range(12):
            fps.add(b ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, 6))))
    signed = [f - 2**64 if f >> 63 else f for f in fps]
    table = spark.createDataFrame([(f,) for f in signed], "fp long")
    got = {(r["a"], r["b"]) for r in simhash.linked_fingerprints(table, most).collect()}
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= most}
    assert got == want


def test_components_of_a_long_chain(spark, scratch):
    n = 300
    order = random.Random(1).sample(range(n), n)
    edges = spark.createDataFrame([(order[i], order[i + 1]) for i in range(n - 1) if i != 150], "a long, b long")
    got = {r["node"]: r["root"] for r in simhash.components(edges, scratch).collect()}
    assert got == {**{k: min(order[:151]) for k in order[:151]}, **{k: min(order[151:]) for k in order[151:]}}


def test_empty_and_clashing_columns(spark, scratch, no_docs, odd_docs):
    assert simhash.near_duplicates(no_docs, shingle=3, max_distance=2, scratch=scratch).count() == 0
    assert simhash.drop_near_duplicates(no_docs, shingle=3, max_distance=2, scratch=scratch).count() == 0
    clash = odd_docs.withColumn("component_id", F.lit("x")).withColumn("n_docs", F.lit("y"))
    out = simhash.near_duplicates(clash, shingle=3, max_distance=2, scratch=scratch)
    assert dict(out.dtypes)["component_id"] == "bigint" and out.columns.count("component_id") == 1


def test_long_text_in_parts():
    text = " ".join(str(i % 977) for i in range(150_000))
    h = simhash.shingle_hashes(text.encode(), 3)
    assert len(h) == 150_000 - 2
    bits = ((h[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).sum(axis=0)
    assert simhash.fingerprint(h) & (2**64 - 1) == sum(1 << b for b in range(64) if 2 * int(bits[b]) > len(h))


def test_balls_are_never_broadcast(spark):
    many = spark.range(1_200_000).select(F.xxhash64("id").alias("fp"))  # planned only
    for threshold in ("10MB", "-1", "10GB"):
        before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            plan = simhash.linked_fingerprints(many, 2)._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
        # the balls are emitted by partitions of their own, which nothing merges
        assert "RoundRobinPartitioning(4)" in plan and "REPARTITION_BY_NUM" in plan


def test_balls_are_emitted_by_all_tasks(spark, scratch):
    few = scratch.write(spark.range(400).select(F.xxhash64("id").alias("fp")), "few")
    pairs = simhash.linked_fingerprints(few, 2)
    assert pairs.count() == 0
    dealt = few.select("fp").distinct().repartition(4).select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert len(dealt) == 4 and max(r["count"] for r in dealt) <= 110
