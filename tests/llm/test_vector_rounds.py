"""Shallot and Orchard search against full scans, whole runs against plain Python, odd rows, and bounded traffic."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest

from catalog_sync.llm import clustering, registered, vector_codes
from catalog_sync.llm.rounds import Rounds, lists, matrix
from catalog_sync.llm.tables import Scratch
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int"


def hashed():
    return F.sha2(F.concat(F.lit("2:"), F.col("id").cast("string")), 256)


def data(kind, seed, n, dim, k):
    rng = np.random.default_rng(seed)
    if kind == "random":
        return rng.integers(-200, 200, (n, dim))
    if kind == "clustered":
        return rng.integers(-5000, 5000, (k, dim))[rng.integers(0, k, n)] + rng.integers(-40, 40, (n, dim))
    return rng.integers(0, 3, (n, dim))  # many ties and equal rows


def scan(x, c):
    d = ((x[:, None, :] - c[None]) ** 2).sum(axis=2)
    return d.argmin(axis=1), d.min(axis=1)


def means(x, own, c):
    return np.stack([x[own == j].sum(axis=0) // max(1, (own == j).sum()) if (own == j).any() else c[j] for j in range(len(c))])


@pytest.mark.parametrize("kind", ["random", "clustered", "ties"])
@pytest.mark.parametrize("k", [1, 2, 3, 17])
def test_shallot_equals_full_scans_round_by_round(kind, k):
    x = data(kind, k, 1500, 6, k)
    points = x[:k].copy()
    state = [np.zeros(1500, np.int32), np.ones(1500, np.int32), np.full(1500, np.inf), np.zeros(1500)]
    seen, measured = clustering.Centroids.of(points), []
    for _ in range(9):
        measured.append(clustering.shallot(x, seen, *state))
        own, _ = scan(x, points)
        assert (state[0] == own).all()
        assert (state[2] * (1 + 1e-9) >= np.sqrt(((x - points[own]) ** 2).sum(axis=1))).all()
        new = means(x, own, points)
        seen, points = clustering.Centroids.of(new, points), new
    if kind == "clustered" and k > 2:
        assert measured[-1] < 0.5 * 1500 * k  # bounds and balls save most of a scan


@pytest.mark.parametrize("kind", ["random", "clustered", "ties"])
@pytest.mark.parametrize("k", [1, 2, 16])
def test_orchard_equals_full_scans(kind, k):
    x = data(kind, k, 2000, 4, k)
    for entries in (x[:k], np.repeat(x[:1], k, axis=0)):
        book = vector_codes.Codebook.of(entries)
        for start in (np.zeros(2000, np.int64), np.random.default_rng(1).integers(0, k, 2000)):
            entry, d, measured = vector_codes.orchard(x, book, start)
            own, least = scan(x, entries)
            assert (entry == own).all() and (d == least).all() and measured <= 2000 * k
    if kind == "clustered" and k == 16:
        assert vector_codes.orchard(x, vector_codes.Codebook.of(x[:k]), scan(x, x[:k])[0])[2] < 0.6 * 2000 * k


def plain_clusters(vectors, k, n_rounds, scale):
    """{id: (cluster, distance)} and centroids; vectors: list of (id, floats)."""
    first = sorted(vectors, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), [float(v) for v in r[1]]))
    x = np.floor(np.array([r[1] for r in vectors], np.float64) * scale).astype(np.int64)
    c = np.floor(np.array([r[1] for r in first[:k]], np.float64) * scale).astype(np.int64)
    for _ in range(n_rounds):
        c = means(x, scan(x, c)[0], c)
    return *scan(x, c), c


def test_kmeans_query_equals_plain_python(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    own, d, c = plain_clusters(rows, 40, 5, 256)
    got = {r["vec_id"]: r for r in registered.op12_shallot_kmeans(spark, SF).collect()}
    assert len(got) == len(rows)
    for i, (vec_id, _) in enumerate(rows):
        r = got[vec_id]
        assert (r["cluster"], r["distance"], r["inertia"], r["cluster_inertia"]) == (own[i], d[i], d.sum(), d[own == own[i]].sum())
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, c[own[i]])).encode()).hexdigest()


def odd_vectors(spark, dim, n=60):
    rng = np.random.default_rng(3)
    base = [[float(v) for v in np.float32(rng.standard_normal(dim))] for _ in range(n)]
    rows = [(i, v, i % 3 if i % 5 else None) for i, v in enumerate(base)]
    rows += [rows[4]] * 30 + [(4, base[9], 1), (None, base[2], 2), (None, base[3], None), (500, base[7], 7)]
    bad = [(600, None, 1), (601, [], 1), (602, base[0][:-1], 1), (603, [None, *base[0][1:]], 1), (604, [float("nan"), *base[0][1:]], 1),
           (605, [float("-inf"), *base[0][1:]], None), (606, base[0] + [1.0], 1)]
    return spark.createDataFrame(rows + bad, SCHEMA).withColumn("cluster", F.lit("clash")).withColumn("code", F.lit("clash")).withColumn("id", F.lit(-1)), rows


@pytest.mark.parametrize("k", [1, 7, 500])
def test_kmeans_odd_rows(spark, scratch, k):
    table, rows = odd_vectors(spark, 5)
    own, d, _ = plain_clusters([r[:2] for r in rows], k, 3, 256)
    got = clustering.cluster(table.repartition(5), scratch, k=k, n_rounds=3, scale=256, dim=5, order=hashed()).collect()
    assert sorted(str((r["vec_id"], r["cluster"], r["distance"])) for r in got) == sorted(str((v[0], o, e)) for v, o, e in zip(rows, own.tolist(), d.tolist(), strict=True))


def test_empty_tables_and_huge_components(spark, scratch):
    empty = spark.createDataFrame([], SCHEMA)
    assert clustering.cluster(empty, scratch, k=4, n_rounds=2, scale=256, dim=4, order=hashed()).collect() == []
    codes = vector_codes.compress(empty, scratch, n_parts=2, n_entries=4, n_rounds=2, scale=16)
    assert vector_codes.with_label_error(codes.vectors).collect() == [] and codes.books == []
    huge = spark.createDataFrame([(1, [1e30, 0.0], 1), (2, [3e6, 1.0], 1)], SCHEMA)
    for one in (huge, huge.filter("vec_id = 2")):
        with pytest.raises(Exception):
            clustering.cluster(one, scratch, k=2, n_rounds=1, scale=256, dim=2, order=hashed()).collect()
        with pytest.raises(Exception):
            vector_codes.compress(one, scratch, n_parts=2, n_entries=2, n_rounds=1, scale=4096).vectors.collect()


def plain_codes(rows, n_parts, n_entries, n_rounds, scale):
    first = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, [float(v) for v in r[1]]))[:n_entries]
    x, c = (np.floor(np.array([r[1] for r in t], np.float64) * scale).astype(np.int64) for t in (rows, first))
    codes, books, error = [], [], 0
    for xp, book in zip(np.split(x, n_parts, axis=1), np.split(c, n_parts, axis=1), strict=True):
        for _ in range(n_rounds):
            book = means(xp, scan(xp, book)[0], book)
        own, d = scan(xp, book)
        codes.append(own)
        books.append(book)
        error = error + d
    return ["".join(f"{e:02x}" for e in code) for code in zip(*codes, strict=True)], error, books


@pytest.mark.parametrize(("n_parts", "n_entries"), [(1, 3), (3, 16), (6, 200)])
def test_codes_of_odd_rows(spark, scratch, n_parts, n_entries):
    table, rows = odd_vectors(spark, 6)
    want, error, books = plain_codes(rows, n_parts, n_entries, 4, 4096)
    per_label = {lab: sum(int(e) for r, e in zip(rows, error, strict=True) if r[2] == lab) for lab in {r[2] for r in rows}}
    codes = vector_codes.compress(table.repartition(5), scratch, n_parts=n_parts, n_entries=n_entries, n_rounds=4, scale=4096)
    assert all((a == b).all() for a, b in zip(codes.books, books, strict=True))
    for most in (0, 10):  # joined by a shuffle, and as a broadcast
        got = vector_codes.with_label_error(codes.vectors, most).collect()
        assert sorted(str((r["id"], bytes(r["code"]).hex(), r["error"], r["label_error"])) for r in got) == sorted(
            str((r[0], code, int(e), per_label[r[2]])) for r, code, e in zip(rows, want, error, strict=True))


def test_codes_query_equals_plain_python(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    want, error, books = plain_codes(rows, 8, 16, 6, 4096)
    digest = hashlib.sha256(",".join(str(v) for b in books for v in b.ravel()).encode()).hexdigest()
    got = {r["vec_id"]: r for r in registered.op13_orchard_codes(spark, SF).collect()}
    assert len(got) == len(rows)
    for r, code, e in zip(rows, want, error, strict=True):
        assert (got[r[0]]["code"], got[r[0]]["error"], got[r[0]]["codebooks_sha256"]) == (code, e, digest)


def test_a_round_replaces_the_table_before(spark, scratch):
    table = spark.createDataFrame([(i, [i, -i]) for i in range(50)], "id long, vector array<int>").repartition(7)
    before = len(Scratch.live)
    held = Rounds(table, scratch)
    names = held.schema.names

    def assign(batch):
        x = matrix(batch.column(names.index("vector")))
        return {"vector": lists(x + 1, pa.int32())}, (x[:, 0] % 3), x

    for k in range(3):
        counts, sums = held.run(assign, 4, 2)
        own = np.array([[i + k, -i + k] for i in range(50)])
        assert counts.tolist() == [int((own[:, 0] % 3 == e).sum()) for e in range(4)]
        assert (sums == np.stack([own[own[:, 0] % 3 == e].sum(axis=0) if e < 3 else [0, 0] for e in range(4)])).all()
        assert len(Scratch.live) == before + 1 and held.table.count() == 50
    held.release()
    assert len(Scratch.live) == before
