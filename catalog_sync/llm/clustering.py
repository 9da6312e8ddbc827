"""Exact k-means in integers by Shallot search.

Every vector carries its nearest and second-nearest centroid and two bounds: its
distance to the nearest is at most ``upper``, to any other at least
``lower``. After a round the bounds move with the centroids. A vector whose upper
bound stays under its lower bound, or under half the way from its centroid
to the next one, keeps its centroid unseen. Any other
measures its two remembered centroids and starts from the closer one:
a centroid that comes closer than the second-nearest lies within the distance to
the start plus that to the second-nearest, so it walks the start's neighbours by distance
and stops at that ball, which shrinks whenever a nearer one is met. Bounds are floating-point
with a margin and only ever skip work; survivors are compared by their squared
distances in integers, ties going to the smaller number, so the result is that of a full
scan.

Vectors of a batch with the same start walk its list together, one
centroid at a time, as a shrinking set. See :mod:`.rounds` for what moves and what
bounds a task; the centroids and their distances (``k`` and its square) travel
with the tasks.

Defined cases: vectors that are null, of another length than ``dim``, or with null or
non-finite components take no part; scaled components whose squared distances may not fit a
long fail the job; a null id takes part, and starts a centroid only if the ids don't suffice;
repeated rows each count and get a row, and of rows sharing an id the smaller vectors start first; with fewer than ``k`` vectors all are centroids; equal centroids tie, the
smaller number wins and the others stay empty; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalog_sync.llm.rounds import Rounds, check_range, finite_vectors, floor_means, matrix, squared
from catalog_sync.llm.tables import Scratch

#: Relative margin of the bounds: far above their rounding errors, far below what decides a skip.
MARGIN = 1e-9


@dataclass
class Centroids:
    """Integer centroids with what the search needs: distances, sorted neighbours, half gaps, how far others last moved."""

    points: np.ndarray
    away: np.ndarray
    near_first: np.ndarray
    half_gap: np.ndarray
    moved: np.ndarray
    others_moved: np.ndarray

    @classmethod
    def of(cls, points: np.ndarray, before: np.ndarray | None = None) -> Centroids:
        k = len(points)
        away = np.sqrt(np.stack([squared(points, p[None]) for p in points]).astype(float))
        apart = away + np.diag(np.full(k, np.inf))
        moved = np.zeros(k) if before is None else np.sqrt(squared(points, before).astype(float))
        others = np.array([np.delete(moved, i).max(initial=0.0) for i in range(k)])
        return cls(points, away, np.argsort(apart, axis=1, kind="stable")[:, : k - 1], apart.min(axis=1) / 2, moved, others)


def shallot(x: np.ndarray, c: Centroids, near: np.ndarray, second: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> int:
    """Bring the four state arrays of the vectors ``x`` up to date in place; the number of measured distances."""
    points, n_measured = c.points, 0
    if len(points) == 1:
        near[:], upper[:], lower[:] = 0, np.sqrt(squared(x, points[:1]).astype(float)), np.inf
        return len(x)

    def open_(idx: np.ndarray) -> np.ndarray:
        return idx[upper[idx] * (1 + MARGIN) >= np.maximum(lower[idx], c.half_gap[near[idx]]) * (1 - MARGIN)]

    upper += c.moved[near]
    lower -= c.others_moved[near]
    todo = open_(np.arange(len(x)))
    upper[todo] = np.sqrt(squared(x[todo], points[near[todo]]).astype(float))
    n_measured += len(todo)
    todo = open_(todo)
    best, other = near[todo], second[todo]
    best_d, other_d = squared(x[todo], points[best]), squared(x[todo], points[other])
    n_measured += 2 * len(todo)
    swap = (other_d < best_d) | (other_d == best_d) & (other < best)
    best, other = np.where(swap, other, best), np.where(swap, best, other)
    best_d, other_d = np.where(swap, other_d, best_d), np.where(swap, best_d, other_d)
    start, reach = best.copy(), np.sqrt(best_d.astype(float))
    by_start = np.argsort(start, kind="stable")
    for own in np.split(by_start, np.flatnonzero(np.diff(start[by_start])) + 1):
        if not len(own):
            continue
        first = start[own[0]]
        for j in c.near_first[first]:
            own = own[c.away[first, j] * (1 - MARGIN) <= (reach[own] + np.sqrt(other_d[own].astype(float))) * (1 + MARGIN)]
            if not len(own):
                break
            d = squared(x[todo[own]], points[j][None])
            n_measured += len(own)
            wins = (d < best_d[own]) | (d == best_d[own]) & (j < best[own])
            next_ = ~wins & (j != best[own]) & ((d < other_d[own]) | (d == other_d[own]) & (j < other[own]))
            a, b = own[wins], own[next_]
            other[a], other_d[a] = best[a], best_d[a]
            best[a], best_d[a] = j, d[wins]
            other[b], other_d[b] = j, d[next_]
    near[todo], second[todo] = best, other
    upper[todo], lower[todo] = np.sqrt(best_d.astype(float)), np.sqrt(other_d.astype(float))
    return n_measured


def _state(batch: pa.RecordBatch, names: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
    return matrix(batch.column(names.index("vector"))), [batch.column(names.index(n)).to_numpy(zero_copy_only=False).copy() for n in ("near", "second", "upper", "lower")]


def first_centroids(vectors: DataFrame, k: int, order: Column) -> np.ndarray:
    """The ``k`` first vectors by ``order`` (nulls last; then by their components)."""
    return np.array([r["vector"] for r in vectors.orderBy(order.asc_nulls_last(), "vector").limit(k).collect()], np.int64)


def cluster(rows: DataFrame, scratch: Scratch, *, k: int, n_rounds: int, scale: int, dim: int, order: Column, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every vector of length ``dim``.

    The centroids start as the ``k`` vectors first by ``order`` (an expression over the id, named ``id``).
    """
    vectors = finite_vectors(rows.filter(F.size(F.col(f"`{vector}`")) == dim), vector, scale, {"id": vec_id})
    state = vectors.withColumns({"near": F.lit(0), "second": F.lit(1), "upper": F.lit(float("inf")), "lower": F.lit(0.0)})
    rounds = Rounds(state, scratch)
    names = rounds.schema.names
    points = first_centroids(rounds.table, k, order)
    result = "id long, cluster int, distance long"
    if not len(points):
        rounds.release()
        empty = rows.sparkSession.createDataFrame([], f"vec_id {dict(rows.dtypes)[vec_id]}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
        return empty
    check_range(points, dim)
    seen = Centroids.of(points)
    for _ in range(n_rounds):
        def assign(batch: pa.RecordBatch, seen: Centroids = seen):
            x, (near, second, upper, lower) = _state(batch, names)
            check_range(x, dim)
            shallot(x, seen, near, second, upper, lower)
            return {"near": pa.array(near, pa.int32()), "second": pa.array(second, pa.int32()), "upper": pa.array(upper), "lower": pa.array(lower)}, near, x

        counts, sums = rounds.run(assign, len(seen.points), dim)
        seen = Centroids.of(floor_means(seen.points, counts, sums), seen.points)

    def finish(batches):
        for batch in batches:
            if batch.num_rows:
                x, (near, second, upper, lower) = _state(batch, names)
                check_range(x, dim)
                shallot(x, seen, near, second, upper, lower)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(near, pa.int32()), pa.array(squared(x, seen.points[near]), pa.int64())], names=["id", "cluster", "distance"])

    result = f"id {rounds.schema['id'].dataType.simpleString()}, cluster int, distance long"
    placed = scratch.write(rounds.table.mapInArrow(finish, result), "placed")
    rounds.release()
    totals = {r["cluster"]: r["total"] for r in placed.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}  # at most k rows
    whole = sum(totals.values())
    facts = [(i, total, whole, hashlib.sha256(",".join(map(str, seen.points[i].tolist())).encode()).hexdigest()) for i, total in totals.items()]
    # a row per centroid, a parameter: small whatever the data
    named = F.broadcast(rows.sparkSession.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"))
    return placed.join(named, "cluster").select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
