"""Approximate nearest neighbours: inverted lists with an adaptive dimension scan.

Vectors are rotated by a random orthogonal matrix and stored list after list
in shards, dimension after dimension, so that a shard's first dimensions lie
together. Over the probed lists a query sums squared differences for one
column block after the other; after each, a hypothesis test compares the
partial distance with what a vector at the current k-th distance would show, and
candidates that fail are abandoned. The survivors' distances are computed in
double precision on the original vectors.

Equal vectors are one entry with their ``k + 1`` smallest ids (more of them
cannot be in any result), and equal queries are searched once, so a vector that
holds a third of all rows costs one entry. A shard holds several small lists or a part of
a long one, and a query travels once to each shard with the numbers of the lists it probes there, in
chunks of bounded size, so no task gets all queries. A query first scans its nearest lists (``FIRST_ROWS`` rows),
which bounds its k-th distance; with that bound it scans the others, all shards in parallel.

The lists are trained on a bounded sample (``sample_rows``); every row is
indexed. The number of probed lists is measured, not guessed: for
``tune_queries`` sampled queries the true neighbours are found by brute force over
all rows, and the smallest number that reaches ``recall`` on them is used.

Defined cases: vectors that are null, zero, of another length than the most
common one (the longer of equally common ones), or with null or non-finite components take no part, nor do null ids;
with fewer than ``k`` other vectors all are returned (probing goes on until enough rows are covered);
ties go to the smaller id; an id that several rows share counts once per query, at its smallest distance; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catalog_sync.llm.tables import Scratch

COLUMN_BLOCK = 16
#: Strictness of the hypothesis test: a true neighbour is abandoned with a probability of a few in a thousand at most.
EPSILON = 2.1
#: Rows of a query's nearest lists that set the distance the other lists are tested against.
FIRST_ROWS = 512
#: Queries that meet a shard in one group.
CHUNK_QUERIES = 16_384


def usable(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """``vec_id, vector`` (array of double) of the rows that take part."""
    v = F.col("vector")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("vector"))
    rows = rows.filter(F.col("vec_id").isNotNull() & v.isNotNull()).filter(fine)
    size = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.filter(F.size("vector") == (size["n"] if size else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    """A column of equally long lists as a matrix."""
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)


def _nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances less the points' own squares: enough to rank the centres of each point."""
    return (centres * centres).sum(axis=1) - 2 * points @ centres.T


def _own_centre(points: np.ndarray, centres: np.ndarray, rows: int = 1_024) -> np.ndarray:
    """The nearest centre of each point, in slices: a matrix of all points by all centres may be large."""
    return np.concatenate([_nearest(points[at : at + rows], centres).argmin(axis=1) for at in range(0, len(points), rows)])


def train_centres(sample: np.ndarray, n_lists: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    """k-means on a bounded sample; empty lists keep their old centre."""
    rng = np.random.default_rng(seed)
    centres = sample[rng.choice(len(sample), min(n_lists, len(sample)), replace=False)]
    for _ in range(rounds):
        own = _own_centre(sample, centres)
        sums, n = np.zeros_like(centres), np.bincount(own, minlength=len(centres))
        np.add.at(sums, own, sample)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


@dataclass
class Index:
    """A written index: ``entries`` (``list_id, ids, vector``), ``shards``, and what is bounded by the number of lists."""

    entries: DataFrame
    shards: DataFrame
    centres: np.ndarray
    rotation: np.ndarray
    sizes: np.ndarray  # rows per list, at most k + 1 per distinct vector
    first_shard: np.ndarray  # of each list
    n_shards: np.ndarray  # that each list is spread over
    k: int
    n_ids: int = 0  # distinct ids in the lists


def place_lists(n_entries: np.ndarray, shard_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """The first shard of each list and over how many it is spread: a long list has its own, short ones share."""
    spread = np.maximum(-(-n_entries // shard_rows), 1)
    first, at, held = np.zeros(len(n_entries), np.int64), 0, 0
    for i, n in enumerate(n_entries.tolist()):
        if held and held + n > shard_rows:
            at, held = at + 1, 0
        first[i] = at
        held += n
        if spread[i] > 1:
            at, held = at + int(spread[i]), 0
    return first, spread


def build_index(rows: DataFrame, scratch: Scratch, *, k: int, sample_rows: int = 16_384, lists_per_root: int = 4, max_lists: int = 4_096,
                block_rows: int | None = None, seed: int = 7) -> Index | None:
    """Index of all ``rows`` (output of :func:`usable`); None for an empty table.

    There are ``lists_per_root`` times the root of the number of distinct vectors as lists. ``block_rows`` (rows of a shard) bounds a
    task's memory; by default it is a 64th of the vectors, between 4,096 and 65,536.
    """
    by_vector = Window.partitionBy("vector").orderBy("vec_id")
    few = rows.withColumn("r", F.dense_rank().over(by_vector)).filter(F.col("r") <= k + 1)
    entries = scratch.write(few.groupBy("vector").agg(F.sort_array(F.collect_set("vec_id")).alias("ids")), "entries")
    sample = entries.select("vector", F.xxhash64(F.get("ids", F.lit(0))).alias("h")).orderBy("h").limit(sample_rows).toArrow()
    if not len(sample):
        return None
    points = _matrix(sample["vector"].combine_chunks())
    dim = points.shape[1]
    n_vectors = entries.count()
    n_lists = int(min(max_lists, max(1, round(lists_per_root * n_vectors**0.5))))
    block_rows = block_rows or min(max(n_vectors // 64, 4_096), 65_536)
    centres = train_centres(points, n_lists, seed=seed)
    rotation = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))[0]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                own = _own_centre(_matrix(batch.column(0)), centres)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(own, pa.int32())], names=["vector", "ids", "list_id"])

    assigned = scratch.write(entries.mapInArrow(assign, "vector array<double>, ids array<bigint>, list_id int"), "assigned")
    sizes, n_entries = np.zeros(len(centres), np.int64), np.zeros(len(centres), np.int64)
    for r in assigned.groupBy("list_id").agg(F.sum(F.size("ids")).alias("s"), F.count(F.lit(1)).alias("n")).collect():  # at most max_lists rows
        sizes[r["list_id"]], n_entries[r["list_id"]] = r["s"], r["n"]
    first, spread = place_lists(n_entries, block_rows)
    of_list = lambda numbers: F.get(F.lit(numbers.tolist()).cast("array<bigint>"), F.col("list_id"))
    dealt = assigned.withColumn("shard", (of_list(first) + F.pmod(F.xxhash64(F.get("ids", F.lit(0))), of_list(spread))).cast("int"))

    def lay_out(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        smallest = table["ids"].combine_chunks().flatten().to_numpy()[np.concatenate(([0], np.cumsum(table["n"].to_numpy())[:-1]))]
        table = table.take(pa.array(np.lexsort((smallest, table["list_id"].to_numpy())))).combine_chunks()
        lists, starts = np.unique(table["list_id"].to_numpy(), return_index=True)
        points = _matrix(table["vector"].combine_chunks())
        rotated = np.ascontiguousarray((points @ rotation).T.astype(np.float32))  # dimension after dimension
        return pa.table({
            "shard": table["shard"].slice(0, 1), "lists": pa.array([lists], pa.list_(pa.int32())), "starts": pa.array([starts], pa.list_(pa.int32())),
            "ids": pa.array([table["ids"].to_pylist()], pa.list_(pa.list_(pa.int64()))),
            "points": pa.array([points.tobytes()], pa.binary()), "rotated": pa.array([rotated.tobytes()], pa.binary())})

    shards = dealt.withColumn("n", F.size("ids")).groupBy("shard").applyInArrow(
        lay_out, "shard int, lists array<int>, starts array<int>, ids array<array<bigint>>, points binary, rotated binary")
    n_ids = assigned.select(F.explode("ids").alias("i")).distinct().count()
    return Index(assigned, scratch.write(shards, "shards"), centres, rotation, sizes, first, spread, k, n_ids)


def probe_order(points: np.ndarray, index: Index) -> np.ndarray:
    """The lists in each point's order of nearness."""
    return np.argsort(_nearest(points, index.centres), axis=1, kind="stable")


def measure_probes(queries: DataFrame, index: Index, *, recall: float, tune_queries: int) -> int:
    """Lists to probe for ``recall``: brute force of a bounded sample of the queries against every row, in batches."""
    sample = queries.orderBy(F.xxhash64("query_key"), "query_key").limit(tune_queries).toArrow()
    if not len(sample):
        return 1
    points, k = _matrix(sample["vector"].combine_chunks()), index.k + 1

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows, lists = _matrix(batch.column(0)), batch.column(1).to_numpy()
            apart = (points * points).sum(axis=1)[:, None] + (rows * rows).sum(axis=1) - 2 * points @ rows.T
            ids, out = batch.column(2).to_pylist(), []
            for q, order in enumerate(np.argsort(apart, axis=1, kind="stable")):
                taken: set[int] = set()
                for e in order:
                    if len(taken) >= k:
                        break
                    out += [(q, apart[q, e], lists[e], i) for i in ids[e] if i not in taken]
                    taken.update(ids[e])
            names = ["q", "d", "list_id", "vec_id"]
            kinds = [pa.int32(), pa.float64(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    found = index.entries.select("vector", "list_id", "ids").mapInArrow(best, "q int, d double, list_id int, vec_id bigint")
    found = found.groupBy("q", "vec_id").agg(F.min(F.struct("d", "list_id")).alias("n")).select("q", "n.*")
    ranked = found.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy("d", "list_id"))).filter(F.col("r") <= k)
    place = np.argsort(probe_order(points, index), axis=1)
    needed = np.sort([place[r["q"], r["list_id"]] for r in ranked.collect()])  # at most tune_queries * (k + 1) rows
    return int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))) - 1)]) + 1 if len(needed) else 1


def probes(queries: DataFrame, index: Index, n_probe: int, n_chunks: int) -> DataFrame:
    """A row for each query and shard with its probed ``lists`` there, nearest first; those that bound the search (``near``) apart.

    Probing goes on until the lists hold ``k + 1`` rows.
    """
    centres, sizes, first, spread, k = index.centres, index.sizes, index.first_shard, index.n_shards, index.k

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):  # a query may go to many shards
                part = batch.slice(at, 256)
                row, shard, near, lists = [], [], [], []
                for i, order in enumerate(np.argsort(_nearest(_matrix(part.column(1)), centres), axis=1, kind="stable")):
                    covered = np.cumsum(sizes[order])
                    n_lists = max(n_probe, int(np.searchsorted(covered, k + 1)) + 1)
                    n_near = int(np.searchsorted(covered, FIRST_ROWS)) + 1
                    for is_near, own in ((True, order[: min(n_near, n_lists)]), (False, order[n_near:n_lists])):
                        ends = np.cumsum(spread[own])
                        own = np.repeat(own, spread[own])
                        # the shards of a list follow each other
                        target = first[own] + np.arange(len(own)) - np.repeat(ends - np.diff(ends, prepend=0), np.diff(ends, prepend=0))
                        by_shard = np.argsort(target, kind="stable")
                        for group in np.split(by_shard, np.flatnonzero(np.diff(target[by_shard])) + 1):
                            if len(group):
                                row.append(i)
                                shard.append(target[group[0]])
                                near.append(is_near)
                                lists.append(own[group])
                taken = part.take(pa.array(row, pa.int64()))
                yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(shard, pa.int32()), pa.array(near, pa.bool_()), pa.array(lists, pa.list_(pa.int32()))],
                                                 names=["query_key", "vector", "shard", "near", "lists"])

    probed = queries.select("query_key", "vector").mapInArrow(run, "query_key bigint, vector array<double>, shard int, near boolean, lists array<int>")
    return probed.withColumn("chunk", F.pmod(F.xxhash64("query_key"), F.lit(n_chunks)).cast("int"))


def scan_block(query: np.ndarray, rotated_query: np.ndarray, points: np.ndarray, rotated: np.ndarray, ids: list[list[int]], k: int, bound: float,
               rows: np.ndarray | None = None, work: np.ndarray | None = None) -> list[tuple[float, int]]:
    """The ``k`` nearest (distance, id) of a shard's ``rows`` (default: all), each id once, those beyond ``bound`` left out.

    ``rotated`` has a row per dimension. Vectors are taken in runs; the first
    run sets the distance that the later ones are tested against. ``work`` adds up the
    dimensions of the candidates and how many of them were summed.
    """
    dim = len(rotated)
    rows = np.arange(rotated.shape[1]) if rows is None else rows
    best: list[tuple[float, int]] = []
    for at in range(0, len(rows), FIRST_ROWS):
        alive = rows[at : at + FIRST_ROWS]
        partial = np.zeros(len(alive))
        if work is not None:
            work[0] += len(alive) * dim
        for d in range(0, dim, COLUMN_BLOCK):
            if not len(alive):
                break
            upto = min(dim, d + COLUMN_BLOCK)
            if work is not None:
                work[1] += len(alive) * (upto - d)
            diff = rotated[d:upto, alive] - rotated_query[d:upto, None]
            partial = partial + np.einsum("ij,ij->j", diff, diff)
            if upto < dim and np.isfinite(bound):
                # under the hypothesis "no farther than bound" the scaled partial distance stays below this
                passed = partial * (dim / upto) <= (bound * (1 + EPSILON / np.sqrt(upto))) ** 2
                alive, partial = alive[passed], partial[passed]
        if np.isfinite(bound):
            alive = alive[partial <= (bound * (1 + 1e-4)) ** 2 + 1e-9]  # partial sums are in single precision
        if len(alive):
            exact = np.sqrt(((points[alive] - query) ** 2).sum(axis=1))
            best += [(d, i) for d, a in zip(exact.tolist(), alive.tolist(), strict=True) if d <= bound for i in ids[a]]
            nearest: dict[int, float] = {}
            for d, i in sorted(best):  # an id counts once, at its smallest distance
                nearest.setdefault(i, d)
            best = [(d, i) for i, d in nearest.items()][:k]
            if len(best) == k:
                bound = min(bound, best[-1][0])
    return best


def _scan(probed: DataFrame, index: Index, n_chunks: int) -> DataFrame:
    """``query_key, vec_id, score``: the nearest rows of each query's probed lists in each shard; ``probed`` has a ``bound`` per query."""
    k, rotation = index.k + 1, index.rotation

    def run(queries: pa.Table, shard: pa.Table) -> pa.Table:
        out: list[tuple[int, int, float]] = []
        if len(queries) and len(shard):
            ids = shard["ids"][0].as_py()
            points = np.frombuffer(shard["points"][0].as_buffer()).reshape(len(ids), -1)
            rotated = np.frombuffer(shard["rotated"][0].as_buffer(), np.float32).reshape(-1, len(ids))
            starts = shard["starts"][0].as_py()
            span = {at: np.arange(a, b) for at, a, b in zip(shard["lists"][0].as_py(), starts, [*starts[1:], len(ids)], strict=True)}
            wanted = _matrix(queries["vector"].combine_chunks())
            turned = (wanted @ rotation).astype(np.float32)
            for i, (key, bound, lists) in enumerate(zip(queries["query_key"].to_pylist(), queries["bound"].to_pylist(), queries["lists"].to_pylist(), strict=True)):
                held = [span[at] for at in lists if at in span]
                if held:
                    out += [(key, v, d) for d, v in scan_block(wanted[i], turned[i], points, rotated, ids, k, bound, np.concatenate(held))]
        q, v, d = zip(*out, strict=True) if out else ((), (), ())
        return pa.table({"query_key": pa.array(q, pa.int64()), "vec_id": pa.array(v, pa.int64()), "score": pa.array(d, pa.float64())})

    shards = index.shards.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1))))
    return probed.groupBy("shard", "chunk").cogroup(shards.groupBy("shard", "chunk")).applyInArrow(run, "query_key bigint, vec_id bigint, score double")


def _nearest_rows(found: DataFrame, by: str, k: int) -> DataFrame:
    """The ``k`` nearest rows of each group with their ``rank``, ties to the smaller id; cut before the shuffle, too."""
    order = Window.partitionBy(by).orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _once(found: DataFrame) -> DataFrame:
    """Each id of a query once, at its smallest distance."""
    return found.groupBy("query_key", "vec_id").agg(F.min("score").alias("score"))


def search(index: Index, queries: DataFrame, scratch: Scratch, *, recall: float = 0.97, tune_queries: int = 200) -> DataFrame:
    """``query_key, vec_id, score`` of the ``k + 1`` nearest rows of each query (``query_key, vector``; keys are distinct)."""
    n_probe = measure_probes(queries, index, recall=recall, tune_queries=tune_queries)
    n_chunks = -(-queries.count() // CHUNK_QUERIES) or 1
    probed = scratch.write(probes(queries, index, n_probe, n_chunks), "probes")
    near = scratch.write(_scan(probed.filter("near").withColumn("bound", F.lit(float("inf"))), index, n_chunks), "nearest-lists")
    bounds = _nearest_rows(_once(near), "query_key", index.k + 1).groupBy("query_key").agg(F.max("score").alias("far"), F.count(F.lit(1)).alias("n"))
    bounds = bounds.select(F.col("query_key").alias("q"), F.when(F.col("n") > index.k, F.col("far")).alias("far"))
    rest = probed.filter("NOT near").join(bounds, F.col("query_key") == F.col("q"), "left").drop("q")
    rest = rest.withColumn("bound", F.coalesce("far", F.lit(float("inf")))).drop("far")
    found = _nearest_rows(_once(near.unionByName(_scan(rest, index, n_chunks))), "query_key", index.k + 1).select("query_key", "vec_id", "score")
    if int(index.sizes.sum()) == index.n_ids:  # no id is shared: the probed lists hold enough
        return found
    # the probed lists of a query can hold few ids: then all lists are searched
    found = scratch.write(found, "found")
    enough = found.groupBy("query_key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min(index.k + 1, index.n_ids)).select("query_key")
    short = scratch.write(queries.join(enough, "query_key", "left_anti"), "short-queries")
    everywhere = probes(short, index, len(index.centres), n_chunks).withColumn("bound", F.lit(float("inf")))
    whole = _nearest_rows(_once(_scan(everywhere, index, n_chunks)), "query_key", index.k + 1).select("query_key", "vec_id", "score")
    return found.join(enough, "query_key", "left_semi").unionByName(whole)


def nearest_neighbours(vectors: DataFrame, queries: DataFrame, scratch: Scratch, *, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding",
                       recall: float = 0.97, tune_queries: int = 200, **build: int) -> DataFrame:
    """``query_id, rank, vec_id, score`` (Euclidean): the ``k`` nearest rows of ``vectors`` of each row of ``queries``, its own id left out."""
    rows = usable(vectors, vec_id, vector)
    wanted = usable(queries, vec_id, vector).select(F.col("vec_id").alias("query_id"), "vector")
    index = build_index(rows, scratch, k=k, **build)
    if index is None:
        return wanted.filter("false").select("query_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("vec_id"), F.lit(0.0).alias("score"))
    wanted = scratch.write(wanted.filter(F.size("vector") == len(index.rotation)), "queries")
    distinct = scratch.write(wanted.groupBy("vector").agg(F.min("query_id").alias("query_key")), "distinct-queries")
    # a key names one vector: an id that repeats with other vectors gets more keys
    distinct = scratch.write(distinct.select(F.monotonically_increasing_id().alias("query_key"), "vector"), "query-keys")
    found = search(index, distinct, scratch, recall=recall, tune_queries=tune_queries)
    named = wanted.join(distinct, "vector").select("query_id", "query_key").distinct()
    pairs = named.join(found, "query_key").filter("query_id != vec_id").groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    return _nearest_rows(pairs, "query_id", k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
