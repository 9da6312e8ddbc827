"""All-products neighbours by a neighbour graph (NN-descent), for tables too large for a square scan.

Random-projection trees put near vectors into leaves; the exact neighbours
within a leaf seed a graph of ``degree`` edges per product. Each round then joins what
neighbours have in common: the neighbours and reverse neighbours of a product are scored
against each other where one of the two is new, and every product keeps its ``degree`` best. Rounds end when few of
the edges in use are new. A round's work is rows x (2 ``sample``) squared / 2 at most, whatever the number
of rows, and the rounds needed grow slowly, so the scored pairs grow little faster than
the rows.

Where the category counts (``w > 0``) a second graph links the products of each category, in the same rounds: the
best by blended score are among the nearest of the same category and the nearest of all. A category of up to
:data:`EXACT_ROWS` nodes is scored whole, once, and moves through no round.

Equal vectors (of one category, and of one brand where the brand rule holds) are one node with
their ``k + 1`` smallest ids: more of them can't be in a result, and a vector
that holds a third of all rows costs one node. During the descent distances come from
vectors rounded to 8 bits a component, a quarter of what moves; the ``shortlist`` best of each product are scored exactly.

Nodes live in parts, the branches of the first tree, and all that moves between parts is packed: the used edges that lead from one part
to another are one row, the codes that a part's lists name come once for all of them, and a part merges what its lists found
(the ``degree`` best of each node) before it is sent. So a round moves rows by the pairs of parts, not by edges, and bytes by the edges.
Every round is a written table, read by the next and then deleted.

What is bounded: trees are grown on at most ``SAMPLE_ROWS`` vectors; a leaf holds a 16th of its graph, from ``leaf_rows`` to ``LEAF_GROWTH`` times
as many, and is cut into blocks of at most twice that by hash, as parts are of ``PART_ROWS``; a product's reverse neighbours are sampled down to ``sample``
before their shuffle (the method itself; what a round misses others bring), so a product that is near to very many
makes no long list; a part's lists name at most ``2 * sample`` codes a node.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize_at, release
from .similar import CHUNK_ROWS, DIGITS, _best, _items, _pair_schema, _places, _scan_against

SAMPLE_ROWS = 1 << 16
#: Sampled vectors a tree's node must hold to be split at its own median; deeper levels are split at zero.
NODE_SAMPLE = 64
#: Nodes of a category up to which its graph is exact: one leaf, scored at once, that takes no part in the rounds.
EXACT_ROWS = 4096
#: Times ``leaf_rows`` that a leaf may hold in a large graph.
LEAF_GROWTH = 16
#: The graph of all nodes, among those of the categories.
ALL = "all"
#: Nodes of a part, the unit in which lists are kept, sent and joined: at most about twice as many.
PART_ROWS = 12288
#: A node's number in a graph is its part's, then its place there in so many bits; together with a place it fits a long.
PLACE_BITS, NODE_BITS = 20, 43
PLACES = (1 << PLACE_BITS) - 1


@dataclass
class GraphReport:
    """What a run did: nodes, scored pairs (leaves and rounds), and of each round the share of used edges that were new."""

    nodes: int = 0
    scored: int = 0
    rounds: list[float] = field(default_factory=list)


def _unit(vectors: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.nan_to_num(vectors / np.linalg.norm(vectors, axis=1, keepdims=True), posinf=0.0, neginf=0.0)


def _rounded(vectors: np.ndarray) -> np.ndarray:
    """Components as signed bytes; the length is lost, the direction kept."""
    most = np.abs(vectors).max(axis=1, keepdims=True, initial=0.0)
    return np.round(np.nan_to_num(vectors / np.where(most > 0, most, 1.0)) * 127).astype(np.int8)


def _grow(sample: np.ndarray, depth: int, seed: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """A tree: one direction per level, and per level the threshold of each node (zero where the sample is too thin)."""
    rng = np.random.default_rng(seed)
    planes = rng.normal(size=(sample.shape[1], max(depth, 1)))
    levels, node = [], np.zeros(len(sample), np.int64)
    for level in range(depth):
        if len(sample) >> level < NODE_SAMPLE:
            break
        p = sample @ planes[:, level]
        order = np.lexsort((p, node))
        starts = np.searchsorted(node[order], np.arange((1 << level) + 1))
        cuts = np.array([np.median(p[order[a:b]]) if b > a else 0.0 for a, b in zip(starts[:-1], starts[1:], strict=True)])
        levels.append(cuts)
        node = 2 * node + (p > cuts[node])
    return planes, levels


def _leaves(vectors: np.ndarray, planes: np.ndarray, levels: list[np.ndarray], depth: int) -> np.ndarray:
    """The path of each vector, the first level's side in the highest of ``depth`` bits."""
    node = np.zeros(len(vectors), np.int64)
    for level in range(depth):
        cut = levels[level][node] if level < len(levels) else 0.0
        node = 2 * node + (vectors @ planes[:, level] > cut)
    return node


def _nodes(items: DataFrame, k: int, key: list[str]) -> DataFrame:
    """One row per distinct ``key``: ``n`` (a number), the key, and the ``k + 1`` smallest ids."""
    few = items.withColumn("__r", F.dense_rank().over(Window.partitionBy(*key).orderBy("id"))).filter(F.col("__r") <= k + 1)
    grouped = few.groupBy(*key).agg(F.sort_array(F.collect_set("id")).alias("ids"))
    return materialize_at(grouped.withColumn("n", F.monotonically_increasing_id()), "graph-nodes")[0]


def _leaf_size(rows, leaf_rows: int):
    """Rows of a leaf of a graph of ``rows`` nodes: a 16th of them, from ``leaf_rows`` to ``LEAF_GROWTH`` times as many. Scoring a leaf is one matrix product."""
    return F.greatest(F.lit(leaf_rows), F.least(F.lit(LEAF_GROWTH * leaf_rows), F.floor(rows / F.lit(16)))).cast("int")


def _levels(rows, size, depth: int):
    """Splits that bring ``rows`` to ``size``, at most ``depth``."""
    return F.greatest(F.lit(0), F.least(F.lit(depth), F.ceil(F.log2(rows / size)))).cast("int")


def _coded(nodes: DataFrame, dim: int, n: int, trees: int, leaf_rows: int, seed: int, by_category: bool) -> tuple[DataFrame, int]:
    """``n, q, paths`` of every node in each graph it is in (``cat``), with the graph's ``exact, levels, part_levels`` and ``size`` of a leaf; the trees' depth."""
    depth = max(0, math.ceil(math.log2(max(1, n / max(leaf_rows, min(LEAF_GROWTH * leaf_rows, n // 16))))))
    sample = nodes.select("vector", F.xxhash64("n").alias("h")).orderBy("h").limit(SAMPLE_ROWS).toPandas()
    points = _unit(np.vstack(sample["vector"].to_numpy()).astype(np.float64))
    grown = [_grow(points, depth, seed + t) for t in range(trees)]

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                raw = batch.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, dim)
                unit = _unit(raw)
                paths = np.stack([_leaves(unit, *t, depth) for t in grown], axis=1)
                q = pa.array([row.tobytes() for row in _rounded(raw)], pa.binary())
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, trees * batch.num_rows + 1, trees), pa.int32()), pa.array(paths.ravel(), pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), q, lists], names=["n", "category", "q", "paths"])

    schema = f"n long, category {nodes.schema['category'].dataType.simpleString()}, q binary, paths array<long>"
    coded = materialize_at(nodes.select("n", "category", "vector").mapInArrow(code, schema), "graph-codes")[0]

    def shape(rows):
        size = _leaf_size(rows, leaf_rows)
        return [_levels(rows, size, depth).alias("levels"), _levels(rows, F.lit(PART_ROWS), depth).alias("part_levels"), size.alias("size")]

    whole = coded.select("n", "q", "paths", F.lit(ALL).alias("cat"), F.lit(False).alias("exact"), *shape(F.lit(n)))
    if by_category:
        kinds = coded.filter("category IS NOT NULL").groupBy(F.col("category").alias("__c")).agg(F.count(F.lit(1)).alias("__n"))
        kinds = kinds.select("__c", (F.col("__n") <= EXACT_ROWS).alias("exact"), *shape(F.col("__n")))
        own = coded.join(kinds, F.col("category") == F.col("__c"))
        whole = whole.unionByName(own.select("n", "q", "paths", F.concat(F.lit("of "), F.col("category").cast("string")).alias("cat"), "exact", "levels", "part_levels", "size"))
    return whole, depth


def _placed(coded: DataFrame, depth: int) -> DataFrame:
    """``coded`` with the number of the part a node lives in (odd in a category's graph) and its place there.

    A part is a branch of the first tree, so neighbours often share it; a branch that is too large is dealt by hash.
    """
    branch = ["cat", "branch"]
    coded = coded.withColumn("branch", F.expr(f"shiftright(paths[0], {depth} - part_levels)"))
    sizes = coded.groupBy(*branch).agg(F.ceil(F.count(F.lit(1)) / F.lit(2 * PART_ROWS)).cast("int").alias("blocks"))
    # a row per branch: few
    sizes = sizes.withColumn("first", F.sum("blocks").over(Window.orderBy(*branch).rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("blocks"))
    number = 2 * (F.col("first") + F.pmod(F.xxhash64("n"), F.col("blocks"))) + (F.col("cat") != ALL).cast("int")
    placed = coded.join(sizes, branch).withColumn("part", number.cast("long"))
    placed = placed.withColumn("place", (F.row_number().over(Window.partitionBy("part").orderBy("n")) - 1).cast("long"))
    return placed.select(F.shiftleft("part", PLACE_BITS).bitwiseOR(F.col("place")).alias("g"), "part", "n", "q", "paths", "cat", "levels", "size")


EDGES = "v long, u long, d float, scored long"
#: Edges to nodes of part ``v``, packed: places there (int32), ends (int64), distances (float32).
PACKED = "v long, at binary, u binary, d binary, scored long"
#: What part ``src`` sends part ``v``: used edges into it (its own place, the place in ``v``, new or not), the places of their ends in ``v`` and of those of its own nodes that come with them.
MAIL = "v long, src long, at binary, u binary, fresh binary, asks binary, places binary"
#: Codes and reaches of nodes of part ``src`` for part ``v``.
CODES = "v long, src long, places binary, q binary, reach binary"
STATE = "part long, n binary, q binary, u binary, d binary, fresh binary, reach binary, used long, new long, scored long"


def _inverse_norms(q: np.ndarray) -> np.ndarray:
    norm = np.sqrt(np.einsum("ij,ij->i", q, q, dtype=np.float32))
    return (1 / np.where(norm > 0, norm, 1)).astype(np.float32)


def _nearest(q: np.ndarray, degree: int, rows_at_once: int = 1024) -> tuple[np.ndarray, np.ndarray]:
    """Of each row the places of its ``degree`` nearest others (all, if fewer) by rounded vectors, and their cosine distances."""
    x = q.astype(np.float32) * _inverse_norms(q)[:, None]
    k = min(degree, len(x) - 1)
    best, distance = np.empty((len(x), k), np.int64), np.empty((len(x), k), np.float32)
    for i in range(0, len(x), rows_at_once):
        d = 1 - x[i:i + rows_at_once] @ x.T
        d[np.arange(len(d)), np.arange(i, i + len(d))] = np.inf
        best[i:i + len(d)] = at = np.argpartition(d, k - 1, axis=1)[:, :k]
        distance[i:i + len(d)] = np.take_along_axis(d, at, 1)
    return best, distance


def _leaf_edges(degree: int, dim: int):
    """pandas function for a category: the best ``degree`` of each node; the pairs scored as an edge of -1."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        v = pdf["v"].to_numpy()
        if len(v) < 2:
            return pd.DataFrame({"v": [], "u": [], "d": [], "scored": []})
        best, d = _nearest(np.frombuffer(b"".join(pdf["q"]), np.int8).reshape(len(v), dim), degree)
        out = pd.DataFrame({"v": np.repeat(v, best.shape[1]), "u": v[best].ravel(), "d": d.ravel(), "scored": 0})
        return pd.concat([out, pd.DataFrame({"v": [-1], "u": [-1], "d": [0.0], "scored": [len(v) * (len(v) - 1) // 2]})], ignore_index=True)

    return run


def _packed(v: np.ndarray, u: np.ndarray, d: np.ndarray, scored: int) -> pd.DataFrame:
    """Edges as rows of ``PACKED``, one per part of ``v``, which is sorted; the first says how many pairs were scored."""
    part = v >> PLACE_BITS
    cuts = np.flatnonzero(np.diff(part, prepend=-1))
    rows = [(int(part[a]), (v[a:b] & PLACES).astype(np.int32).tobytes(), u[a:b].tobytes(), d[a:b].tobytes(), 0) for a, b in zip(cuts, np.append(cuts, len(v))[1:], strict=True)]
    out = pd.DataFrame(rows or [(-1, b"", b"", b"", 0)], columns=["v", "at", "u", "d", "scored"])
    out.loc[0, "scored"] = scored
    return out


def _seeds(degree: int, dim: int):
    """pandas function for one block of a leaf: the best ``degree`` of each."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("g")
        g = pdf["g"].to_numpy()
        if len(g) < 2:
            return _packed(g[:0], g[:0], g[:0].astype(np.float32), 0)
        best, d = _nearest(np.frombuffer(b"".join(pdf["q"]), np.int8).reshape(len(g), dim), degree)
        return _packed(np.repeat(g, best.shape[1]), g[best].ravel(), d.ravel(), len(g) * (len(g) - 1) // 2)

    return run


def _joined(values: pd.Series, kind) -> np.ndarray:
    return np.frombuffer(b"".join(v for v in values if v is not None), kind)


def _ranks(group: np.ndarray) -> np.ndarray:
    """Places of rows within their group; ``group`` is sorted."""
    return np.arange(len(group)) - np.searchsorted(group, group)


def _merge(degree: int, sample: int):
    """Function of a part's new edges and its state: the ``degree`` best distinct edges of each node; an edge is new until it was among those in use."""

    def run(key, found: pd.DataFrame, state: pd.DataFrame) -> pd.DataFrame:
        old = state.iloc[0]
        rows = len(old["n"]) // 8
        at, u, d = _joined(found["at"], np.int32).astype(np.int64), _joined(found["u"], np.int64), _joined(found["d"], np.float32)
        fresh = np.ones(len(u), bool)
        if old["u"] is not None:
            lists = np.frombuffer(old["u"], np.int64).reshape(rows, degree)
            place, rank = np.nonzero(lists >= 0)
            still = np.frombuffer(old["fresh"], bool).reshape(rows, degree)[place, rank] & (rank >= sample)
            at, u = np.append(place, at), np.append(lists[place, rank], u)
            d, fresh = np.append(np.frombuffer(old["d"], np.float32).reshape(rows, degree)[place, rank], d), np.append(still, fresh)
        order = np.argsort(at << NODE_BITS | u, kind="stable")  # the edge that was there stays
        at, u, d, fresh = at[order], u[order], d[order], fresh[order]
        once = (np.diff(at, prepend=-1) != 0) | (np.diff(u, prepend=-1) != 0)
        at, u, d, fresh = at[once], u[once], np.maximum(d[once], 0), fresh[once]
        order = np.argsort(at << 32 | d.view(np.int32), kind="stable")  # by distance, then by u
        order = order[_ranks(at[order]) < degree]
        at, u, d, fresh = at[order], u[order], d[order], fresh[order]
        rank = _ranks(at)
        lists, distance, new = np.full((rows, degree), -1, np.int64), np.full((rows, degree), np.inf, np.float32), np.zeros((rows, degree), bool)
        lists[at, rank], distance[at, rank], new[at, rank] = u, d, fresh
        used = rank < sample
        return pd.DataFrame([(key[0], old["n"], old["q"], lists.tobytes(), distance.tobytes(), new.tobytes(), np.ascontiguousarray(distance[:, -1]).tobytes(),
                              int(used.sum()), int(fresh[used].sum()), int(found["scored"].sum()))], columns=[x.split()[0] for x in STATE.split(", ")])

    return run


def _chosen(u: np.ndarray, v: np.ndarray, sample: int, turn: int) -> np.ndarray:
    """Of the edges ``v -> u`` at most ``sample`` of each ``u``, by a hash: places, by ``u``. A choice from chosen ones is that from all."""
    with np.errstate(over="ignore"):
        h = (u.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ v.astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(turn)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    order = np.lexsort((h >> np.uint64(32), u))
    return order[_ranks(u[order]) < sample]


def _mail(degree: int, sample: int, turn: int):
    """pandas function: what a part sends to the parts that its used edges lead to."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for part, u, fresh in pdf[["part", "u", "fresh"]].itertuples(index=False):
                u, fresh = (np.frombuffer(x, kind).reshape(-1, degree)[:, :sample] for x, kind in ((u, np.int64), (fresh, bool)))
                place, rank = np.nonzero(u >= 0)
                u, fresh = u[place, rank], fresh[place, rank]
                asked = np.unique(u)
                back = _chosen(u, place + (part << PLACE_BITS), sample, turn)
                u, place, fresh = u[back], place[back].astype(np.int32), fresh[back]
                to = np.unique(asked >> PLACE_BITS)
                rows = []
                for p, a, b, c, e in zip(to.tolist(), *(np.searchsorted(x, y << PLACE_BITS) for x in (u, asked) for y in (to, to + 1)), strict=True):
                    rows.append((p, part, place[a:b].tobytes(), (u[a:b] & PLACES).astype(np.int32).tobytes(), fresh[a:b].tobytes(),
                                 (asked[c:e] & PLACES).astype(np.int32).tobytes(), np.unique(place[a:b]).tobytes()))
                yield pd.DataFrame(rows, columns=[x.split()[0] for x in MAIL.split(", ")])

    return run


def _codes(dim: int):
    """Function of the places (``v, src``: of a part, for another) that mail names and the part's state: their codes and reaches, each once."""

    def run(key, named: pd.DataFrame, state: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(named):
            q, reach = np.frombuffer(state.iloc[0]["q"], np.int8).reshape(-1, dim), np.frombuffer(state.iloc[0]["reach"], np.float32)
            for to, places in named.groupby("src")["places"]:
                places = np.unique(_joined(places, np.int32))
                rows.append((to, key[0], places.tobytes(), q[places].tobytes(), reach[places].tobytes()))
        return pd.DataFrame(rows, columns=[x.split()[0] for x in CODES.split(", ")])

    return run


def _best_found(a: np.ndarray, b: np.ndarray, s: np.ndarray, least: np.ndarray, degree: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``degree`` best distinct pairs of each ``a``, sorted by ``a``; ``least`` rises to what a pair must exceed to be among them."""
    order = np.argsort(a << 32 | b)
    a, b, s = a[order], b[order], s[order]
    once = (np.diff(a, prepend=-1) != 0) | (np.diff(b, prepend=-1) != 0)
    a, b, s = a[once], b[once], s[once]
    if len(a) and np.bincount(a).max() > degree:
        order = np.argsort(a << 32 | np.maximum(1 - s, 0).view(np.int32).astype(np.int64))
        rank = _ranks(a[order])
        last = order[rank == degree - 1]
        least[a[last]] = np.maximum(least[a[last]], s[last])
        order = order[rank < degree]
        a, b, s = a[order], b[order], s[order]
    return a, b, s


def _local_join(dim: int, degree: int, sample: int, turn: int, lists_at_once: int = 64, pairs_at_once: int = 1 << 21):
    """Function of the mail to a part and its state: each list's members against each other; the pairs that would enter a member's list."""

    def run(key, mail: pd.DataFrame, state: pd.DataFrame) -> pd.DataFrame:
        own, old = key[0] << PLACE_BITS, state.iloc[0]
        # all nodes that the lists name, in order
        codes, sent = mail[mail["q"].notna()].sort_values("src"), mail[mail["u"].notna()]
        known = np.concatenate([np.zeros(0, np.int64), *[(src << PLACE_BITS) + np.frombuffer(p, np.int32) for src, p in zip(codes["src"], codes["places"], strict=True)]])
        q, least = _joined(codes["q"], np.int8).reshape(-1, dim), 1 - _joined(codes["reach"], np.float32)
        scale = _inverse_norms(q)
        # the lists: used edges and those back
        lists, flags = (np.frombuffer(old[c], kind).reshape(-1, degree)[:, :sample] for c, kind in (("u", np.int64), ("fresh", bool)))
        owner, rank = np.nonzero(lists >= 0)
        member, fresh = lists[owner, rank], flags[owner, rank]
        if len(sent):
            to = _joined(sent["u"], np.int32).astype(np.int64)
            v = np.concatenate([(src << PLACE_BITS) + np.frombuffer(p, np.int32) for src, p in zip(sent["src"], sent["at"], strict=True)])
            back = _chosen(own + to, v, sample, turn)
            owner, member, fresh = np.append(owner, to[back]), np.append(member, v[back]), np.append(fresh, _joined(sent["fresh"], bool)[back])
        order = np.argsort(owner << NODE_BITS | member)
        owner, member, fresh = owner[order], member[order], fresh[order]
        starts = np.flatnonzero((np.diff(owner, prepend=-1) != 0) | (np.diff(member, prepend=-1) != 0))
        if not len(starts):
            return _packed(known[:0], known[:0], least[:0], 0)
        owner, member, fresh = owner[starts], member[starts], np.logical_or.reduceat(fresh, starts)
        place = np.searchsorted(known, member)
        if not np.array_equal(known[np.minimum(place, len(known) - 1)], member):
            raise ValueError("a list names a node whose code did not come")
        member = place
        begins = np.flatnonzero(np.diff(owner, prepend=-1))
        sizes = np.diff(begins, append=len(owner))
        new = np.add.reduceat(fresh.astype(np.int64), begins)
        begins, sizes, new = (x[(new > 0) & (sizes > 1)] for x in (begins, sizes, new))
        scored = int((sizes * (sizes - 1) // 2 - (sizes - new) * (sizes - new - 1) // 2).sum())
        kept, waiting, count = [], [], 0
        for at in range(0, len(begins), lists_at_once):
            size = sizes[at:at + lists_at_once]
            most = int(size.max())
            place = np.arange(most)
            inside = place < size[:, None]
            where = np.where(inside, begins[at:at + lists_at_once, None] + place, 0)
            m, f = member[where], fresh[where]
            x = q[m].astype(np.float32) * np.where(inside, scale[m], 0)[:, :, None]
            s = np.matmul(x, x.transpose(0, 2, 1))
            s[:, place, place] = -np.inf
            hit = _places((s > np.where(inside, least[m], np.inf)[:, :, None]).ravel())
            row, b = np.divmod(hit, most)
            i = row // most
            m, f = m.ravel(), f.ravel()
            other = i * most + b
            ok = inside.ravel()[other] & (f[row] | f[other])
            waiting.append((m[row[ok]], m[other[ok]], s.ravel()[hit[ok]]))
            count += len(waiting[-1][0])
            if count >= pairs_at_once or at + lists_at_once >= len(begins):
                kept.append(_best_found(*(np.concatenate(x) for x in zip(*waiting, strict=True)), least, degree))
                waiting, count = [], 0
                if sum(len(x[0]) for x in kept[1:]) > max(2 * pairs_at_once, len(kept[0][0])):
                    kept = [_best_found(*(np.concatenate(x) for x in zip(*kept, strict=True)), least, degree)]
        if not kept:
            return _packed(known[:0], known[:0], least[:0], scored)
        a, b, s = _best_found(*(np.concatenate(x) for x in zip(*kept, strict=True)), least, degree)
        here = (known[a] >> PLACE_BITS) == key[0]  # what a node of this part has is seen here
        if here.any():
            mine = np.flatnonzero(here)
            whole = np.frombuffer(old["u"], np.int64).reshape(-1, degree)
            have = np.sort(((np.arange(len(whole)) << NODE_BITS)[:, None] | whole)[whole >= 0])
            edge = (known[a[mine]] - own) << NODE_BITS | known[b[mine]]
            drop = mine[have[np.minimum(np.searchsorted(have, edge), len(have) - 1)] == edge] if len(have) else mine[:0]
            a, b, s = (np.delete(x, drop) for x in (a, b, s))
        order = np.argsort(a, kind="stable")
        return _packed(known[a[order]], known[b[order]], 1 - s[order], scored)

    return run


def _kept(edges: DataFrame, degree: int, sample: int) -> DataFrame:
    """The ``degree`` best distinct edges of each node as a sorted list; an edge is new until it was among those in use.

    ``edges``: ``v, u, d, fresh``. Equal pairs are merged map-side first, and the cut runs before the
    shuffle by node as well (window group limit).
    """
    once = edges.groupBy("v", "u").agg(F.min("d").alias("d"), F.min("fresh").alias("fresh"))
    best = once.withColumn("r", F.row_number().over(Window.partitionBy("v").orderBy("d", "u"))).filter(F.col("r") <= degree)
    return best.groupBy("v").agg(F.sort_array(F.collect_list(F.struct("d", "u", "fresh"))).alias("edges"))


def _counted(spark: SparkSession, edges: DataFrame, name: str, report: GraphReport) -> tuple[DataFrame, str]:
    """``edges`` as a written table; the scored pairs that came along are added to the report."""
    table, path = materialize_at(edges, name)
    report.scored += table.agg(F.coalesce(F.sum("scored"), F.lit(0))).first()[0]
    return table.filter("v >= 0"), path


def neighbour_graph(nodes: DataFrame, dim: int, *, degree: int, sample: int, trees: int, leaf_rows: int, max_rounds: int, min_new: float,
                    seed: int, by_category: bool, short: int, report: GraphReport) -> DataFrame:
    """``a, b``: of each node in each graph it is in the ``short`` nearest (numbers ``n``; a pair may come twice); see the module."""
    spark = nodes.sparkSession
    report.nodes = nodes.count()
    coded, depth = _coded(nodes, dim, report.nodes, trees, leaf_rows, seed, by_category)
    placed, _ = materialize_at(_placed(coded.filter("NOT exact"), depth), "graph-places")

    def pack(key, pdf):
        pdf = pdf.sort_values("g")
        return pd.DataFrame([(key[0], pdf["n"].to_numpy().tobytes(), b"".join(pdf["q"]), *[None] * 4, 0, 0, 0)], columns=[x.split()[0] for x in STATE.split(", ")])

    state = placed.select("part", "g", "n", "q").groupBy("part").applyInPandas(pack, STATE)
    # a graph that fits a leaf needs one tree
    leaf = ["tree", "cat", "leaf"]
    leaves = placed.select("g", "q", "cat", "levels", "size", F.posexplode("paths").alias("tree", "path")).filter("levels > 0 OR tree = 0")
    leaves = leaves.withColumn("leaf", F.expr(f"shiftright(path, {depth} - levels)")).drop("path", "levels")
    sizes = leaves.groupBy(*leaf).agg(F.ceil(F.count(F.lit(1)) / (2 * F.max("size"))).cast("int").alias("blocks"))
    blocks = leaves.join(sizes, leaf).withColumn("block", F.pmod(F.xxhash64("g", "tree"), F.col("blocks")))
    seeds = blocks.select(*leaf, "block", "g", "q").groupBy(*leaf, "block").applyInPandas(_seeds(degree, dim), PACKED)
    merged = lambda found, state: found.groupBy("v").cogroup(state.groupBy("part")).applyInPandas(_merge(degree, sample), STATE)
    state, state_at = materialize_at(merged(seeds.filter("v >= 0"), state), "graph")
    report.scored += state.agg(F.coalesce(F.sum("scored"), F.lit(0))).first()[0]
    for turn in range(max_rounds):
        used, new = state.agg(F.coalesce(F.sum("used"), F.lit(0)), F.coalesce(F.sum("new"), F.lit(0))).first()
        share = new / used if used else 0.0
        report.rounds.append(round(share, 4))
        if share <= min_new:
            break
        mail, mail_at = materialize_at(state.select("part", "u", "fresh").mapInPandas(_mail(degree, sample, turn), MAIL), "graph-mail")
        named = mail.select("v", "src", F.col("asks").alias("places")).union(mail.select("src", "v", "places"))
        codes = named.groupBy("v").cogroup(state.select("part", "q", "reach").groupBy("part")).applyInPandas(_codes(dim), CODES)
        letters = mail.select("v", "src", "at", "u", "fresh").unionByName(codes, allowMissingColumns=True).groupBy("v")
        joins = letters.cogroup(state.select("part", "u", "fresh").groupBy("part")).applyInPandas(_local_join(dim, degree, sample, turn), PACKED)
        found, found_at = _counted(spark, joins, "graph-found", report)
        before, (state, state_at) = state_at, materialize_at(merged(found, state), "graph")
        for path in (before, found_at, mail_at):
            release(spark, path)

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for n, u in pdf[["n", "u"]].itertuples(index=False):
                u = np.frombuffer(u, np.int64).reshape(-1, degree)[:, :short]
                place, rank = np.nonzero(u >= 0)
                yield pd.DataFrame({"a": np.frombuffer(n, np.int64)[place], "g": u[place, rank]})

    pairs = state.select("n", "u").mapInPandas(nearest, "a long, g long").join(placed.select("g", F.col("n").alias("b")), "g").select("a", "b")
    if by_category:  # no pair comes twice and no round adds any: only the lists are made
        own, _ = _counted(spark, coded.filter("exact").select(F.col("n").alias("v"), "q", "cat").groupBy("cat").applyInPandas(_leaf_edges(degree, dim), EDGES), "graph-own", report)
        whole = _kept(own.select("v", "u", "d", F.lit(False).alias("fresh")), short, sample)
        pairs = pairs.unionByName(whole.select(F.col("v").alias("a"), F.explode("edges").alias("e")).select("a", F.col("e.u").alias("b")))
    return pairs


def similar_for_all_graph(df: DataFrame, k: int = 4, exclude_same_brand: bool = False, w: float = 1.0, *, degree: int = 60, sample: int = 50,
                          trees: int = 4, leaf_rows: int = 256, max_rounds: int = 10, min_new: float = 0.05, shortlist: int | None = None, seed: int = 17,
                          block_rows: int = 4096, chunk_rows: int = CHUNK_ROWS, id_col: str = "id", vector_col: str = "vector",
                          flag_col: str = "is_vector", report: GraphReport | None = None) -> DataFrame:
    """Approximate top-k neighbours of every product (same output as ``similar_for_all``), scores exact.

    A product whose list holds fewer than ``k`` others (a very small category with the brand rule, for one) is
    scanned against all rows, so none is left short where there are that many. ``report`` is filled with what the run did.
    """
    report = report if report is not None else GraphReport()
    shortlist = min(degree, shortlist or 4 * k)
    spark = df.sparkSession
    items = _items(df, id_col, vector_col, flag_col)
    first = items.select(F.size("vector")).first()
    id_type = items.schema["id"].dataType
    if first is None:
        return _best(spark.createDataFrame([], _pair_schema(id_type)), k)
    key = ["vector", *(["category"] if w else []), *(["brand"] if exclude_same_brand else [])]
    nodes = _nodes(items, k, key)
    for c in ("category", "brand"):
        if c not in key:
            nodes = nodes.withColumn(c, F.lit(None).cast("string"))
    pairs = neighbour_graph(nodes, int(first[0]), degree=degree, sample=sample, trees=trees, leaf_rows=leaf_rows, max_rounds=max_rounds, min_new=min_new,
                            seed=seed, by_category=bool(w), short=degree if exclude_same_brand else shortlist, report=report)
    pairs = pairs.union(nodes.select(F.col("n").alias("a"), F.col("n").alias("b"))).distinct()  # equal vectors are each other's neighbours
    side = lambda name: nodes.select(F.col("n").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in ("vector", "category", "brand", "ids")])
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    if exclude_same_brand:
        both = both.filter(F.col("a_brand") != F.col("b_brand"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (batch.column(i).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, -1) for i in (2, 3))
                with np.errstate(divide="ignore", invalid="ignore"):
                    cos = np.einsum("ij,ij->i", x, y) / (np.linalg.norm(x, axis=1) * np.linalg.norm(y, axis=1))
                cos[~np.isfinite(cos)] = np.nan
                distance = pa.array(np.round(1.0 - cos, DIGITS) + 0.0, pa.float64())  # no negative zero
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(4), distance], names=["a", "category_match", "ids", "vector_distance"])

    match = F.when(F.col("a_category") == F.col("b_category"), 1.0).otherwise(0.0).alias("category_match")
    kinds = f"a long, category_match double, ids array<{id_type.simpleString()}>, vector_distance double"
    scored = both.select("a", match, "a_vector", "b_vector", F.col("b_ids").alias("ids")).mapInArrow(score, kinds)
    scored = scored.withColumn("combined_score", (1.0 - F.col("vector_distance")) * (1.0 - w) + F.col("category_match") * w)
    # what a node's own products see: its best (node, id) pairs, k + 1 of them as one may be the product itself
    near = scored.select("a", "vector_distance", "category_match", "combined_score", F.explode("ids").alias("neighbor_id"))
    order = Window.partitionBy("a").orderBy(F.col("combined_score").desc_nulls_first(), "vector_distance", "neighbor_id")
    near = near.withColumn("__r", F.row_number().over(order)).filter(F.col("__r") <= k + 1).drop("__r")
    near = materialize_at(near, "graph-near")[0]
    numbered = items.alias("i").join(nodes.alias("n"), [F.col(f"i.{c}").eqNullSafe(F.col(f"n.{c}")) for c in key]).select("i.id", "n.n")
    found = numbered.join(near, F.col("n") == F.col("a")).filter("id != neighbor_id").select("id", "neighbor_id", "vector_distance", "category_match", "combined_score")
    found = materialize_at(_best(found, k), "graph-best")[0]
    enough = found.groupBy("id").agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") >= k)
    few = materialize_at(items.join(enough, "id", "left_anti"), "graph-few")[0]
    n_few = few.count()
    if not n_few:
        return found
    whole = _scan_against(few, items, items.count(), n_few, k, w, exclude_same_brand, block_rows, chunk_rows)
    return found.join(enough, "id", "left_semi").unionByName(_best(whole, k))
