"""Similarity search over embedding vectors, scored by cosine distance blended
with category match: ``(1 - distance) * (1 - w) + category_match * w``.

* :func:`find_similar` — neighbours of one reference product: the reference
  vector (one row) is shipped with the task, candidates are filtered in the
  scan, scored per Arrow batch with one numpy matrix-vector product (or with
  higher-order functions, ``engine="hof"``), and ``orderBy.limit`` keeps k rows
  per partition before the single merge task.
* :func:`similar_for_all` — top-k neighbours of every product, exact. Rows are
  hashed into blocks of ``block_rows`` or more, :data:`BLOCKS` at most until a block
  holds :data:`BLOCK_VALUES` components; each unordered block pair is
  one Arrow group that multiplies the two matrices once with numpy (the score
  is symmetric, so the product serves both directions) and emits only the k
  best candidates per row; a window group limit merges the per-pair winners.
  A row is shuffled once per block, no group holds more than two blocks and
  no task emits all pairs. Its work is the square of the rows, so at scale it
  is for one bounded slice (a category, a brand) at a time.
* :func:`similar_for_all_lsh` — the same for large tables: candidates from
  random-hyperplane buckets, of all rows and of each category, as many and as
  large as the recall measured on sampled products asks for, and an exact scan
  for the products whose buckets hold too few.

Distances are rounded to :data:`DIGITS` digits before anything is ranked or blended, so
equal vectors tie whatever matrix position or batch they were computed at,
and ties fall to the smaller id. Rows without a vector take no part;
vectors of another length than the rest fail the job. Ids may be of any type.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.vectors import cosine_distance_to, dot, norm
from ..session import scratch_path
from .filters import search_text


#: Digits to which distances are rounded: far above the noise of a dot product, far below any difference that matters.
DIGITS = 10


def _score(distance: Column, match: Column, w: float) -> Column:
    return (F.lit(1.0) - distance) * F.lit(1.0 - w) + match * F.lit(w)


def reference_row(df: DataFrame, ref_id, id_col: str = "id", flag_col: str = "is_vector"):
    """The reference product (one row) with a current embedding, or None."""
    rows = df.filter((F.col(id_col) == F.lit(ref_id)) & (F.col(flag_col) == F.lit(True)))
    rows = (rows.filter(F.col("vector").isNotNull()) if "vector" in df.columns else rows).limit(1).collect()
    return rows[0] if rows else None


def find_similar(df: DataFrame, ref_id, k: int = 4, exclude_same_brand: bool = False, w: float = 1.0,
                 id_col: str = "id", vector_col: str = "vector", flag_col: str = "is_vector",
                 engine: str = "arrow") -> DataFrame:
    """Top-k products similar to ``ref_id`` among rows with a current embedding.

    ``exclude_same_brand`` drops candidates whose brand equals the reference's,
    and (as SQL ``!=`` does) rows where either brand is NULL. A NULL category
    scores 0. Order: score descending with NULL first (PostgreSQL's DESC), then
    distance, then id, so ties are deterministic. Unknown reference -> empty.
    """
    ref = reference_row(df, ref_id, id_col, flag_col)
    out_cols = [id_col, "description", "brand", "category", "vector_distance", "category_match", "combined_score"]
    if ref is None:
        return df.limit(0).select(
            id_col, "description", "brand", "category",
            F.lit(None).cast("double").alias("vector_distance"), F.lit(None).cast("double").alias("category_match"),
            F.lit(None).cast("double").alias("combined_score"),
        )
    ref_vec = [float(x) for x in ref[vector_col]]
    ref_norm = math.sqrt(sum(x * x for x in ref_vec))
    lit_vec = F.array(*[F.lit(x).cast("double") for x in ref_vec])
    cand = df.filter((F.col(flag_col) == F.lit(True)) & (F.col(id_col) != F.lit(ref_id)) & F.col(vector_col).isNotNull())
    if exclude_same_brand:
        cand = cand.filter(F.col("brand") != F.lit(ref["brand"]))
    if engine == "arrow":
        distance = cosine_distance_to(vector_col, ref_vec)
    else:  # JVM higher-order functions
        denom = norm(vector_col) * F.lit(ref_norm)
        distance = F.lit(1.0) - F.when(denom == 0, F.lit(float("nan"))).otherwise(dot(vector_col, lit_vec) / denom)
    distance = F.round(distance, DIGITS) + F.lit(0.0)  # no negative zero
    match = F.when(F.col("category") == F.lit(ref["category"]), F.lit(1.0)).otherwise(F.lit(0.0))
    scored = cand.select(id_col, "description", "brand", "category", distance.alias("vector_distance"),
                         match.alias("category_match"))
    scored = scored.withColumn("combined_score", _score(F.col("vector_distance"), F.col("category_match"), w))
    return scored.orderBy(F.col("combined_score").desc_nulls_first(), F.col("vector_distance").asc(), F.col(id_col).asc()).limit(k).select(*out_cols)


def search_then_similar(df: DataFrame, text: str, k: int = 5, exclude_same_brand: bool = False, w: float = 1.0,
                        id_col: str = "id", style: str = "fixed") -> DataFrame:
    """Text search picks the first hit (by id), then its similar products. No hit -> empty result.

    ``style="fixed"``: similarity and score as 2-decimal text, category match as
    a boolean (the web lookup). ``style="percent"``: similarity and score as
    percentages with 2 decimals (``87.53%``), category match as ``Yes``/``No``
    (the console lookup).
    """
    if style not in ("fixed", "percent"):
        raise ValueError(f"unknown style {style!r}")
    percent = style == "percent"
    hit = search_text(df, text, limit=1, order_by=id_col).select(id_col).collect()
    if not hit:
        return find_similar(df, None, k).select(
            id_col, "description", "brand", "category",
            F.lit(None).cast("string").alias("vector_similarity"),
            F.lit(None).cast("string" if percent else "boolean").alias("category_match"),
            F.lit(None).cast("string").alias("combined_score"),
        )
    sim = find_similar(df, hit[0][0], k, exclude_same_brand, w, id_col)

    def fmt(c: Column) -> Column:
        return F.concat(F.format_number(c * F.lit(100.0), 2), F.lit("%")) if percent else F.format_number(c, 2)

    is_match = F.col("category_match") == 1.0
    return sim.select(
        id_col, "description", "brand", "category",
        fmt(F.lit(1.0) - F.col("vector_distance")).alias("vector_similarity"),
        (F.when(is_match, F.lit("Yes")).otherwise(F.lit("No")) if percent else is_match).alias("category_match"),
        fmt(F.col("combined_score")).alias("combined_score"),
    )


def _pair_schema(id_type: T.DataType) -> T.StructType:
    return T.StructType([
        T.StructField("id", id_type),
        T.StructField("neighbor_id", id_type),
        T.StructField("vector_distance", T.DoubleType()),
        T.StructField("category_match", T.DoubleType()),
        T.StructField("combined_score", T.DoubleType()),
    ])


_PAIR_COLS = ["id", "neighbor_id", "vector_distance", "category_match", "combined_score"]


def _exact_topk_mask(sort_score: np.ndarray, dist: np.ndarray, cand_ids: np.ndarray, valid: np.ndarray, k: int) -> np.ndarray:
    """Per row, mark exactly the k best valid columns by (score desc, distance asc, id asc).

    Rows strictly above the k-th score are kept; ties at the k-th score are
    ranked by distance and id, so at most k columns per row survive even when
    many scores are equal (e.g. category weight 1.0).
    """
    rows, cols = sort_score.shape
    kk = min(k, cols)
    part = np.argpartition(-sort_score, kk - 1, axis=1)[:, :kk]
    kth = np.take_along_axis(sort_score, part, axis=1).min(axis=1)
    better = (sort_score > kth[:, None]) & valid
    need = kk - better.sum(axis=1)
    tie = (sort_score == kth[:, None]) & valid
    ti, tj = np.nonzero(tie)
    if len(ti):
        by_id = np.unique(cand_ids, return_inverse=True)[1]  # places in id order, for ids of any type
        order = np.lexsort((by_id[tj], dist[ti, tj], ti))
        ti, tj = ti[order], tj[order]
        starts = np.searchsorted(ti, np.arange(rows))
        pos = np.arange(len(ti)) - starts[ti]
        sel = pos < need[ti]
        better[ti[sel], tj[sel]] = True
    return better


# rows scored against a tile of TILE_ROWS others per matrix product (16 MB at 1024 x 4096)
CHUNK_ROWS = 1024
TILE_ROWS = 4096
#: Blocks into which a scan deals its rows, that is copies of a row that are shuffled, until a block reaches BLOCK_VALUES components.
BLOCKS = 24
BLOCK_VALUES = 1 << 22


def _block_size(n: float, block_rows: int, dim: int, blocks: int = BLOCKS) -> int:
    """Rows of a block: at least ``block_rows``, as many as make ``blocks`` of them, and at most ``BLOCK_VALUES`` components."""
    return max(1, block_rows, min(math.ceil(n / blocks), BLOCK_VALUES // max(1, dim)))


def _candidates(vectors: pd.Series, odd: np.ndarray, category: np.ndarray, brand: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Of equal rows only those with the ``k + 1`` smallest ids can be among anyone's k best; rows whose scores are all NaN count as equal."""
    value = pd.factorize(np.array([b"" if o else v.tobytes() for v, o in zip(vectors, odd, strict=True)], dtype=object))[0]
    rows = pd.DataFrame({"value": value, "category": np.where(odd, -1, category), "brand": brand, "id": ids})
    key = ["value", "category", "brand"]
    size = rows.groupby(key)["id"].transform("size").to_numpy()
    keep = size <= k + 1
    if not keep.all():
        keep[~keep] = rows[~keep].groupby(key)["id"].rank("dense").to_numpy() <= k + 1
    return keep


def _kth(s: np.ndarray, k: int, axis: int, room: np.ndarray) -> np.ndarray:
    """A lower bound of the k-th largest value along ``axis``: that of the maxima of disjoint sets of places. ``room``: memory for half of ``s``."""
    n = s.shape[axis]
    while n >= 16 * k:
        half = n // 2
        if axis == 0:
            s = np.maximum(s[:half], s[n - half:n], out=room[:half * s.shape[1]].reshape(half, -1))
        else:
            s = np.maximum(s[:, :half], s[:, n - half:n], out=s[:, :half] if s.base is room else room[:len(s) * half].reshape(-1, half))
        n = half
    s = s.T if axis == 0 else s
    return np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k] if s.shape[1] >= k else np.full(len(s), -np.inf, s.dtype)


def _places(mask: np.ndarray) -> np.ndarray:
    """The set places of a flat mask that has few, eight at a time."""
    whole = len(mask) // 8 * 8
    eights = np.flatnonzero(mask[:whole].view(np.uint64))
    r, c = np.nonzero(mask[:whole].reshape(-1, 8)[eights])
    return np.append(eights[r] * 8 + c, np.flatnonzero(mask[whole:]) + whole)


class _Rows:
    """Rows of a group as arrays; ids, categories and brands as numbers (missing ones -1), ids in their order."""

    def __init__(self, pdf: pd.DataFrame, k: int, w: float, exclude_same_brand: bool) -> None:
        self.k, self.w, self.rule = k, w, exclude_same_brand
        self.vector = np.vstack(pdf["vector"].to_numpy()).astype(np.float64)
        with np.errstate(all="ignore"):
            self.norm = np.linalg.norm(self.vector, axis=1)
            self.never = ~np.isfinite(self.vector).all(axis=1) | (self.norm == 0)  # NaN against any other
            self.extreme = ~self.never & ~((self.norm > 1e-140) & (self.norm < 1e140))  # left to double precision
            self.unit = np.where((self.never | self.extreme)[:, None], 0.0, self.vector / self.norm[:, None]).astype(np.float32)
        self.id = pd.factorize(pdf["id"].to_numpy(), sort=True)[0]
        self.category = pd.factorize(pdf["category"].to_numpy(dtype=object))[0]
        self.brand = pd.factorize(pdf["brand"].to_numpy(dtype=object))[0] if exclude_same_brand else np.zeros(len(pdf), np.int64)
        self.candidate = _candidates(pdf["vector"], self.never, self.category, self.brand, self.id, k)
        # single-precision scores rank as the exact ones do, but for eps; at w=1 equal scores rank by distance
        self.by_cosine, self.by_category = (1.0, 2.0) if w == 1 else (1.0 - w, w)
        self.eps = np.float32((abs(self.by_cosine) + abs(self.by_category)) * (self.vector.shape[1] + 32) * 2.0**-22)

    def exact(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distance, category match and score of the pairs of rows ``(a, b)``."""
        cos = np.empty(len(a))
        with np.errstate(all="ignore"):
            for i in range(0, len(a), 1 << 16):
                x, y = a[i:i + (1 << 16)], b[i:i + (1 << 16)]
                cos[i:i + (1 << 16)] = np.einsum("ij,ij->i", self.vector[x], self.vector[y]) / (self.norm[x] * self.norm[y])
        cos[~np.isfinite(cos)] = np.nan
        dist = np.round(1.0 - cos, DIGITS) + 0.0  # no negative zero
        match = ((self.category[a] == self.category[b]) & (self.category[a] >= 0)).astype(np.float64)
        return dist, match, (1.0 - dist) * (1.0 - self.w) + match * self.w

    def valid(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        ok = (self.id[a] != self.id[b]) | (self.id[a] < 0)
        return ok & (self.brand[a] != self.brand[b]) & (self.brand[a] >= 0) & (self.brand[b] >= 0) if self.rule else ok

    def best_of_all(self, a: np.ndarray, b: np.ndarray, at_once: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Pairs with the exact best among ``b`` of each of ``a``, where single precision can't tell enough of them apart."""
        out = []
        for i in range(0, len(a), at_once):
            for j in range(0, len(b), TILE_ROWS):
                x, y = np.meshgrid(a[i:i + at_once], b[j:j + TILE_ROWS], indexing="ij")
                dist, _, score = (v.reshape(x.shape) for v in self.exact(x.ravel(), y.ravel()))
                ok = self.valid(x, y)
                rank = np.where(ok, np.where(np.isnan(score), np.inf, score), -np.inf)
                keep = _exact_topk_mask(rank, dist, self.id[b[j:j + TILE_ROWS]], ok, self.k)
                out.append((x[keep], y[keep]))
        return out

    def pairs(self, a: np.ndarray, b: np.ndarray, at_once: int, same: bool, both_ways: bool) -> list[tuple[np.ndarray, np.ndarray]]:
        """Pairs ``(row, candidate)`` that hold the k best in ``b`` of each row in ``a`` and, ``both_ways``, the k best in ``a`` of each in ``b``.

        Tiles of single-precision scores, each read both ways; a pair stays while it may still be among a row's k best. ``same``: the
        two share ids.
        """
        a, b = a[np.argsort(self.category[a], kind="stable")], b[np.argsort(self.category[b], kind="stable")]
        reach = {0: np.full(len(a), -np.inf, np.float32), 1: np.full(len(b), -np.inf, np.float32)}  # at least so much has the k-th best
        crowd = {0: self.extreme[a], 1: self.extreme[b]}  # rows with too many equals in single precision
        kept: dict[int, list] = {0: [], 1: []}
        left = self.unit[a] * np.float32(self.by_cosine)

        def least(side: int, part: slice) -> np.ndarray:
            least = np.maximum(reach[side][part] - self.eps, np.float32(-3e38))
            least[crowd[side][part]] = np.nan
            return least

        def cut(side: int) -> None:
            if kept[side]:
                own, other, score = (np.concatenate(x) for x in zip(*kept[side], strict=True))
                ok = score >= least(side, slice(None))[own]
                kept[side] = [(own[ok], other[ok], score[ok])]

        area = min(at_once, len(a)) * min(TILE_ROWS, len(b))
        scores, room, flags = np.empty(area, np.float32), np.empty(area // 2 + 1, np.float32), np.empty(area, bool)
        for i in range(0, len(a), at_once):
            rows = slice(i, i + at_once)
            x = a[rows]
            for j in range(0, len(b), TILE_ROWS):
                cols = slice(j, j + TILE_ROWS)
                y = b[cols]
                s = np.matmul(left[rows], self.unit[y].T, out=scores[:len(x) * len(y)].reshape(len(x), len(y)))
                kinds, first = np.unique(self.category[x], return_index=True)
                lo, hi = np.searchsorted(self.category[y], kinds, "left"), np.searchsorted(self.category[y], kinds, "right")
                for kind, r0, r1, c0, c1 in zip(kinds, first, [*first[1:], len(x)], lo, hi, strict=True):
                    if kind >= 0:
                        s[r0:r1, c0:c1] += np.float32(self.by_category)
                s[:, self.never[y]] = np.inf
                s[self.never[x], :] = np.inf
                s[:, self.extreme[y]] = -np.inf
                s[self.extreme[x], :] = -np.inf
                if self.rule:
                    s[(self.brand[x][:, None] == self.brand[y][None, :])] = -np.inf
                    s[self.brand[x] < 0, :] = -np.inf
                    s[:, self.brand[y] < 0] = -np.inf
                if same:
                    order = np.argsort(self.id[y], kind="stable")
                    lo, hi = np.searchsorted(self.id[y], self.id[x], "left", order), np.searchsorted(self.id[y], self.id[x], "right", order)
                    n = np.where(self.id[x] < 0, 0, hi - lo)
                    at = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
                    s[np.repeat(np.arange(len(x)), n), order[at]] = -np.inf
                for side, part, other in ((0, rows, cols), (1, cols, rows))[:1 + both_ways]:
                    reach[side][part] = np.maximum(reach[side][part], _kth(s, self.k, 1 - side, room))
                    limit = least(side, part)
                    flag = np.greater_equal(s, limit[:, None] if side == 0 else limit[None, :], out=flags[:s.size].reshape(s.shape))
                    r, c = np.divmod(_places(flag.ravel()), s.shape[1])
                    score = s[r, c]
                    own, others = (r, c) if side == 0 else (c, r)
                    many = np.bincount(own, minlength=len(limit)) > 64 * self.k
                    if many.any():
                        crowd[side][part] |= many
                        ok = ~many[own]
                        own, others, score = own[ok], others[ok], score[ok]
                    kept[side].append((own + part.start, others + other.start, score))
            if len(kept[1]) >= 32:
                cut(1)
        out = []
        for side, mine, others in ((0, a, b), (1, b, a))[:1 + both_ways]:
            cut(side)
            out += [(mine[own], others[other]) for own, other, _ in kept[side]]
            if crowd[side].any():
                out += self.best_of_all(mine[crowd[side]], others, at_once)
            if self.extreme[others].any():
                out += self.best_of_all(mine[~crowd[side]], others[self.extreme[others]], at_once)
        return out


def _block_pair_topk(k: int, w: float, exclude_same_brand: bool, chunk_rows: int = CHUNK_ROWS, both_ways: bool = True):
    """pandas function for one unordered block pair ``(lo, hi)``.

    The score is symmetric (cosine, category match and the brand rule all
    are), so each tile between blocks ``lo`` and ``hi`` is computed once and
    read both ways: rows of ``lo`` against all of ``hi`` and, when the blocks
    differ, rows of ``hi`` against all of ``lo``; the final window merges. Tiles
    are ``chunk_rows`` x ``TILE_ROWS`` and hold scores in single precision, which only leave out pairs
    that can't be among a row's k best; what stays is scored and ranked in double precision. Each group
    holds at most two blocks. ``both_ways=False`` ranks for ``lo`` only.
    """

    def run(key, pdf):
        lo, hi = int(key[-2]), int(key[-1])
        is_lo = (pdf["__b"] == lo).to_numpy()
        if not is_lo.any() or (hi != lo and is_lo.all()):
            return pd.DataFrame({c: [] for c in _PAIR_COLS})
        t = _Rows(pdf, k, w, exclude_same_brand)
        same, both = hi == lo or not both_ways, hi != lo and both_ways
        is_hi = is_lo if hi == lo else ~is_lo
        few = t.candidate & is_hi
        if not both:
            found = t.pairs(np.flatnonzero(is_lo), np.flatnonzero(few), chunk_rows, same, False)
        else:
            mine, theirs = t.candidate & is_lo, few
            found = t.pairs(np.flatnonzero(mine), np.flatnonzero(theirs), chunk_rows, same, True)
            for rest, others in ((is_lo & ~mine, theirs), (is_hi & ~theirs, mine)):
                if rest.any():
                    found += t.pairs(np.flatnonzero(rest), np.flatnonzero(others), chunk_rows, same, False)
        a, b = (np.concatenate(x) for x in zip(*found, strict=True))
        dist, match, score = t.exact(a, b)
        # NaN scores first (PostgreSQL DESC), then score desc, distance asc, id asc
        order = np.lexsort((t.id[b], dist, np.where(np.isnan(score), -np.inf, -score), a))
        ranked = a[order]
        order = order[np.arange(len(order)) - np.searchsorted(ranked, ranked) < k]
        ids = pdf["id"].to_numpy()
        return pd.DataFrame({"id": ids[a[order]], "neighbor_id": ids[b[order]], "vector_distance": dist[order], "category_match": match[order], "combined_score": score[order]})

    return run


def _pair_groups(items: DataFrame, block: Column, n_blocks: Column) -> DataFrame:
    """Send each row to the unordered block pairs it belongs to: ``n_blocks`` copies,
    one per partner block, keyed ``(__lo, __hi)`` with ``__lo <= __hi``."""
    partner = F.explode(F.sequence(F.lit(0), n_blocks - 1))
    spread = items.select("*", block.alias("__b"), partner.alias("__x"))
    return spread.select(
        *[c for c in spread.columns if c != "__x"],
        F.least("__b", "__x").alias("__lo"), F.greatest("__b", "__x").alias("__hi"),
    )


def _items(df: DataFrame, id_col: str, vector_col: str, flag_col: str) -> DataFrame:
    """``id, vector, brand, category`` of the rows that take part, all vectors of one length."""
    items = df.filter((F.col(flag_col) == F.lit(True)) & F.col(vector_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(vector_col).alias("vector"), "brand", "category"
    )
    first = items.select(F.size("vector")).first()
    dim = first[0] if first else 0
    check = F.assert_true(F.size("vector") == dim, F.lit(f"vectors must all have {dim} components"))
    return items.filter(check.isNull())


def _best(pairs: DataFrame, k: int, name: str = "rank") -> DataFrame:
    """The k best neighbours of each id; the cut also runs before the shuffle (window group limit)."""
    order = Window.partitionBy("id").orderBy(
        F.col("combined_score").desc_nulls_first(), F.col("vector_distance").asc(), F.col("neighbor_id").asc()
    )
    return pairs.withColumn(name, F.row_number().over(order)).filter(F.col(name) <= k)


def similar_for_all(df: DataFrame, k: int = 4, exclude_same_brand: bool = False, w: float = 1.0,
                    block_rows: int = 4096, id_col: str = "id", vector_col: str = "vector",
                    flag_col: str = "is_vector", chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Exact top-k neighbours of every product with a current embedding.

    Output (id, neighbor_id, vector_distance, category_match, combined_score,
    rank) with rank 1..k in the same order as :func:`find_similar`. A row is
    shuffled once per block; ``block_rows`` is the least rows of one. The pairs scored are the square of
    the rows: for very large tables call it per category or brand, or :func:`similar_for_all_lsh`.
    """
    items = _items(df, id_col, vector_col, flag_col)
    n, dim = items.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    blocks = max(1, math.ceil(n / _block_size(n, block_rows, dim or 0)))
    b = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    pairs = _pair_groups(items, b, F.lit(blocks)).groupBy("__lo", "__hi").applyInPandas(
        _block_pair_topk(k, w, exclude_same_brand, chunk_rows), _pair_schema(items.schema["id"].dataType)
    )
    return _best(pairs, k)


def _hyperplanes(dim: int, bands: int, bits: int, seed: int) -> np.ndarray:
    """Columns are the planes, band after band. Fewer bands or bits are the first ones of more."""
    return np.concatenate([np.random.default_rng((seed, b)).normal(size=(bits, dim)).T for b in range(bands)], axis=1)


def lsh_codes(vector_col: str, dim: int, bands: int = 4, bits: int = 8, seed: int = 17) -> Column:
    """Random-hyperplane (SimHash) bucket code per band, ``array<int>`` of length ``bands``.

    Computed with an Arrow-batched pandas UDF: one matrix product per batch.
    """
    planes = _hyperplanes(dim, bands, bits, seed)
    weights = (1 << np.arange(bits)).astype(np.int64)

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def codes(vecs: pd.Series) -> pd.Series:
        if len(vecs) == 0:
            return pd.Series([], dtype=object)
        m = np.vstack(vecs.to_numpy()).astype(np.float64)
        signs = (m @ planes >= 0).reshape(len(m), bands, bits).astype(np.int64)
        return pd.Series(list((signs * weights).sum(axis=2).astype(np.int32)))

    return codes(F.col(vector_col))


#: Buckets up to which their sizes are broadcast.
BROADCAST_BUCKETS = 1 << 16
#: Most bands that are tried before buckets are made larger.
MAX_BANDS = 256
#: Seconds of one Arrow group, one copied row and one scored pair, by which settings of equal recall are ranked.
GROUP_S, COPY_S, PAIR_S = 3e-3, 1e-5, 2e-9


@dataclass(frozen=True)
class Buckets:
    """Setting of :func:`similar_for_all_lsh`: ``2**bits`` buckets of all rows in each of ``bands`` bands (0 bits: one
    bucket, an exact scan), and buckets of about ``category_rows`` rows of one category in each of ``category_bands``.
    ``recall`` is that measured on the sampled products, the lower one of those with and without a category."""

    bits: int
    bands: int
    category_rows: int
    category_bands: int
    recall: float


def _bucket_block(n: int, bits: int, bands: int, block_rows: int, dim: int) -> int:
    """Rows of a block of a bucket: twice the mean bucket, so that only hot ones are split, or few buckets into ``BLOCKS`` in all."""
    if bands * 2**bits < BLOCKS:
        return _block_size(n * bands, block_rows, dim)
    return _block_size(2 * n / 2**bits, block_rows, dim, 1)


def _work(rows, bits, block_rows: int, ceil=np.ceil):
    """Estimated seconds of one band: ``rows`` in ``2**bits`` equal buckets (numbers, or columns with ``ceil=F.ceil``)."""
    n_buckets = 2.0**bits if isinstance(bits, int) else F.pow(F.lit(2.0), bits)
    subs = ceil(rows / n_buckets / block_rows)
    return n_buckets * subs * (subs + 1) / 2 * GROUP_S + rows * subs * COPY_S + rows * rows / n_buckets * PAIR_S


def _category_bits(rows: Column, rows_per_bucket: int, most: int) -> Column:
    return F.least(F.greatest(F.ceil(F.log2(rows / F.lit(rows_per_bucket))), F.lit(0)), F.lit(most)).cast("int")


def _tune(items: DataFrame, sizes: DataFrame | None, n: int, dim: int, most_bits: int, k: int, w: float, exclude_same_brand: bool, bands: int,
          rows_per_bucket: int, block_rows: int, seed: int, chunk_rows: int, recall: float, tune_queries: int) -> Buckets:
    """The cheapest setting from ``bands`` and ``rows_per_bucket`` upwards that reaches ``recall``.

    The true neighbours of ``tune_queries`` products with and as many without a category are found by an exact scan of all
    rows. Both groups must reach ``recall`` by two standard errors (by itself where the sample is the whole group).
    ``sizes`` has the rows per category, None where categories do not count.
    """
    groups = [F.lit(True)] if sizes is None else [F.col("category").isNotNull(), F.col("category").isNull()]
    samples = [items.filter(g).orderBy(F.xxhash64("id"), "id").limit(tune_queries).withColumn("__group", F.lit(i)) for i, g in enumerate(groups)]
    sample = samples[0] if len(samples) == 1 else samples[0].unionByName(samples[1])
    path = scratch_path(items.sparkSession, "lsh-sample")
    sample.write.parquet(path)
    sample = items.sparkSession.read.parquet(path)
    taken = {r["__group"]: r["count"] for r in sample.groupBy("__group").count().collect()}
    true = _best(_scan_against(sample.drop("__group"), items, n, sum(taken.values()), k, w, exclude_same_brand, block_rows, chunk_rows), k)
    mine = sample.select("id", "__group", F.col("vector").alias("__a"), F.col("category").alias("__c"))
    other = items.select(F.col("id").alias("neighbor_id"), F.col("vector").alias("__b"))
    true = true.select("id", "neighbor_id", "category_match").join(mine, "id").join(other, "neighbor_id")
    true = true.withColumn("__rows", F.lit(0)) if sizes is None else true.join(sizes, F.col("__c") == F.col("category"), "left")
    rows = true.select("id", "__group", "__a", "__b", "category_match", "__rows").collect()  # at most 2 * tune_queries * k rows
    if not rows:  # nothing has a neighbour
        return Buckets(0, 1, rows_per_bucket, 0, 1.0)
    tries = [bands]
    while tries[-1] * 3 // 2 <= MAX_BANDS:
        tries.append(max(tries[-1] + 1, tries[-1] * 3 // 2))
    planes = _hyperplanes(dim, tries[-1], most_bits, seed)
    side = lambda c: (np.array([r[c] for r in rows], np.float64) @ planes >= 0).reshape(len(rows), tries[-1], most_bits)
    shared = np.cumprod(side("__a") == side("__b"), axis=2, dtype=np.int8).sum(axis=2)  # first bits that a pair has in common, per band
    shared = np.maximum.accumulate(shared, axis=1)
    # settings of the buckets of all rows, each with its work and the pairs it misses
    whole = [(bits, b) for bits in range(1, most_bits + 1) for b in tries] + [(0, 1)]
    whole_work = np.array([b * _work(n, bits, _bucket_block(n, bits, b, block_rows, dim)) for bits, b in whole])
    whole_miss = np.array([shared[:, b - 1] < bits for bits, b in whole], float)
    # and of those of each category
    per, per_work, per_miss = [(rows_per_bucket, 0)], np.zeros(1), np.ones((1, len(rows)))
    if sizes is not None:
        same = np.array([r["category_match"] == 1.0 for r in rows])
        own = np.array([r["__rows"] or 1 for r in rows], float)
        levels = [rows_per_bucket << i for i in range(most_bits + 1)]
        costs = []
        for level in levels:  # a category in one bucket needs one band
            bits = _category_bits(F.col("__rows"), level, most_bits)
            work = _work(F.col("__rows").cast("double"), bits, _block_size(2 * level, block_rows, dim, 1), F.ceil)
            costs += [F.sum(F.when(bits == 0, work).otherwise(0.0)), F.sum(F.when(bits > 0, work).otherwise(0.0))]
        costs = [x or 0.0 for x in sizes.agg(*costs).first()]
        for i, level in enumerate(levels):
            bits = np.clip(np.ceil(np.log2(own / level)), 0, most_bits)
            for b in tries:
                per.append((level, b))
                per_work = np.append(per_work, costs[2 * i] + b * costs[2 * i + 1])
                per_miss = np.vstack([per_miss, ~same | (shared[:, b - 1] < bits)])
    work = whole_work[:, None] + per_work[None, :]
    if sizes is not None:  # without category buckets only if all rows are scanned anyway
        work[:-1, 0] = np.inf
    reached, fine = np.ones(work.shape), np.isfinite(work)
    for g, n_taken in taken.items():
        of = np.array([r["__group"] == g for r in rows])
        if of.any():
            got = 1.0 - whole_miss[:, of] @ per_miss[:, of].T / of.sum()
            n_queries = len({r["id"] for r, x in zip(rows, of, strict=True) if x})
            error = np.sqrt(got * (1 - got) / n_queries) if n_taken >= tune_queries else 0.0
            fine &= got - 2 * error >= recall - 1e-9
            reached = np.minimum(reached, got)
    i, j = np.unravel_index(np.argmin(np.where(fine, work, np.inf)), work.shape)
    return Buckets(*whole[i], *per[j], float(reached[i, j]))


def _scan_against(wanted: DataFrame, items: DataFrame, n_items: int, n_wanted: int, k: int, w: float, exclude_same_brand: bool,
                  block_rows: int, chunk_rows: int) -> DataFrame:
    """Exact candidates of the ``wanted`` items among all ``items``: blocks of one side meet blocks of the other."""
    dim = (items.select(F.size("vector")).first() or [0])[0]
    a_blocks = max(1, math.ceil(n_wanted / _block_size(n_wanted, block_rows, dim, 1)))
    b_blocks = max(1, math.ceil(n_items / _block_size(n_items, block_rows, dim, max(1, BLOCKS // a_blocks))))
    cell = lambda side, mine, others: side.withColumn("__own", F.pmod(F.xxhash64("id"), F.lit(mine)).cast("int")).withColumn(
        "__other", F.explode(F.sequence(F.lit(0), F.lit(others - 1))))
    left = cell(wanted, a_blocks, b_blocks).withColumnsRenamed({"__own": "__lo", "__other": "__hi"})
    right = cell(items, b_blocks, a_blocks).withColumnsRenamed({"__own": "__hi", "__other": "__lo"})
    score = _block_pair_topk(k, w, exclude_same_brand, chunk_rows, both_ways=False)

    def run(key, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        return score((0, 1), pd.concat([a.assign(__b=0), b.assign(__b=1)], ignore_index=True))

    return left.groupBy("__lo", "__hi").cogroup(right.groupBy("__lo", "__hi")).applyInPandas(run, _pair_schema(items.schema["id"].dataType))


def similar_for_all_lsh(df: DataFrame, k: int = 4, exclude_same_brand: bool = False, w: float = 1.0,
                        bands: int = 16, rows_per_bucket: int = 4096, block_rows: int = 4096, seed: int = 17,
                        id_col: str = "id", vector_col: str = "vector", flag_col: str = "is_vector",
                        chunk_rows: int = CHUNK_ROWS, recall: float = 0.9, tune_queries: int = 200, setting: Buckets | None = None) -> DataFrame:
    """Approximate top-k neighbours of every product (same output as :func:`similar_for_all`).

    ``setting``: buckets to use as they are, without the search for a setting (whose recall the caller has measured).

    Candidates are the products that share a random-hyperplane bucket in at
    least one band. Where the category counts (``w > 0``) the rows of each
    category have buckets of their own as well: the best by blended score are
    among the nearest of the same category and the nearest of all. ``bands`` and
    ``rows_per_bucket`` are where the search for a setting starts: bands are added
    and buckets made larger, up to an exact scan, until ``recall`` is reached on
    ``tune_queries`` products whose true neighbours are found by brute force
    (:func:`_tune`); of the settings that reach it the cheapest is used.
    Buckets are scanned exactly with the bounded block scheme; one that is
    larger than ``block_rows`` and twice the mean (a hot bucket can hold a big share of the rows)
    is split into several blocks, so a row is shuffled about once per band. Scores are exact. A product whose
    buckets hold fewer than ``k`` others is scanned against all rows, so
    every product has its k neighbours (where there are that many).

    Codes are computed once: the coded rows are written to the shared
    checkpoint folder and read for the bucket sizes and for the scan.
    """
    spark = df.sparkSession
    items = _items(df, id_col, vector_col, flag_col)
    first = items.select(F.size("vector")).first()
    if first is None:
        return similar_for_all(df, k, exclude_same_brand, w, block_rows, id_col, vector_col, flag_col, chunk_rows)
    base = scratch_path(spark, "lsh")
    items.write.parquet(f"{base}/items")
    items = spark.read.parquet(f"{base}/items")
    n = items.count()
    bits = setting.bits if setting else max(1, min(30, math.ceil(math.log2(max(2, n / rows_per_bucket)))))
    sizes = None
    if w:
        items.filter("category IS NOT NULL").groupBy("category").agg(F.count(F.lit(1)).alias("__rows")).write.parquet(f"{base}/sizes")
        sizes = spark.read.parquet(f"{base}/sizes")
    use = setting or _tune(items, sizes, n, int(first[0]), bits, k, w, exclude_same_brand, bands, rows_per_bucket, block_rows, seed, chunk_rows, recall, tune_queries)
    bands = use.bands + use.category_bands
    coded = items.withColumn("__codes", lsh_codes("vector", int(first[0]), max(use.bands, use.category_bands), bits, seed))
    if use.category_bands:
        own_bits = sizes.select(F.col("category").alias("__c"), _category_bits(F.col("__rows"), use.category_rows, bits).alias("__bits"))
        coded = coded.join(own_bits, F.col("category") == F.col("__c"), "left").drop("__c")
    coded.write.parquet(f"{base}/coded")
    coded = spark.read.parquet(f"{base}/coded")

    def keyed_by(rows: DataFrame, group: Column, n_bands: Column, n_bits: Column) -> DataFrame:
        rows = rows.select("id", "vector", "brand", "category", group.alias("__g"), n_bits.alias("__n"),
                           F.posexplode(F.slice("__codes", F.lit(1), n_bands)).alias("band", "code"))
        return rows.withColumn("code", F.expr("code & (shiftleft(1, __n) - 1)")).drop("__n")

    # the first bits of a code are its lowest
    keyed, n_buckets = keyed_by(coded, F.lit("all"), F.lit(use.bands), F.lit(use.bits)), use.bands * 2**use.bits
    if use.category_bands:
        own = F.when(F.col("__bits") == 0, F.lit(1)).otherwise(F.lit(use.category_bands))  # a category in one bucket needs one band
        keyed = keyed.unionByName(keyed_by(coded.filter("category IS NOT NULL"), F.concat(F.lit("of "), F.col("category").cast("string")), own, F.col("__bits")))
        n_buckets += own_bits.agg(F.sum(F.pow(F.lit(2.0), "__bits") * own)).first()[0] or 0
    bucket = ["__g", "band", "code"]
    dim = int(first[0])
    rows_all = _bucket_block(n, use.bits, use.bands, block_rows, dim)
    rows_own = max(rows_all, _block_size(2 * use.category_rows, block_rows, dim, 1))
    per_block = F.when(F.col("__g") == "all", F.lit(rows_all)).otherwise(F.lit(rows_own))
    subs = keyed.groupBy(*bucket).agg(F.ceil(F.count(F.lit(1)) / F.any_value(per_block)).cast("int").alias("__nsub")).filter("__nsub > 1")
    if n_buckets <= BROADCAST_BUCKETS:  # else Spark chooses; few buckets are split
        subs = F.broadcast(subs)
    keyed = keyed.join(subs, bucket, "left").withColumn("__nsub", F.coalesce("__nsub", F.lit(1)))
    b = F.pmod(F.xxhash64("id"), F.col("__nsub")).cast("int")
    pairs = _pair_groups(keyed, b, F.col("__nsub")).drop("__nsub").groupBy(*bucket, "__lo", "__hi").applyInPandas(
        _block_pair_topk(k, w, exclude_same_brand, chunk_rows), _pair_schema(items.schema["id"].dataType)
    )
    # A pair is found at most once per band, so the k * bands best rows of an id hold at
    # least k distinct neighbours; the merge and the final rank reuse that partitioning.
    best = _best(pairs, k * bands, "__r").groupBy("id", "neighbor_id").agg(
        F.min(F.struct("vector_distance", "category_match", "combined_score")).alias("__m")
    ).select("id", "neighbor_id", "__m.*")
    _best(best, k).write.parquet(f"{base}/found")
    found = spark.read.parquet(f"{base}/found")
    enough = found.groupBy("id").agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") >= k)
    items.join(enough, "id", "left_anti").write.parquet(f"{base}/few")
    few = spark.read.parquet(f"{base}/few")
    n_few = few.count()
    if not n_few:
        return found
    whole = _scan_against(few, items, n, n_few, k, w, exclude_same_brand, block_rows, chunk_rows)
    return found.join(enough, "id", "left_semi").unionByName(_best(whole, k))
