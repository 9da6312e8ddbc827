"""Vector codes: equal parts, a codebook of integer entries per part, nearest entries by Orchard search.

Every entry of a codebook has a list of the others by their distance from it.
A part starts at the entry it had in the round before and walks that entry's list; as
soon as an entry is closer (or as close, with a lower index), the walk jumps to that entry's list.
Entries met before are marked and not measured again. By the triangle inequality an entry farther from the current one than twice
the part's distance can't be closer, so there the walk ends. All of it is in integers
(four times the squared distance against the squared gap), so the result is exact. The parts of a batch walk
together, each with its own place in its own list, as a shrinking set.

See :mod:`.rounds` for what moves and what bounds a task; the codebooks and their
sorted gaps (entries squared per part) travel with the tasks. Errors are
summed per label by partial aggregation; the sums are joined back as a broadcast only while they
are few rows, else by a shuffle that AQE splits at a hot label.

Defined cases: vectors that are null or hold null or non-finite components take no part, nor do those of another length than the
commonest one that the parts divide (the longer of equally common ones); scaled components whose squared distances may not fit a
long fail the job; a null id takes part and starts an entry only if the ids don't suffice; repeated rows each count and get a
row, and of rows sharing an id the smaller vectors start first; with fewer vectors than entries each is one; equal entries tie,
the lower index wins and the others stay as they are; null labels are one label; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog_sync.llm.rounds import Rounds, check_range, finite_vectors, floor_means, lists, matrix, squared
from catalog_sync.llm.tables import Scratch, bounded_broadcast


@dataclass
class Codebook:
    """The entries of one part position with their neighbour lists."""

    entries: np.ndarray  # (entries, width)
    lists: np.ndarray  # (entries, entries - 1): the others, nearest first
    gaps: np.ndarray  # their squared distances

    @classmethod
    def of(cls, entries: np.ndarray) -> Codebook:
        gaps = np.stack([squared(entries, e[None]) for e in entries])
        n = len(entries)
        order = np.stack([np.delete(o := np.argsort(gaps[i], kind="stable"), np.flatnonzero(o == i)) for i in range(n)])
        return cls(entries, order, np.take_along_axis(gaps, order, axis=1))


def orchard(x: np.ndarray, book: Codebook, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest entries of the rows of ``x``, their squared distances, and how many distances were measured."""
    entry = start.astype(np.int64)
    d = squared(x, book.entries[entry])
    n, most, measured = len(x), book.lists.shape[1], len(x)
    seen = np.zeros((n, len(book.entries)), bool)
    seen[np.arange(n), entry] = True
    place = np.zeros(n, np.int64)
    live = np.arange(n if most else 0)
    while len(live):
        at, step = entry[live], place[live]
        near = book.gaps[at, step] <= 4 * d[live]  # else nothing from here on can be closer, or as close
        live, at, step = live[near], at[near], step[near]
        other = book.lists[at, step]
        place[live] = step + 1
        fresh = ~seen[live, other]
        who, other = live[fresh], other[fresh]
        seen[who, other] = True
        new = squared(x[who], book.entries[other])
        measured += len(who)
        wins = (new < d[who]) | (new == d[who]) & (other < entry[who])
        who = who[wins]
        entry[who], d[who], place[who] = other[wins], new[wins], 0
        live = live[place[live] < most]
    return entry, d, measured


def commonest_length(rows: DataFrame, vector: str, n_parts: int) -> int:
    """The commonest length that the parts divide; 0 if there is none."""
    size = F.size(F.col(f"`{vector}`"))
    found = rows.filter((size > 0) & (size % n_parts == 0)).groupBy(size.alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return found["n"] if found else 0


@dataclass
class Codes:
    """``vectors``: ``id, label, code, error``, the code as one byte per part; ``books``: the entries by part."""

    vectors: DataFrame
    books: list[np.ndarray]

    def digest(self) -> str:
        """Lower-case hex SHA-256 of all components by part, entry and place, as decimal integers joined by commas."""
        return hashlib.sha256(",".join(str(v) for book in self.books for v in book.ravel().tolist()).encode()).hexdigest()


def compress(rows: DataFrame, scratch: Scratch, *, n_parts: int, n_entries: int, n_rounds: int, scale: int, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> Codes:
    """Codes of all vectors. The codebooks start as the parts of the ``n_entries`` vectors with the smallest ids."""
    fine = finite_vectors(rows, vector, scale, {"id": vec_id, "label": label})
    dim = commonest_length(rows, vector, n_parts)
    vectors = fine.filter(F.size("vector") == dim)
    kinds = f"id {vectors.schema['id'].dataType.simpleString()}, label {vectors.schema['label'].dataType.simpleString()}"
    rounds = Rounds(vectors.withColumn("code", F.array_repeat(F.lit(0), n_parts)), scratch)
    names = rounds.schema.names
    first = [r["vector"] for r in rounds.table.orderBy(F.col("id").asc_nulls_last(), "vector").limit(n_entries).collect()]
    if not first:
        rounds.release()
        return Codes(rows.sparkSession.createDataFrame([], f"{kinds}, code binary, error long"), [])
    check_range(np.array(first), dim)
    width, k = dim // n_parts, len(first)
    books = [Codebook.of(np.ascontiguousarray(part)) for part in np.split(np.array(first, np.int64), n_parts, axis=1)]

    def search(batch: pa.RecordBatch, books: list[Codebook]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        x, code = matrix(batch.column(names.index("vector"))), matrix(batch.column(names.index("code")))
        check_range(x, dim)
        parts = x.reshape(len(x), n_parts, width)
        error = np.zeros(len(x), np.int64)
        for p, book in enumerate(books):
            code[:, p], d, _ = orchard(np.ascontiguousarray(parts[:, p]), book, code[:, p])
            error += d
        return parts, code, error

    for _ in range(n_rounds):
        def assign(batch: pa.RecordBatch, books: list[Codebook] = books):
            parts, code, _ = search(batch, books)
            return {"code": lists(code, pa.int32())}, (code + k * np.arange(n_parts)).ravel(), parts.reshape(-1, width)

        counts, sums = rounds.run(assign, n_parts * k, width)
        books = [Codebook.of(floor_means(b.entries, counts[p * k : (p + 1) * k], sums[p * k : (p + 1) * k])) for p, b in enumerate(books)]

    def finish(batches):
        for batch in batches:
            if batch.num_rows:
                _, code, error = search(batch, books)
                packed = pa.array([row.tobytes() for row in code.astype(np.uint8)], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), packed, pa.array(error, pa.int64())], names=["id", "label", "code", "error"])

    coded = scratch.write(rounds.table.mapInArrow(finish, f"{kinds}, code binary, error long"), "coded")
    rounds.release()
    return Codes(coded, [b.entries for b in books])


def with_label_error(coded: DataFrame, max_rows: int = 10_000) -> DataFrame:
    """``coded`` with ``label_error``, the errors summed over equal labels, nulls together."""
    per_label = coded.groupBy(F.col("label").alias("__llm_label")).agg(F.sum("error").alias("label_error"))
    return coded.join(bounded_broadcast(per_label, max_rows), F.col("label").eqNullSafe(F.col("__llm_label"))).drop("__llm_label")
