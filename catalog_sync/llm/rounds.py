"""Rounds over a table of integer vectors: each assigns every vector and sums the vectors of each entry in one pass.

A round is a scan without a shuffle: a task reads its vectors with the state
that the round before left beside them, writes both again, and adds one row
per entry with its sums. Spark adds those rows up (partial aggregation, then
a row per entry), so what reaches the driver is bounded by the number of
entries, whatever the number of vectors or tasks, and a hot vector is only more rows
of a scan. A round's table is written, so lost executors cost no more than their
tasks; the table of the round before is deleted.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog_sync.llm.tables import Scratch

#: What a round makes of a batch: new values of some columns, the entry of each summed row, and the rows to sum.
Assigned = tuple[dict[str, pa.Array], np.ndarray, np.ndarray]


def finite_vectors(rows: DataFrame, vector: str, scale: int, keep: dict[str, str]) -> DataFrame:
    """``keep`` (new name to column) and ``vector``: floor(scale * x) of each component, of the rows whose vector is neither null nor holds null or non-finite components."""
    raw = rows.select(*[F.col(f"`{c}`").alias(n) for n, c in keep.items()], F.col(f"`{vector}`").cast("array<double>").alias("vector"))
    whole = raw.filter(F.col("vector").isNotNull() & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    return whole.withColumn("vector", F.transform("vector", lambda x: F.floor(x * scale).cast("int")))


def matrix(column: pa.Array) -> np.ndarray:
    """A column of equally long integer lists as a matrix of 64-bit integers."""
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(n, -1)


def lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    """The rows of a matrix as a column of lists."""
    n, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, n * width + 1, width) if width else np.zeros(n + 1), pa.int32()), pa.array(values.ravel(), kind))


def check_range(values: np.ndarray, dim: int) -> None:
    """Fail on components whose squared distances, or four times them, may not fit 64 bits."""
    most = int((2**59 // max(dim, 1)) ** 0.5)
    if values.size and np.abs(values).max() > most:
        raise ValueError(f"a scaled vector component is beyond {most}: its squared distance may not fit a long")


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances row by row, in integers."""
    gap = a - b
    return np.einsum("ij,ij->i", gap, gap)


def floor_means(old: np.ndarray, counts: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Componentwise floor(sum / count), the old entry where nothing was counted."""
    return np.where(counts[:, None] > 0, sums // np.maximum(counts, 1)[:, None], old)


class Rounds:
    """A table of vectors and state that each round replaces."""

    def __init__(self, table: DataFrame, scratch: Scratch):
        self.spark, self.name = scratch.spark, scratch.path.rsplit("/", 1)[-1]
        self.schema = table.schema
        self.own = Scratch(self.spark, self.name)
        self.table = self.own.write(table, "vectors")

    def run(self, assign: Callable[[pa.RecordBatch], Assigned], n_entries: int, width: int) -> tuple[np.ndarray, np.ndarray]:
        """One round; the counts of each entry, and the sums of the rows assigned to it."""
        names = self.schema.names
        schema = T.StructType([*[T.StructField(f.name, f.dataType) for f in self.schema], T.StructField("entry", T.IntegerType()), T.StructField("sums", T.ArrayType(T.LongType()))])

        def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counts, sums, seen = np.zeros(n_entries, np.int64), np.zeros((n_entries, width), np.int64), None
            for batch in batches:
                if not batch.num_rows:
                    continue
                new, entry, rows = assign(batch)
                counts += np.bincount(entry, minlength=n_entries)
                order = np.argsort(entry, kind="stable")
                firsts = np.flatnonzero(np.diff(entry[order], prepend=-1))
                sums[entry[order][firsts]] += np.add.reduceat(rows[order], firsts, axis=0)
                kept = [new.get(c, batch.column(i)) for i, c in enumerate(names)]
                yield pa.RecordBatch.from_arrays([*kept, pa.nulls(batch.num_rows, pa.int32()), pa.nulls(batch.num_rows, pa.list_(pa.int64()))], names=schema.names)
                seen = [x.type for x in kept]
            if seen:
                hit = np.flatnonzero(counts)
                total = lists(np.column_stack((counts, sums))[hit], pa.int64())
                yield pa.RecordBatch.from_arrays([*[pa.nulls(len(hit), t) for t in seen], pa.array(hit, pa.int32()), total], names=schema.names)

        before, self.own = self.own, Scratch(self.spark, self.name)
        swept = self.own.write(self.table.mapInArrow(sweep, schema), "round")
        before.release()
        self.table = swept.filter("entry IS NULL").select(*names)
        added = swept.filter("entry IS NOT NULL").groupBy("entry").agg(*[F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(width + 1)])
        counts, sums = np.zeros(n_entries, np.int64), np.zeros((n_entries, width), np.int64)
        for row in added.collect():  # at most n_entries rows
            counts[row[0]], sums[row[0]] = row[1], row[2:]
        return counts, sums

    def release(self) -> None:
        self.own.release()
