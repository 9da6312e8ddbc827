"""Vector best-fit packing of documents into training sequences.

A sequence has three capacities: tokens, documents and attention cost (the sum of
its pieces' squared lengths). Documents are encoded, ended by an end token and
cut into pieces of at most the sequence length, the first of which takes the
rest. Pieces are placed in decreasing size; each goes to the open sequence
that has room in every capacity and that the chosen rule prefers: the smallest
weighted norm of what would be left, or the largest weighted dot product of demand
and room. Pieces are dealt at random into groups of bounded size that are packed apart, so the
work is linear, no group grows with the data and no key can be hot; a group leaves a few
sequences part-filled, under 0.1 % of its own.

Defined cases: null and empty texts are the end token alone; repeated rows are
packed each; a null id stays null; an empty table gives an empty result;
pieces over a capacity by themselves raise; other columns named like a result column give way.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog_sync.llm.tables import Scratch, replace_columns
from catalog_sync.llm.tokens import encoder, text_batches

#: Pieces that one task packs at a time.
GROUP_ROWS = 32_768


@dataclass(frozen=True)
class Capacity:
    """Most tokens, documents and attention cost of a sequence, and the weight of each in the choice."""

    tokens: int = 1024
    documents: int = 1024
    attention: int = 1024 * 1024
    weights: tuple[float, float, float] = (1.0, 0.01, 0.01)
    rule: str = "norm"  # or "dot"


def token_pieces(docs: DataFrame, tokenizer: str, *, end_id: int, most: int, text: str = "text") -> DataFrame:
    """One row per piece: the columns of ``docs`` but the text, ``piece`` (from 0), ``start``, ``length`` and ``ids``
    (little-endian unsigned 32-bit). One pass, no shuffle."""
    taken = {text.lower(), "piece", "start", "length", "ids"}
    rest = [c for c in docs.columns if c.lower() not in taken]
    new = [T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType())]
    schema = T.StructType([*[docs.schema[c] for c in rest], *new])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in text_batches(batches):
            row, piece, start, length, blobs = [], [], [], [], []
            for i, ids in enumerate(encode(batch.column(len(rest)).to_pylist())):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                first = (len(ids) - 1) % most + 1
                cuts = [0, *range(first, len(ids) + 1, most)]
                for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                    row.append(i)
                    piece.append(k)
                    start.append(a)
                    length.append(b - a)
                    blobs.append(ids[a:b].tobytes())
            taken_rows = pa.Table.from_batches([batch]).select(list(range(len(rest)))).take(pa.array(row, pa.int64())) if rest else None
            columns = [c.combine_chunks() for c in taken_rows.columns] if rest else []
            arrays = [pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(blobs, pa.binary())]
            yield pa.RecordBatch.from_arrays([*columns, *arrays], names=[*rest, "piece", "start", "length", "ids"])

    whole = docs.select(*[F.col(f"`{c}`") for c in rest], F.coalesce(F.col(f"`{text}`"), F.lit("")).alias(text))
    return whole.mapInArrow(run, schema)


def best_fit(lengths: np.ndarray, capacity: Capacity) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and token offset of each piece of one group."""
    most = np.array([capacity.tokens, capacity.documents, capacity.attention], np.float64)
    demand = np.stack([lengths, np.ones_like(lengths), lengths * lengths]).astype(np.float64)
    if (demand > most[:, None]).any():
        raise ValueError("a piece exceeds a capacity of the sequences by itself")
    weight = np.array(capacity.weights, np.float64) / (most if capacity.rule == "dot" else most * most)
    order = np.argsort(-lengths, kind="stable")
    smallest = lengths.min() if len(lengths) else 0
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    room = np.empty((3, 1024))  # of the open sequences, the first n_open columns
    names = np.empty(1024, np.int64)
    n_open = n_bins = placed = 0
    for i in order:
        need = demand[:, i]
        here = room[:, :n_open]
        left = here - need[:, None]
        fits = (left >= 0).all(axis=0)
        if fits.any():
            if capacity.rule == "dot":
                score = (weight * need / most) @ here
                at = int(np.argmax(np.where(fits, score, -np.inf)))
            else:
                score = weight @ (left * left)
                at = int(np.argmin(np.where(fits, score, np.inf)))
            bins[i], offsets[i] = names[at], capacity.tokens - room[0, at]
            room[:, at] -= need
            if room[0, at] < smallest or room[1, at] < 1:  # full: the last open one takes its place
                n_open -= 1
                room[:, at], names[at] = room[:, n_open], names[n_open]
        else:
            bins[i], offsets[i] = n_bins, 0
            if capacity.tokens - need[0] >= smallest and capacity.documents > 1:
                if n_open == room.shape[1]:
                    room, names = np.concatenate([room, np.empty_like(room)], axis=1), np.concatenate([names, np.empty_like(names)])
                room[:, n_open], names[n_open] = most - need, n_bins
                n_open += 1
            n_bins += 1
        placed += 1
    return bins, offsets


def pack(pieces: DataFrame, capacity: Capacity, scratch: Scratch, *, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``pieces`` (with ``length``) with ``sequence_id`` and ``offset`` (the piece's place in its sequence, without gaps).

    The pieces are written once with a random-looking group number (a hash of
    their row numbers in the written table), counted, and packed group by group.
    """
    numbered = scratch.write(pieces.withColumn("__llm_row", F.monotonically_increasing_id()), "pieces")
    n_groups = max(1, math.ceil(numbered.count() / group_rows))
    grouped = numbered.withColumn("__llm_group", F.pmod(F.xxhash64("__llm_row"), F.lit(n_groups)))
    keep = [c for c in pieces.columns if c.lower() not in ("sequence_id", "offset")]
    schema = T.StructType([*[pieces.schema[c] for c in keep], T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("__llm_row")  # the same result whatever order the rows came in
        bins, offsets = best_fit(table["length"].to_numpy().astype(np.int64), capacity)
        ids = (table["__llm_group"][0].as_py() << 32) + bins
        return table.select(keep).append_column("sequence_id", pa.array(ids)).append_column("offset", pa.array(offsets))

    return grouped.repartition(n_groups, "__llm_group").groupBy("__llm_group").applyInArrow(run, schema)


def pack_documents(docs: DataFrame, tokenizer: str, scratch: Scratch, *, end_id: int = 2, capacity: Capacity = Capacity(),
                   with_ids: bool = True, text: str = "text", group_rows: int = GROUP_ROWS) -> DataFrame:
    """One row per piece of every document: the columns of ``docs`` but the text, ``piece, start, length, ids_crc32,
    sequence_id, offset`` and, ``with_ids``, the token ``ids`` themselves."""
    pieces = token_pieces(docs, tokenizer, end_id=end_id, most=capacity.tokens, text=text)
    pieces = replace_columns(pieces, {"ids_crc32": F.crc32("ids")})
    return pack(pieces if with_ids else pieces.drop("ids"), capacity, scratch, group_rows=group_rows)
