"""An index for substring search (``ILIKE '%text%'``): from three characters in a row to the blocks of rows that hold them.

Rows are dealt by a hash of their id into ``blocks`` blocks and stored partitioned by block. A posting is a bitmap of the blocks
that hold a gram, three consecutive characters of the lower-cased text. A search ANDs the bitmaps of the grams of the
pattern's literal runs, reads the blocks that remain and checks their rows by ``ilike`` itself, so its
rows are those of the scan. Patterns without a gram (shorter, or cut by wildcards into shorter runs) scan every block.

Texts and patterns are lower-cased by the same Spark function that ``ilike`` uses, and whole texts are indexed: a row of a match has every gram. A bitmap
is 4 KB, and there are at most 32,768 blocks; the bitmap of a search is all that reaches the driver. A gram that every row holds is as many
pairs as blocks. Rows whose text is NULL match nothing and are stored as they are; rows with a NULL id share a block and are found like others.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import release
from ..sources.files import path_exists
from . import filters

GRAM = 3
#: Blocks of a table by default, and the most that one bitmap numbers.
BLOCKS, MAX_BLOCKS = 256, 32_768
_BLOCK = "__block"


def _block(id_col: str, blocks: int) -> Column:
    return (F.pmod(F.xxhash64(F.col(f"`{id_col}`")), F.lit(blocks)) + 1).cast("int")


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct (block, gram) of each batch of ``block, lower-cased text``."""
    for batch in batches:
        held: dict[int, set[str]] = {}
        for block, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            t = text.as_py()
            held.setdefault(block, set()).update(map("".join, zip(t, t[1:], t[2:])))
        for block, grams in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([block] * len(grams), pa.int32()), pa.array(list(grams), pa.string())], names=["block", "gram"])


def postings(rows: DataFrame, text_col: str) -> DataFrame:
    """``gram, blocks`` (a bitmap) of rows that carry their block."""
    texts = rows.select(F.col(_BLOCK).alias("block"), F.lower(F.col(f"`{text_col}`")).alias("t")).filter(F.length("t") >= GRAM)
    # distinct first: a hash aggregate cuts the pairs of a task, the bitmaps' aggregate has to sort
    pairs = texts.mapInArrow(_grams, "block int, gram string").distinct()
    return pairs.groupBy("gram").agg(F.bitmap_construct_agg(F.bitmap_bit_position("block")).alias("blocks"))


def _rows_path(base: str) -> str:
    return os.path.join(base, "rows")


def _postings_path(base: str) -> str:
    return os.path.join(base, "postings")


def write_index(df: DataFrame, base: str, id_col: str = "id", text_col: str = "description", blocks: int = BLOCKS) -> None:
    """Store ``df`` by blocks at ``base`` with the postings of ``text_col``."""
    if not 1 <= blocks <= MAX_BLOCKS:
        raise ValueError(f"blocks must be between 1 and {MAX_BLOCKS}")
    stored = df.withColumn(_BLOCK, _block(id_col, blocks))
    # hashed ids spread evenly; rows that repeat one id are spread over tasks and only share the block's folder
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(4))
    stored.repartition(_BLOCK, spread).write.mode("overwrite").partitionBy(_BLOCK).parquet(_rows_path(base))
    # a table without rows has no file to tell its columns
    stored.limit(0).write.mode("overwrite").parquet(os.path.join(base, "columns"))
    _write_postings(postings(_stored(df.sparkSession, base), text_col), base, "overwrite")


def _stored(spark: SparkSession, base: str) -> DataFrame:
    columns = spark.read.parquet(os.path.join(base, "columns")).schema
    return spark.read.schema(columns).parquet(_rows_path(base))


def _write_postings(posted: DataFrame, base: str, mode: str) -> None:
    # sorted by gram, so that a search reads the row groups of its grams
    posted.sortWithinPartitions("gram").write.mode(mode).parquet(_postings_path(base))


def update_index(df: DataFrame, base: str, changed: DataFrame, id_col: str = "id", text_col: str = "description", blocks: int = BLOCKS) -> list[int]:
    """Bring the index up to date with ``df`` (all rows) for the ids ``changed`` (a column ``id_col``); returns the blocks' numbers.

    ``df`` must not read the index itself. Only the blocks of changed ids are written. Their new postings are added before the rows
    are replaced, so after a failure in between, and for rows that are gone, a search at most reads a block too many.
    """
    touched = sorted(r[0] for r in changed.select(_block(id_col, blocks)).distinct().collect())  # at most `blocks` numbers
    if not touched:
        return []
    spark = df.sparkSession
    rows = df.withColumn(_BLOCK, _block(id_col, blocks)).filter(F.col(_BLOCK).isin(touched))
    _write_postings(postings(rows, text_col), base, "append")
    rows.repartition(_BLOCK).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(_BLOCK).parquet(_rows_path(base))
    full = {r[0] for r in rows.select(_BLOCK).distinct().collect()}
    for block in set(touched) - full:  # no row left
        where = os.path.join(_rows_path(base), f"{_BLOCK}={block}")
        if path_exists(spark, where):
            release(spark, where)
    return touched


def literal_runs(pattern: str) -> list[str]:
    r"""The texts between the wildcards of a LIKE pattern; a backslash makes ``%``, ``_`` and itself literal."""
    runs, run, i = [], "", 0
    while i < len(pattern):
        c = pattern[i]
        if c == "\\" and i + 1 < len(pattern):
            i += 1
            run += pattern[i]
        elif c in "%_":
            runs.append(run)
            run = ""
        else:
            run += c
        i += 1
    return [r for r in [*runs, run] if r]


def pattern_grams(spark: SparkSession, pattern: str) -> list[str]:
    """The distinct grams that every text matching ``ILIKE pattern`` has."""
    lowered = spark.range(1).select(F.lower(F.lit(pattern))).first()[0]
    return sorted({run[i : i + GRAM] for run in literal_runs(lowered) for i in range(len(run) - GRAM + 1)})


def candidate_blocks(spark: SparkSession, base: str, pattern: str) -> list[int] | None:
    """Numbers of the blocks that hold all grams of the pattern; None if it has none."""
    grams = pattern_grams(spark, pattern)
    if not grams:
        return None
    posted = spark.read.schema("gram string, blocks binary").parquet(_postings_path(base)).filter(F.col("gram").isin(grams))
    # an update adds postings of the same gram
    whole = posted.groupBy("gram").agg(F.bitmap_or_agg("blocks").alias("blocks"))
    found = whole.agg(F.count(F.lit(1)).alias("n"), F.bitmap_and_agg("blocks").alias("blocks")).first()
    if found["n"] < len(grams):
        return []
    bits = np.unpackbits(np.frombuffer(bytes(found["blocks"]), np.uint8), bitorder="little")
    return (np.flatnonzero(bits) + 1).tolist()


def search(spark: SparkSession, base: str, pattern: str, text_col: str = "description") -> DataFrame:
    """The rows whose text matches ``ILIKE pattern``, read from the candidate blocks alone."""
    blocks = candidate_blocks(spark, base, pattern)
    rows = _stored(spark, base)
    if blocks is not None:
        rows = rows.filter(F.col(_BLOCK).isin(blocks) if blocks else F.lit(False))
    return rows.filter(F.col(f"`{text_col}`").ilike(pattern)).drop(_BLOCK)


def search_text(spark: SparkSession, base: str, text: str, text_col: str = "description", flag_col: str | None = "is_vector",
                limit: int | None = 5, order_by: str = "id") -> DataFrame:
    """:func:`filters.search_text` answered from the index."""
    hits = search(spark, base, f"%{text}%", text_col)
    return filters.search_text(hits, text, text_col, flag_col, limit, order_by)
