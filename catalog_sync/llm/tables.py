"""Written intermediate tables, bounded broadcasts and other small helpers of the operators."""

from __future__ import annotations

import atexit
import sys
import types
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog_sync.session import ensure_checkpoint_dir, release

#: ASCII white space: 0x20 and 0x09-0x0D. Words are the runs between them.
WHITE_SPACE = " \t\n\x0b\x0c\r"

#: Rows up to which a parameter table (strata, sources) is broadcast; longer ones are joined by a shuffle.
BROADCAST_ROWS = 10_000


class Scratch:
    """The tables that one operator run writes below ``spark.checkpoint.dir``.

    A written table cuts the lineage, survives lost executors and is read
    again instead of being computed twice. The frames an operator returns read
    these tables, so the caller deletes them with :meth:`release` when done;
    what is left goes when the driver's Python ends.
    """

    live: list[Scratch] = []

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
        self.n_written = 0
        Scratch.live.append(self)

    def place(self, name: str) -> str:
        """A new folder for a table; a name may be used again."""
        self.n_written += 1
        return f"{self.path}/{self.n_written:03d}-{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` once and return the written table."""
        where = self.place(name)
        df.write.parquet(where)
        return self.spark.read.schema(df.schema).parquet(where)

    def release(self) -> None:
        if self in Scratch.live:
            Scratch.live.remove(self)
            release(self.spark, self.path)


def release_all() -> None:
    """Delete what all runs so far have written (their results must have been used)."""
    for run in list(Scratch.live):
        try:
            run.release()
        except Exception:  # the session has ended; the folder's owner cleans up
            Scratch.live.remove(run) if run in Scratch.live else None


atexit.register(release_all)


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``max_rows`` rows, else as it is (Spark then shuffles)."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once per row, also inside nested lambdas."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def words_of(text: Column) -> Column:
    """Array of the maximal runs without ASCII white space; null text has none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITE_SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))


def replace_columns(df: DataFrame, new: dict[str, Column]) -> DataFrame:
    """``df`` with the columns ``new``; an input column of the same name gives way (case does not count)."""
    taken = {n.lower() for n in new}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken], *[v.alias(k) for k, v in new.items()])


def once_per_process(key: str, make: Callable[[], object]) -> object:
    """An object that a Python worker builds once and keeps for its later tasks (a loaded tokenizer)."""
    kept = sys.modules.setdefault("_catalog_sync_llm_kept", types.ModuleType("_catalog_sync_llm_kept"))
    if not hasattr(kept, key):
        setattr(kept, key, make())
    return getattr(kept, key)
