"""Deletes over a graph of foreign keys: what goes with the deleted rows, and what loses its reference.

Cascading references are followed to a fixpoint in written rounds: a round
joins only the keys that the last one found with the (key, reference) columns of their child tables, and
keeps those not found before, so cycles end and a round costs what it finds. Only
the number of new keys reaches the driver. Then every table is filtered once: a
row goes if its own key or what it references by a cascading key is gone, and a ``set_null`` reference to a row that is gone
becomes NULL. Rows are joined by plain equi-joins that AQE splits at a hot parent;
the keys of deleted rows are never broadcast by hand.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize_at

CASCADE, SET_NULL, RESTRICT = "cascade", "set_null", "restrict"


@dataclass(frozen=True)
class ForeignKey:
    """``child.column`` references the key of ``parent``; ``on_delete``: ``cascade``, ``set_null`` or ``restrict``."""

    child: str
    column: str
    parent: str
    on_delete: str = CASCADE


class RestrictError(ValueError):
    pass


def gone_keys(tables: dict[str, DataFrame], keys: dict[str, str], references: list[ForeignKey], deleted: dict[str, DataFrame],
              max_rounds: int = 1000) -> dict[str, DataFrame]:
    """Per table the distinct keys (column ``key``) of all rows that go when the keys ``deleted`` (first column) are deleted.

    Rounds needed: the longest chain of cascading references. NULL keys and references match nothing.
    """
    for r in references:
        if r.on_delete not in (CASCADE, SET_NULL, RESTRICT):
            raise ValueError(f"unknown rule {r.on_delete!r}")
    found: dict[str, list[DataFrame]] = {t: [] for t in tables}
    fresh: dict[str, DataFrame] = {}
    for t, rows in deleted.items():
        key = rows.select(rows[rows.columns[0]].cast(tables[t].schema[keys[t]].dataType).alias("key"))
        # only keys that the table has: deleting another one deletes nothing
        own = tables[t].select(F.col(keys[t]).alias("key"))
        fresh[t] = materialize_at(key.filter("key IS NOT NULL").distinct().join(own, "key", "left_semi"), "closure")[0]
    for _ in range(max_rounds):
        fresh = {t: f for t, f in fresh.items() if f.limit(1).count()}
        if not fresh:
            return {t: reduce(DataFrame.union, f) if f else tables[t].select(F.col(keys[t]).alias("key")).limit(0) for t, f in found.items()}
        for t, f in fresh.items():
            found[t].append(f)
        reached: dict[str, list[DataFrame]] = {}
        for r in references:
            if r.on_delete == CASCADE and r.parent in fresh:
                hit = tables[r.child].select(F.col(keys[r.child]).alias("key"), F.col(r.column).alias("ref")).filter("key IS NOT NULL")
                hit = hit.join(fresh[r.parent].withColumnRenamed("key", "ref"), "ref", "left_semi").select("key")
                reached.setdefault(r.child, []).append(hit)
        fresh = {}
        for t, parts in reached.items():
            new = reduce(DataFrame.union, parts).distinct()
            for old in found[t]:
                new = new.join(old, "key", "left_anti")
            fresh[t] = materialize_at(new, "closure")[0]
    raise RuntimeError(f"chains of references are longer than {max_rounds}")


def delete_closure(tables: dict[str, DataFrame], keys: dict[str, str], references: list[ForeignKey], deleted: dict[str, DataFrame],
                   max_rounds: int = 1000) -> dict[str, DataFrame]:
    """Every table as it is after the deletion of ``deleted`` (per table a frame of keys).

    A ``restrict`` reference from a row that stays to one that goes raises :class:`RestrictError`.
    """
    gone = gone_keys(tables, keys, references, deleted, max_rounds)
    out = {}
    for name, rows in tables.items():
        columns = rows.columns
        if not (deleted.get(name) is None and all(r.child != name for r in references)):
            rows = rows.join(gone[name].select(F.col("key").alias("__gone")), F.col(keys[name]) == F.col("__gone"), "left_anti")
        for r in references:
            if r.child == name and r.on_delete == CASCADE:  # rows without a key of their own go as well
                rows = rows.join(gone[r.parent].select(F.col("key").alias("__gone")), F.col(r.column) == F.col("__gone"), "left_anti")
        for i, r in enumerate(x for x in references if x.child == name and x.on_delete == SET_NULL):
            mark = gone[r.parent].select(F.col("key").alias(f"__gone{i}"))
            rows = rows.join(mark, F.col(r.column) == F.col(f"__gone{i}"), "left").withColumn(r.column, F.when(F.col(f"__gone{i}").isNull(), F.col(r.column)))
        out[name] = rows.select(*columns)
    for r in references:
        if r.on_delete == RESTRICT:
            left = out[r.child].join(gone[r.parent].select(F.col("key").alias("__gone")), F.col(r.column) == F.col("__gone"), "left_semi")
            if left.limit(1).count():
                raise RestrictError(f"rows of {r.child} still reference deleted rows of {r.parent} by {r.column}")
    return out
