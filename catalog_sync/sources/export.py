"""BI query results: the ``{"results":[{"tables":[{"rows":[...]}]}]}`` envelope.

Exports are written and read as pages: each JSON line is one complete
envelope holding one page of rows, so a reader splits the files by line and
no task ever parses the whole export; the writer builds pages inside each
task, without a shuffle. ``multi_line=True`` reads classic
pretty-printed one-document-per-file exports (one task per file).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class ExportFormatError(ValueError):
    pass


# The envelope a BI result comes in, around a comma-separated run of row objects.
ENVELOPE_HEAD = '{"results":[{"tables":[{"rows":['
ENVELOPE_TAIL = ']}]}]}'


def _pages(rows_per_page: int):
    """Arrow function: each batch of row JSON strings -> envelope lines of at most ``rows_per_page`` rows."""

    def run(batches):
        for b in batches:
            rows = b.column(0)
            n = len(rows)
            if n == 0:
                continue
            offsets = np.append(np.arange(0, n, rows_per_page), n).astype(np.int32)
            joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), rows), ",")
            yield pa.RecordBatch.from_arrays([pc.binary_join_element_wise(ENVELOPE_HEAD, joined, ENVELOPE_TAIL, "")], ["value"])

    return run


def write_export(rows: DataFrame, path: str, rows_per_page: int = 50_000, mode: str = "overwrite") -> None:
    """Write ``rows`` as envelope pages (JSON lines), explicit nulls kept.

    Rows are rendered to JSON in the JVM (``to_json``); each task then joins
    runs of at most ``rows_per_page`` consecutive rows of its own Arrow batches
    into one envelope line (vectorised Arrow string joins). No shuffle: a page
    never mixes tasks, so a retried task rewrites exactly its own pages, and
    pages are bounded whatever the data holds, even many identical rows.
    """
    cols = [F.col(f"`{c}`") for c in rows.columns]
    as_json = rows.select(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias("r"))
    as_json.mapInArrow(_pages(rows_per_page), "value string").write.mode(mode).text(path)


def read_export(spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool = False) -> DataFrame:
    """Rows of ``results[0].tables[0].rows`` from every envelope under ``path``.

    Every page is checked on its own, inside the plan: text that is not JSON
    and an envelope without results, tables or rows (an ``{"error": ...}``
    page, a cut-off line) fail the job. Without ``schema`` (the row schema) it
    is inferred first, and an export in which no page has rows raises
    :class:`ExportFormatError`.
    """
    if schema is None:
        inferred = spark.read.option("multiLine", multi_line).json(path).schema
        try:
            tables = inferred["results"].dataType.elementType["tables"].dataType
            schema = tables.elementType["rows"].dataType.elementType
        except (KeyError, AttributeError) as exc:
            raise ExportFormatError(f"export at {path} is not a results/tables/rows envelope") from exc
    table = T.StructType([T.StructField("rows", T.ArrayType(schema))])
    envelope = T.StructType([T.StructField("results", T.ArrayType(T.StructType([T.StructField("tables", T.ArrayType(table))])))])
    pages = spark.read.text(path, wholetext=multi_line).filter(F.trim("value") != "")
    env = pages.select(F.from_json("value", envelope, {"mode": "FAILFAST"}).alias("e"))

    def level(there: Column, value: Column, missing: str) -> Column:
        return F.when(there, value).otherwise(F.raise_error(F.lit(f"export page without {missing}")))

    results = F.col("e.results")
    tables = level(F.size(results) > 0, F.get(results, F.lit(0))["tables"], "results")
    rows = F.get(tables, F.lit(0))["rows"]
    checked = env.select(level(F.size(tables) > 0, rows, "tables").alias("rows"))
    checked = checked.select(level(F.col("rows").isNotNull(), F.col("rows"), "rows").alias("rows"))
    # outer: an inner explode would let Spark drop pages before they are checked
    out = checked.select(F.explode_outer("rows").alias("r"), (F.size("rows") == 0).alias("none")).filter("NOT none")
    return out.select("r.*")
