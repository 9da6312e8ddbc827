"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most ``2 r`` bits have a common variant within
``r`` bits of each. So every distinct fingerprint emits all its variants within
half the radius, the rows are shuffled on the variant, and fingerprints that
meet are candidates; pairs are de-duplicated and verified by their bit distance.
Work is on distinct fingerprints: however many copies a text has, its
fingerprint is one row, and a variant is shared by at most as many
fingerprints as it has variants itself (65 for ``r = 1``), so no group is hot. Linked
fingerprints become components by alternating star contraction in written tables.

Defined cases: null text is empty; a text without words has fingerprint zero
and is linked like any other; texts with fewer words than a shingle use the
whole word sequence; repeated rows each get a row; a null id takes part but never names
a component (a component without ids has a null one); an empty table gives an empty result; other
columns of the documents are kept, those named like a result column give way to it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog_sync.llm.tables import Scratch, replace_columns

SEED = 42
BITS = 64


def shingle_hashes(text: bytes, shingle: int, seed: int = SEED) -> np.ndarray:
    """XXH64 of every word shingle of a UTF-8 text, A-Z lower-cased, repeats included."""
    import xxhash

    words = text.lower().split()  # on bytes: lowers A-Z only, splits at ASCII white space only
    if not words:
        return np.empty(0, np.uint64)
    joined, k = b" ".join(words), min(shingle, len(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)
    return np.array([digest(joined[a:b], seed) for a, b in spans], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """Signed 64-bit value whose bits are set in over half of the hashes (zero for none)."""
    if not len(hashes):
        return 0
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):  # a long text takes bounded memory
        part = np.ascontiguousarray(hashes[at : at + (1 << 16)].astype("<u8"))
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def with_fingerprint(docs: DataFrame, shingle: int, *, text: str = "text", name: str = "simhash") -> DataFrame:
    """``docs`` with their fingerprint as a signed long; one pass, no shuffle."""
    rest = [c for c in docs.columns if c.lower() not in (text.lower(), name.lower())]
    schema = T.StructType([*[docs.schema[c] for c in rest], docs.schema[text], T.StructField(name, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(len(rest))
            texts = column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary())
            values = [fingerprint(shingle_hashes(t.as_py() or b"", shingle)) for t in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.int64())], names=[*rest, text, name])

    return docs.select(*[F.col(f"`{c}`") for c in rest], F.col(f"`{text}`")).mapInArrow(run, schema)


def _ball(fp: Column, radius: int) -> Column:
    """All values within ``radius`` bits of ``fp``, each once."""
    masks = [0]
    grown = {0}
    for _ in range(radius):
        grown = {m ^ (1 << b) for m in grown for b in range(BITS)} - set(masks)
        masks += sorted(grown)
    signed = [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]
    return F.transform(F.lit(signed).cast("array<bigint>"), lambda m: fp.bitwiseXOR(m))


def linked_fingerprints(fingerprints: DataFrame, max_distance: int) -> DataFrame:
    """All pairs ``a < b`` (signed order) of distinct fingerprints (column ``fp``) at most ``max_distance`` bits apart."""
    half = (max_distance + 1) // 2
    # Rows grow by the ball's size here. Dealt out without a key: by one, it would melt into the exchange of the distinct
    # below, whose small partitions are merged into a few.
    spread = int(fingerprints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    variants = fingerprints.select("fp").distinct().repartition(spread).select("fp", F.explode(_ball(F.col("fp"), half)).alias("variant"))
    a, b = variants.select("variant", F.col("fp").alias("a")), variants.select("variant", F.col("fp").alias("b"))
    # Spark sizes the balls by the fingerprints they come from, so without the hint it would broadcast them
    met = a.hint("merge").join(b.hint("merge"), "variant").filter("a < b").select("a", "b").distinct()
    return met.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance)


def components(edges: DataFrame, scratch: Scratch, name: str = "components") -> DataFrame:
    """``node, root`` for every node of the undirected ``edges`` (columns ``a, b``): root is the component's smallest node.

    Alternating large-star and small-star contraction: a round links each
    node's larger (then smaller) neighbours to its smallest neighbour; the
    number of rounds grows with the logarithm of the longest path. Minima are pre-aggregated
    before their shuffle and the joins are plain equi-joins that AQE splits
    at hot nodes. Each round is a written table; only its row count and a checksum reach the driver.
    """
    state, before = edges.select("a", "b"), None
    for k in range(1, 200):
        both = state.union(state.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")).select(F.col("a").alias("n"), "m")
        large = both.filter("b > a").join(least, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = scratch.write(large.filter("a != b").distinct(), f"{name}-{k}-large")
        low = large.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n_low")).select(F.col("a").alias("n"), "m", "n_low")
        many = large.join(low.filter("n_low > 1"), F.col("a") == F.col("n")).filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = many.union(low.select(F.col("n").alias("a"), F.col("m").alias("b"))).distinct()
        state = scratch.write(small, f"{name}-{k}-small")
        now = state.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))"), F.expr("bit_xor(xxhash64(b, a, 1))")).first()
        if now == before:
            break
        before = now
    roots = state.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(state.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def classes(marked: DataFrame, max_distance: int, scratch: Scratch, *, doc_id: str = "doc_id") -> DataFrame:
    """One row per distinct fingerprint of ``marked`` (``doc_id, simhash``).

    Columns: ``fp``; ``component_id``, the smallest id of a document reachable
    over links; ``keeper``, that document's fingerprint (the smallest, if rows
    of several fingerprints share the id); ``n_docs`` with this fingerprint;
    ``n_links``, the linked other fingerprints.
    """
    identity = F.struct(F.col(f"`{doc_id}`").isNull().alias("none"), F.col(f"`{doc_id}`").alias("id"), F.col("simhash").alias("fp"))
    own = marked.groupBy(F.col("simhash").alias("fp")).agg(F.min(identity).alias("first"), F.count(F.lit(1)).alias("n_docs"))
    own = scratch.write(own, "fingerprints")
    links = scratch.write(linked_fingerprints(own, max_distance), "links")
    roots = components(links, scratch)
    degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("n_links"))
    by_fp = own.join(roots, F.col("fp") == F.col("node"), "left").drop("node").withColumn("root", F.coalesce("root", "fp"))
    named = by_fp.groupBy("root").agg(F.min("first").alias("least"))
    out = by_fp.join(named, "root").join(degree, F.col("fp") == F.col("node"), "left")
    return scratch.write(out.select("fp", F.col("least.id").alias("component_id"), F.col("least.fp").alias("keeper"), "n_docs",
                                    F.coalesce("n_links", F.lit(0)).alias("n_links")), "classes")


def near_duplicates(docs: DataFrame, *, shingle: int, max_distance: int, scratch: Scratch, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: its columns without the text, with ``simhash, component_id, n_docs, n_links``."""
    marked = scratch.write(with_fingerprint(docs, shingle, text=text).drop(text), "marked")
    found = classes(marked, max_distance, scratch, doc_id=doc_id)
    side = found.select(F.col("fp").alias("__llm_fp"), F.struct("component_id", "n_docs", "n_links").alias("__llm_c"))
    joined = marked.join(side, F.col("simhash") == F.col("__llm_fp"))
    return replace_columns(joined, {c: F.col(f"__llm_c.{c}") for c in ("component_id", "n_docs", "n_links")}).drop("__llm_fp", "__llm_c")


def drop_near_duplicates(docs: DataFrame, *, shingle: int, max_distance: int, scratch: Scratch, doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest id (of rows repeating it, one).

    Fingerprints are computed once more for the texts, rather than writing all
    texts; each text is shuffled once, by its fingerprint and id. The keepers
    grow with the documents, so they are never broadcast.
    """
    marked = scratch.write(with_fingerprint(docs, shingle).select(F.col(f"`{doc_id}`"), "simhash"), "marked")
    found = classes(marked, max_distance, scratch, doc_id=doc_id)
    key = ["__llm_fp", "__llm_id", "__llm_none"]  # a null id is an id of its own

    def keyed(rows: DataFrame, fp: str, name: str) -> DataFrame:
        named = F.col(f"`{name}`")
        return rows.withColumns({"__llm_fp": F.col(fp), "__llm_id": F.coalesce(named.cast("string"), F.lit("")), "__llm_none": named.isNull()})

    keepers = keyed(found, "keeper", "component_id").select(*key).distinct()
    rows = keyed(with_fingerprint(docs, shingle, name="__llm_fp"), "__llm_fp", doc_id)
    kept = rows.join(keepers.hint("merge"), key)
    one = F.row_number().over(Window.partitionBy(*key).orderBy(F.lit(0)))
    return kept.withColumn("__llm_n", one).filter("__llm_n = 1").select(*[F.col(f"`{c}`") for c in docs.columns])


def fingerprint_hex(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
