"""Product characteristics as entity-attribute-value rows.

Parsing is a narrow per-row expression (regex + higher-order functions): no
shuffle. Searches group by *product*, never by property key, because a few
keys hold most rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import strip_ws, trim_ws
from . import sync
from .aggregate import at_most_per_key

# Fixed value: the documented pattern for "key: value | key: value" text.
PROPERTY_PATTERN = r"(?:^|\|\s*)([^:|]+):\s*([^|]*?)(?=\s*\||$)"

PROP_COLS = ("product_id", "prop_key", "prop_value")


def property_pairs(text: Column | str) -> Column:
    """``array<struct<prop_key, pos, prop_value>>`` of the pairs in one text, cleaned,
    empty keys or values dropped, duplicate keys kept (``pos`` = order in the text)."""
    t = F.col(text) if isinstance(text, str) else text
    keys = F.regexp_extract_all(t, F.lit(PROPERTY_PATTERN), 1)
    vals = F.regexp_extract_all(t, F.lit(PROPERTY_PATTERN), 2)
    pairs = F.transform(
        F.arrays_zip(keys.alias("k"), vals.alias("v")),
        lambda p, i: F.struct(
            trim_ws(p["k"], extra_left="|").alias("prop_key"),
            i.alias("pos"),  # (key, pos) lead the struct so array_sort orders by them
            trim_ws(p["v"], extra_right="|").alias("prop_value"),
        ),
    )
    return F.filter(pairs, lambda p: (p["prop_key"] != "") & (p["prop_value"] != ""))


def last_per_key(sorted_pairs: Column) -> Column:
    """Keep the last occurrence of each key in an array already sorted by (key, pos):
    an element survives when the next one has another key.

    Pass a column *reference* to an array that was sorted in an earlier
    projection: the lambda reads the array at ``i + 1``, and an expression in
    its place would be re-evaluated for every element.
    """
    n = F.size(sorted_pairs)
    return F.filter(sorted_pairs, lambda p, i: (i == n - 1) | (F.get(sorted_pairs, i + 1)["prop_key"] != p["prop_key"]))


def _staged_pairs(df: DataFrame, text_col: str, dedupe: bool, keep: list[Column]) -> DataFrame:
    """Rows with ``__pairs``: parsed (and, with ``dedupe``, last-per-key) pairs of ``text_col``.

    Sorting happens in its own projection so the de-duplication lambda reads a
    materialised array (O(n log n) per text).
    """
    pairs = property_pairs(text_col)
    if not dedupe:
        return df.select(*keep, pairs.alias("__pairs"))
    staged = df.select(*keep, F.sort_array(pairs).alias("__sorted"))
    return staged.select(*[F.col(c) for c in staged.columns if c != "__sorted"],
                         last_per_key(F.col("__sorted")).alias("__pairs"))


def parse_properties(df: DataFrame, id_col: str = "id", text_col: str = "product_properties",
                     dedupe: bool = True, keep_pos: bool = False) -> DataFrame:
    """``'Brand: X | Color: Y'`` -> rows (product_id, prop_key, prop_value).

    A segment without ``:`` is skipped, a value may contain ``:``, stray pipes
    are stripped, and a repeated key keeps its last value (per input row; the
    product id is expected to be unique per row, as after an upsert).
    """
    staged = _staged_pairs(df, text_col, dedupe, [F.col(id_col).alias("product_id")])
    # explode_outer + NULL filter: an inner explode makes Catalyst infer
    # size(__pairs) > 0 and push it below the projections with the whole parse
    # expression inlined (and re-run per element inside the lambda)
    out = staged.select("product_id", F.explode_outer("__pairs").alias("p")).filter(F.col("p").isNotNull())
    cols = [F.col("product_id"), F.col("p.prop_key").alias("prop_key"), F.col("p.prop_value").alias("prop_value")]
    if keep_pos:
        cols.append(F.col("p.pos").alias("pos"))
    return out.select(*cols)


def repair_property_keys(props: DataFrame, now, stamp_col: str = "updated_at") -> tuple[DataFrame, DataFrame]:
    """Keys starting with ``|``: remove every ``|``, trim, stamp ``stamp_col``.

    A repaired key may collide with an existing (product_id, key): the row with
    the latest ``stamp_col`` wins (the repaired one, stamped ``now``). A key of
    pipes only becomes an empty key and its row stays. Returns (repaired
    table, one-row stats: found, fixed, and remaining, the keys that still
    start with a pipe after the repair; pipes inside a key are no fault).
    """
    now_c = F.lit(str(now)).cast("timestamp_ntz")
    bad = F.col("prop_key").startswith("|")
    fixed = props.withColumn("__bad", bad).select(
        "product_id",
        F.when(F.col("__bad"), strip_ws(F.regexp_replace("prop_key", r"\|", ""))).otherwise(F.col("prop_key")).alias("prop_key"),
        "prop_value",
        F.when(F.col("__bad"), now_c).otherwise(F.col(stamp_col)).alias(stamp_col),
        "__bad",
    )
    w = Window.partitionBy("product_id", "prop_key").orderBy(
        F.col(stamp_col).desc_nulls_last(), F.col("__bad").desc(), F.col("prop_value").asc_nulls_last()
    )  # full order: a retried task keeps the same row
    table = fixed.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn", "__bad")
    stats = fixed.agg(
        F.count_if(F.col("__bad")).alias("found"),
        F.count_if(F.col("__bad")).alias("fixed"),
        F.count_if(F.col("prop_key").startswith("|")).alias("remaining"),
    )
    return table, stats


def _pair_cond(filters: dict[str, str]) -> Column:
    return reduce(lambda a, b: a | b, [(F.col("prop_key") == k) & (F.col("prop_value") == v) for k, v in filters.items()])


def search_by_properties(products: DataFrame, props: DataFrame, filters: dict[str, str], id_col: str = "id",
                         limit: int | None = None, method: str = "having", with_properties: bool = False) -> DataFrame:
    """Products having *all* the given (key, value) pairs.

    ``having`` (default): one pass over the properties with an OR of the pairs
    (pushed to the scan), group by product, keep products matching every key,
    semi-join. ``selfjoin``: one semi-join per pair. ``single``: the first pair only.
    ``limit`` keeps the first products by id. ``with_properties`` adds each
    hit's ``properties`` map, built only for the hits (after the limit).
    """
    if method == "having":
        hits = (
            props.filter(_pair_cond(filters))
            .groupBy("product_id")
            # the set holds at most len(filters) keys: one shuffle, partial aggregation map-side
            .agg(F.size(F.collect_set("prop_key")).alias("__n"))
            .filter(F.col("__n") == len(filters))
            .select(F.col("product_id").alias(id_col))
        )
        out = products.join(hits, id_col, "left_semi")
    elif method in ("selfjoin", "single"):
        items = list(filters.items())[: 1 if method == "single" else None]
        out = products
        for k, v in items:
            ids = props.filter((F.col("prop_key") == k) & (F.col("prop_value") == v)).select(F.col("product_id").alias(id_col))
            out = out.join(ids, id_col, "left_semi")
    else:
        raise ValueError(f"unknown method {method!r}")
    if limit is not None:
        out = out.orderBy(id_col).limit(limit)
    if with_properties:
        hit_props = props.join(out.select(F.col(id_col).alias("product_id")), "product_id", "left_semi")
        out = with_property_map(out, hit_props, id_col)
    return out


def property_map(props: DataFrame, order_col: str | None = None, max_items: int | None = None) -> DataFrame:
    """All properties of each product as ``map<string,string>`` (keys sorted).

    A key that repeats for a product keeps its last value by ``order_col``
    (without one the greatest value), chosen by a partial aggregate before the
    map is built. ``max_items`` fails the job where a product has more keys.
    """
    last = F.max_by("prop_value", F.struct(order_col, "prop_value")) if order_col else F.max("prop_value")
    single = props.groupBy("product_id", "prop_key").agg(last.alias("prop_value"))
    if max_items is not None:
        single = at_most_per_key(single, "product_id", max_items, "properties")
    entries = F.array_sort(F.collect_list(F.struct("prop_key", "prop_value")))
    return single.groupBy("product_id").agg(F.map_from_entries(entries).alias("properties"))


def with_property_map(products: DataFrame, props: DataFrame, id_col: str = "id") -> DataFrame:
    m = property_map(props).withColumnRenamed("product_id", id_col)
    return products.join(m, id_col, "left")


def property_stats(props: DataFrame) -> DataFrame:
    """total properties, products with properties, distinct keys.

    Rows are counted per product and per key with partial aggregation, then
    the small counts are added up (two distinct counts at once would copy
    every row three times).
    """
    per_product = props.groupBy("product_id").agg(F.count(F.lit(1)).alias("n"))
    per_key = props.groupBy("prop_key").agg(F.count(F.lit(1)).alias("n"))
    none = F.lit(None).cast("long")
    totals = per_product.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("a"), F.count("product_id").alias("b"), none.alias("c"))
    totals = totals.unionByName(per_key.agg(none.alias("a"), none.alias("b"), F.count("prop_key").alias("c")))
    return totals.agg(F.max("a").alias("total_properties"), F.max("b").alias("products_with_properties"), F.max("c").alias("unique_keys"))


def property_run_stats(snapshot: DataFrame, text_col: str = "product_properties") -> DataFrame:
    """Statistics of one property load: rows processed and properties parsed, one pass, no explode."""
    n = F.size("__pairs")
    return _staged_pairs(snapshot, text_col, True, []).agg(
        F.count(F.lit(1)).alias("updated_rows"),
        F.coalesce(F.sum(F.when(n > 0, n)), F.lit(0)).cast("bigint").alias("properties_processed"),
    )


def property_keys(props: DataFrame) -> DataFrame:
    return props.select("prop_key").distinct()


def property_values(props: DataFrame, key: str) -> DataFrame:
    return props.filter(F.col("prop_key") == key).select("prop_value").distinct()


def update_properties(props: DataFrame, updates: DataFrame, now) -> DataFrame:
    """Upsert (product_id, prop_key) pairs: existing keys get the new value, new keys
    are inserted, keys not mentioned are kept. ``updated_at`` is stamped when the
    value changes or the key is new."""
    return sync.upsert(props, updates, keys=["product_id", "prop_key"], change_cols=["prop_value"], now=now,
                       flag_col=None, stamp_col="updated_at")


def products_without_properties(products: DataFrame, props: DataFrame, id_col: str = "id") -> DataFrame:
    """Products with no property row. The property side is reduced to distinct
    ids first (partial aggregation map-side), so a product with very many
    property rows sends one row per map task to the anti-join, not all of them."""
    return products.join(props.select(F.col("product_id").alias(id_col)).distinct(), id_col, "left_anti")


def duplicate_properties(props: DataFrame) -> DataFrame:
    return props.groupBy("product_id", "prop_key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def keys_with_pipes(props: DataFrame, samples: int = 5) -> tuple[DataFrame, DataFrame]:
    """(count of keys containing ``|``, the first ``samples`` such rows by key and product)."""
    bad = props.filter(F.col("prop_key").contains("|"))
    count = bad.agg(F.count(F.lit(1)).alias("keys_with_pipes"))
    sample = bad.select("product_id", "prop_key").orderBy("prop_key", "product_id").limit(samples)
    return count, sample


def sync_properties(props: DataFrame, snapshot: DataFrame, now, id_col: str = "id",
                    text_col: str = "product_properties", delete_vanished: bool = True) -> DataFrame:
    """Parse the snapshot's property text and merge it into the property table.

    Keys present in the text are updated or inserted. With ``delete_vanished``
    a product in the snapshot loses the keys its text no longer has; products
    not in the snapshot keep theirs (their deletion is the orphan cleanup's job).
    """
    parsed = parse_properties(snapshot, id_col, text_col)
    merged = sync.upsert(props, parsed, keys=["product_id", "prop_key"], change_cols=["prop_value"], now=now,
                         flag_col=None, stamp_col="updated_at", with_action=True)
    if delete_vanished:
        in_snap = snapshot.select(F.col(id_col).alias("product_id")).distinct().withColumn("__snap", F.lit(True))
        merged = merged.join(in_snap, "product_id", "left").filter(
            ~((F.col("_action") == sync.ACTION_KEEP) & F.col("__snap").isNotNull())
        ).drop("__snap")
    return merged.drop("_action")
