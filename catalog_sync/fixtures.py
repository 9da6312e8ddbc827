"""Catalog-shaped views derived deterministically from the TESTDATA tables.

The DataFrame builders here and the SQL text in ``FIXTURE_SQL`` define the same
rows (see FIXTURES.md part B); the SQL is what the DuckDB oracle runs as CTEs.
Modulo rules on the id only decide *which* rows play vanished / changed /
inserted in the two snapshots; every view still covers the whole ``part`` table.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed timestamps used by every sync query ("yesterday's" load and "now").
TARGET_LOADED_AT = "2024-01-01 00:00:00"
NOW = "2024-06-01 00:00:00"


def ts(value: str):
    return F.lit(value).cast("timestamp_ntz")


_TABLES: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A TESTDATA table. The read (file listing, footer schema) is resolved once
    per application and path; every action still scans the files."""
    path = os.path.join(sf_dir, f"{name}.parquet")
    key = (spark.sparkContext.applicationId, path)
    df = _TABLES.get(key)
    if df is None or df.sparkSession is not spark:
        df = _TABLES[key] = spark.read.parquet(path)
    return df


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return p.select(
        k.alias("id"),
        F.concat(F.col("p_name"), F.lit(" "), k.cast("string")).alias("description"),
        F.when(k % 13 == 0, F.lit(None).cast("string")).otherwise(F.col("p_brand")).alias("brand"),
        F.col("p_type").alias("category"),
        (F.col("p_size") % 7 == 0).alias("withdrawn_from_range"),
        F.concat(F.lit("IT-"), k.cast("string")).alias("item_number"),
        "p_brand",
        "p_type",
        "p_size",
    )


def cat_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = catalog(spark, sf_dir)
    i = F.col("id")
    return c.filter(i % 11 != 0).select(
        "id",
        F.when(i % 5 == 0, F.concat(F.col("description"), F.lit(" old"))).otherwise(F.col("description")).alias("description"),
        F.when(i % 26 == 0, F.lit("Brand#0")).otherwise(F.col("brand")).alias("brand"),
        "category",
        "withdrawn_from_range",
        "item_number",
        (i % 2 == 0).alias("is_vector"),
        ts(TARGET_LOADED_AT).alias("updated_at"),
    )


def cat_source(spark: SparkSession, sf_dir: str, guard_case: bool = False) -> DataFrame:
    c = catalog(spark, sf_dir)
    cond = (F.col("id") % 20 == 0) if guard_case else (F.col("id") % 7 != 0)
    return c.filter(cond).select("id", "description", "brand", "category", "withdrawn_from_range", "item_number")


def prop_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = catalog(spark, sf_dir)
    i = F.col("id")
    return c.select(
        "id",
        F.concat(
            F.when(i % 3 == 0, F.lit("| ")).otherwise(F.lit("")),
            F.lit("Brand: "), F.col("p_brand"),
            F.lit(" | Type: "), F.col("p_type"),
            F.lit(" | Size: "), F.col("p_size").cast("string"),
            F.when(i % 17 == 0, F.concat(F.lit(" | Size: "), (F.col("p_size") + 1).cast("string"))).otherwise(F.lit("")),
            F.when(i % 19 == 0, F.lit(" | junk")).otherwise(F.lit("")),
            F.when(i % 23 == 0, F.lit(" | Note: a: b")).otherwise(F.lit("")),
        ).alias("product_properties"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = catalog(spark, sf_dir)
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return c.join(e, "id").select(
        "id", "description", "brand", "category", (F.col("id") % 10 != 0).alias("is_vector"), "vector"
    )


def characteristics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(article, sort_order, name, value): the three properties of each product.

    Products with ``id % 9 = 0`` have no characteristics (they drop out of the
    export when blank groups are dropped); a NULL brand simply has no row.
    """
    c = catalog(spark, sf_dir).filter(F.col("id") % 9 != 0)
    long = c.select(
        F.col("item_number").alias("article"),
        F.explode(
            F.array(
                F.struct(F.lit(1).alias("sort_order"), F.lit("Brand").alias("name"), F.col("brand").alias("value")),
                F.struct(F.lit(2).alias("sort_order"), F.lit("Type").alias("name"), F.col("category").alias("value")),
                F.struct(F.lit(3).alias("sort_order"), F.lit("Size").alias("name"), F.col("p_size").cast("string").alias("value")),
            )
        ).alias("c"),
    )
    return long.select("article", "c.sort_order", "c.name", "c.value").filter(F.col("value").isNotNull())


def partners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer rows with blanks, shaped like the partner export (key + 7 attributes)."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")

    def blank_if(cond, col):
        return F.when(cond, F.lit(None)).otherwise(col)

    return c.select(
        blank_if(k % 97 == 0, k).alias("partner_id"),
        blank_if(k % 3 == 0, F.col("c_name")).alias("name"),
        blank_if(k % 4 == 0, F.col("c_nationkey")).alias("nation"),
        blank_if(k % 5 == 0, F.col("c_acctbal")).alias("balance"),
        blank_if(k % 6 == 0, F.col("c_mktsegment")).alias("segment"),
        blank_if(k % 4 == 0, F.concat(F.lit("mgr-"), (k % 10).cast("string"))).alias("manager"),
        blank_if(k % 6 == 0, F.concat(F.lit("region-"), (k % 5).cast("string"))).alias("region"),
        blank_if(k % 3 == 0, F.concat(F.lit("tier-"), (k % 4).cast("string"))).alias("tier"),
        blank_if(k % 8 == 0, (k % 2).cast("int")).alias("blocked"),
    )


def props(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .operators.props import parse_properties

    return parse_properties(prop_text(spark, sf_dir), "id", "product_properties")


def legacy_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Property rows as the old parser left them: a leading ``| `` on the keys of
    every third product (except Brand), for every sixth product an older
    clean ``Type`` row that collides with the repaired key, and for every tenth
    one a key with a pipe inside, which is no fault."""
    p = props(spark, sf_dir)
    pid, key = F.col("product_id"), F.col("prop_key")
    piped = p.select(
        "product_id",
        F.when((pid % 3 == 0) & (key != "Brand"), F.concat(F.lit("| "), key)).otherwise(key).alias("prop_key"),
        "prop_value",
        ts(TARGET_LOADED_AT).alias("updated_at"),
    )
    older = p.filter((pid % 6 == 0) & (key == "Type")).select(
        "product_id", "prop_key", F.concat(F.col("prop_value"), F.lit(" old")).alias("prop_value"),
        ts(TARGET_LOADED_AT).alias("updated_at"),
    )
    inner = p.filter((pid % 10 == 0) & (key == "Type")).select(
        "product_id", F.lit("Width|Height").alias("prop_key"), F.lit("1|2").alias("prop_value"), ts(TARGET_LOADED_AT).alias("updated_at"),
    )
    return piped.unionByName(older).unionByName(inner)


def old_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yesterday's property table: Size differs for every 4th product and every
    5th product has a Color key the text no longer has."""
    p = props(spark, sf_dir)
    pid, key = F.col("product_id"), F.col("prop_key")
    base = p.select(
        "product_id", "prop_key",
        F.when((pid % 4 == 0) & (key == "Size"), F.concat(F.col("prop_value"), F.lit("0"))).otherwise(F.col("prop_value")).alias("prop_value"),
        ts(TARGET_LOADED_AT).alias("updated_at"),
    )
    color = p.filter((pid % 5 == 0) & (key == "Type")).select(
        "product_id", F.lit("Color").alias("prop_key"), F.lit("red").alias("prop_value"), ts(TARGET_LOADED_AT).alias("updated_at")
    )
    return base.unionByName(color)


def prop_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs to upsert: today's pairs of even products plus a new Weight key for every 8th."""
    p = props(spark, sf_dir)
    pid = F.col("product_id")
    even = p.filter(pid % 2 == 0)
    weight = p.filter((pid % 8 == 0) & (F.col("prop_key") == "Type")).select(
        "product_id", F.lit("Weight").alias("prop_key"), F.lit("1 kg").alias("prop_value")
    )
    return even.unionByName(weight)


def tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reconciliation tasks shaped from orders: month cycle = year-month of the
    order date; status F -> completed, O -> in_progress, else pending; priority
    from the order priority word (some fall outside the allowed list)."""
    o = table(spark, sf_dir, "orders")
    st = F.col("o_orderstatus")
    return o.select(
        F.col("o_orderkey").alias("task_id"),
        F.col("o_custkey").alias("supplier_id"),
        F.date_format("o_orderdate", "yyyy-MM").alias("month_cycle"),
        F.when(st == "F", "completed").when(st == "O", "in_progress").otherwise("pending").alias("status"),
        F.lower(F.substring_index("o_orderpriority", "-", -1)).alias("priority"),
        F.col("o_orderdate").alias("deadline"),
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier messages shaped from conversations: user -> inbound, others -> outbound."""
    c = table(spark, sf_dir, "conversations")
    return c.select(
        F.concat(F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string")).alias("message_id"),
        F.col("conv_id").cast("string").alias("thread_id"),
        F.when(F.col("role") == "user", "inbound").otherwise("outbound").alias("direction"),
        F.when(F.col("role") == "user", "email_received").when(F.col("role") == "assistant", "email_sent")
        .otherwise(F.col("role")).alias("message_type"),
        F.col("text").alias("body"),
        F.col("text").alias("subject"),
    )


# ---------------------------------------------------------------------------
# The same views as SQL (DuckDB dialect) for the oracle queries.
# ---------------------------------------------------------------------------

FIXTURE_SQL = {
    "catalog": """
catalog AS (
  SELECT p_partkey AS id, concat(p_name, ' ', CAST(p_partkey AS VARCHAR)) AS description,
         CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_brand END AS brand, p_type AS category,
         (p_size % 7 = 0) AS withdrawn_from_range, concat('IT-', CAST(p_partkey AS VARCHAR)) AS item_number,
         p_brand, p_type, p_size
  FROM part)""",
    "cat_target": f"""
cat_target AS (
  SELECT id, CASE WHEN id % 5 = 0 THEN concat(description, ' old') ELSE description END AS description,
         CASE WHEN id % 26 = 0 THEN 'Brand#0' ELSE brand END AS brand, category, withdrawn_from_range,
         item_number, (id % 2 = 0) AS is_vector, TIMESTAMP '{TARGET_LOADED_AT}' AS updated_at
  FROM catalog WHERE id % 11 <> 0)""",
    "cat_source": """
cat_source AS (
  SELECT id, description, brand, category, withdrawn_from_range, item_number FROM catalog WHERE id % 7 <> 0)""",
    "cat_source_guard": """
cat_source_guard AS (
  SELECT id, description, brand, category, withdrawn_from_range, item_number FROM catalog WHERE id % 20 = 0)""",
    "prop_text": """
prop_text AS (
  SELECT id, concat(CASE WHEN id % 3 = 0 THEN '| ' ELSE '' END,
         'Brand: ', p_brand, ' | Type: ', p_type, ' | Size: ', CAST(p_size AS VARCHAR),
         CASE WHEN id % 17 = 0 THEN concat(' | Size: ', CAST(p_size + 1 AS VARCHAR)) ELSE '' END,
         CASE WHEN id % 19 = 0 THEN ' | junk' ELSE '' END,
         CASE WHEN id % 23 = 0 THEN ' | Note: a: b' ELSE '' END) AS product_properties
  FROM catalog)""",
    "vectors": """
vectors AS (
  SELECT c.id, c.description, c.brand, c.category, (c.id % 10 <> 0) AS is_vector, e.embedding AS vector
  FROM catalog c JOIN embeddings e ON c.id = e.vec_id)""",
    "characteristics": """
characteristics AS (
  SELECT * FROM (
    SELECT item_number AS article, 1 AS sort_order, 'Brand' AS name, brand AS value FROM catalog WHERE id % 9 <> 0
    UNION ALL
    SELECT item_number, 2, 'Type', category FROM catalog WHERE id % 9 <> 0
    UNION ALL
    SELECT item_number, 3, 'Size', CAST(p_size AS VARCHAR) FROM catalog WHERE id % 9 <> 0
  ) WHERE value IS NOT NULL)""",
    "partners": """
partners AS (
  SELECT CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE c_custkey END AS partner_id,
         CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_name END AS name,
         CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_nationkey END AS nation,
         CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_acctbal END AS balance,
         CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE c_mktsegment END AS segment,
         CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE concat('mgr-', CAST(c_custkey % 10 AS VARCHAR)) END AS manager,
         CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE concat('region-', CAST(c_custkey % 5 AS VARCHAR)) END AS region,
         CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE concat('tier-', CAST(c_custkey % 4 AS VARCHAR)) END AS tier,
         CASE WHEN c_custkey % 8 = 0 THEN NULL ELSE CAST(c_custkey % 2 AS INTEGER) END AS blocked
  FROM customer)""",
}

FIXTURE_SQL.update({
    "props": """
props AS (
  SELECT product_id, prop_key, prop_value FROM (
    SELECT id AS product_id, pos, trim(substr(seg, 1, strpos(seg, ':') - 1)) AS prop_key,
           trim(substr(seg, strpos(seg, ':') + 1)) AS prop_value
    FROM (SELECT id, unnest(string_split(product_properties, '|')) AS seg,
                 unnest(range(1, len(string_split(product_properties, '|')) + 1)) AS pos FROM prop_text)
    WHERE strpos(seg, ':') > 0)
  WHERE prop_key <> '' AND prop_value <> ''
  QUALIFY row_number() OVER (PARTITION BY product_id, prop_key ORDER BY pos DESC) = 1)""",
    "legacy_props": f"""
legacy_props AS (
  SELECT product_id, CASE WHEN product_id % 3 = 0 AND prop_key <> 'Brand' THEN concat('| ', prop_key) ELSE prop_key END AS prop_key,
         prop_value, TIMESTAMP '{TARGET_LOADED_AT}' AS updated_at FROM props
  UNION ALL
  SELECT product_id, prop_key, concat(prop_value, ' old'), TIMESTAMP '{TARGET_LOADED_AT}' FROM props
  WHERE product_id % 6 = 0 AND prop_key = 'Type'
  UNION ALL
  SELECT product_id, 'Width|Height', '1|2', TIMESTAMP '{TARGET_LOADED_AT}' FROM props WHERE product_id % 10 = 0 AND prop_key = 'Type')""",
    "old_props": f"""
old_props AS (
  SELECT product_id, prop_key,
         CASE WHEN product_id % 4 = 0 AND prop_key = 'Size' THEN concat(prop_value, '0') ELSE prop_value END AS prop_value,
         TIMESTAMP '{TARGET_LOADED_AT}' AS updated_at FROM props
  UNION ALL
  SELECT product_id, 'Color', 'red', TIMESTAMP '{TARGET_LOADED_AT}' FROM props WHERE product_id % 5 = 0 AND prop_key = 'Type')""",
    "prop_updates": """
prop_updates AS (
  SELECT product_id, prop_key, prop_value FROM props WHERE product_id % 2 = 0
  UNION ALL
  SELECT product_id, 'Weight', '1 kg' FROM props WHERE product_id % 8 = 0 AND prop_key = 'Type')""",
})

FIXTURE_SQL.update({
    "tasks": """
tasks AS (
  SELECT o_orderkey AS task_id, o_custkey AS supplier_id, strftime(o_orderdate, '%Y-%m') AS month_cycle,
         CASE WHEN o_orderstatus = 'F' THEN 'completed' WHEN o_orderstatus = 'O' THEN 'in_progress' ELSE 'pending' END AS status,
         lower(split_part(o_orderpriority, '-', -1)) AS priority, o_orderdate AS deadline
  FROM orders)""",
    "messages": """
messages AS (
  SELECT concat(CAST(conv_id AS VARCHAR), '-', CAST(turn AS VARCHAR)) AS message_id, CAST(conv_id AS VARCHAR) AS thread_id,
         CASE WHEN role = 'user' THEN 'inbound' ELSE 'outbound' END AS direction,
         CASE WHEN role = 'user' THEN 'email_received' WHEN role = 'assistant' THEN 'email_sent' ELSE role END AS message_type,
         text AS body, text AS subject
  FROM conversations)""",
})

_DEPENDS = {
    "props": ["catalog", "prop_text"],
    "legacy_props": ["catalog", "prop_text", "props"],
    "old_props": ["catalog", "prop_text", "props"],
    "prop_updates": ["catalog", "prop_text", "props"],
    "cat_target": ["catalog"],
    "cat_source": ["catalog"],
    "cat_source_guard": ["catalog"],
    "prop_text": ["catalog"],
    "vectors": ["catalog"],
    "characteristics": ["catalog"],
}


def with_views(*names: str) -> str:
    """``WITH`` clause holding the named fixture views (and what they need)."""
    order: list[str] = []
    for n in names:
        for dep in _DEPENDS.get(n, []) + [n]:
            if dep not in order:
                order.append(dep)
    return "WITH " + ",".join(FIXTURE_SQL[n] for n in order) + "\n"
