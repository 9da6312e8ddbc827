"""The product export as one plan: products + their concatenated characteristics,
blank groups dropped, top N by id with ties (the BI query the sync consumes)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.aggregate import concat_ordered
from ..operators.filters import lookup_item
from ..operators.topn import ties_cut

EXPORT_COLS = ("id", "description", "brand", "category", "withdrawn_from_range", "item_number")


def product_export(products: DataFrame, characteristics: DataFrame, article_col: str = "item_number",
                   top: int | None = None, props_limit: int | None = None, drop_blank: bool = True) -> DataFrame:
    """``products`` left-joined to ``Product_Properties`` text built per article.

    The per-product lookup is decorrelated: characteristics are grouped by
    article once and joined (no per-product query). With ``drop_blank`` a product
    without characteristics drops out, as a group whose measures are all blank
    does. ``top`` (a TOPN the caller asks for; a sync passes none) keeps the N
    highest ids, ties included; ``props_limit`` the top characteristics of a product.

    Plan order with ``top``: a product's text is blank exactly when its article has no
    characteristic row (``props_limit >= 1`` keeps at least one row of every
    group). So the top-N cut is found on products semi-joined to the distinct
    articles, before any text is built, and becomes a literal id filter pushed
    into the product scan; only the exported articles' characteristics are
    concatenated (the semi-join side is at most N products plus ties), and an
    inner join with the text drops the blank products. The aggregate never
    runs over the whole characteristics table.
    """
    if props_limit is not None and props_limit < 1:
        raise ValueError("props_limit must be >= 1 (or None for no cap)")
    prods = products.select(*EXPORT_COLS)
    if top is not None:
        ranked = prods
        if drop_blank:
            has_text = characteristics.select(F.col("article").alias(article_col)).distinct()
            ranked = prods.join(has_text, article_col, "left_semi")
        prods = prods.filter(ties_cut(ranked, top, ["id"], desc=True))
        characteristics = characteristics.join(prods.select(F.col(article_col).alias("article")), "article", "left_semi")
    text = concat_ordered(characteristics, key="article", name="name", value="value", order="sort_order",
                          limit=props_limit, top_desc=True, out_col="product_properties")
    text = text.withColumnRenamed("article", article_col)
    out = prods.join(text, article_col, "inner" if drop_blank else "left")
    return out.select(*EXPORT_COLS, "product_properties")


def export_lookup(products: DataFrame, characteristics: DataFrame, item_number: str, article_col: str = "item_number") -> DataFrame:
    """The item lookup over the grouped export: a product's keys with its property text.

    Both sides are cut to the one item before the text is built, so the
    equality reaches both scans. A product without text is a blank group and drops out.
    """
    one = lookup_item(products.select(*EXPORT_COLS), article_col, item_number)
    return product_export(one, lookup_item(characteristics, "article", item_number), article_col).drop("withdrawn_from_range")


def as_bi_rows(export: DataFrame, table: str = "CompanyProducts") -> DataFrame:
    """Rename export columns to BI result names (``Table[Column]``, ``[Measure]``)."""
    names = {
        "id": f"{table}[ID]", "description": f"{table}[Description]", "brand": f"{table}[Brand]",
        "category": f"{table}[Category]", "withdrawn_from_range": f"{table}[Withdrawn_from_range]",
        "item_number": f"{table}[item_number]", "product_properties": "[Product_Properties]",
        # Columns that come from related tables
        "product_category": "УТ_Товарные категории[_description]", "on_order": "УТ_РСвДополнительныеСведения2_0[Под заказ]",
    }
    return export.select(*[F.col(c).alias(names.get(c, c)) for c in export.columns])
