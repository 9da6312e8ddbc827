"""Projection, renaming, typing and schema evolution.

These work on the schema (driver-side metadata) and emit one ``select`` per
call, so Catalyst collapses them into the scan's projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import normalize_names, quote

# The BI column names of the product and partner exports -> table columns,
# and the columns that are forced to boolean by name.
PRODUCT_MAPPING = {
    "CompanyProducts[ID]": "id",
    "CompanyProducts[Description]": "description",
    "CompanyProducts[Brand]": "brand",
    "CompanyProducts[Category]": "category",
    "CompanyProducts[Withdrawn_from_range]": "withdrawn_from_range",
    "CompanyProducts[item_number]": "item_number",
    "[Product_Properties]": "product_properties",
    "УТ_Товарные категории[_description]": "product_category",
    "УТ_РСвДополнительныеСведения2_0[Под заказ]": "on_order",
    "Выводится_без_остатков": "is_vector",
    "CountRowsУТ_РСвДополнительныеСведения2_0": "count_rows",
}
PARTNER_MAPPING = {
    "УТ_Партнеры[Партнер.УТ11]": "partner",
    "УТ_Контактные лица партнеров[Контактное лицо]": "contact",
    "УТ_Контактные лица партнеров[email]": "contact_email",
    "УТ_Пользователи[_description]": "responsible_manager",
    "УТ_Партнеры[id_1c]": "id_1c_partner",
    "УТ_Партнеры[is_client]": "is_client",
    "УТ_Партнеры[is_supplier]": "is_supplier",
    "УТ_Контактные лица партнеров[Роль]": "role",
    "УТ_Контактные лица партнеров[id_1c]": "id_1c_contact",
}
BOOLEAN_COLS = ("is_vector", "on_order", "withdrawn_from_range")


def map_columns(df: DataFrame, mapping: dict[str, str], extracted_at=None, ignore_absent: bool = False) -> DataFrame:
    """Ordered projection source -> target name.

    A source column missing from ``df`` becomes a NULL column (or is left out
    with ``ignore_absent=True``); unmapped columns are dropped; when two sources
    map to one target the later one wins, also with NULL if it is missing. ``extracted_at`` (a timestamp string
    or Column) is added as a literal column.
    """
    present = set(df.columns)
    chosen: dict[str, Column] = {}
    for src, tgt in mapping.items():
        if src in present:
            chosen[tgt] = F.col(quote(src))
        elif not ignore_absent:
            chosen[tgt] = F.lit(None).cast("string")
    cols = [c.alias(t) for t, c in chosen.items()]
    if extracted_at is not None:
        ts = extracted_at if isinstance(extracted_at, Column) else F.lit(str(extracted_at)).cast("timestamp_ntz")
        cols.append(ts.alias("extracted_at"))
    return df.select(*cols)


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename only the columns present, keep the rest in place."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def normalize_columns(df: DataFrame, bracket: bool = False) -> DataFrame:
    """Normalised, de-duplicated column names (positional, so duplicate inputs work)."""
    return df.toDF(*normalize_names(df.columns, bracket))


_TYPE_NAMES = {
    "bool": "boolean", "boolean": "boolean",
    "int": "int", "integer": "int", "int64": "bigint", "bigint": "bigint",
    "numeric": "decimal(38,18)", "decimal": "decimal(38,18)", "double": "double", "float": "double",
    "timestamp": "timestamp_ntz", "datetime": "timestamp_ntz", "date": "date",
    "text": "string", "string": "string", "varchar": "string",
}

# Boolean spellings PostgreSQL accepts that Spark's cast does not.
_BOOL_WORDS = {"on": True, "off": False, "tr": True, "tru": True, "fa": False, "fal": False, "fals": False}


def spark_type(name: str) -> str:
    n = name.strip().lower()
    if n.startswith(("numeric(", "decimal(")):
        return "decimal" + n[n.index("("):]
    if n.startswith("varchar("):
        return "string"
    return _TYPE_NAMES.get(n, "string")


def cast_columns(df: DataFrame, types: dict[str, str], strict: bool = True, force_bool: bool = True) -> DataFrame:
    """Typed cast per column: boolean / int / numeric / timestamp / text.

    Values go through their text form, NaN becomes NULL, and bad text raises
    (ANSI cast) unless ``strict=False`` (then it becomes NULL). Columns named in
    ``BOOLEAN_COLS`` are cast to boolean when ``force_bool``.
    """
    wanted = {c: spark_type(t) for c, t in types.items() if c in df.columns}
    if force_bool:
        for c in BOOLEAN_COLS:
            if c in df.columns:
                wanted.setdefault(c, "boolean")
    dtypes = dict(df.dtypes)
    out = []
    for c in df.columns:
        if c not in wanted:
            out.append(F.col(quote(c)))
            continue
        t = wanted[c]
        src = F.col(quote(c))
        if dtypes[c] in ("double", "float"):
            src = F.when(F.isnan(src), F.lit(None)).otherwise(src)
        if t == dtypes[c]:
            out.append(src.alias(c))
            continue
        if t == "boolean" and dtypes[c] != "boolean":
            txt = F.lower(F.trim(src.cast("string")))
            plain = txt.cast("boolean") if strict else txt.try_cast("boolean")
            expr = F.when(txt.isNull(), F.lit(None).cast("boolean"))
            for word, val in _BOOL_WORDS.items():
                expr = expr.when(txt == word, F.lit(val))
            out.append(expr.otherwise(plain).alias(c))
        else:
            out.append((src.cast(t) if strict else src.try_cast(t)).alias(c))
    return df.select(*out)


def _ci(names) -> dict[str, str]:
    return {n.lower(): n for n in names}


def evolve_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add every column of ``schema`` missing from ``df`` (case-insensitive) as a typed NULL; never drop."""
    have = _ci(df.columns)
    add = {f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name.lower() not in have}
    return df.withColumns(add) if add else df


def conform_schema(df: DataFrame, schema: T.StructType, drop_extra: bool = True, cast: bool = True) -> DataFrame:
    """Apply a schema diff: drop extras (optional), add missing as NULL, order like ``schema``."""
    have = _ci(df.columns)
    cols = []
    for f in schema.fields:
        if f.name.lower() in have:
            c = F.col(quote(have[f.name.lower()]))
            cols.append((c.cast(f.dataType) if cast else c).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    if not drop_extra:
        wanted = {f.name.lower() for f in schema.fields}
        cols += [F.col(quote(c)) for c in df.columns if c.lower() not in wanted]
    return df.select(*cols)


def migrate_types(df: DataFrame, types: dict[str, str], add_missing: bool = True) -> DataFrame:
    """``ALTER COLUMN TYPE ... USING cast``: cast listed columns; missing ones are added as NULL.

    Text to ``numeric(p,s)`` rounds half-up like PostgreSQL.
    """
    out = []
    for c in df.columns:
        out.append(F.col(quote(c)).cast(spark_type(types[c])).alias(c) if c in types else F.col(quote(c)))
    if add_missing:
        out += [F.lit(None).cast(spark_type(t)).alias(c) for c, t in types.items() if c not in df.columns]
    return df.select(*out)


def stamp(df: DataFrame, col: str, now, when: Column | None = None) -> DataFrame:
    """Set ``col`` to ``now`` on all rows, or only where ``when`` holds."""
    ts = now if isinstance(now, Column) else F.lit(str(now)).cast("timestamp_ntz")
    if when is None or col not in df.columns:
        return df.withColumn(col, ts if when is None else F.when(when, ts))
    return df.withColumn(col, F.when(when, ts).otherwise(F.col(col)))


def schema_drift(rows: DataFrame, required: T.StructType | list[tuple[str, str]], special: dict[str, str] | None = None,
                 json_col: str = "value", file_col: str | None = None) -> DataFrame:
    """Per file, which columns to add and which are extra, over JSON rows.

    ``rows`` holds one JSON object per row in ``json_col`` and the file it came
    from in ``file_col`` (default: the full path a reader adds as ``_metadata.file_path``, so
    files of one name in two folders stay apart).
    Output rows ``(file, action, column, type)`` with action ``add`` (a required
    column no row of that file carries; special columns always carry their own
    type) or ``extra`` (a key in the file that is neither required nor special).
    Files whose key set matches exactly produce no row.
    """
    special = special or {}
    if isinstance(required, T.StructType):
        req = [(f.name, f.dataType.simpleString()) for f in required.fields]
    else:
        req = list(required)
    req_all = req + [(k, v) for k, v in special.items() if k not in dict(req)]
    fcol = F.col(file_col) if file_col else F.col("_metadata.file_path")

    # Rows shrink to the distinct key sets of each file before anything is exploded (rows
    # of one file mostly share one), so the required list goes out once per key set. Partial
    # aggregates run before each shuffle, and a file whose rows carry no key still appears.
    found = F.sort_array(F.coalesce(F.json_object_keys(F.col(json_col)), F.array().cast("array<string>")))
    key_sets = rows.select(fcol.alias("file"), found.alias("keys")).distinct()

    def mark(column: Column, typ: Column, data: bool) -> Column:
        return F.struct(column.alias("column"), typ.alias("type"), F.lit(data).alias("data"), F.lit(not data).alias("req"))

    required_marks = F.array(*[mark(F.lit(n), F.lit(t), False) for n, t in req_all])
    data_marks = F.transform("keys", lambda k: mark(k, F.lit(None).cast("string"), True))
    marks = key_sets.select("file", F.explode(F.concat(data_marks, required_marks)).alias("m"))
    per_column = marks.groupBy("file", F.col("m.column").alias("column")).agg(
        F.max("m.data").alias("seen"), F.max("m.req").alias("wanted"), F.max("m.type").alias("type")
    )
    action = F.when(F.col("wanted") & ~F.col("seen"), F.lit("add")).when(F.col("seen") & ~F.col("wanted"), F.lit("extra"))
    return per_column.select("file", action.alias("action"), "column", F.when(action == "add", F.col("type")).alias("type")).filter(
        F.col("action").isNotNull()
    )
