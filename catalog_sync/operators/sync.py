"""Snapshot sync: upsert with change detection, orphan cleanup, validation, diff.

All operators are lazy DataFrame plans built from joins and aggregates. The
only driver-side values are one-row statistics that decide a branch (the
orphan guard), never data rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The change columns the live flow ends up using (business columns of the export).
DEFAULT_CHANGE_COLS = ("description", "brand", "category", "withdrawn_from_range")

# How keys are compared: as they are, or as UUIDs are (text, whatever its case, blanks around it ignored).
KEY_EXACT, KEY_UUID = "exact", "uuid"

ACTION_INSERT = "insert"
ACTION_UPDATE = "update"  # matched, business columns changed
ACTION_SAME = "unchanged"  # matched, nothing relevant changed
ACTION_KEEP = "untouched"  # target row without a source row


def _now(now) -> Column:
    if now is None:
        return F.current_timestamp().cast("timestamp_ntz")
    if isinstance(now, Column):
        return now
    return F.lit(str(now)).cast("timestamp_ntz")


def _any(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, cols) if cols else F.lit(False)


def _all(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, cols) if cols else F.lit(True)


def dedupe_source(source: DataFrame, keys: list[str], on_duplicate: str = "error", order_col: str | None = None) -> DataFrame:
    """One row per key. ``error`` fails the job on a repeated key (inside the
    plan, no extra action); ``last`` keeps the row with the highest ``order_col``.

    Both are windows over the key whose exchange and sort are the ones the
    following sort-merge join on the same key needs, so with unique keys (the
    normal case) the check costs no shuffle, no sort and no extra scan. A
    separate key-only aggregate would shuffle every key a second time. Both
    cut a hot key before the shuffle (window group limit): ``last`` to one
    row per map task, ``error`` to the two that show the duplicate.
    """
    if on_duplicate == "error":
        n = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
        checked = source.withColumn("__n", n).filter(F.col("__n") <= 2)
        check = F.assert_true(F.col("__n") == 1, F.lit("duplicate source key in upsert"))
        return checked.filter(check.isNull()).drop("__n")
    if on_duplicate == "last":
        if not order_col:
            raise ValueError("on_duplicate='last' needs order_col")
        # a content hash breaks ties so a retried task picks the same row
        others = [F.col(c) for c in source.columns if c not in keys]
        w = Window.partitionBy(*keys).orderBy(F.col(order_col).desc_nulls_last(), F.xxhash64(*others).desc())
        return source.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")
    if on_duplicate == "assume_unique":
        return source
    raise ValueError(f"unknown on_duplicate={on_duplicate!r}")


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str] | str = "id",
    change_cols: list[str] | None = None,
    now=None,
    flag_col: str = "is_vector",
    stamp_col: str = "updated_at",
    on_duplicate: str = "error",
    order_col: str | None = None,
    reject_null_keys: bool = True,
    with_action: bool = False,
    partitions: int | None = None,
    key_rule: str = KEY_EXACT,
) -> DataFrame:
    """MERGE ``source`` into ``target`` on ``keys`` as one full-outer join.

    * matched: every non-key source column overwrites (NULLs included);
      target-only columns keep their value;
    * matched and any change column IS DISTINCT FROM -> ``flag_col`` = FALSE,
      ``stamp_col`` = now; otherwise both kept;
    * not matched in target -> inserted with ``flag_col`` = FALSE, ``stamp_col`` = now;
    * target rows without a source row are kept unchanged;
    * incoming ``flag_col`` is ignored.

    ``change_cols=None`` uses the business columns in ``DEFAULT_CHANGE_COLS``
    that exist in the source; pass ``[]`` for "no change detection".

    ``partitions``: hash-partition the source on the keys into this many
    partitions before the duplicate check. Pass the bucket count of a target
    stored with :func:`~catalog_sync.sources.files.write_bucketed_version`:
    the target is then joined without a shuffle and the source is shuffled
    once for both the duplicate check and the join.

    ``key_rule="uuid"`` compares keys as lower-case trimmed text (see
    :func:`key_expr`); the table keeps the target's spelling, and an inserted row its source's.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    t_names, s_names = set(target.columns), set(source.columns)
    for k in keys:
        if k not in t_names or k not in s_names:
            raise ValueError(f"key column {k!r} must exist in target and source")
    spelled = list(keys)  # the key columns as the table shows them; ``keys`` are what is compared
    if key_rule != KEY_EXACT:
        keys = [f"__k_{k}" for k in spelled]
        target = target.withColumns({c: key_expr(k, key_rule) for c, k in zip(keys, spelled, strict=True)})
        source = source.withColumns({c: key_expr(k, key_rule) for c, k in zip(keys, spelled, strict=True)})
    src = source.drop(flag_col) if flag_col and flag_col in s_names else source
    if on_duplicate != "last" and order_col and order_col in src.columns:
        src = src.drop(order_col)
    if reject_null_keys:
        src = src.filter(F.assert_true(_all([F.col(k).isNotNull() for k in keys]), F.lit("NULL key in upsert source")).isNull())
    else:
        src = src.filter(_all([F.col(k).isNotNull() for k in keys]))
    if partitions:
        src = src.repartition(partitions, *keys)
    src = dedupe_source(src, keys, on_duplicate, order_col)
    if order_col and order_col in src.columns and order_col not in target.columns:
        src = src.drop(order_col)

    # schemas fetched once: every .dtypes / .columns is a round trip to the JVM
    t_types = dict(target.dtypes)
    t_cols = list(t_types)
    s_types = dict(src.dtypes)
    s_cols = [c for c in s_types if c not in keys]
    # Typed like the target column when both have it (the reference casts to the column type).
    t_side = target.select(*[F.col(c).alias(c) for c in keys], *[F.col(c).alias(f"__t_{c}") for c in t_cols if c not in keys], F.lit(True).alias("__in_t"))
    s_side = src.select(
        *[(F.col(k).cast(t_types[k]) if s_types[k] != t_types[k] else F.col(k)).alias(k) for k in keys],
        *[(F.col(c).cast(t_types[c]) if c in t_types and s_types[c] != t_types[c] else F.col(c)).alias(f"__s_{c}") for c in s_cols],
        F.lit(True).alias("__in_s"),
    )
    j = t_side.join(s_side, keys, "full_outer")
    in_t = F.col("__in_t").isNotNull()
    in_s = F.col("__in_s").isNotNull()
    if change_cols is None:
        change_cols = DEFAULT_CHANGE_COLS
    change_cols = [c for c in change_cols if c in s_cols and c not in spelled and c != flag_col]
    flag_col = flag_col or None
    stamp_col = stamp_col or None
    diffs = [
        ~F.col(f"__t_{c}").eqNullSafe(F.col(f"__s_{c}")) if c in t_types else F.col(f"__s_{c}").isNotNull()
        for c in change_cols
    ]
    changed = in_t & in_s & _any(diffs)
    j = j.withColumn("__changed", changed)
    now_c = _now(now)

    as_shown = keys != spelled
    out: list[Column] = [F.coalesce(f"__t_{k}", F.col(f"__s_{k}").cast(t_types[k])).alias(k) if as_shown else F.col(k) for k in spelled]
    for c in t_cols:
        if c in keys or c in spelled:
            continue
        if flag_col and c == flag_col:
            out.append(F.when(~in_t | F.col("__changed"), F.lit(False)).otherwise(F.col(f"__t_{c}")).alias(c))
        elif stamp_col and c == stamp_col and c not in s_cols:
            out.append(F.when(~in_t | F.col("__changed"), now_c).otherwise(F.col(f"__t_{c}")).alias(c))
        elif c in s_cols:
            out.append(F.when(in_s, F.col(f"__s_{c}")).otherwise(F.col(f"__t_{c}")).alias(c))
        else:
            out.append(F.col(f"__t_{c}").alias(c))
    for c in s_cols:
        if c not in t_types and c not in spelled:
            out.append(F.col(f"__s_{c}").alias(c))
    if flag_col and flag_col not in t_types:
        out.append(F.when(~in_t | F.col("__changed"), F.lit(False)).alias(flag_col))
    if stamp_col and stamp_col not in t_types and stamp_col not in s_cols:
        out.append(F.when(~in_t | F.col("__changed"), now_c).cast("timestamp_ntz").alias(stamp_col))
    if with_action:
        action = (
            F.when(~in_t, F.lit(ACTION_INSERT))
            .when(~in_s, F.lit(ACTION_KEEP))
            .when(F.col("__changed"), F.lit(ACTION_UPDATE))
            .otherwise(F.lit(ACTION_SAME))
        )
        out.append(action.alias("_action"))
    return j.select(*out)


STAT_NAMES = ["source_rows", "inserted", "matched", "changed", "unchanged", "untouched", "updated_rows", "total_rows"]


def stat_columns() -> list[Column]:
    """The aggregates of :func:`merge_stats`; they may also be observed on the plan that writes the table."""
    a = F.col("_action")
    return [
        F.count_if(a != ACTION_KEEP).alias("source_rows"),
        F.count_if(a == ACTION_INSERT).alias("inserted"),
        F.count_if(a.isin(ACTION_UPDATE, ACTION_SAME)).alias("matched"),
        F.count_if(a == ACTION_UPDATE).alias("changed"),
        F.count_if(a == ACTION_SAME).alias("unchanged"),
        F.count_if(a == ACTION_KEEP).alias("untouched"),
        F.count_if(a != ACTION_KEEP).alias("updated_rows"),
        F.count(F.lit(1)).alias("total_rows"),
    ]


def merge_stats(merged_with_action: DataFrame) -> DataFrame:
    """One-row statistics over ``upsert(..., with_action=True)``.

    ``updated_rows`` follows the reference's row count: every matched or inserted row.
    """
    return merged_with_action.agg(*stat_columns())


def orphan_row(keys: list[str]) -> Column:
    """Whether a row of ``upsert(..., with_action=True)`` vanished from the source (a NULL key matches nothing and never vanishes)."""
    return (F.col("_action") == ACTION_KEEP) & _all([F.col(k).isNotNull() for k in keys])


def key_expr(key: str, rule: str) -> Column:
    """The key as it is compared: ``exact`` as it is, ``uuid`` as lower-case trimmed text."""
    if rule not in (KEY_EXACT, KEY_UUID):
        raise ValueError(f"unknown key rule {rule!r}")
    return F.lower(F.trim(F.col(key).cast("string"))) if rule == KEY_UUID else F.col(key)


_UUID_FORM = r"^\s*[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}\s*$"


def detect_key_rule(target: DataFrame, source: DataFrame, key: str) -> str:
    """``uuid`` if the keys are text and all of both sides look like UUIDs, else ``exact``.

    One scan of the key column of each side, without a shuffle; keys of other types are never scanned.
    """
    if "string" not in (dict(target.dtypes)[key], dict(source.dtypes)[key]):
        return KEY_EXACT
    both = target.select(F.col(key).cast("string").alias("k")).union(source.select(F.col(key).cast("string").alias("k")))
    return KEY_UUID if both.agg(F.bool_and(F.col("k").rlike(_UUID_FORM))).first()[0] else KEY_EXACT


def _rule(target: DataFrame, source: DataFrame, key: str, rule: str | None) -> str:
    """The rule asked for; without one keys of different types are compared as text."""
    if key not in target.columns:
        raise ValueError(f"key column {key!r} not in target")
    if key not in source.columns:
        raise ValueError(f"key column {key!r} not in the snapshot")
    return rule or (KEY_EXACT if dict(target.dtypes)[key] == dict(source.dtypes)[key] else KEY_UUID)


def _keys_pair(target: DataFrame, source: DataFrame, key: str, rule: str):
    tk = target.select(key_expr(key, rule).alias("__k"))
    sk = source.select(key_expr(key, rule).alias("__k")).filter(F.col("__k").isNotNull())
    return tk, sk


def find_orphans(target: DataFrame, source: DataFrame, key: str = "id", key_rule: str | None = None) -> DataFrame:
    """Target rows whose key is absent from the new snapshot (NULL keys on either side
    are never orphans, as ``DELETE ... WHERE key IN (...)`` never hits them).

    ``key_rule`` as in :func:`key_expr`; without one, keys of the same type are compared as they are.
    """
    rule = _rule(target, source, key, key_rule)
    _, sk = _keys_pair(target, source, key, rule)
    tk = target.withColumn("__k", key_expr(key, rule)).filter(F.col("__k").isNotNull())
    return tk.join(sk.distinct(), "__k", "left_anti").drop("__k")


@dataclass
class CleanupResult:
    table: DataFrame
    stats: DataFrame
    status: str
    deleted: int


def cleanup_stats(target: DataFrame, source: DataFrame, key: str = "id", key_rule: str | None = None) -> DataFrame:
    """existing / new / common / orphan key counts in one pass (distinct keys, one full-outer join),
    and ``unkeyed``, the target rows without a key."""
    tk, sk = _keys_pair(target, source, key, _rule(target, source, key, key_rule))
    t = tk.groupBy("__k").agg(F.count(F.lit(1)).alias("__t"))
    s = sk.distinct().withColumn("__s", F.lit(True))
    j = t.join(s, "__k", "full_outer")
    in_t, in_s = F.col("__t").isNotNull() & F.col("__k").isNotNull(), F.col("__s").isNotNull()
    return j.agg(
        F.count_if(in_t).alias("total_existing"),
        F.count_if(in_s).alias("total_new"),
        F.count_if(in_t & in_s).alias("common"),
        F.count_if(in_t & ~in_s).alias("orphans"),
        F.coalesce(F.sum(F.when(F.col("__k").isNull(), F.col("__t"))), F.lit(0)).alias("unkeyed"),
    )


def cleanup_orphans(
    target: DataFrame,
    source: DataFrame | None,
    key: str = "id",
    min_overlap: float = 0.1,
    max_orphan_share: float = 0.9,
    key_rule: str | None = None,
) -> CleanupResult:
    """Delete target rows missing from the snapshot unless the guard trips.

    Guard: orphans > ``max_orphan_share``·existing AND common < ``min_overlap``·existing
    -> status ``error``, nothing deleted. A snapshot without the key column
    (an empty export) -> ``failed``, nothing deleted. One small aggregate is
    collected to decide; the returned table is a lazy ``left_semi`` plan.
    """
    spark = target.sparkSession
    if source is None or key not in source.columns:
        if source is not None and len(source.columns) > 0:
            raise ValueError(f"key column {key!r} not in the snapshot")
        stats = spark.createDataFrame(
            [(None, None, 0, "failed", "empty snapshot")],
            "total_existing long, total_new long, deleted_records long, status string, message string",
        )
        return CleanupResult(target, stats, "failed", 0)
    rule = _rule(target, source, key, key_rule)
    row = cleanup_stats(target, source, key, rule).first()
    existing, new, common, orphans = row["total_existing"], row["total_new"], row["common"], row["orphans"]
    guard = existing > 0 and orphans > max_orphan_share * existing and common < min_overlap * existing
    if guard:
        status, deleted, table = "error", 0, target
        msg = guard_text(common, existing)
    elif orphans == 0:
        status, deleted, table = "success", 0, target
        msg = "nothing to delete"
    else:
        _, sk = _keys_pair(target, source, key, rule)
        keyed = target.withColumn("__k", key_expr(key, rule))
        hits = sk.distinct().withColumn("__hit", F.lit(True))
        # keep matched rows and NULL-key rows (never orphans); AQE can split a hot left side
        table = keyed.join(hits, "__k", "left").filter(F.col("__hit").isNotNull() | F.col("__k").isNull()).drop("__k", "__hit")
        status, deleted = "success", orphans
        msg = f"{orphans} keys gone from the snapshot"
    stats = spark.createDataFrame(
        [(existing, new, common, orphans, deleted, existing - deleted, status, msg)],
        "total_existing long, total_new long, common long, orphans long, deleted_records long, final_count long, status string, message string",
    )
    return CleanupResult(table, stats, status, deleted)


def guard_text(common: int, existing: int) -> str:
    return f"guard: snapshot shares {common} of {existing} keys"


def cleanup_after_upsert(merged_with_action: DataFrame, min_overlap: float = 0.1, max_orphan_share: float = 0.9,
                         keys: list[str] | str = "id", counts=None) -> CleanupResult:
    """Orphan cleanup fused with the preceding upsert: a filter of the same plan, no second join.

    After ``upsert(target, source, with_action=True)`` every key is in the
    table, so existing = all keyed rows, new = common = source rows and
    orphans = untouched keyed rows (a NULL-key target row matches nothing and
    is never deleted, as in the standalone cleanup). The guard is decided from
    one aggregate. ``counts``, a row of :func:`cleanup_stats` (a scan of the two key
    columns), spares the aggregate over the whole merged plan: the deleted
    rows are then decided before the table is written, once.
    """
    spark = merged_with_action.sparkSession
    keys = [keys] if isinstance(keys, str) else list(keys)
    has_key = _all([F.col(k).isNotNull() for k in keys])
    a = F.col("_action")
    orphan = orphan_row(keys)
    if counts is None:
        row = merged_with_action.agg(
            F.count_if(has_key).alias("existing"), F.count_if(a != ACTION_KEEP).alias("common"), F.count_if(orphan).alias("orphans"),
            F.count_if(~has_key).alias("unkeyed"),
        ).first()
        existing, common, orphans, unkeyed = row["existing"], row["common"], row["orphans"], row["unkeyed"]
    else:
        common, orphans, unkeyed = counts["total_new"], counts["orphans"], counts["unkeyed"]
        existing = common + orphans
    table = merged_with_action.drop("_action")
    if existing > 0 and orphans > max_orphan_share * existing and common < min_overlap * existing:
        status, deleted, msg = "error", 0, guard_text(common, existing)
    elif orphans == 0:
        status, deleted, msg = "success", 0, "nothing to delete"
    else:
        table = merged_with_action.filter(~orphan).drop("_action")
        status, deleted, msg = "success", orphans, f"{orphans} keys gone from the snapshot"
    stats = spark.createDataFrame(
        [(existing, common, common, orphans, deleted, existing + unkeyed - deleted, status, msg)],
        "total_existing long, total_new long, common long, orphans long, deleted_records long, final_count long, status string, message string",
    )
    return CleanupResult(table, stats, status, deleted)


def validate_load(profile: DataFrame, rules: str = "A") -> DataFrame:
    """Status over a one-row profile.

    Rule set A (profile of :func:`profile_completeness`): total=0 -> error;
    no description -> warning; no brand is only a note (status stays success).
    Rule set B (profile of :func:`profile_uniqueness`): total>0 and distinct
    ids = total -> success else warning; an empty profile -> error.
    """
    if rules == "A":
        def none_has(col: str) -> Column:  # a column that the profile lacks says nothing
            return F.col(col) == 0 if col in profile.columns else F.lit(False)

        status = (
            F.when(F.col("total_products") == 0, F.lit("error"))
            .when(none_has("products_with_description"), F.lit("warning"))
            .otherwise(F.lit("success"))
        )
        note = F.when((F.col("total_products") > 0) & none_has("products_with_brand"), F.lit("no brands")).otherwise(F.lit(None).cast("string"))
        return profile.select("*", status.alias("status"), note.alias("note"))
    if rules == "B":
        status = F.when(
            (F.col("total_count") > 0) & (F.col("unique_ids") == F.col("total_count")), F.lit("success")
        ).otherwise(F.lit("warning"))
        return profile.select("*", status.alias("status"))
    raise ValueError(f"unknown rule set {rules!r}")


def null_key_salt(df: DataFrame, keys: list[str], buckets: int = 1 << 16) -> Column:
    """Extra join key that spreads NULL-key rows: 0 when every key is set, else a
    hash of the row. NULL keys never match, so results are unchanged, but the
    rows no longer all hash to one reducer (AQE cannot split a skewed
    partition of a full outer join)."""
    any_null = _any([F.col(k).isNull() for k in keys])
    return F.when(any_null, F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(buckets))).otherwise(F.lit(0))


def diff_snapshots(old: DataFrame, new: DataFrame, keys: list[str] | str = "id", compare_cols: list[str] | None = None) -> DataFrame:
    """Classify every key as new / deleted / changed / unchanged between two exports.

    A 64-bit xxhash fingerprint of the compared columns is returned for change
    tracking, but the decision uses the exact null-safe column comparison.
    Rows with a NULL key never match (new / deleted) and are spread over the
    reducers by :func:`null_key_salt`.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if compare_cols is None:
        compare_cols = [c for c in new.columns if c not in keys and c in old.columns]
    o = old.select(*keys, *[F.col(c).alias(f"__o_{c}") for c in compare_cols], F.lit(True).alias("__in_o"),
                   null_key_salt(old, keys).alias("__salt"))
    n = new.select(*keys, *[F.col(c).alias(f"__n_{c}") for c in compare_cols], F.lit(True).alias("__in_n"),
                   null_key_salt(new, keys).alias("__salt"))
    j = o.join(n, [*keys, "__salt"], "full_outer")
    same = _all([F.col(f"__o_{c}").eqNullSafe(F.col(f"__n_{c}")) for c in compare_cols])
    status = (
        F.when(F.col("__in_o").isNull(), F.lit("new"))
        .when(F.col("__in_n").isNull(), F.lit("deleted"))
        .when(same, F.lit("unchanged"))
        .otherwise(F.lit("changed"))
    )
    changed_cols = F.filter(
        F.array(*[F.when(~F.col(f"__o_{c}").eqNullSafe(F.col(f"__n_{c}")), F.lit(c)) for c in compare_cols]),
        lambda x: x.isNotNull(),
    )
    fp_old = F.xxhash64(*[F.col(f"__o_{c}") for c in compare_cols])
    fp_new = F.xxhash64(*[F.col(f"__n_{c}") for c in compare_cols])
    return j.select(
        *keys,
        status.alias("status"),
        F.when(status == "changed", F.array_join(changed_cols, ",")).alias("changed_columns"),
        F.when(F.col("__in_o").isNotNull(), fp_old).alias("old_fingerprint"),
        F.when(F.col("__in_n").isNotNull(), fp_new).alias("new_fingerprint"),
    )
