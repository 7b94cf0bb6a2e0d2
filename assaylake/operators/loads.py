"""Layer loads: staging, dimension build and upsert, history, denormalised fact, keys."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assaylake.functions.columns import EPOCH_MARK, OPEN_END, ntz, qualified, row_hash


# --- incremental reads -----------------------------------------------------------------


def high_water_mark(target: DataFrame, column: str) -> DataFrame:
    """One row `hwm`: the newest loaded time, or 1900-01-01 for an empty target."""
    return target.agg(F.coalesce(F.max(column).cast("timestamp_ntz"), ntz(EPOCH_MARK)).alias("hwm"))


def newer_than_mark(source: DataFrame, column: str, target: DataFrame, target_column: str) -> DataFrame:
    """Source rows strictly newer than the target's mark, in one lazy plan."""
    return source.filter(F.col(column) > high_water_mark(target, target_column).scalar())


def newer_than(source: DataFrame, column: str, mark: str) -> DataFrame:
    """The same for a known mark: a literal comparison that reaches the Parquet scan."""
    return source.filter(F.col(column) > ntz(mark))


def newer_or_equal(source: DataFrame, column: str, mark: str) -> DataFrame:
    return source.filter(F.col(column) >= ntz(mark))


def not_staged(found: DataFrame, staged: DataFrame, identity: list[str]) -> DataFrame:
    """Rows of a second reading that no staged row is equal to in `identity`; NULLs are equal."""
    held = staged.select(*[F.col(c).alias(f"_held_{c}") for c in identity]).distinct()
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_held_{c}")) for c in identity])
    return found.join(held, same, "left_anti")


def within_window(source: DataFrame, column: str, previous_end: str, now: str) -> DataFrame:
    """Rows after the end of the previous batch, up to and including now."""
    return source.filter((F.col(column) > ntz(previous_end)) & (F.col(column) <= ntz(now)))


def insert_if_absent(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """`existing` plus those rows of `new` whose keys it does not hold yet."""
    return existing.unionByName(new.join(existing.select(*keys), keys, "left_anti"))


# --- staging and keys ------------------------------------------------------------------


def stage(
    source: DataFrame,
    loaded_at: str,
    hash_columns: Iterable[str],
    run_id: str,
    as_of: str,
) -> DataFrame:
    """A near copy of the source with audit columns, a row hash and no status yet."""
    return source.withColumnRenamed(loaded_at, "_source_loaded_at").withColumns(
        {
            "load_dt": ntz(as_of),
            "update_dt": F.lit(None).cast("timestamp_ntz"),
            "row_status": F.lit("ACTIVE"),
            "dq_status": F.lit(None).cast("string"),
            "record_hash": row_hash(hash_columns),
            "job_id": F.lit(run_id),
            "_run_id": F.lit(run_id),
        }
    )


def hash_key(columns: Iterable[str]) -> Column:
    """A surrogate key that any run derives again from the business columns."""
    return row_hash(columns)


def load_key(prefix: str) -> Column:
    """A key unique within one load, fixed when the load is written; needs no shuffle."""
    return F.concat(F.lit(f"{prefix}:"), F.monotonically_increasing_id().cast("string"))


def dense_key(df: DataFrame, key: str, name: str, start: int = 0, digits: int = 4) -> DataFrame:
    """Gap-free numbers start+1 .. start+n, in the order of (hash bucket of the key, key).

    Rows are numbered inside hash buckets, and each bucket starts after the rows of the
    buckets before it. The buckets are a fixed number (16 ** digits) of similar size, so
    the running total over them is small whatever the table's size. `key` must identify a
    row: repeated or NULL keys would all fall into one bucket (`load_key` has no such need).
    """
    bucket = F.substring(F.md5(F.col(key).cast("string")), 1, digits)
    keyed = df.withColumn("_bucket", F.coalesce(bucket, F.lit("")))
    sizes = keyed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    within = F.row_number().over(Window.partitionBy("_bucket").orderBy(key))
    return (
        keyed.withColumn("_place", within)
        .join(F.broadcast(starts), "_bucket")  # at most 16 ** digits rows
        .withColumn(name, F.lit(start) + F.col("_start") + F.col("_place"))
        .drop("_bucket", "_place", "_start")
    )


def keep_latest(df: DataFrame, keys: list[str], order: Iterable[str | Column]) -> DataFrame:
    """The newest row per key. Spark limits each group before the shuffle, so a hot key stays small."""
    newest = [c if isinstance(c, Column) else F.col(c).desc() for c in order]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest))
    return df.withColumn("_place", place).filter("_place = 1").drop("_place")


# --- dimension -------------------------------------------------------------------------


def layer_gate(df: DataFrame, status: str = "dq_status") -> DataFrame:
    """Rows whose status lets them into the next layer."""
    return df.filter(qualified(F.col(status)))


def join_reference(rows: DataFrame, key: str, reference: DataFrame, reference_key: str, columns: Mapping[str, str]):
    """Left join to a gated reference: a row without a qualified reference keeps NULLs."""
    right = layer_gate(reference).select(
        F.col(reference_key).alias("_key"), *[F.col(c).alias(name) for c, name in columns.items()]
    )
    return rows.join(right, F.col(key) == F.col("_key"), "left").drop("_key")


def _merged(
    target: DataFrame, source: DataFrame, key: str, updated: Iterable[str], as_of: str, how: str,
    insert_defaults: Mapping[str, Column] | None, reset_unchanged: bool,
) -> tuple[DataFrame, Column, list[Column]]:
    """(target joined to the source, whether a row is new or changed, the target's columns after the load)."""
    updated = list(updated)
    src = source.select(*[F.col(c).alias(f"_s_{c}") for c in source.columns], F.lit(True).alias("_in_source"))
    tgt = target.withColumn("_in_target", F.lit(True))
    both = tgt.join(src, F.col(key) == F.col(f"_s_{key}"), how)
    matched = F.col("_in_target").isNotNull() & F.col("_in_source").isNotNull()
    changed = matched
    if not reset_unchanged:
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_s_{c}")) for c in updated if c != "_run_id"])
        changed = matched & ~same
    inserted = F.col("_in_target").isNull()
    defaults = {
        "load_dt": ntz(as_of),
        "row_status": F.lit("ACTIVE"),
        "dq_status": F.lit(None),
        "update_dt": F.lit(None),
        **(insert_defaults or {}),
    }

    def value(field) -> Column:
        name, kind = field.name, field.dataType
        fresh = F.col(f"_s_{name}") if name in source.columns else defaults.get(name, F.lit(None))
        kept = F.col(name)
        if name in updated:
            kept = F.when(changed, F.col(f"_s_{name}")).otherwise(kept)
        elif name == "dq_status":
            kept = F.when(changed, F.lit(None)).otherwise(kept)
        elif name == "update_dt":
            kept = F.when(changed, ntz(as_of)).otherwise(kept)
        return F.when(inserted, fresh).otherwise(kept).cast(kind).alias(name)

    return both, inserted | changed, [value(f) for f in target.schema.fields]


def upsert(
    target: DataFrame,
    source: DataFrame,
    key: str,
    updated: Iterable[str],
    as_of: str,
    *,
    insert_defaults: Mapping[str, Column] | None = None,
    reset_unchanged: bool = False,
) -> DataFrame:
    """The target after update-or-insert by `key`.

    Matched rows take the `updated` columns and lose their status, by default only if one
    of these columns changed; other columns keep the target's value. Rows only in the
    target stay as they are. The source must hold each key once; a NULL key never
    matches, so such rows are inserted.
    """
    both, _, columns = _merged(target, source, key, updated, as_of, "full_outer", insert_defaults, reset_unchanged)
    return both.select(*columns)


def upserted_rows(
    target: DataFrame, source: DataFrame, key: str, updated: Iterable[str], as_of: str, *,
    insert_defaults: Mapping[str, Column] | None = None, reset_unchanged: bool = False, part: str = "_part",
) -> DataFrame:
    """Only the rows that an `upsert` changes or inserts, as they are after it.

    `part` is a column of the target that says where a row lies; it is kept, NULL for an inserted row.
    """
    plain = target.drop(part)
    both, touched, columns = _merged(
        target.withColumnRenamed(part, "_lies_in"), source, key, updated, as_of, "right", insert_defaults, reset_unchanged)
    names = [f.name for f in target.withColumnRenamed(part, "_lies_in").schema.fields]
    kept = [c for c, name in zip(columns, names) if name != "_lies_in"]
    return both.filter(touched).select(*kept, F.col("_lies_in").alias(part)).select(*plain.columns, part)


# --- history ---------------------------------------------------------------------------


def version_source(dimension: DataFrame, key: str, tracked: Mapping[str, str]) -> DataFrame:
    """Gated rows of a dimension with the hash of their tracked attributes."""
    named = [F.col(c).alias(name) for c, name in tracked.items()]
    return layer_gate(dimension).select(F.col(key), *named, row_hash(tracked).alias("_hash_diff"))


def changed_versions(current: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Current versions whose key comes with another hash."""
    src = source.select(F.col(key).alias("_key"), F.col("_hash_diff").alias("_new_hash"))
    return current.filter("_is_current").join(
        src, (F.col(key) == F.col("_key")) & (F.col("_hash_diff") != F.col("_new_hash")), "left_semi"
    )


def new_versions(current: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Source rows without a current version of the same hash."""
    cur = current.filter("_is_current").select(key, "_hash_diff")
    return source.join(cur, [key, "_hash_diff"], "left_anti")


def version_key(key: str, as_of: str) -> Column:
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{as_of}")))


def version_changes(current: DataFrame, source: DataFrame, key: str, run_id: str, as_of: str) -> DataFrame:
    """Current versions after a load plus the versions it closes, from a single join.

    Needs one current version per key. Keys that the source lacks stay open.
    """
    attributes = [c for c in source.columns if c not in (key, "_hash_diff")]
    old = current.filter("_is_current").select(F.struct(*current.columns).alias("_old"), F.col(key).alias("_old_key"))
    new = source.select(F.struct(*source.columns).alias("_new"), F.col(key).alias("_new_key"))
    both = old.join(new, F.col("_old_key") == F.col("_new_key"), "full_outer")
    has_old, has_new = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    closes = has_old & has_new & (F.col("_old._hash_diff") != F.col("_new._hash_diff"))
    opens = has_new & (~has_old | ~F.col("_old._hash_diff").eqNullSafe(F.col("_new._hash_diff")))

    def pick(name: str, kind, closing: Column, opening: Mapping[str, Column]) -> tuple[Column, Column]:
        kept = F.col(f"_old.{name}")
        if name == "_valid_to":
            kept = F.when(closing, ntz(as_of)).otherwise(kept)
        if name == "_is_current":
            kept = ~closing
        return kept.cast(kind).alias(name), opening[name].cast(kind).alias(name)

    opening = {
        "scd_key": F.md5(F.concat(F.col("_new_key").cast("string"), F.lit(f"|{as_of}"))),
        key: F.col("_new_key"),
        **{a: F.col(f"_new.{a}") for a in attributes},
        "_valid_from": ntz(as_of),
        "_valid_to": ntz(OPEN_END),
        "_is_current": F.lit(True),
        "_hash_diff": F.col("_new._hash_diff"),
        "_run_id": F.lit(run_id),
    }
    pairs = [pick(f.name, f.dataType, closes, opening) for f in current.schema.fields]
    versions = F.array(
        F.when(has_old, F.struct(*[p[0] for p in pairs])),
        F.when(opens, F.struct(*[p[1] for p in pairs])),
    )
    return both.select(F.explode(versions).alias("_v")).filter("_v is not null").select("_v.*")


def merge_versions(history: DataFrame, source: DataFrame, key: str, run_id: str, as_of: str) -> DataFrame:
    """The whole history after a load: closed versions are carried over untouched."""
    closed = history.filter(~F.col("_is_current"))
    return closed.unionByName(version_changes(history, source, key, run_id, as_of))


# --- fact ------------------------------------------------------------------------------


def denormalize(
    history: DataFrame,
    dimension: DataFrame,
    key: str,
    from_history: Iterable[str | Column],
    from_dimension: Iterable[Column],
    current_only: bool = False,
) -> DataFrame:
    """History joined to its gated dimension row: all versions, or only current ones."""
    versions = history.filter("_is_current") if current_only else history
    dim = layer_gate(dimension).select(F.col(key).alias("_key"), *from_dimension)
    return versions.select(key, *from_history).join(dim, F.col(key) == F.col("_key")).drop("_key")
