"""Uniqueness against everything loaded before: a keyed table of the keys that batches have brought."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaylake.sources.lake import BUCKETS, Lake
from assaylake.sources.scratch import written_table

LAYER = "keys"


def key_of(columns: list[str]) -> Column:
    """One text for the columns, different for different values; NULL is a value."""
    texts = [F.col(c).cast("string") for c in columns]
    return F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def repeated(
    lake: Lake, table: str, rows: DataFrame, columns: list[str], order: list[str], batch: str, buckets: int = BUCKETS
) -> DataFrame:
    """`rows` with `is_repeated`: the key came in an earlier batch, or earlier in this one by `order`.

    A key is one row of the table, with the batch that brought it first; a repeated run of a batch finds
    its own keys and judges as before. Only parts that may hold a key of the batch are read.
    """
    schema = "key string, batch string"
    keyed = rows.withColumn("_key", key_of(columns))
    keys = written_table(keyed.select(F.col("_key").alias("key")).distinct())
    with lake.change() as change:
        change.keyed(LAYER, table, "key", buckets)
        known = lake.read(LAYER, table, schema, lake.parts_with(LAYER, table, keys)).join(keys, "key", "left_semi")
        known = written_table(known)
        new = written_table(keys.join(known, "key", "left_anti").select("key", F.lit(batch).alias("batch")))
        if not new.isEmpty():
            change.write_keyed(LAYER, table, new)
    before = known.filter(F.col("batch") != batch).select(F.col("key").alias("_before"))
    # The first of a key is found by an aggregate that combines on the map side, so a hot key is one row.
    rank = F.struct(*order)
    first = keyed.groupBy(F.col("_key").alias("_of")).agg(F.min(rank).alias("_first"))
    joined = keyed.join(first, F.col("_key") == F.col("_of")).join(before, F.col("_key") == F.col("_before"), "left")
    return joined.select(*rows.columns, (F.col("_before").isNotNull() | ~rank.eqNullSafe(F.col("_first"))).alias("is_repeated"))

