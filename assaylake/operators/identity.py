"""Surrogate numbers that stay: a map from business keys to gap-free numbers, grown by each load."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaylake.operators.loads import dense_key
from assaylake.sources.lake import BUCKETS, Lake
from assaylake.sources.scratch import written_table

LAYER = "keys"


def number_keys(lake: Lake, table: str, rows: DataFrame, key: str, number: str, buckets: int = BUCKETS) -> DataFrame:
    """`rows` with the number of their key. Keys seen before keep theirs, new ones get the next in order.

    Only parts of the map that may hold a key are read. Two loads at a time cannot give out the same
    number: the later one is told by a `Conflict` and can be repeated. Rows with a NULL key get none.
    """
    kind = dict(rows.dtypes)[key]
    schema = f"`{key}` {kind}, `{number}` bigint"
    wanted = written_table(rows.select(key).filter(F.col(key).isNotNull()).distinct())
    with lake.change() as change:
        change.keyed(LAYER, table, key, buckets)
        last = int(lake.properties(LAYER, table).get("last", 0))
        near = lake.parts_with(LAYER, table, wanted)
        known = lake.read(LAYER, table, schema, near).join(wanted, key, "left_semi")
        new = written_table(dense_key(wanted.join(known, key, "left_anti"), key, number, start=last).withColumn(
            number, F.col(number).cast("bigint")).select(key, number))
        count = new.count()
        if count:
            change.expect(LAYER, table, last=last or None)
            change.set(LAYER, table, last=last + count)
            change.write_keyed(LAYER, table, new)
    numbers = known.unionByName(new).select(F.col(key).alias("_key"), number)
    return rows.join(numbers, F.col(key) == F.col("_key"), "left").drop("_key")


def key_map(lake: Lake, table: str, schema: str) -> DataFrame:
    return lake.read(LAYER, table, schema)


