"""Sharding by jump consistent hashing.

A document's shard follows from its id and the number of shards alone: no ring table, and one more
shard takes rows only into itself. Places within a shard come from a running count that is spread
over buckets, so no task handles a whole shard.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaylake.llm.common import buckets_for, numbered_copies, running_sum, text_of
from assaylake.sources.scratch import written_table
from assaylake.sources.tables import table

SHARDS = 40
OVERHEAD = 16  # bytes counted for a document besides its text
NO_KEY = 0x5DEECE66D  # stands in for a NULL id

# Fixed value: the generator's multiplier in the published algorithm.
_STEP = np.uint64(2862933555777941757)


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each 64-bit key; about log(shards) vectorised rounds."""
    state = keys.astype(np.uint64)
    place, ahead = np.full(len(state), -1, np.int64), np.zeros(len(state), np.int64)
    live = np.arange(len(state))
    while len(live):
        place[live] = ahead[live]
        state[live] = state[live] * _STEP + np.uint64(1)
        ratio = float(1 << 31) / ((state[live] >> np.uint64(33)).astype(np.float64) + 1.0)
        ahead[live] = ((place[live] + 1).astype(np.float64) * ratio).astype(np.int64)
        live = live[ahead[live] < shards]
    return place


def shard_of(column, shards: int):
    """Column expression of `jump_hash` for a 64-bit id; NULL ids share one shard."""

    @F.arrow_udf("int")
    def apply(ids: pa.Array) -> pa.Array:
        keys = np.asarray(ids.fill_null(NO_KEY)).astype(np.int64).view(np.uint64)
        return pa.array(jump_hash(keys, shards).astype(np.int32))

    return apply(column.cast("long"))


def shard_rows(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for each document.

    The size is the text's UTF-8 bytes and 16; a NULL text has none of the former. Rows that repeat
    an id share its shard and get slots of their own, as do rows with a NULL id. Other columns are
    ignored; an empty table gives an empty result. Rows with equal results are counted before they are
    dealt to buckets, so that copies of one row, or rows of one id, are in no bucket together.
    """
    text = text_of(F.col("text"))
    rows = written_table(docs.select(
        "doc_id", (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32")))
    alike = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("n")).select(
        "*", shard_of(F.col("doc_id"), shards).alias("shard"), shard_of(F.col("doc_id"), shards + 1).alias("grown_shard"))
    # The hottest id decides how many buckets its shard needs.
    most = alike.groupBy("shard").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0] or 0
    bucket = F.pmod(F.xxhash64("doc_id", "size", "text_crc32", F.expr("copy div 1000")), F.lit(buckets_for(most)))
    every = numbered_copies(alike, "n", "copy").withColumns({"bucket": bucket, "one": F.lit(1)})
    placed = running_sum(every, ["shard"], "bucket", ["doc_id", "text_crc32", "size", "copy"], "one", "slot")
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op7_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return shard_rows(table(spark, folder, "documents"))
