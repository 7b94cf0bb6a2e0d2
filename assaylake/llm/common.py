"""Helpers shared by the training-data operators."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The white space that separates words, and a class of everything else. Single
# characters instead of ranges let the regular expression engine use a bit table.
SPACE = r"[ \t\n\x0B\f\r]+"
SPACE_BYTES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Bytes of text that one vectorised step handles; a longer text is a step of its own.
STEP_BYTES = 500_000


# Rows per Arrow batch: with whole texts or sets in them, Spark's 10,000 rows take a worker too much memory.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Lowers the session's Arrow batches to BATCH_ROWS; results do not depend on them."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name, "10000")) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def text_of(column: Column) -> Column:
    return F.coalesce(column, F.lit(""))


def word_count(text: Column) -> Column:
    """Number of words between white space; 0 for NULL. Stays in the JVM."""
    trimmed = F.btrim(text_of(text), F.lit(" \t\n\x0b\f\r"))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, SPACE))).cast("long")


# A side of at most so many rows of a few numbers is broadcast; beyond it the same join shuffles.
BROADCAST_ROWS = 500_000
# Copies of one row that are written out in one piece.
COPIES_PER_PIECE = 10_000


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A written table with a broadcast hint if it is counted to have few rows."""
    return F.broadcast(df) if df.count() <= rows else df


def whole_rows(docs: DataFrame, *hashed: str) -> DataFrame:
    """(row, id, hash, rest): each row as one struct, so that no column of it can clash with another side's."""
    hash_ = F.xxhash64(*(hashed or ("text",)))
    return docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), hash_.alias("hash"), others_hash(docs).alias("rest"))


def matching(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """`whole_rows` joined to `keys`, whose first two columns are an id, which may be NULL, and a hash."""
    id_, hash_ = keys.columns[:2]
    named = keys.select(F.col(id_).alias("key_id"), F.col(hash_).alias("key_hash"), *keys.columns[2:])
    return rows.join(named, F.col("id").eqNullSafe(F.col("key_id")) & (F.col("hash") == F.col("key_hash")), how)


def fields(docs: DataFrame, text: Column | None = None) -> list[Column]:
    """The columns of `docs` out of the struct `row`, with another text if given."""
    return [text.alias(c) if c == "text" and text is not None else F.col("row").getField(c).alias(c) for c in docs.columns]


def others_hash(docs: DataFrame) -> Column:
    """A hash of all columns but id and text; rows with equal id, text and hash are taken as equal."""
    kinds = dict(docs.dtypes)
    plain = lambda c: F.to_json(F.struct(c)) if "map<" in kinds[c] or "variant" in kinds[c] else F.col(c)
    rest = [F.col(f"`{c}`") if "." in c else plain(c) for c in sorted(docs.columns) if c not in ("doc_id", "text")]
    return F.xxhash64(F.lit(0), *[x for c in rest for x in (c.isNull(), c)])


def numbered_copies(counted: DataFrame, count: str, out: str) -> DataFrame:
    """Each row `count` times, numbered from 0; a count of any size is spread over tasks."""
    plain = [c for c in counted.columns if c != count]
    size = F.lit(COPIES_PER_PIECE).cast("long")
    once = counted.filter(F.col(count) == 1).select(*plain, F.lit(0).cast("long").alias(out))
    pieces = counted.filter(F.col(count) > 1).withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(count) - 1) / size))))
    last = F.least((F.col("piece") + 1) * size, F.col(count)) - 1
    spread = pieces.repartition(*plain, "piece").select(*plain, F.explode(F.sequence(F.col("piece") * size, last)).alias(out))
    return once.unionByName(spread)


def running_sum(df: DataFrame, group: list[str], bucket: str, order: list[str], value: str, out: str) -> DataFrame:
    """Exclusive running sum of `value` per group, in the order (bucket, order).

    Rows of a group are dealt to buckets, so that a group of any size is spread over tasks; only
    one total per bucket is summed in a single place. `group` and `bucket` hold no NULL.
    """
    keys = [*group, bucket]
    before = lambda window: window.rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy(*keys).agg(F.sum(value).alias("_total"))
    base = F.coalesce(F.sum("_total").over(before(Window.partitionBy(*group).orderBy(bucket))), F.lit(0))
    bases = totals.select(*[F.col(k).alias(f"_k_{k}") for k in keys], base.alias("_base"))
    inner = F.coalesce(F.sum(value).over(before(Window.partitionBy(*keys).orderBy(*order))), F.lit(0))
    same = [F.col(k) == F.col(f"_k_{k}") for k in keys]
    joined = df.withColumn("_inner", inner).join(bases, same)
    return joined.select(*df.columns, (F.col("_base") + F.col("_inner")).cast("long").alias(out))


def buckets_for(rows: int, per_bucket: int = 20_000) -> int:
    return max(1, math.ceil(rows / per_bucket))


# --- vectorised words -------------------------------------------------------------------------

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACE_BYTES)] = True
_BYTE_NAMES = np.random.default_rng(20_240_501).integers(0, 2**64, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words."""
    x = x ^ (x >> np.uint64(33))
    x = x * _MIX[0]
    x = x ^ (x >> np.uint64(33))
    x = x * _MIX[1]
    return x ^ (x >> np.uint64(33))


def odd_multipliers(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**64, n, dtype=np.uint64) | np.uint64(1)


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and document offsets of a string column; NULL is empty. Copies nothing but offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    ends = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    ends = ends.astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, ends - ends[0]


def steps(offsets: np.ndarray, size: int = STEP_BYTES):
    """Ranges of documents of about `size` bytes each."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte start and end of every word, and each document's first word (with the total at the end)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~_IS_SPACE[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    before = np.empty(len(data), bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    after = np.empty(len(data), bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_names(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit name for each word, equal for equal words."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    first = np.zeros(len(starts), np.int64)
    np.cumsum(lengths[:-1], out=first[1:])
    place = np.arange(int(lengths.sum()), dtype=np.int64)
    within = place - np.repeat(first, lengths)
    powers = np.cumprod(np.full(int(lengths.max()), _BASE, np.uint64))
    values = _BYTE_NAMES[data[np.repeat(starts, lengths) + within]] * powers[within]
    return mix(np.add.reduceat(values, first) + lengths.astype(np.uint64))


def gram_names(words: np.ndarray, n: int, multipliers: np.ndarray) -> np.ndarray:
    """A name for each run of `n` words, by its first word's place."""
    count = len(words) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = words[:count] * multipliers[0]
    for i in range(1, n):
        total = total + words[i : i + count] * multipliers[i]
    return mix(total)
