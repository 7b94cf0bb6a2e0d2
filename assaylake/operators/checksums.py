"""Reconciliation by a tree of checksums: sums of row hashes per bucket, compared from the top down.

A checksum does not depend on the order of rows. Both tables are read once, narrow, for the sums of the
lowest level; upper levels are sums of these. Rows are compared only from buckets that differ.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaylake.sources.scratch import written_table

FANOUT, LEVELS = 16, 3  # 4,096 buckets at the lowest level


def row_digest(df: DataFrame) -> Column:
    """A 64-bit hash of a row with its NULLs; columns in the order of their names."""
    parts = [x for c in sorted(df.columns) for x in (F.col(c).isNull(), F.col(c))]
    return F.xxhash64(*parts)


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit("bucket")), F.lit(buckets))


def checksums(df: DataFrame, key: str, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """(bucket, rows, low, high, xor) of the lowest level: the hashes' halves summed, and their exclusive or."""
    digest = row_digest(df)
    hashed = df.select(bucket_of(key, fanout**levels).alias("bucket"), digest.alias("digest"))
    return hashed.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("digest").bitwiseAND(0xFFFFFFFF)).alias("low"),
        F.sum(F.shiftright("digest", 32)).alias("high"), F.bit_xor("digest").alias("xor"))


def differing(left: DataFrame, right: DataFrame, fanout: int = FANOUT, levels: int = LEVELS) -> list[int]:
    """Buckets of the lowest level that differ, found from the top down; at most `fanout ** levels`."""
    sums = ["rows", "low", "high"]

    def above(df: DataFrame, level: int) -> DataFrame:
        node = F.floor(F.col("bucket") / fanout ** (levels - level))
        return df.groupBy(node.alias("node")).agg(*[F.sum(c).alias(c) for c in sums], F.bit_xor("xor").alias("xor"))

    found = [0]
    for level in range(1, levels + 1):
        wanted = [child for node in found for child in range(node * fanout, (node + 1) * fanout)]
        a, b = (above(df, level).filter(F.col("node").isin(wanted)) for df in (left, right))
        b = b.select(*[F.col(c).alias(f"_{c}") for c in b.columns])
        both = a.join(b, F.col("node") == F.col("_node"), "full_outer")
        same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*sums, "xor")])
        found = sorted(r[0] for r in both.filter(~same).select(F.coalesce("node", "_node")).collect())
        if not found:
            return []
    return found


def differences(left: DataFrame, right: DataFrame, key: str, buckets: list[int], fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """(key, difference) of the rows in the given buckets: LEFT_ONLY, RIGHT_ONLY or CHANGED. A key is one row a side."""
    count = fanout**levels

    def rows(df: DataFrame, side: str) -> DataFrame:
        own = df.filter(bucket_of(key, count).isin(buckets)) if buckets else df.limit(0)
        return own.select(F.col(key).alias(f"_{side}"), row_digest(df).alias(f"_{side}_digest"))

    both = rows(left, "left").join(rows(right, "right"), F.col("_left").eqNullSafe(F.col("_right")), "full_outer")
    kind = F.when(F.col("_right_digest").isNull(), "LEFT_ONLY").when(F.col("_left_digest").isNull(), "RIGHT_ONLY")
    kind = kind.when(F.col("_left_digest") != F.col("_right_digest"), "CHANGED")
    return both.select(F.coalesce("_left", "_right").alias(key), kind.alias("difference")).filter("difference is not null")


def reconcile_rows(left: DataFrame, right: DataFrame, key: str, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """Keys on which two tables of the same columns differ."""
    sums = [written_table(checksums(df, key, fanout, levels)) for df in (left, right)]
    found = differing(*sums, fanout, levels)
    return differences(left, right, key, found, fanout, levels)
