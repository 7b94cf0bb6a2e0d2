"""Profiles that merge: sketches of a table's parts, kept with them and put together for the whole.

Estimates are named as such. Distinct counts come from HyperLogLog sketches with 2^14 registers (standard
error 0.8 %), quantiles from KLL sketches of size 200 (rank error 1.7 % with 99 % confidence).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaylake.functions.columns import percent

REGISTERS_LOG2, KLL_SIZE = 14, 200
SKETCH_SCHEMA = (
    "batch string, column_name string, row_count bigint, null_count bigint, min_value string, max_value string, "
    "distinct_sketch binary, quantile_sketch binary"
)


def as_number(column: Column, kind: T.DataType) -> Column | None:
    """The value on a number line; None for kinds that have none."""
    if isinstance(kind, T.NumericType):
        return column.cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(column.cast("timestamp")).cast("double")
    return None


def column_sketches(df: DataFrame, columns: list[str], batch: str) -> DataFrame:
    """One row per column in one scan, to be kept as the sketches of this batch."""
    kinds = {f.name: f.dataType for f in df.schema.fields}

    def sketch(name: str) -> Column:
        column, number = F.col(name), as_number(F.col(name), kinds[name])
        quantiles = F.lit(None).cast("binary") if number is None else F.kll_sketch_agg_double(number, F.lit(KLL_SIZE))
        return F.struct(
            F.lit(name).alias("column_name"), F.count(F.lit(1)).alias("row_count"), F.count_if(column.isNull()).alias("null_count"),
            F.min(column).cast("string").alias("min_value"), F.max(column).cast("string").alias("max_value"),
            F.hll_sketch_agg(column.cast("string"), REGISTERS_LOG2).alias("distinct_sketch"), quantiles.alias("quantile_sketch"))

    found = df.agg(F.array(*[sketch(c) for c in columns]).alias("_all")).select(F.lit(batch).alias("batch"), F.inline("_all"))
    return found.select(*T.StructType.fromDDL(SKETCH_SCHEMA).names)


def merged_profile(sketches: DataFrame) -> DataFrame:
    """The profile of all batches together; rows of the tables are not read."""
    merged = sketches.groupBy("column_name").agg(
        F.sum("row_count").alias("row_count"), F.sum("null_count").alias("null_count"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("estimated_distinct"),
        F.kll_merge_agg_double("quantile_sketch").alias("_quantiles"))
    filled = F.kll_sketch_get_n_double("_quantiles") > 0  # no number, no quantile
    return merged.select(
        "column_name", "row_count", percent(F.col("null_count"), F.col("row_count")).alias("null_pct"), "estimated_distinct",
        F.when(filled, F.kll_sketch_get_quantile_double("_quantiles", F.lit(0.5))).alias("estimated_median"))
