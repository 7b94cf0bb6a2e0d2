"""Counts kept per batch, so that reports read batches and not violations.

A batch's counts replace those of its earlier run, which takes these back; totals are sums over batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaylake.functions.columns import FAIL
from assaylake.operators.audit import reject_reason
from assaylake.sources.lake import Lake

ROLLUP_SCHEMA = (
    "dq_batch_id string, table_nm string, rule_id bigint, feed_id bigint, result string, violation_count bigint, "
    "first_at timestamp_ntz, last_at timestamp_ntz"
)
LAYER, TABLE = "audit", "dq_rollup"


def batch_rollup(results: DataFrame) -> DataFrame:
    return results.groupBy("dq_batch_id", "table_nm", "rule_id", "feed_id", "result").agg(
        F.count(F.lit(1)).alias("violation_count"), F.min("record_ins_ts").alias("first_at"), F.max("record_ins_ts").alias("last_at"))


def keep_rollup(lake: Lake, results: DataFrame, batch_id: str) -> None:
    """Keep the counts of a batch's violations in the place of any from an earlier run of it."""
    lake.put(LAYER, TABLE, batch_rollup(results), {"batch": batch_id})


def rollups(lake: Lake) -> DataFrame:
    return lake.read(LAYER, TABLE, ROLLUP_SCHEMA)


def reject_totals(kept: DataFrame) -> DataFrame:
    """`reject_summary` over all batches."""
    return kept.filter(F.col("result") == FAIL).groupBy("table_nm", "rule_id", "feed_id").agg(
        F.sum("violation_count").alias("reject_count"), F.min("first_at").alias("first_rejected_at"),
        F.max("last_at").alias("last_rejected_at"),
    ).select(F.col("table_nm").alias("source_table"), reject_reason().alias("reject_reason"), "reject_count",
             "first_rejected_at", "last_rejected_at")


def rule_totals(kept: DataFrame) -> DataFrame:
    """`violations_by_rule` over all batches."""
    return kept.groupBy("table_nm", "rule_id", "result").agg(F.sum("violation_count").alias("cnt"))
