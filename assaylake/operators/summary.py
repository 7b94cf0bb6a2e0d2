"""Batch summaries, the quality gate and monitoring reports over results and logs."""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaylake.functions.columns import FAIL, PASS, SOFT, decode, percent
from assaylake.operators.loads import keep_latest

DEFAULT_THRESHOLD = Decimal("10.00")


def failed_records(results: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Number of distinct records with a critical violation, and of all violations."""
    failed = F.col("result") == FAIL
    # Two steps, so that a hot table is counted by many tasks: first one row per record.
    per_record = results.groupBy(*by, "record_key").agg(
        F.max(failed).alias("_failed"), F.count(F.lit(1)).alias("_violations")
    )
    counted = F.col("_failed") & F.col("record_key").isNotNull()
    return per_record.groupBy(*by).agg(
        F.count_if(counted).alias("failed_count"),
        F.coalesce(F.sum("_violations"), F.lit(0)).alias("violation_count"),
        F.coalesce(F.sum(F.when(F.col("record_key").isNull(), F.col("_violations"))), F.lit(0)).alias(
            "unkeyed_violation_count"
        ),
    )


def summarize(pending: DataFrame, results: DataFrame, batch_id: str, layer: str, table: str) -> DataFrame:
    """The log row of one batch and table; an empty batch gives zeros."""
    counts = ["overall_count", "failed_count", "violation_count", "unkeyed_violation_count"]
    total = pending.agg(F.count(F.lit(1)).alias("overall_count"))
    both = total.unionByName(failed_records(results), allowMissingColumns=True)
    return both.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts]).select(
        F.lit(batch_id).alias("dq_batch_id"),
        F.lit(layer).alias("layer"),
        F.lit(table).alias("table_nm"),
        *counts,
        percent(F.col("failed_count"), F.col("overall_count")).alias("fail_pct"),
    )


def threshold_keys(layers=("BRONZE", "SILVER", "GOLD")) -> dict[str, str]:
    return {layer: f"DQ_{layer}_THRESHOLD" for layer in layers}


def threshold_for(layer: Column, settings: Mapping[str, object]) -> Column:
    """The configured threshold of a layer; the default where none is configured."""
    known = {
        layer_name: str(Decimal(str(settings[name])))
        for layer_name, name in threshold_keys().items()
        if settings.get(name) not in (None, "")
    }
    return decode(layer, known, str(DEFAULT_THRESHOLD)).cast("decimal(5,2)")


def gate(summary: DataFrame, settings: Mapping[str, object]) -> DataFrame:
    """Add the threshold, whether the failed share exceeds it, and the outcome.

    A summary whose counts are missing did not finish its checks and counts as exceeded.
    """
    limit = threshold_for(F.col("layer"), settings)
    over = F.coalesce(F.col("fail_pct") > limit.cast("double"), F.lit(True))
    return summary.withColumns({"threshold": limit, "threshold_exceeded": over}).withColumn(
        "status", F.when(over, "THRESHOLD_EXCEEDED").otherwise("COMPLETED")
    )


def gate_all(gated: DataFrame) -> DataFrame:
    """One decision for all tables of a batch: any exceeded threshold stops it; so does no table at all."""
    stop = F.coalesce(F.max("threshold_exceeded"), F.lit(True))
    return gated.groupBy("dq_batch_id").agg(
        F.count(F.lit(1)).alias("table_count"),
        F.count_if("threshold_exceeded").alias("exceeded_count"),
        stop.alias("threshold_exceeded"),
        F.when(stop, "FAILED").otherwise("COMPLETED").alias("status"),
    )


def status_distribution(df: DataFrame, status: str = "dq_status") -> DataFrame:
    """Rows per status; pending rows are a group of their own."""
    return df.groupBy(F.col(status).alias("dq_status")).agg(F.count(F.lit(1)).alias("cnt"))


def status_distribution_all(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Status distributions of several tables, labelled by table."""
    parts = [status_distribution(df).select(F.lit(name).alias("tbl"), "dq_status", "cnt") for name, df in tables.items()]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def violations_by_rule(results: DataFrame, only_failed: bool = False) -> DataFrame:
    """Violation counts per table, rule and result."""
    chosen = results.filter(F.col("result") == FAIL) if only_failed else results
    return chosen.groupBy("table_nm", "rule_id", "result").agg(F.count(F.lit(1)).alias("cnt")).orderBy(
        "table_nm", "rule_id", "result"
    )


def category_rollup(results: DataFrame, rules: DataFrame, categories: DataFrame) -> DataFrame:
    """Violations per quality dimension. Counts are reduced per rule before the metadata is joined."""
    per_rule = results.groupBy("rule_id").agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(F.col("result") == FAIL).alias("_failed")
    )
    named = rules.select("rule_id", F.col("category_id").cast("bigint")).join(categories, "category_id")
    return (
        named.join(per_rule, "rule_id", "left")
        .groupBy("category_id", "category_nm")
        .agg(
            F.countDistinct("rule_id").alias("rule_count"),
            F.coalesce(F.sum("_n"), F.lit(0)).alias("violation_count"),
            F.coalesce(F.sum("_failed"), F.lit(0)).alias("failed_count"),
        )
    )


def current_log(log: DataFrame) -> DataFrame:
    """The newest log row of each layer and table; the log itself is the history."""
    return keep_latest(log, ["layer", "table_nm"], ["dq_start_ts", "dq_batch_id"])


def latest_log(log: DataFrame, k: int = 20) -> DataFrame:
    """The k newest log rows."""
    return log.orderBy(F.col("dq_start_ts").desc(), "dq_batch_id", "table_nm").limit(k)


def record_drilldown(results: DataFrame, source: DataFrame, key: str, record_key: str | None = None) -> DataFrame:
    """Violations next to the row they are about, for one record or for all."""
    found = results.filter(F.col("record_key") == record_key) if record_key is not None else results
    rows = source.withColumn("_record", F.col(key).cast("string"))
    return found.join(rows, F.col("record_key") == F.col("_record")).drop("_record")

