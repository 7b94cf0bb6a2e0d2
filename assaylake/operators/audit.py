"""Rejects, run and step events, alerts and source counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assaylake.functions.columns import FAIL, ntz, percent, seconds_between


def reject_reason() -> Column:
    return F.format_string("RULE_%d_FEED_%d", F.col("rule_id"), F.col("feed_id"))


def reject_summary(results: DataFrame, batch_id: str | None = None) -> DataFrame:
    """Critical violations per table, rule and feed, of one batch or of all."""
    chosen = results.filter(F.col("result") == FAIL)
    if batch_id is not None:
        chosen = chosen.filter(F.col("dq_batch_id") == batch_id)
    return (
        chosen.groupBy("table_nm", "rule_id", "feed_id")
        .agg(
            F.count(F.lit(1)).alias("reject_count"),
            F.min("record_ins_ts").alias("first_rejected_at"),
            F.max("record_ins_ts").alias("last_rejected_at"),
        )
        .select(
            F.col("table_nm").alias("source_table"),
            reject_reason().alias("reject_reason"),
            "reject_count",
            "first_rejected_at",
            "last_rejected_at",
        )
    )


def reject_records(results: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Rejected records with all their reasons and their content as JSON.

    A record has at most one reason per feed, so the list is bounded by the metadata. Only
    rejected rows are turned into JSON.
    """
    reasons = (
        results.filter((F.col("result") == FAIL) & F.col("record_key").isNotNull())
        .groupBy("table_nm", "record_key")
        .agg(F.array_sort(F.collect_set(reject_reason())).alias("reject_reasons"))
    )
    data = source.select(F.col(key).cast("string").alias("_record"), F.struct("*").alias("_row"))
    joined = reasons.join(data, F.col("record_key") == F.col("_record"))
    return joined.select(*reasons.columns, F.to_json("_row").alias("record_data"))


def source_row_counts(source: DataFrame, name: str, loaded_at: str, mark: str) -> DataFrame:
    """All rows of a source, and those newer than the mark, in one pass."""
    return source.agg(
        F.count(F.lit(1)).alias("total_count"), F.count_if(F.col(loaded_at) > ntz(mark)).alias("incremental_count")
    ).select(F.lit(name).alias("source_table"), "total_count", "incremental_count")


# --- events ----------------------------------------------------------------------------

# Runs, steps and errors are appended as events; the state of a step is derived from them.
# Fixed value: the columns of a log entry.
EVENT_SCHEMA = (
    "run_id string, step_id bigint, step_name string, event string, event_ts timestamp_ntz, status string, "
    "rows_read bigint, rows_written bigint, rows_rejected bigint, rows_updated bigint, error_message string"
)


def step_states(events: DataFrame) -> DataFrame:
    """The latest state of each step of each run, with duration and reject percentage."""
    latest = F.max_by(
        F.struct("status", "rows_read", "rows_written", "rows_rejected", "rows_updated", "error_message"),
        F.struct("event_ts", (F.col("event") != "START").alias("_later")),
    )
    state = events.groupBy("run_id", "step_id", "step_name").agg(
        F.min(F.when(F.col("event") == "START", F.col("event_ts"))).alias("start_ts"),
        F.max(F.when(F.col("event") == "END", F.col("event_ts"))).alias("end_ts"),
        latest.alias("_s"),
    )
    return state.select(
        "run_id",
        "step_id",
        "step_name",
        "start_ts",
        "end_ts",
        seconds_between(F.col("start_ts"), F.col("end_ts")).alias("duration_seconds"),
        "_s.*",
        percent(F.col("_s.rows_rejected"), F.col("_s.rows_read")).alias("reject_percentage"),
    )


def run_states(steps: DataFrame) -> DataFrame:
    """One row per run from its step states: times, row totals, completed steps, first failed step."""
    failed = F.col("status") == "FAILED"
    whole = steps.groupBy("run_id").agg(
        F.min("start_ts").alias("start_ts"),
        F.max("end_ts").alias("end_ts"),
        F.sum("rows_read").alias("total_rows_read"),
        F.sum("rows_written").alias("total_rows_written"),
        F.sum("rows_rejected").alias("total_rows_rejected"),
        F.count(F.lit(1)).alias("total_steps"),
        F.count_if(F.col("status") == "COMPLETED").alias("completed_steps"),
        F.min(F.when(failed, F.col("step_id"))).alias("failed_step_id"),
        F.count_if(F.col("status") == "RUNNING").alias("_open"),
    )
    state = F.when(F.col("failed_step_id").isNotNull(), "FAILED").when(F.col("_open") > 0, "RUNNING")
    return whole.withColumn("run_status", state.otherwise("COMPLETED")).withColumn(
        "duration_seconds", seconds_between(F.col("start_ts"), F.col("end_ts"))
    ).drop("_open")


def latest_run(steps: DataFrame, start: str = "start_ts") -> DataFrame:
    """Steps of the run that started last (not of the greatest run id)."""
    newest = steps.agg(F.max_by("run_id", F.struct(start, "run_id")).alias("_latest"))
    return steps.join(F.broadcast(newest), F.col("run_id") == F.col("_latest")).drop("_latest")  # one row


def remaining_steps(registry: DataFrame, failed: DataFrame) -> DataFrame:
    """What each failed run still has to do: active steps from the failed one on, by step order."""
    onward = Window.orderBy("step_order").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    active = registry.filter("is_active")
    steps = F.collect_list(F.struct("step_id", "step_name", "step_layer", "step_order"))
    plan = active.select(F.col("step_id").alias("_failed_id"), steps.over(onward).alias("_steps"))
    joined = failed.join(plan, F.col("failed_step_id") == F.col("_failed_id"))
    return joined.select(*failed.columns, F.inline("_steps"))


def alerts(gated: DataFrame, domains: DataFrame, recipients: DataFrame, enabled: bool = True) -> DataFrame:
    """Pending alert rows for exceeded thresholds, one per recipient of the table's domain."""
    routed = gated.filter(F.col("threshold_exceeded") & F.lit(enabled)).join(domains, "table_nm")
    people = recipients.select("domain", F.explode(F.split("emails", ",")).alias("recipient"))
    return routed.join(people, "domain", "left").select(
        "dq_batch_id",
        "table_nm",
        "domain",
        F.trim("recipient").alias("recipient"),
        F.lit("EMAIL").alias("notification_type"),
        F.lit("DQ_THRESHOLD").alias("event_type"),
        F.lit("PENDING").alias("send_status"),
    )
