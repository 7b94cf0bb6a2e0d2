"""Rejects, run and step reports, logs and alerts."""

from __future__ import annotations

from pyspark.sql import functions as F

from assaylake.catalog.engine import gated
from assaylake.catalog.inputs import (
    BATCH,
    CUSTOMER_FEEDS,
    EVENT_FEEDS,
    LINE_RESULTS_SQL,
    LINES_SQL,
    NATION_FEEDS,
    PART_FEEDS,
    PART_RESULTS_SQL,
    check_events,
    check_lines,
    check_parts,
    lines,
)
from assaylake.functions.columns import FAIL
from assaylake.operators import audit
from assaylake.operators.evaluate import score_rows
from assaylake.operators.summary import current_log, latest_log
from assaylake.sources.metadata import (
    FEED_SCHEMA,
    RECIPIENT_SCHEMA,
    Step,
    frame,
    step_frame,
)
from assaylake.sources.tables import table

EVENT_STEPS = [
    Step(1, "view", "BRONZE", 1.0),
    Step(2, "click", "DQ_BRONZE", 2.0, (1,)),
    Step(3, "signup", "SILVER", 3.5, (2,)),
    Step(4, "purchase", "GOLD", 3.0, (2,)),
    Step(5, "archive", "AUDIT", 5.0, (4,), False),
]
RECIPIENTS = [
    (1, "PARTS", "parts@lake.example, quality@lake.example"),
    (2, "CUSTOMERS", "customers@lake.example"),
]


def reject_summary(spark, folder):
    both = check_lines(spark, folder).results.unionByName(check_parts(spark, folder).results)
    return audit.reject_summary(both, BATCH)


def reject_records(spark, folder):
    """Rejected line items with their reasons; one field is read back from the stored content."""
    rejects = audit.reject_records(check_lines(spark, folder).results, lines(spark, folder), "row_key")
    return rejects.select(
        "table_nm", "record_key", F.array_join("reject_reasons", ",").alias("reject_reasons"),
        F.get_json_object("record_data", "$.l_returnflag").alias("l_returnflag"),
    )


# --- runs and steps: every user and day of the event table is taken as a run ------------


def run_id():
    return F.concat_ws("-", F.col("user_id"), F.date_format("ts", "yyyyMMdd"))


def failed_runs(spark, folder):
    """Runs with an error event; they failed at the last step of the registry they reached."""
    step = F.when(F.col("event_type") == "view", 1).when(F.col("event_type") == "click", 2)
    step = step.when(F.col("event_type") == "signup", 3).when(F.col("event_type") == "purchase", 4)
    return (
        table(spark, folder, "events")
        .groupBy(run_id().alias("run_id"))
        .agg(
            F.coalesce(F.max(step), F.lit(1)).cast("bigint").alias("failed_step_id"),
            F.count_if(F.col("event_type") == "error").alias("error_count"),
        )
        .filter("error_count > 0")
    )


def step_plan(spark, folder):
    plan = audit.remaining_steps(step_frame(spark, EVENT_STEPS), failed_runs(spark, folder))
    return plan.select("run_id", "failed_step_id", "step_id", "step_name",
                       F.col("step_order").cast("double").alias("step_order"))


def step_events(spark, folder):
    """Start and end events: an event of the table is a step that takes `value` seconds."""
    failed = F.col("event_type") == "error"
    base = table(spark, folder, "events").select(
        run_id().alias("run_id"), F.col("event_id").alias("step_id"), F.col("event_type").alias("step_name"), "ts",
        F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.floor("value").cast("decimal(18,6)")).alias("_span"),
        F.get_json_object("props", "$.k").cast("bigint").alias("_k"), failed.alias("_failed"),
    )
    start = base.select(
        "run_id", "step_id", "step_name", F.lit("START").alias("event"), F.col("ts").alias("event_ts"),
        F.lit("RUNNING").alias("status"),
        *[F.lit(0).cast("bigint").alias(c) for c in ("rows_read", "rows_written", "rows_rejected", "rows_updated")],
        F.lit(None).cast("string").alias("error_message"),
    )
    end = base.select(
        "run_id", "step_id", "step_name", F.lit("END").alias("event"), (F.col("ts") + F.col("_span")).alias("event_ts"),
        F.when(F.col("_failed"), "FAILED").otherwise("COMPLETED").alias("status"),
        F.lit(128).cast("bigint").alias("rows_read"), (F.lit(128) - F.col("_k")).alias("rows_written"),
        F.col("_k").alias("rows_rejected"), F.lit(0).cast("bigint").alias("rows_updated"),
        F.when(F.col("_failed"), F.lit("error event")).alias("error_message"),
    )
    return start.unionByName(end)


def step_metrics(spark, folder):
    return audit.step_states(step_events(spark, folder))


def run_metrics(spark, folder):
    return audit.run_states(audit.step_states(step_events(spark, folder)))


def latest_run_steps(spark, folder):
    steps = audit.latest_run(audit.step_states(step_events(spark, folder)))
    return steps.select("run_id", "step_id", "step_name", "status", "rows_read", "rows_written", "error_message")


def daily_log(spark, folder):
    """A log row per day of the event table: the batch of that day."""
    scored = score_rows(table(spark, folder, "events"), check_events(spark, folder))
    marked = scored.select(
        F.date_trunc("day", "ts").cast("timestamp_ntz").alias("dq_start_ts"), (F.col("dq_status") == FAIL).alias("_failed"))
    return marked.groupBy("dq_start_ts").agg(
        F.count(F.lit(1)).alias("overall_count"), F.count_if("_failed").alias("failed_count")
    ).select(
        F.date_format("dq_start_ts", "yyyyMMdd").alias("dq_batch_id"), F.lit("events").alias("table_nm"),
        "dq_start_ts", "overall_count", "failed_count", F.lit("Success").alias("status"),
    )


def current_dq_log(spark, folder):
    """Every event type is taken as a table with a log row per day: its newest one."""
    days = table(spark, folder, "events").groupBy(
        F.col("event_type").alias("table_nm"), F.date_trunc("day", "ts").cast("timestamp_ntz").alias("dq_start_ts")
    ).agg(F.count(F.lit(1)).alias("overall_count"), F.count_if(F.col("value") > 100).alias("failed_count"))
    log = days.withColumns({"layer": F.lit("BRONZE"), "dq_batch_id": F.date_format("dq_start_ts", "yyyyMMdd")})
    return current_log(log)


def latest_dq_log(spark, folder):
    return latest_log(daily_log(spark, folder), 20)


def alert_rows(spark, folder):
    feeds = frame(spark, PART_FEEDS + CUSTOMER_FEEDS + NATION_FEEDS + EVENT_FEEDS, FEED_SCHEMA)
    domains = feeds.select("table_nm", "domain").distinct()
    return audit.alerts(gated(spark, folder), domains, frame(spark, RECIPIENTS, RECIPIENT_SCHEMA))


_REJECTS = f"({LINE_RESULTS_SQL} UNION ALL {PART_RESULTS_SQL})"
_RUN = "user_id || '-' || strftime(ts, '%Y%m%d')"
_STATES = (
    f"SELECT {_RUN} AS run_id, event_id AS step_id, event_type AS step_name, ts AS start_ts, "
    "ts + to_seconds(CAST(floor(value) AS BIGINT)) AS end_ts, CAST(floor(value) AS BIGINT) AS duration_seconds, "
    "CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'COMPLETED' END AS status, CAST(128 AS BIGINT) AS rows_read, "
    "128 - CAST(json_extract_string(props, '$.k') AS BIGINT) AS rows_written, "
    "CAST(json_extract_string(props, '$.k') AS BIGINT) AS rows_rejected, CAST(0 AS BIGINT) AS rows_updated, "
    "CASE WHEN event_type = 'error' THEN 'error event' END AS error_message, "
    "round(CAST(json_extract_string(props, '$.k') AS DOUBLE) / 128 * 100, 2) AS reject_percentage FROM events"
)

QUERIES = {
    "reject_summary": (reject_summary, (
        "SELECT table_nm AS source_table, 'RULE_' || rule_id || '_FEED_' || feed_id AS reject_reason, "
        "count(*) AS reject_count, TIMESTAMP '2001-12-01 00:00:00' AS first_rejected_at, "
        f"TIMESTAMP '2001-12-01 00:00:00' AS last_rejected_at FROM {_REJECTS} WHERE result = 'FAIL' "
        "GROUP BY table_nm, rule_id, feed_id")),
    "reject_records": (reject_records, (
        "SELECT table_nm, r.record_key, string_agg('RULE_' || rule_id || '_FEED_' || feed_id, ',' ORDER BY "
        "'RULE_' || rule_id || '_FEED_' || feed_id) AS reject_reasons, any_value(l_returnflag) AS l_returnflag "
        f"FROM ({LINE_RESULTS_SQL}) r JOIN {LINES_SQL} ON r.record_key = l.row_key WHERE result = 'FAIL' GROUP BY ALL")),
    "step_plan": (step_plan, (
        "SELECT run_id, CAST(failed_step_id AS BIGINT) AS failed_step_id, CAST(s.i AS BIGINT) AS step_id, "
        "s.n AS step_name, CAST(s.o AS DOUBLE) AS step_order FROM ("
        f"SELECT {_RUN} AS run_id, coalesce(max(CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'signup' "
        "THEN 3 WHEN 'purchase' THEN 4 END), 1) AS failed_step_id, count(*) FILTER (event_type = 'error') AS errors "
        "FROM events GROUP BY 1) r "
        "JOIN (VALUES (1, 1.0), (2, 2.0), (3, 3.5), (4, 3.0)) AS f(i, o) ON f.i = r.failed_step_id "
        "JOIN (VALUES (1, 'view', 1.0), (2, 'click', 2.0), (3, 'signup', 3.5), (4, 'purchase', 3.0)) AS s(i, n, o) "
        "ON s.o >= f.o WHERE errors > 0")),
    "step_metrics": (step_metrics, _STATES),
    "run_metrics": (run_metrics, (
        "SELECT run_id, min(start_ts) AS start_ts, max(end_ts) AS end_ts, "
        "CAST(sum(rows_read) AS BIGINT) AS total_rows_read, CAST(sum(rows_written) AS BIGINT) AS total_rows_written, "
        "CAST(sum(rows_rejected) AS BIGINT) AS total_rows_rejected, count(*) AS total_steps, "
        "CAST(count(*) FILTER (status = 'COMPLETED') AS BIGINT) AS completed_steps, "
        "min(CASE WHEN status = 'FAILED' THEN step_id END) AS failed_step_id, "
        "CASE WHEN bool_or(status = 'FAILED') THEN 'FAILED' ELSE 'COMPLETED' END AS run_status, "
        "date_diff('second', min(start_ts), max(end_ts)) AS duration_seconds "
        f"FROM ({_STATES}) GROUP BY run_id")),
    "current_dq_log": (current_dq_log, (
        "SELECT event_type AS table_nm, CAST(date_trunc('day', ts) AS TIMESTAMP) AS dq_start_ts, count(*) AS "
        "overall_count, CAST(count(*) FILTER (value > 100) AS BIGINT) AS failed_count, 'BRONZE' AS layer, "
        "strftime(date_trunc('day', ts), '%Y%m%d') AS dq_batch_id FROM events GROUP BY event_type, "
        "date_trunc('day', ts) QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY date_trunc('day', ts) "
        "DESC) = 1")),
    "latest_run_steps": (latest_run_steps, (
        f"SELECT run_id, step_id, step_name, status, rows_read, rows_written, error_message FROM ({_STATES}) "
        f"WHERE run_id = (SELECT run_id FROM ({_STATES}) ORDER BY start_ts DESC, run_id DESC LIMIT 1)")),
    "latest_dq_log": (latest_dq_log, (
        "SELECT strftime(date_trunc('day', ts), '%Y%m%d') AS dq_batch_id, 'events' AS table_nm, "
        "CAST(date_trunc('day', ts) AS TIMESTAMP) AS dq_start_ts, count(*) AS overall_count, "
        "CAST(count(*) FILTER (value > 100) AS BIGINT) AS failed_count, 'Success' AS status FROM events "
        "GROUP BY date_trunc('day', ts) ORDER BY dq_start_ts DESC LIMIT 20")),
    "alert_rows": (alert_rows, (
        f"SELECT '{BATCH}' AS dq_batch_id, 'part' AS table_nm, 'PARTS' AS domain, e AS recipient, "
        "'EMAIL' AS notification_type, 'DQ_THRESHOLD' AS event_type, 'PENDING' AS send_status "
        "FROM (VALUES ('parts@lake.example'), ('quality@lake.example')) AS v(e) WHERE (SELECT count(*) FILTER "
        "(p_name <> upper(p_name)) * 100.0 / count(*) FROM part) > 90 UNION ALL "
        "SELECT 'batch-2', 'customer', 'CUSTOMERS', 'customers@lake.example', 'EMAIL', 'DQ_THRESHOLD', 'PENDING' "
        "WHERE (SELECT round(count(*) FILTER (c_acctbal < 0) * 100.0 / count(*), 2) FROM customer) > 5 UNION ALL "
        "SELECT 'batch-3', 'nation', 'CUSTOMERS', 'customers@lake.example', 'EMAIL', 'DQ_THRESHOLD', 'PENDING' "
        "WHERE (SELECT round(count(*) FILTER (n_regionkey NOT IN (0, 1, 2, 3)) * 100.0 / count(*), 2) FROM nation) "
        "> 10")),
}

