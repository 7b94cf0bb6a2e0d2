"""The check step of a layer: evaluate, record violations, write statuses back, gate."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import replace
from datetime import datetime

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from assaylake.functions.columns import FAIL
from assaylake.operators.evaluate import ERROR, Evaluation, evaluate, merge_statuses, pending_rows, recorded, score_rows
from assaylake.operators.rules import Check
from assaylake.operators.summary import failed_records, gate
from assaylake.sources.lake import Change, Lake, observed
from assaylake.sources.metadata import as_schema, frame

LOG_SCHEMA = (
    "dq_batch_id string, layer string, domain string, table_nm string, feed_id bigint, dq_start_ts timestamp_ntz, "
    "dq_end_ts timestamp_ntz, error_message string, overall_count bigint, failed_count bigint, status string"
)


def log_rows(target: Lake | Change, rows: Iterable[tuple]) -> None:
    lake = target if isinstance(target, Lake) else target.lake
    target.append("audit", "dq_log", frame(lake.spark, list(rows), LOG_SCHEMA).coalesce(1))


def run_checks(
    lake: Lake,
    layer: str,
    table: str,
    schema: str,
    checks: list[Check],
    *,
    batch_id: str,
    as_of: str,
    settings: Mapping[str, object],
    tables: Mapping[str, DataFrame] | None = None,
    unique_key: bool = True,
    fail_closed: bool = False,
) -> dict:
    """Check the pending rows of a table. A run that cannot finish reports FAILED, which stops the package.

    A feed that cannot be evaluated, or fails on some row, is logged and left out; the outcome lists the
    critical ones as `failed_critical_feeds`. With `fail_closed` such a feed fails the run before any
    status is written. Violations, statuses and the log become visible in one commit.
    """
    started = datetime.now()

    def log(domain, feed_id, message, total, failed, status):
        return (batch_id, layer, domain, table, feed_id, started, datetime.now(), message, total, failed, status)

    try:
        rows, waiting = lake.read_pending(layer, table, schema)
        if not waiting or pending_rows(rows).isEmpty():
            log_rows(lake, [log(None, None, None, 0, 0, "Success")])
            return _outcome(lake, layer, table, batch_id, 0, 0, settings)

        with lake.change() as change:
            outcome, found = _record(change, rows, checks, batch_id, as_of, tables, unique_key)
            critical = [check.feed.feed_id for check, _ in outcome.errors if check.result == FAIL]
            errors = [log(c.feed.domain, c.feed.feed_id, message, 0, 0, "Fail") for c, message in outcome.errors]
            if critical and fail_closed:
                log_rows(lake, errors)
                raise ValueError(f"critical feeds that cannot be evaluated: {critical}")
            marked = rows.withColumn("_pending", F.col("dq_status").isNull())
            if unique_key:
                scored = score_rows(marked, recorded(outcome, found))
            else:
                scored = merge_statuses(marked, found, outcome.keys)
            seen = Observation()
            failing = F.col("_pending") & (F.col("dq_status") == FAIL)
            scored = scored.observe(seen, F.count_if("_pending").alias("total"), F.count_if(failing).alias("failed"))
            change.replace_pending(layer, table, scored.select(*as_schema(schema).names), waiting)
            counts = observed(seen, "total", "failed")
            total, failed = counts["total"], counts["failed"]
            if not unique_key:  # several rows may share a failed key
                failed = failed_records(found).first()["failed_count"]
            log_rows(change, [*errors, log(None, None, None, total, failed, "Success")])
        return {**_outcome(lake, layer, table, batch_id, total, failed, settings), "failed_critical_feeds": critical}
    except Exception as error:  # reported to the caller as a failed step
        log_rows(lake, [log(None, None, str(error), 0, 0, "Fail")])
        return {"status": "FAILED", "table": table, "layer": layer, "error": str(error), "threshold_exceeded": True}


def _record(change: Change, rows, checks, batch_id, as_of, tables, unique_key) -> tuple[Evaluation, DataFrame]:
    """Write the violations, and count in the same pass the rows that each expression fails on.

    Feeds with such rows are left out, which takes a pass over the violations only. If a check fails in a way
    that its expression does not show, the checks are tried one by one, so that one bad feed does not hide
    the others.
    """

    def attempt(chosen: list[Check]) -> tuple[Evaluation, DataFrame]:
        outcome = evaluate(
            rows, chosen, batch_id=batch_id, as_of=as_of, tables=tables, unique_key=unique_key, capture_errors=True)
        by = ("dq_batch_id",)
        if not outcome.fallible:
            return outcome, change.append("audit", "dq_result", outcome.results, by)
        seen = Observation()
        failed = F.col("result") == ERROR
        counts = [F.count_if(failed & (F.col("feed_id") == feed)).alias(str(feed)) for feed in outcome.fallible]
        found = change.append("audit", "dq_result", outcome.captured.observe(seen, *counts), by)
        broken = {int(feed): n for feed, n in observed(seen).items() if n}
        if not broken:
            return outcome, found
        change.remove(change.added[-1:])
        left = change.append("audit", "dq_result", found.filter(~F.col("feed_id").isin(list(broken))), by)
        errors = [(c, f"the expression fails on {broken[c.feed.feed_id]} rows") for c in chosen if c.feed.feed_id in broken]
        return replace(
            outcome, results=left, errors=outcome.errors + errors,
            checks=[c for c in outcome.checks if c.feed.feed_id not in broken],
            keys={feed: key for feed, key in outcome.keys.items() if feed not in broken},
            conditions=[(c, x) for c, x in outcome.conditions if c.feed.feed_id not in broken]), left

    try:
        return attempt(checks)
    except PySparkException:
        good, bad = [], []
        for check in checks:
            alone = evaluate(rows, [check], batch_id=batch_id, as_of=as_of, tables=tables, unique_key=unique_key)
            try:
                alone.results.write.format("noop").mode("overwrite").save()
                good.append(check)
            except PySparkException as error:
                bad.append((check, str(error)))
        if not bad:
            raise
        outcome, found = attempt(good)
        return replace(outcome, errors=outcome.errors + bad), found


def _outcome(lake, layer, table, batch_id, total, failed, settings) -> dict:
    pct = round(failed / total * 100, 2) if total else 0.0
    row = (batch_id, layer, table, total, failed, pct)
    summary = frame(
        lake.spark,
        [row],
        "dq_batch_id string, layer string, table_nm string, overall_count bigint, failed_count bigint, fail_pct double",
    )
    decided = gate(summary, settings).first()
    return {
        "status": decided["status"],
        "table": table,
        "layer": layer,
        "total_records": total,
        "failed_records": failed,
        "fail_pct": pct,
        "threshold_exceeded": decided["threshold_exceeded"],
    }
