"""Run the steps of a load in order, record their events, stop at a failure, resume there."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from datetime import datetime

from pyspark.sql import functions as F

from assaylake.operators.audit import EVENT_SCHEMA, step_states
from assaylake.operators.evaluate import RESULT_SCHEMA
from assaylake.plans.checks import LOG_SCHEMA
from assaylake.sources.lake import Lake
from assaylake.sources.metadata import Step, frame

NOTIFICATION_SCHEMA = "run_id string, notification_type string, event_type string, send_status string"

StepFunction = Callable[[str, str], dict]  # (run id, mode) -> result with a "status"


# Small parts of the tables that only grow are written together once there are so many.
PARTS_TO_COMPACT = 24
COMMITS_KEPT = 60


class Events:
    """Run, step and error events; nothing is updated in place. Those of a step are written together."""

    def __init__(self, lake: Lake, run_id: str, notify: bool):
        self.lake, self.run_id, self.notify_enabled = lake, run_id, notify
        self.events: list[tuple] = []
        self.notices: list[tuple] = []

    def add(self, event: str, step: Step | None = None, result: Mapping | None = None) -> None:
        result = result or {}
        self.events.append((
            self.run_id,
            step.step_id if step else None,
            step.step_name if step else None,
            event,
            datetime.now(),
            result.get("status", "RUNNING"),
            *(result.get(c, 0) for c in ("rows_read", "rows_written", "rows_rejected", "rows_updated")),
            result.get("error") or result.get("reason"),
        ))

    def notify(self, event: str) -> None:
        if self.notify_enabled:
            self.notices.append((self.run_id, "EMAIL", event, "PENDING"))

    def write(self) -> None:
        spark = self.lake.spark
        with self.lake.change() as change:
            if self.events:
                change.append("audit", "step_event", frame(spark, self.events, EVENT_SCHEMA).coalesce(1))
            if self.notices:
                change.append("audit", "notification", frame(spark, self.notices, NOTIFICATION_SCHEMA).coalesce(1))
        self.events, self.notices = [], []


def completed_steps(lake: Lake, run_id: str) -> set[int]:
    events = lake.read("audit", "step_event", EVENT_SCHEMA).filter((F.col("run_id") == run_id) & F.col("step_id").isNotNull())
    return {r["step_id"] for r in step_states(events).filter(F.col("status") == "COMPLETED").select("step_id").collect()}


def maintain(lake: Lake) -> None:
    """Write the small parts of growing tables together and delete what no recent commit needs."""
    for table, schema, by in (
        ("step_event", EVENT_SCHEMA, ()), ("notification", NOTIFICATION_SCHEMA, ()), ("dq_log", LOG_SCHEMA, ()),
        ("dq_result", RESULT_SCHEMA, ("dq_batch_id",)),
    ):
        lake.compact("audit", table, schema, by, at_least=PARTS_TO_COMPACT)
    lake.remove_old(keep=COMMITS_KEPT)


def run_package(
    lake: Lake,
    steps: list[tuple[Step, StepFunction]],
    mode: str = "INCREMENTAL",
    resume_run_id: str | None = None,
    notify: bool = False,
) -> dict:
    """Run all active steps by step order. RESUME continues a run from its first step that has not completed."""
    active = sorted((s for s in steps if s[0].is_active), key=lambda s: s[0].step_order)
    run_id = resume_run_id if mode == "RESUME" and resume_run_id else str(uuid.uuid4())
    if mode == "RESUME" and resume_run_id:
        done = completed_steps(lake, run_id)
        start = next((s.step_order for s, _ in active if s.step_id not in done), active[0][0].step_order)
        active = [(s, f) for s, f in active if s.step_order >= start]
    events = Events(lake, run_id, notify)
    events.add("RUN_START")
    events.notify("RUN_START")
    results = {}
    for step, function in active:
        events.add("START", step)
        try:
            result = function(run_id, "INCREMENTAL" if mode == "RESUME" else mode)
        except Exception as error:  # a raising step is a failed step
            events.add("ERROR", step, {"status": "FAILED", "error": str(error)})
            result = {"status": "FAILED", "error": str(error)}
        events.add("END", step, result)
        if result.get("status") == "COMPLETED":
            events.write()
        results[step.step_name] = result
        if result.get("status") != "COMPLETED":
            message = result.get("error") or result.get("reason") or "step failed"
            events.notify("STEP_FAILURE")
            events.add("RUN_END", None, {"status": "FAILED", "error": message})
            events.notify("RUN_FAILURE")
            events.write()
            return {
                "run_id": run_id, "status": "FAILED", "failed_step": step.step_name, "error": message,
                "steps": results,
            }
    events.add("RUN_END", None, {"status": "COMPLETED"})
    events.notify("RUN_COMPLETE")
    events.write()
    maintain(lake)
    return {"run_id": run_id, "status": "COMPLETED", "steps_completed": len(results), "steps": results}
