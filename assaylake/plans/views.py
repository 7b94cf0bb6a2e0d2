"""Monitoring reports of a load as views, to be read by name."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from assaylake.operators.audit import EVENT_SCHEMA, run_states, step_states
from assaylake.operators.evaluate import RESULT_SCHEMA
from assaylake.operators.profile import register_views
from assaylake.operators.summary import category_rollup, current_log, status_distribution_all, violations_by_rule
from assaylake.plans.checks import LOG_SCHEMA
from assaylake.sources.lake import Lake
from assaylake.sources.metadata import CATEGORIES, CATEGORY_SCHEMA, RULE_SCHEMA, Rule, frame


def monitoring_views(lake: Lake, tables: Mapping[str, DataFrame], rules: list[Rule]) -> None:
    """Statuses, failures per rule, dimension totals, current log, step and run states."""
    results = lake.read("audit", "dq_result", RESULT_SCHEMA)
    states = step_states(lake.read("audit", "step_event", EVENT_SCHEMA).filter("step_id is not null"))
    register_views({
        "dq_status": status_distribution_all(tables),
        "dq_failures": violations_by_rule(results, only_failed=True),
        "dq_categories": category_rollup(
            results, frame(lake.spark, rules, RULE_SCHEMA), frame(lake.spark, CATEGORIES, CATEGORY_SCHEMA)),
        "dq_current_log": current_log(lake.read("audit", "dq_log", LOG_SCHEMA).filter("feed_id is null")),
        "step_states": states,
        "run_states": run_states(states),
    })
