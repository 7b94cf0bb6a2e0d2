"""The provider load on its golden input: statuses, violations, history, fact, rejects, resume."""

from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from assaylake.operators.audit import EVENT_SCHEMA, step_states
from assaylake.operators.evaluate import RESULT_SCHEMA
from assaylake.operators.summary import status_distribution
from assaylake.plans.checks import LOG_SCHEMA
from assaylake.plans.provider import DIM_PROVIDER, RAW_REGISTRY, RAW_SPECIALTY, STG_REGISTRY, STG_SPECIALTY, ProviderLoad
from assaylake.sources.lake import Lake
from assaylake.sources.metadata import frame
from tests.fixtures import registry_rows, specialty_rows

DAY_ONE, DAY_TWO = "2026-06-18 00:00:00", "2026-06-19 00:00:00"
SECOND_LOAD = datetime(2026, 6, 18, 12)


def load(spark, root, registry=None, specialties=None, as_of=DAY_ONE, **kwargs):
    return ProviderLoad(
        Lake(spark, str(root)),
        frame(spark, registry_rows() if registry is None else registry, RAW_REGISTRY),
        frame(spark, specialty_rows() if specialties is None else specialties, RAW_SPECIALTY),
        as_of,
        **kwargs,
    )


def counts(df):
    return {r["dq_status"]: r["cnt"] for r in status_distribution(df).collect()}


def read(job, layer, table, ddl):
    return job.lake.read(layer, table, ddl)


@pytest.fixture(scope="module")
def first(spark, tmp_path_factory):
    job = load(spark, tmp_path_factory.mktemp("lake"))
    return job, job.run("FULL")


def test_run_completes_all_steps(first):
    _, result = first
    assert result["status"] == "COMPLETED", result
    assert result["steps_completed"] == 8
    assert result["steps"]["STG_NPI_REGISTRY"]["rows_written"] == 15


def test_bronze_statuses(first):
    job, _ = first
    assert counts(job.lake.read("bronze", "stg_npi_registry", STG_REGISTRY)) == {"PASS": 10, "PASS-SOFT": 2, "FAIL": 3}
    assert counts(job.lake.read("bronze", "stg_specialty_type", STG_SPECIALTY)) == {
        "PASS": 11, "PASS-SOFT": 3, "FAIL": 1,
    }


def test_violations(first):
    job, _ = first
    results = read(job, "audit", "dq_result", RESULT_SCHEMA)
    found = {(r["table_nm"], r["feed_id"], r["result"]): r["count"] for r in
             results.groupBy("table_nm", "feed_id", "result").count().collect()}
    assert found == {
        ("stg_npi_registry", 1, "FAIL"): 1,
        ("stg_npi_registry", 2, "FAIL"): 2,
        ("stg_npi_registry", 3, "FAIL"): 1,
        ("stg_npi_registry", 4, "FAIL"): 1,
        ("stg_npi_registry", 6, "PASS-SOFT"): 1,
        ("stg_npi_registry", 7, "PASS-SOFT"): 1,
        ("stg_specialty_type", 8, "FAIL"): 1,
        ("stg_specialty_type", 11, "PASS-SOFT"): 4,
        ("dim_provider", 203, "PASS-SOFT"): 1,
    }


def test_log_and_gate(first):
    job, result = first
    log = {r["table_nm"]: (r["overall_count"], r["failed_count"]) for r in read(job, "audit", "dq_log", LOG_SCHEMA).collect()}
    assert log == {"stg_npi_registry": (15, 3), "stg_specialty_type": (15, 1), "dim_provider": (12, 0)}
    tables = result["steps"]["DQ_CHECK_BRONZE"]["tables"]
    assert tables["stg_npi_registry"]["fail_pct"] == 20.0
    assert tables["stg_specialty_type"]["fail_pct"] == 6.67
    assert not tables["stg_npi_registry"]["threshold_exceeded"]


def test_dimension(first):
    job, _ = first
    dimension = job.lake.read("silver", "dim_provider", DIM_PROVIDER)
    assert counts(dimension) == {"PASS": 11, "PASS-SOFT": 1}
    missing = dimension.filter("primary_specialty is null").select("provider_bk").collect()
    assert [r[0] for r in missing] == ["3333333333"]
    soft = dimension.filter("dq_status = 'PASS-SOFT'").select("provider_bk").collect()
    assert [r[0] for r in soft] == ["2222222222"]


def test_history_and_fact(first):
    job, result = first
    step = result["steps"]["SCD2_PROVIDER_ATTRIBUTES"]
    assert (step["new_versions"], step["closed_versions"]) == (12, 0)
    fact = job.fact("x")
    assert fact.count() == 12
    genders = {r["gender_desc"] for r in fact.select("gender_desc").distinct().collect()}
    assert genders == {"Male", "Female"}


def test_reject_summary(first):
    job, _ = first
    ddl = "source_table string, reject_reason string, reject_count bigint"
    rows = {(r[0], r[1]): r[2] for r in read(job, "reject", "reject_summary", ddl).collect()}
    assert rows == {
        ("stg_npi_registry", "RULE_2_FEED_1"): 1,
        ("stg_npi_registry", "RULE_2_FEED_2"): 2,
        ("stg_npi_registry", "RULE_4_FEED_3"): 1,
        ("stg_npi_registry", "RULE_6_FEED_4"): 1,
        ("stg_specialty_type", "RULE_2_FEED_8"): 1,
    }


def test_step_events(first):
    job, result = first
    states = step_states(read(job, "audit", "step_event", EVENT_SCHEMA).filter("step_id is not null")).collect()
    assert len(states) == 8
    assert {s["status"] for s in states} == {"COMPLETED"}
    bronze = next(s for s in states if s["step_name"] == "DQ_CHECK_BRONZE")
    assert (bronze["rows_read"], bronze["rows_rejected"]) == (30, 4)


def test_views(spark, first):
    job, result = first
    job.register_views()
    failures = {(r["table_nm"], r["rule_id"]): r["cnt"] for r in spark.table("dq_failures").collect()}
    assert failures == {("stg_npi_registry", 2): 3, ("stg_npi_registry", 4): 1, ("stg_npi_registry", 6): 1,
                        ("stg_specialty_type", 2): 1}
    assert spark.table("dq_status").agg(F.sum("cnt")).first()[0] == 42
    assert spark.table("dq_current_log").count() == 3
    run = spark.table("run_states").first()
    assert (run["run_id"], run["run_status"], run["completed_steps"]) == (result["run_id"], "COMPLETED", 8)
    assert spark.table("dq_categories").filter("category_nm = 'Completeness'").first()["failed_count"] == 4


def test_second_runs(spark, tmp_path):
    rows = registry_rows()
    assert load(spark, tmp_path).run("FULL")["status"] == "COMPLETED"

    # Nothing new: the mark skips every row, ties included, and the history stays.
    again = load(spark, tmp_path, as_of=DAY_TWO).run("INCREMENTAL")
    assert again["steps"]["STG_NPI_REGISTRY"]["rows_read"] == 0
    step = again["steps"]["SCD2_PROVIDER_ATTRIBUTES"]
    assert (step["new_versions"], step["closed_versions"]) == (0, 0)

    # One changed credential, one new provider, one row that ties with the mark.
    changed = (*rows[0][:4], "DO", *rows[0][5:13], SECOND_LOAD, *rows[0][14:])
    new = ("4444444444", *rows[1][1:13], SECOND_LOAD, *rows[1][14:])
    tie = ("5555555555", *rows[2][1:])
    job = load(spark, tmp_path, registry=rows + [changed, new, tie], as_of=DAY_TWO)
    third = job.run("INCREMENTAL")
    assert third["status"] == "COMPLETED", third
    assert third["steps"]["STG_NPI_REGISTRY"]["rows_read"] == 2
    step = third["steps"]["SCD2_PROVIDER_ATTRIBUTES"]
    assert (step["new_versions"], step["closed_versions"]) == (2, 1)
    history = job.history()
    assert history.count() == 14
    assert history.filter("_is_current").groupBy("provider_bk").count().filter("count > 1").count() == 0
    old = history.filter("provider_bk = '1234567890' and not _is_current").first()
    assert (old["credential"], str(old["_valid_to"])) == ("MD", DAY_TWO)
    assert job.fact("x").count() == 14
    assert replace(job, current_only=True).fact("x").count() == 13
    only_changed = job.lake.read("silver", "dim_provider", DIM_PROVIDER).filter(F.col("update_dt").isNotNull())
    assert [r["provider_bk"] for r in only_changed.collect()] == ["1234567890"]


def test_gate_stops_and_resume_continues(spark, tmp_path):
    strict = {"DQ_BRONZE_THRESHOLD": "10.00", "DQ_SILVER_THRESHOLD": "90.00", "ENABLE_SCD2": "TRUE",
              "ENABLE_EMAIL_NOTIFY": "TRUE"}
    stopped = load(spark, tmp_path, settings=strict).run("FULL")
    assert stopped["status"] == "FAILED"
    assert stopped["failed_step"] == "DQ_CHECK_BRONZE"
    assert stopped["error"] == "DQ_THRESHOLD_EXCEEDED"
    relaxed = {**strict, "DQ_BRONZE_THRESHOLD": "90.00"}
    job = load(spark, tmp_path, settings=relaxed)
    resumed = job.run("RESUME", stopped["run_id"])
    assert resumed["status"] == "COMPLETED", resumed
    assert "STG_NPI_REGISTRY" not in resumed["steps"]
    assert job.fact("x").count() == 12
    sent = read(job, "audit", "notification", "event_type string").groupBy("event_type").count().collect()
    assert {r[0]: r[1] for r in sent} == {
        "RUN_START": 2, "STEP_FAILURE": 1, "RUN_FAILURE": 1, "RUN_COMPLETE": 1,
    }


def test_broken_table_fails_closed(spark, tmp_path):
    job = load(spark, tmp_path)
    job.rules = None  # no rules can be planned
    result = job.run("FULL")
    assert result["status"] == "FAILED"
    assert result["failed_step"] == "DQ_CHECK_BRONZE"
