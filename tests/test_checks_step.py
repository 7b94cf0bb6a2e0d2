"""The check step on a lake: run-time errors of one feed, growing tables, duplicates among all rows."""

from assaylake.operators.evaluate import evaluate, merge_statuses, score_rows
from assaylake.operators.rules import plan_checks
from assaylake.plans.checks import LOG_SCHEMA, run_checks
from assaylake.sources.lake import Lake
from assaylake.sources.metadata import RULES, Feed, Rule, frame

SCHEMA = "k bigint, v string, dq_status string"
CLOCK = "2024-01-01 00:00:00"
SETTINGS = {"DQ_BRONZE_THRESHOLD": "50"}
UNSAFE = [*RULES, Rule(200, 6, "UNSAFE", "", "CAST(${INPUT1} AS INT) > 5", "SIMPLE")]
FEEDS = [
    Feed(1, "BRONZE", "D", 200, "t", "k", None, "v"),
    Feed(2, "BRONZE", "D", 2, "t", "k", None, "v"),
    Feed(3, "BRONZE", "D", 2, "t", "k", None, "absent"),
    Feed(4, "BRONZE", "D", 1, "t", "k", None, "v", "N"),
]


def step(lake, **kwargs):
    checks = plan_checks(UNSAFE, FEEDS, "t", "BRONZE")
    return run_checks(lake, "BRONZE", "t", SCHEMA, checks, batch_id="b", as_of=CLOCK, settings=SETTINGS, **kwargs)


def statuses(lake):
    return {r["k"]: r["dq_status"] for r in lake.read("BRONZE", "t", SCHEMA).collect()}


def test_one_feed_fails_at_run_time(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.append("BRONZE", "t", frame(spark, [(1, "x", None), (2, None, None), (3, "x", None)], SCHEMA))
    result = step(lake)
    assert (result["status"], result["total_records"], result["failed_records"]) == ("COMPLETED", 3, 1)
    assert statuses(lake) == {1: "PASS-SOFT", 2: "FAIL", 3: "PASS"}
    log = lake.read("audit", "dq_log", LOG_SCHEMA)
    assert {r["feed_id"] for r in log.filter("status = 'Fail'").collect()} == {1, 3}

    # Later parts are checked alone, earlier statuses stay.
    lake.append("BRONZE", "t", frame(spark, [(4, "x", None), (5, "9", None)], SCHEMA))
    assert statuses(lake)[4] is None
    assert step(lake)["total_records"] == 2
    assert statuses(lake) == {1: "PASS-SOFT", 2: "FAIL", 3: "PASS", 4: "PASS", 5: "PASS"}
    assert step(lake)["total_records"] == 0
    lake.replace("BRONZE", "t", frame(spark, [(9, None, None)], SCHEMA))
    assert step(lake)["threshold_exceeded"]
    assert statuses(lake) == {9: "FAIL"}


def test_key_shared_by_rows(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.append("BRONZE", "t", frame(spark, [(1, "x", None), (1, None, None), (2, "y", None)], SCHEMA))
    result = step(lake, unique_key=False)
    assert result["failed_records"] == 1
    assert sorted(r["dq_status"] for r in lake.read("BRONZE", "t", SCHEMA).collect()) == ["FAIL", "FAIL", "PASS"]


def test_unfinished_write_is_not_seen(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.append("BRONZE", "t", frame(spark, [(1, "x", None)], SCHEMA))
    frame(spark, [(7, "left by a step that failed", None)], SCHEMA).write.parquet(str(tmp_path / "bronze/t/part=xfailed"))
    assert statuses(lake) == {1: None}
    lake.append("BRONZE", "t", frame(spark, [(2, "y", None)], SCHEMA))
    assert set(statuses(lake)) == {1, 2}
    lake.replace("BRONZE", "t", frame(spark, [(3, "z", None)], SCHEMA))
    assert set(statuses(lake)) == {3}


def test_duplicates_among_all_rows(spark):
    df = frame(spark, [(1, "x", "PASS"), (9, "x", "PASS"), (5, "x", None), (6, "y", None)], SCHEMA)
    checks = plan_checks(RULES, [Feed(4, "BRONZE", "D", 1, "t", "k", None, "v")], "t", "BRONZE")

    def found(**kwargs):
        return [r["record_key"] for r in evaluate(df, checks, batch_id="b", as_of=CLOCK, **kwargs).results.collect()]

    assert found() == []
    assert found(duplicates_among="all") == ["5"]
    assert found(duplicates_among="all", unique_key=False) == ["5"]


def test_failed_critical_feeds_are_listed_or_close_the_gate(spark, tmp_path):
    rows = frame(spark, [(1, "x", None), (2, None, None)], SCHEMA)
    lake = Lake(spark, f"{tmp_path}/open")
    lake.append("BRONZE", "t", rows)
    assert sorted(step(lake)["failed_critical_feeds"]) == [1, 3]
    lake = Lake(spark, f"{tmp_path}/closed")
    lake.append("BRONZE", "t", rows)
    result = step(lake, fail_closed=True)
    assert result["status"] == "FAILED" and result["threshold_exceeded"] and "[3, 1]" in result["error"]
    assert statuses(lake) == {1: None, 2: None}


def test_feeds_with_different_keys(spark):
    df = frame(spark, [(1, "b", None), (2, "1", None)], SCHEMA)
    rules = [Rule(1, 1, "", "", "${COL1} = 'b'", "MULTIPLE"), Rule(2, 1, "", "", "", "COMPLEX")]
    feeds = [Feed(1, "BRONZE", "D", 1, "t", "nothing", None, "v"), Feed(2, "BRONZE", "D", 1, "t", "v", None, "v", "N"),
             Feed(3, "BRONZE", "D", 2, "t", "k", None, "v", "Y", dq_rule_input_join_tbl="r", dq_rule_input_join_col="v")]
    reference = frame(spark, [("b",)], "v string")
    outcome = evaluate(df, plan_checks(rules, feeds, "t", "BRONZE"), batch_id="b", as_of=CLOCK, tables={"r": reference})
    assert [c.feed.feed_id for c, _ in outcome.errors] == [1]
    for scored in (score_rows(df, outcome), merge_statuses(df, outcome.results, outcome.keys)):
        assert {r["k"]: r["dq_status"] for r in scored.collect()} == {1: "PASS-SOFT", 2: "FAIL"}
