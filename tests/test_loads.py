"""Loads: marks, upsert, history, keys, gates."""

from datetime import datetime

from pyspark.sql import functions as F

from assaylake.functions.columns import percent, seconds_between
from assaylake.operators import loads
from assaylake.operators.evaluate import evaluate, merge_status, reset_status, score_rows
from assaylake.operators.profile import overlapping_versions
from assaylake.operators.rules import plan_checks
from assaylake.operators.summary import failed_records, gate, gate_all, summarize
from assaylake.sources.metadata import RULES, Feed, frame

T1, T2 = "2024-01-01 00:00:00", "2024-02-01 00:00:00"


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_mark_is_strict_and_defaults_to_1900(spark):
    source = frame(spark, [(1, datetime(2024, 1, 1)), (2, datetime(2024, 1, 2))], "k int, t timestamp_ntz")
    empty = frame(spark, [], "t timestamp_ntz")
    assert str(loads.high_water_mark(empty, "t").first()["hwm"]) == "1900-01-01 00:00:00"
    assert loads.newer_than_mark(source, "t", empty, "t").count() == 2
    assert rows(loads.newer_than_mark(source, "t", source.filter("k = 1"), "t"), "k") == [(2,)]
    assert loads.newer_than_mark(source, "t", source, "t").count() == 0


def test_mark_literal_reaches_the_scan(spark, tmp_path):
    frame(spark, [(1, datetime(2024, 1, 1))], "k int, t timestamp_ntz").write.parquet(str(tmp_path / "t"))
    plan = loads.newer_than(spark.read.parquet(str(tmp_path / "t")), "t", T1)._jdf.queryExecution().toString()
    assert "GreaterThan(t," in plan


DIM = "bk string, a string, b string, load_dt timestamp_ntz, update_dt timestamp_ntz, row_status string, dq_status string"


def test_upsert(spark):
    day = datetime(2024, 1, 1)
    target = frame(spark, [
        ("same", "x", "keep", day, None, "ACTIVE", "PASS"),
        ("changed", "x", "keep", day, None, "ACTIVE", "FAIL"),
        ("nulled", "x", "keep", day, None, "ACTIVE", "PASS"),
        ("absent", "x", "keep", day, None, "ACTIVE", "PASS-SOFT"),
    ], DIM)
    source = frame(spark, [("same", "x", "n"), ("changed", "y", "n"), ("nulled", None, "n"), ("new", "z", "n"),
                           (None, "q", "n")], "bk string, a string, b string")
    got = rows(loads.upsert(target, source, "bk", ["a"], T2), "bk", "a", "b", "dq_status",
               F.col("update_dt").isNotNull())
    assert got == sorted([
        ("same", "x", "keep", "PASS", False),
        ("changed", "y", "keep", None, True),
        ("nulled", None, "keep", None, True),
        ("absent", "x", "keep", "PASS-SOFT", False),
        ("new", "z", "n", None, False),
        (None, "q", "n", None, False),
    ], key=str)
    reset = rows(loads.upsert(target, source, "bk", ["a"], T2, reset_unchanged=True), "bk", "dq_status")
    assert ("same", None) in reset and ("absent", "PASS-SOFT") in reset


HISTORY = (
    "scd_key string, bk string, v string, _valid_from timestamp_ntz, _valid_to timestamp_ntz, _is_current boolean, "
    "_hash_diff string, _run_id string"
)


def source_of(spark, pairs):
    dim = frame(spark, [(k, v, "PASS") for k, v in pairs], "bk string, v string, dq_status string")
    return loads.version_source(dim, "bk", {"v": "v"})


def test_history_over_four_loads(spark):
    history = frame(spark, [], HISTORY)
    batches = [[("a", "1"), ("b", "1"), ("n", None)], [("a", "1"), ("b", "2"), ("c", "1")], [("b", "1")],
               [("b", "1"), ("n", "x")]]
    for i, pairs in enumerate(batches, 1):
        history = loads.merge_versions(history, source_of(spark, pairs), "bk", f"r{i}", f"2024-0{i}-01 00:00:00")
        current = history.filter("_is_current").groupBy("bk").count()
        assert current.filter("count > 1").count() == 0
        again = loads.merge_versions(history, source_of(spark, pairs), "bk", "again", f"2024-0{i}-01 00:00:00")
        assert again.exceptAll(history).count() == 0 and history.exceptAll(again).count() == 0
    got = rows(history, "bk", "v", F.date_format("_valid_from", "MM"), F.date_format("_valid_to", "yyyyMM"), "_is_current")
    assert got == sorted([
        ("a", "1", "01", "999912", True),
        ("b", "1", "01", "202402", False),
        ("b", "2", "02", "202403", False),
        ("b", "1", "03", "999912", True),
        ("c", "1", "02", "999912", True),
        ("n", None, "01", "202404", False),
        ("n", "x", "04", "999912", True),
    ], key=str)
    assert overlapping_versions(history, "bk").count() == 0


def test_merge_has_one_join(spark):
    history = frame(spark, [], HISTORY)
    plan = loads.version_changes(history, source_of(spark, [("a", "1")]), "bk", "r", T1)
    assert plan._jdf.queryExecution().analyzed().toString().count("Join FullOuter") == 1


def test_closed_and_new_parts_agree_with_the_merge(spark):
    first = loads.merge_versions(frame(spark, [], HISTORY), source_of(spark, [("a", "1"), ("b", "1")]), "bk", "r1", T1)
    source = source_of(spark, [("a", "2"), ("c", "1")])
    assert rows(loads.changed_versions(first, source, "bk"), "bk") == [("a",)]
    assert rows(loads.new_versions(first, source, "bk"), "bk") == [("a",), ("c",)]


def test_overlaps_inside_and_across_days(spark):
    def at(day, hour):
        return datetime(2024, 1, day, hour)

    versions = frame(spark, [
        ("x", at(1, 0), at(1, 5)), ("x", at(1, 4), at(2, 0)), ("x", at(2, 0), at(9, 0)), ("x", at(5, 0), at(6, 0)),
        ("y", at(1, 0), at(3, 0)), ("y", at(3, 0), at(4, 0)),
    ], "k string, _valid_from timestamp_ntz, _valid_to timestamp_ntz")
    found = rows(overlapping_versions(versions, "k"), "k", F.date_format("_valid_from", "ddHH"))
    assert found == [("x", "0100"), ("x", "0200")]


def test_keys(spark):
    df = frame(spark, [(i, f"n{i}") for i in range(500)], "k bigint, n string").repartition(7)
    numbers = [r[0] for r in loads.dense_key(df, "k", "sk", start=10).select("sk").collect()]
    assert sorted(numbers) == list(range(11, 511))
    once = dict(loads.dense_key(df, "k", "sk").select("k", "sk").collect())
    twice = dict(loads.dense_key(df.repartition(3), "k", "sk").select("k", "sk").collect())
    assert once == twice
    assert df.select(loads.load_key("r").alias("s")).distinct().count() == 500


def test_keep_latest_limits_groups_before_the_shuffle(spark):
    df = frame(spark, [(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "k int, o int, v string").repartition(3)
    latest = loads.keep_latest(df, ["k"], ["o"])
    assert rows(latest, "k", "v") == [(1, "b"), (2, "c")]
    assert "WindowGroupLimit" in latest._jdf.queryExecution().executedPlan().toString()


def test_insert_if_absent(spark):
    old, new = frame(spark, [(1, "old")], "k int, v string"), frame(spark, [(1, "new"), (2, "new")], "k int, v string")
    assert rows(loads.insert_if_absent(old, new, ["k"]), "k", "v") == [(1, "old"), (2, "new")]


def test_seconds_and_percent(spark):
    df = frame(spark, [(datetime(2024, 1, 1, 0, 0, 0, 900000), datetime(2024, 1, 1, 0, 0, 2, 100000), 1, 0)],
               "a timestamp_ntz, b timestamp_ntz, p bigint, w bigint")
    row = df.select(seconds_between(F.col("a"), F.col("b")), percent(F.col("p"), F.col("w"))).first()
    assert tuple(row) == (2, 0.0)


FEEDS = [
    Feed(1, "BRONZE", "D", 2, "t", "k", None, "v", "Y"),
    Feed(2, "BRONZE", "D", 4, "t", "k", None, "v", "N"),
    Feed(3, "BRONZE", "D", 1, "t", "k", None, "v", "N"),
]
DATA = [("1", None), ("2", "ab"), ("3", "abc"), ("4", "ab"), (None, None), ("6", "")]


def test_both_ways_of_scoring_agree(spark):
    df = frame(spark, DATA, "k string, v string")
    outcome = evaluate(df, plan_checks(RULES, FEEDS, "t", "BRONZE"), batch_id="b", as_of=T1)
    joined, placed = merge_status(df, outcome.results, "k"), score_rows(df, outcome)
    assert rows(joined, "k", "dq_status") == rows(placed, "k", "dq_status") == sorted([
        ("1", "FAIL"), ("2", "PASS-SOFT"), ("3", "PASS-SOFT"), ("4", "PASS"), (None, "PASS"), ("6", "FAIL"),
    ], key=str)
    assert reset_status(placed).filter("dq_status is not null").count() == 0
    again = merge_status(placed.withColumn("dq_status", F.lit("PASS")), outcome.results, "k")
    assert rows(again, "dq_status") == [("PASS",)] * 6


def test_expression_checks_need_no_shuffle(spark, tmp_path):
    frame(spark, DATA, "k string, v string").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    outcome = evaluate(df, plan_checks(RULES, FEEDS[:2], "t", "BRONZE"), batch_id="b", as_of=T1)
    for plan in (outcome.results, score_rows(df, outcome)):
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in text and text.count("FileScan") == 1


def test_summary_and_gate(spark):
    df = frame(spark, DATA, "k string, v string")
    outcome = evaluate(df, plan_checks(RULES, FEEDS[:2], "t", "BRONZE"), batch_id="b", as_of=T1)
    summary = summarize(outcome.pending, outcome.results, "b", "BRONZE", "t")
    row = summary.first()
    assert (row["overall_count"], row["failed_count"], row["unkeyed_violation_count"]) == (6, 2, 1)
    assert row["failed_count"] <= row["overall_count"]
    assert row["fail_pct"] == 33.33
    exact = {"DQ_BRONZE_THRESHOLD": "33.33"}
    assert not gate(summary, exact).first()["threshold_exceeded"]  # equal is not above
    assert gate(summary, {"DQ_BRONZE_THRESHOLD": "33.32"}).first()["threshold_exceeded"]
    assert gate(summary, {}).first()["threshold"] == 10
    assert gate_all(gate(summary, {})).first()["status"] == "FAILED"
    unknown = summary.withColumn("fail_pct", F.lit(None).cast("double"))
    assert gate(unknown, exact).first()["threshold_exceeded"]  # fails closed
    assert failed_records(outcome.results.limit(0)).first()["failed_count"] == 0
