"""Errors caught in the scan, checks that share a scan, lasting numbers and keys, sketches, checksums."""

import re

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from assaylake.operators import checksums, sketches
from assaylake.operators.evaluate import evaluate
from assaylake.operators.identity import number_keys
from assaylake.operators.row_errors import NEVER, error_condition
from assaylake.operators.rules import plan_checks
from assaylake.operators.uniqueness import repeated
from assaylake.plans.steps import stage_step
from assaylake.sources.commit_log import Conflict
from assaylake.sources.lake import Lake
from assaylake.sources.metadata import CONFIG_SCHEMA, RULES, Feed, Rule, frame, settings

CLOCK = "2024-01-01 00:00:00"
EXPRESSIONS = [
    "CAST(v AS INT) > 5",
    "v > 5",
    "CASE WHEN v RLIKE '^[0-9]{1,3}$' THEN CAST(v AS INT) > 5 ELSE false END",
    "CASE WHEN z = 0 THEN 1 / z > 0 WHEN k = 3 THEN CAST(v AS INT) > 0 ELSE CAST(v AS INT) > 5 END",
    "10 / z > 1",
    "10 % z > 1",
    "z <> 0 AND 10 / z > 1",
    "z <> 0 OR 10 / z > 1",
    "10 / z > 1 AND z <> 0",
    "datediff(to_date(v), DATE'2020-01-01') > 3",
    "if(z = 0, 1, 10 div z) > 2",
    "coalesce(k, 1 / z) > 0",
    "coalesce(1 / z, k) > 0",
    "abs(CAST(v AS INT)) + 2147483600 > 3",
    "upper(v) NOT IN ('X') AND length(trim(v)) <> 2",
    "TRY_CAST(v AS INT) > 5",
]


@pytest.mark.parametrize("text", EXPRESSIONS)
def test_rows_on_which_an_expression_fails(spark, text):
    rows = [(1, "5", 0), (2, "x", 2), (3, None, 5), (4, "99999999999", 1), (5, "2024-01-05", None), (None, " 7 ", 1)]
    df = frame(spark, rows, "k int, v string, z int")

    def fails(row):
        try:
            frame(spark, [row], "k int, v string, z int").select(F.expr(text)).collect()
            return False
        except PySparkException:
            return True

    condition = error_condition(df, text)
    assert {r["k"] for r in df.filter(condition).collect()} == {r[0] for r in rows if fails(r)}
    if "TRY" in text or "upper" in text:
        assert condition == NEVER


def test_errors_do_not_stop_the_scan(spark):
    df = frame(spark, [(1, "x", "a"), (2, "9", "b"), (3, "1", "a"), (4, None, None)], "k bigint, v string, w string")
    rules = [*RULES, Rule(900, 6, "", "", "CAST(${INPUT1} AS INT) > 5", "SIMPLE")]
    feeds = [Feed(1, "BRONZE", "D", 900, "t", "k", None, "v"), Feed(2, "BRONZE", "D", 1, "t", "k", None, "w", "N"),
             Feed(3, "BRONZE", "D", 2, "t", "k", None, "w")]
    outcome = evaluate(df, plan_checks(rules, feeds, "t", "BRONZE"), batch_id="b", as_of=CLOCK, capture_errors=True)
    got = {(r["feed_id"], r["record_key"], r["result"]) for r in outcome.captured.collect()}
    assert got == {(1, "1", "ERROR"), (1, "2", "FAIL"), (2, "1", "PASS-SOFT"), (3, "4", "FAIL")}
    assert outcome.fallible == [1] and outcome.results.filter("result = 'ERROR'").count() == 0


def test_duplicates_and_lookups_share_a_scan(spark, tmp_path):
    rows = [(i, i % 7, float(i % 5), None if i % 11 == 0 else f"c{i % 4}", bytes([i % 3])) for i in range(60)]
    frame(spark, rows, "k bigint, a int, d double, c string, x binary").write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    references = {"r": frame(spark, [("c0", 1), ("c1", None), ("c1", 2), (None, 3)], "c string, f int"),
                  "n": frame(spark, [(1,), (2,)], "a int")}
    feeds = [
        Feed(1, "B", "D", 1, "t", "k", "d", "a,c"), Feed(2, "B", "D", 1, "t", "k", None, "d"), Feed(3, "B", "D", 1, "t", "c", "k", "x", "N"),
        Feed(4, "B", "D", 3, "t", "k", None, "c", dq_rule_input_join_tbl="r", dq_rule_input_join_col="c", dq_rule_input_where_col="f"),
        Feed(5, "B", "D", 10, "t", "k", None, "a", "N", dq_rule_input_join_tbl="n", dq_rule_input_join_col="a"),
        Feed(6, "B", "D", 2, "t", "k", None, "c"),
    ]
    checks = plan_checks(RULES, feeds, "t", "B")

    def found(unique_key):
        results = evaluate(df, checks, batch_id="b", as_of=CLOCK, tables=references, unique_key=unique_key).results
        kept = [c for c in results.columns if c not in ("record_ins_ts",)]
        return results, sorted(map(str, results.select(*kept).filter("feed_id <> 3").collect()))

    together, alone = found(True), found(False)
    assert together[1] == alone[1] and len(together[1]) > 50
    plan = together[0]._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"FileScan parquet", plan)) == 2


def test_numbers_stay_and_writers_do_not_share_them(spark, tmp_path):
    lake, other = Lake(spark, str(tmp_path)), Lake(spark, str(tmp_path))
    keys = lambda *ks: frame(spark, [(k,) for k in ks], "b string")
    first = {r["b"]: r["n"] for r in number_keys(lake, "t", keys("x", "y", None, "x"), "b", "n").collect()}
    assert sorted(n for n in first.values() if n) == [1, 2] and first[None] is None
    second = {r["b"]: r["n"] for r in number_keys(other, "t", keys("y", "z", "w"), "b", "n").collect()}
    assert second["y"] == first["y"] and sorted([second["z"], second["w"]]) == [3, 4]
    assert {r["n"] for r in number_keys(lake, "t", keys("x", "z"), "b", "n").collect()} == {first["x"], second["z"]}
    change = lake.change()
    change.expect("keys", "t", last=2)
    change.set("keys", "t", last=9)
    with pytest.raises(Conflict):
        change.__exit__(None)


def test_keys_of_a_repeated_batch(spark, tmp_path):
    lake, schema = Lake(spark, str(tmp_path)), "k int, v string"
    batch = frame(spark, [(1, "a"), (2, "a"), (3, None), (4, None)], schema)
    for _ in range(2):
        judged = repeated(lake, "t", batch, ["v"], ["k"], "one").collect()
        assert {r["k"] for r in judged if r["is_repeated"]} == {2, 4}
    later = repeated(lake, "t", frame(spark, [(5, "a"), (6, "b"), (7, "b")], schema), ["v"], ["k"], "two").collect()
    assert {r["k"] for r in later if r["is_repeated"]} == {5, 7}


def test_late_and_tied_rows(spark, tmp_path):
    schema = "s string, k bigint, _source_loaded_at timestamp_ntz, load_dt timestamp_ntz, update_dt timestamp_ntz, row_status string, " \
             "dq_status string, record_hash string, job_id string, _run_id string"
    raw = "k bigint, at timestamp_ntz"
    day = lambda k, d: (k, __import__("datetime").datetime(2024, 1, d))
    first = [day(1, 1), day(2, 10), day(3, 12)]
    later = [*first, day(4, 12), day(5, 11), day(6, 2), day(7, 13)]

    def run(lake, rows, overlap):
        return stage_step(lake, frame(spark, rows, raw), "t", schema, "s", "at", ["k"], "r", "INCREMENTAL", CLOCK, overlap)["rows_read"]

    for overlap, more in ((None, [1]), ("3 days", [3]), ("20 days", [4])):
        lake = Lake(spark, f"{tmp_path}/{str(overlap).replace(' ', '')}")
        assert run(lake, first, overlap) == 3
        assert [run(lake, later, overlap)] == more
        assert run(lake, later, overlap) == 0
        assert lake.mark("bronze", "t", "_source_loaded_at") == "2024-01-13 00:00:00"


def test_sketches_of_empty_and_null_columns(spark):
    df = frame(spark, [(1, None, "a"), (2, None, None)], "a int, b double, c string")
    kept = [sketches.column_sketches(part, ["a", "b", "c"], str(i)) for i, part in enumerate((df, df, df.limit(0)))]
    got = {r["column_name"]: r for r in sketches.merged_profile(kept[0].unionByName(kept[1]).unionByName(kept[2])).collect()}
    assert (got["a"]["row_count"], got["a"]["null_pct"], got["a"]["estimated_distinct"]) == (4, 0.0, 2)
    assert got["b"]["null_pct"] == 100.0 and got["b"]["estimated_median"] is None and got["c"]["estimated_distinct"] == 1


def test_checksums_read_rows_of_differing_buckets_only(spark):
    left = spark.range(5000).select("id", (F.col("id") % 13).alias("v"), F.when(F.col("id") % 3 > 0, "t").alias("t"))
    assert checksums.reconcile_rows(left, left.orderBy(F.col("id").desc()), "id").count() == 0
    right = left.withColumn("v", F.when(F.col("id") == 77, None).otherwise(F.col("v"))).filter("id <> 4000")
    sums = [checksums.checksums(df, "id") for df in (left, right)]
    buckets = checksums.differing(*sums)
    assert len(buckets) == 2
    compared = left.filter(checksums.bucket_of("id", checksums.FANOUT**checksums.LEVELS).isin(buckets)).count()
    assert compared < 20
    assert {tuple(r) for r in checksums.reconcile_rows(left, right, "id").collect()} == {(77, "CHANGED"), (4000, "LEFT_ONLY")}


def test_settings_by_kind(spark):
    rows = [("a", "42.50", "NUMBER", "x"), ("b", "true", "BOOLEAN", "x"), ("c", "DEV", "STRING", None), ("d", None, "NUMBER", None)]
    got = settings(frame(spark, rows, CONFIG_SCHEMA))
    assert (float(got["a"]), got["b"], got["c"], got["d"]) == (42.5, True, "DEV", None)
    with pytest.raises(ValueError):
        settings(frame(spark, [("b", "perhaps", "BOOLEAN", "x")], CONFIG_SCHEMA))
