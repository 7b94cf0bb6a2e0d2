"""Checks of tables above the size for a shared scan: the same violations and statuses, with less shuffled."""

import datetime
import re

import pytest

from assaylake.catalog import package
from assaylake.operators import bad_keys, evaluate as engine
from assaylake.operators.evaluate import evaluate, score_rows
from assaylake.operators.rules import plan_checks
from assaylake.sources.metadata import RULES, Feed, frame

CLOCK = "2024-02-01 00:00:00"
FEEDS = [
    Feed(1, "B", "D", 1, "t", "k", "d", "a,c"), Feed(2, "B", "D", 1, "t", "k", None, "d"), Feed(3, "B", "D", 1, "t", "c", "k", "x", "N"),
    Feed(4, "B", "D", 3, "t", "k", None, "c", dq_rule_input_join_tbl="r", dq_rule_input_join_col="c", dq_rule_input_where_col="f"),
    Feed(5, "B", "D", 10, "t", "k", None, "a", "N", dq_rule_input_join_tbl="n", dq_rule_input_join_col="a"),
    Feed(6, "B", "D", 2, "t", "k", None, "c"),
]


def rows():
    """NULL keys, groups and orders, two signs of zero, exact copies of the latest rows of a group, one hot group."""
    made = [(None if i % 13 == 0 else i, i % 7, None if i % 9 == 0 else -0.0 if i % 5 == 0 else float(i % 5),
             None if i % 11 == 0 else f"c{i % 4}", bytes([i % 3])) for i in range(80)]
    return [*made, *made[60:], *[(1000 + i, 99, 7.0, "hot", b"h") for i in range(200)]]


def checked(spark, path):
    references = {"r": frame(spark, [("c0", 1), ("c1", None), ("c1", 2), (None, 3)], "c string, f int"),
                  "n": frame(spark, [(1,), (2,), (None,)], "a int")}
    return evaluate(spark.read.parquet(path), plan_checks(RULES, FEEDS, "t", "B"), batch_id="b", as_of=CLOCK, tables=references)


def texts(df):
    return sorted(map(str, df.drop("record_ins_ts").collect()))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def path(spark, tmp_path):
    frame(spark, rows(), "k bigint, a int, d double, c string, x binary").repartition(3).write.parquet(f"{tmp_path}/t")
    return f"{tmp_path}/t"


@pytest.mark.parametrize("hot_rows", [1_000_000, 50])
def test_both_forms_agree(spark, path, monkeypatch, hot_rows):
    shared = checked(spark, path)
    expected = texts(shared.results), texts(score_rows(spark.read.parquet(path), shared).repartition(2))
    monkeypatch.setattr(engine, "SHARED_SCAN_BYTES", 0)
    monkeypatch.setattr(bad_keys, "HOT_ROWS", hot_rows)
    alone = checked(spark, path)
    assert texts(alone.results) == expected[0] and len(expected[0]) > 300
    assert texts(score_rows(spark.read.parquet(path), alone)) == expected[1]


def test_colliding_hashes_are_told_apart(spark, path, monkeypatch):
    expected = texts(checked(spark, path).results)
    monkeypatch.setattr(engine, "SHARED_SCAN_BYTES", 0)
    monkeypatch.setattr(bad_keys, "GROUP_HASHES", 2)
    monkeypatch.setattr(bad_keys, "KEY_HASHES", 1)
    monkeypatch.setattr(bad_keys, "HOT_ROWS", 150)
    assert texts(checked(spark, path).results) == expected


def test_violations_of_expressions_are_not_shuffled(spark, path, monkeypatch):
    monkeypatch.setattr(engine, "SHARED_SCAN_BYTES", 0)
    plan = plan_of(checked(spark, path).results)
    assert not re.search(r"hashpartitioning\((_hit|_pos|_at)", plan)


def test_large_references_are_not_broadcast(spark, path, monkeypatch):
    spark.range(20000).selectExpr("CAST(id AS INT) AS a").write.parquet(f"{path}-n")
    df, reference = spark.read.parquet(path), spark.read.parquet(f"{path}-n")
    probe = bad_keys.lookup_probe(df, "a", reference, "a", "a", "k")
    monkeypatch.setattr(bad_keys, "REFERENCE_BYTES", 1000)
    merged = bad_keys.unknown_rows(df.filter("a < 9"), probe, df["a"].cast("string"))
    assert "SortMergeJoin" in plan_of(merged) and merged.count() == 0
    assert bad_keys.unknown_rows(df, bad_keys.lookup_probe(df, "a", reference.filter("a < 99"), "a", "a", "k"), df["a"]).count() == 200


def test_statuses_are_judged_before_the_join(spark, tmp_path):
    frame(spark, [(1, 1, "x"), (2, 1, " "), (3, 2, None)], "k bigint, a int, note string").write.parquet(f"{tmp_path}/n")
    df = spark.read.parquet(f"{tmp_path}/n")
    feeds = [Feed(1, "B", "D", 2, "t", "k", None, "note", "N"), Feed(2, "B", "D", 1, "t", "k", None, "a")]
    outcome = evaluate(df, plan_checks(RULES, feeds, "t", "B"), batch_id="b", as_of=CLOCK)
    scored = score_rows(df, outcome).select("k", "dq_status")
    lines = plan_of(scored).splitlines()
    judged = next(i for i, line in enumerate(lines) if "AS _judged" in line)
    assert not any("note#" in line for line in lines[:judged])  # the join and its exchanges move no column of a condition
    assert {tuple(r) for r in scored.collect()} == {(1, "FAIL"), (2, "PASS-SOFT"), (3, "PASS-SOFT")}


def test_evidence_counts_its_violations_once(spark, tmp_path):
    day = datetime.datetime
    lines = [(i % 9, i, i, i % 2, 10.0 * (i % 4), 1.0, 0.1 * (i % 7), 0.0, "ANR"[i % 3], "OF"[i % 2], day(1995 + i % 7, 1, 2)) for i in range(40)]
    frame(spark, lines, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
          "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
          ).write.parquet(f"{tmp_path}/lineitem.parquet")
    frame(spark, [(i, day(1996, 6, 1)) for i in range(8)], "o_orderkey bigint, o_orderdate timestamp_ntz").write.parquet(
        f"{tmp_path}/orders.parquet")
    found = package.evidence(spark, str(tmp_path))
    got = {r["feed_id"]: (r["violation_count"], r["evidence_count"]) for r in found.collect()}
    assert {1303, 1305, 1306, 1308, 1309, 1310} <= set(got)
    assert all(a == b for a, b in got.values())
    assert "_latest" not in plan_of(found)  # the duplicates are not looked for again


def test_keys_of_a_lookup_are_compared_once(spark, path, monkeypatch):
    spark.range(20000).selectExpr("CAST(id AS INT) AS a").write.parquet(f"{path}-n")
    monkeypatch.setattr(bad_keys, "REFERENCE_BYTES", 1000)
    df, reference = spark.read.parquet(path), spark.read.parquet(f"{path}-n")
    probe = bad_keys.lookup_probe(df, "a", reference.filter("a < 99"), "a", "a", "k")
    found = bad_keys.unknown_rows(df, probe, df["a"].cast("string"))
    # The distinct keys, the rows that share a hash with a missing one, and rows without a key: no second comparison of all.
    assert sum("FileScan" in line and "/t]" in line for line in plan_of(found).splitlines()) == 3
    assert [r["record_value"] for r in found.collect()] == ["99"] * 200
