"""Each rule on NULL, empty, blank and boundary values, and feed errors."""

import pytest

from assaylake.operators.evaluate import evaluate
from assaylake.operators.rules import Check, FeedError, bind_template, plan_checks
from assaylake.sources.metadata import RULES, Feed, Rule, frame

CLOCK = "2024-02-01 00:00:00"
VALUES = [None, "", "  ", "ab", " ab ", "AB", "123456789", "1234567890", "123-45-6789", "1--45-67-89", "12-345-6789",
          "2023-02-01", "2023-01-31", "nonsense", "a@b.c"]


def feed(rule_id, column="v", **kwargs):
    return Feed(1, "BRONZE", "D", rule_id, "t", "k", None, column, **kwargs)


def failing(spark, rule, **kwargs):
    df = frame(spark, [(i, v) for i, v in enumerate(VALUES)], "k bigint, v string")
    outcome = evaluate(df, [Check(feed(rule.rule_id, **kwargs), rule)], batch_id="b", as_of=CLOCK)
    assert not outcome.errors
    return {VALUES[int(r["record_key"])] for r in outcome.results.collect()}


def by_code(code):
    return next(r for r in RULES if r.rule_code == code)


def test_not_null(spark):
    assert failing(spark, by_code("GN_NotNull")) == {None, "", "  "}


def test_lengths(spark):
    assert failing(spark, by_code("GN_Length2")) == set(VALUES) - {None, "ab", " ab ", "AB"}
    assert failing(spark, by_code("GN_Length9")) == set(VALUES) - {None, "123456789"}
    assert failing(spark, by_code("GN_Length10")) == set(VALUES) - {None, "1234567890", "2023-02-01", "2023-01-31"}


def test_tax_format(spark):
    assert failing(spark, by_code("GN_FormatTIN")) == set(VALUES) - {"123-45-6789"}


def test_tax_format_allows_further_dashes(spark):
    df = frame(spark, [(1, "123-45-67-89"), (2, "abc-de-fghi"), (3, "123-45-678")], "k bigint, v string")
    outcome = evaluate(df, [Check(feed(7), by_code("GN_FormatTIN"))], batch_id="b", as_of=CLOCK)
    assert [r["record_key"] for r in outcome.results.collect()] == ["3"]


def test_upper(spark):
    assert failing(spark, by_code("GN_UpperCase")) == {"ab", " ab ", "nonsense", "a@b.c"}


def test_timeliness(spark):
    assert failing(spark, by_code("GN_Timeliness")) == {"2023-01-31"}


def test_in_list_treats_null_as_passing(spark):
    assert failing(spark, by_code("GN_InList"), dq_rule_input_where_col="'ab','AB'") == set(VALUES) - {None, "ab", "AB"}


def test_like(spark):
    assert failing(spark, by_code("GN_EmailFormat")) == set(VALUES) - {None, "a@b.c"}


def test_case_template(spark):
    rule = Rule(50, 1, "X", "", "CASE WHEN ${INPUT1} = 'ab' THEN 'FAIL' ELSE 'PASS' END", "SIMPLE")
    assert failing(spark, rule) == {"ab"}


def test_criticality_and_evidence(spark):
    df = frame(spark, [(1, None)], "k bigint, v string")
    rows = evaluate(
        df, [Check(feed(2, criticality_ind="N"), by_code("GN_NotNull"))], batch_id="b", as_of=CLOCK
    ).results.collect()
    assert rows[0]["result"] == "PASS-SOFT"
    df.selectExpr("*", "CAST(NULL AS STRING) AS dq_status").createOrReplaceTempView("t")
    assert spark.sql(rows[0]["dq_check_sql"]).count() == 1


def test_duplicate_evidence_runs(spark):
    df = frame(spark, [(1, "x"), (2, "x"), (3, None), (4, None), (5, "y")], "k bigint, v string")
    outcome = evaluate(df, [Check(feed(1), by_code("GN_Duplicate"))], batch_id="b", as_of=CLOCK)
    rows = outcome.results.collect()
    assert {r["record_key"] for r in rows} == {"1", "3"}
    df.selectExpr("*", "CAST(NULL AS STRING) AS dq_status").createOrReplaceTempView("t")
    assert {str(r["k"]) for r in spark.sql(rows[0]["dq_check_sql"]).collect()} == {"1", "3"}


def test_only_pending_rows(spark):
    df = frame(spark, [(1, None, "PASS"), (2, None, None)], "k bigint, v string, dq_status string")
    rows = evaluate(df, [Check(feed(2), by_code("GN_NotNull"))], batch_id="b", as_of=CLOCK).results.collect()
    assert [r["record_key"] for r in rows] == ["2"]


def test_plan_order_and_activity():
    feeds = [
        Feed(3, "BRONZE", "D", 2, "t", "k", None, "v"),
        Feed(1, "bronze", "D", 2, "T", "k", None, "v"),
        Feed(2, "BRONZE", "D", 2, "t", "k", None, "v", active_ind="N"),
        Feed(4, "SILVER", "D", 2, "t", "k", None, "v"),
        Feed(5, "BRONZE", "D", 999, "t", "k", None, "v"),
    ]
    assert [c.feed.feed_id for c in plan_checks(RULES, feeds, "t", "BRONZE")] == [1, 3]


def test_tokens():
    rule = Rule(60, 1, "X", "", "${INPUT1}|${INPUT2}|${INPUTN}|${TABLE_NAME}|${JOINTBL2}|${JOINCOL1}|${JOINCOL2}|"
                "${WHERECOL1}|${INCREMENTAL_DATE_COLUMN}", "SIMPLE")
    bound = bind_template(Check(feed(60, "a,b", dq_rule_input_join_col="c", dq_rule_input_where_col="w"), rule),
                          "src", CLOCK, "ref")
    assert bound == "CAST(`a` AS STRING)|w|`a`, `b`|src|ref|`a`|c|w|dq_status IS NULL"
    with pytest.raises(FeedError):
        bind_template(Check(feed(61), Rule(61, 1, "X", "", "${OTHER}", "SIMPLE")), "s", CLOCK)


def test_bad_feeds_do_not_hide_good_ones(spark):
    df = frame(spark, [(1, None)], "k bigint, v string")
    checks = [
        Check(feed(2, "absent"), by_code("GN_NotNull")),
        Check(feed(70), Rule(70, 1, "X", "", "length(${INPUT1})", "SIMPLE")),  # neither boolean nor text
        Check(feed(71), Rule(71, 1, "X", "", "true", "OTHER")),
        Check(feed(3, dq_rule_input_join_tbl="nowhere", dq_rule_input_join_col="x"), by_code("GN_LOOKUP")),
        Check(feed(2), by_code("GN_NotNull")),
    ]
    outcome = evaluate(df, checks, batch_id="b", as_of=CLOCK)
    assert len(outcome.errors) == 4
    assert outcome.results.count() == 1
