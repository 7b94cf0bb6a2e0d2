"""The engine as a whole: violations, statuses, summaries, gates, monitoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from assaylake.catalog.inputs import (
    BATCH,
    CATALOG_RULES,
    CUSTOMER_FEEDS,
    CUSTOMER_RESULTS_SQL,
    CUSTOMER_STATUS_SQL,
    LINE_FEEDS,
    LINE_RESULTS_SQL,
    LINES_SQL,
    NATION_STATUS_SQL,
    ORDERS_CLOCK,
    PART_FEEDS,
    PART_RESULTS_SQL,
    PART_STATUS_SQL,
    VIOLATION,
    check,
    check_customers,
    check_lines,
    check_nations,
    check_parts,
    lines,
    status_sql,
    union_sql,
)
from assaylake.operators import summary
from assaylake.operators.evaluate import (
    evaluate,
    merge_status,
    pending_rows,
    reset_status,
    score_rows,
    worst_by_feed_criticality,
    worst_by_record,
)
from assaylake.operators.loads import layer_gate
from assaylake.operators.rules import feed_plan, plan_checks
from assaylake.sources.metadata import (
    CATEGORIES,
    CATEGORY_SCHEMA,
    FEED_SCHEMA,
    RULE_SCHEMA,
    Feed,
    Rule,
    frame,
)
from assaylake.sources.scratch import written_table
from assaylake.sources.tables import table

LIMITS = {"DQ_BRONZE_THRESHOLD": "90.00", "DQ_SILVER_THRESHOLD": "5.00"}


def scored_parts(spark, folder):
    parts = table(spark, folder, "part")
    return score_rows(parts, check_parts(spark, folder))


def scored_customers(spark, folder):
    return score_rows(table(spark, folder, "customer"), check_customers(spark, folder))


def scored_nations(spark, folder):
    return score_rows(table(spark, folder, "nation"), check_nations(spark, folder))


def results(spark, folder):
    """Ten feeds of all kinds on the line items."""
    return check_lines(spark, folder).results.select(*VIOLATION)


def violation_record(spark, folder):
    """All twelve columns of a violation; the user is compared with the session's."""
    found = check_parts(spark, folder).results
    return found.select(
        "dq_batch_id", "layer", "domain", "table_nm", "rule_id", "feed_id", "record_key", "record_value", "result", "record_ins_ts",
        (F.col("record_ins_by") == F.current_user()).alias("record_ins_by_user"), "dq_check_sql")


DIVISION = [Rule(921, 6, "Share", "", "1000 / (${COL1} - 1) > 400", "MULTIPLE"), Rule(922, 6, "Number", "", "CAST(${INPUT1} AS INT) > 5", "SIMPLE")]
DIVISION_FEEDS = [
    Feed(1601, "BRONZE", "SALES", 921, "lineitem", "row_key", None, "l_linenumber", "Y"),
    Feed(1602, "BRONZE", "SALES", 922, "lineitem", "row_key", None, "l_returnflag", "Y"),
    Feed(1603, "BRONZE", "SALES", 101, "lineitem", "row_key", None, "l_returnflag", "N", dq_rule_input_where_col="'A','N'"),
]


def row_errors(spark, folder):
    """A division by zero on some rows and a cast that fails on all, found in the scan of the other checks."""
    checks = plan_checks([*CATALOG_RULES, *DIVISION], DIVISION_FEEDS, "lineitem", "BRONZE")
    outcome = evaluate(lines(spark, folder), checks, batch_id=BATCH, as_of=ORDERS_CLOCK, capture_errors=True)
    return outcome.captured.groupBy("feed_id", "result").agg(F.count(F.lit(1)).alias("row_count"))


def status_rollup(spark, folder):
    return worst_by_record(check_lines(spark, folder).results)


def status_merge(spark, folder):
    """Statuses by joining the recorded violations."""
    parts, outcome = table(spark, folder, "part"), check_parts(spark, folder)
    return merge_status(parts, outcome.results, "p_partkey").select("p_partkey", "p_brand", "dq_status")


def status_in_place(spark, folder):
    """Statuses judged in place, joined only for duplicate, lookup and query checks."""
    return score_rows(lines(spark, folder), check_lines(spark, folder)).select("row_key", "dq_status")


def status_via_feed(spark, folder):
    feeds = frame(spark, PART_FEEDS, FEED_SCHEMA)
    return worst_by_feed_criticality(check_parts(spark, folder).results, feeds)


def batch_summary(spark, folder):
    outcome = check_lines(spark, folder)
    return summary.summarize(outcome.pending, outcome.results, BATCH, "BRONZE", "lineitem")


def empty_summary(spark, folder):
    """A second check of rows that all have a status: nothing is pending, all counts are zero."""
    scored = written_table(scored_parts(spark, folder))  # so that the rows are really looked at
    outcome = check(scored, PART_FEEDS)
    return summary.summarize(outcome.pending, outcome.results, BATCH, "BRONZE", "part")


def gated(spark, folder):
    """Two tables: part names are never upper case and trip the gate, nations pass."""
    names = Feed(1501, "BRONZE", "PARTS", 8, "part", "p_partkey", None, "p_name", "Y")
    parts, nations = check(table(spark, folder, "part"), [names]), check_nations(spark, folder)
    rows = summary.summarize(parts.pending, parts.results, BATCH, "BRONZE", "part").unionByName(
        summary.summarize(nations.pending, nations.results, BATCH, "BRONZE", "nation")
    )
    customers = check_customers(spark, folder)
    silver = summary.summarize(customers.pending, customers.results, "batch-2", "SILVER", "customer")
    gold = summary.summarize(nations.pending, nations.results, "batch-3", "GOLD", "nation")
    return summary.gate(rows.unionByName(silver).unionByName(gold), LIMITS)


def threshold_gate(spark, folder):
    return gated(spark, folder).select(
        "dq_batch_id", "layer", "table_nm", "overall_count", "failed_count", "fail_pct",
        F.col("threshold").cast("double").alias("threshold"), "threshold_exceeded", "status",
    )


def gate_multi(spark, folder):
    return summary.gate_all(gated(spark, folder))


def distribution(spark, folder):
    return summary.status_distribution(scored_parts(spark, folder))


def distribution_all(spark, folder):
    tables = {
        "part": scored_parts(spark, folder),
        "customer": scored_customers(spark, folder),
        "nation": scored_nations(spark, folder),
    }
    return summary.status_distribution_all(tables)


def reset(spark, folder):
    """All rows are pending again after a reset."""
    return summary.status_distribution(reset_status(scored_customers(spark, folder)))


def pending(spark, folder):
    """Customers re-opened for a check because their balance is negative; the others keep their status."""
    scored = scored_customers(spark, folder)
    reopened = scored.withColumn("dq_status", F.when(F.col("c_acctbal") >= 0, F.col("dq_status")))
    return pending_rows(reopened).select("c_custkey", "c_mktsegment")


def violations(spark, folder):
    both = check_lines(spark, folder).results.unionByName(check_parts(spark, folder).results)
    return summary.violations_by_rule(both)


def drilldown(spark, folder):
    """Violations next to the customers they are about."""
    found = check_customers(spark, folder).results
    joined = summary.record_drilldown(found, table(spark, folder, "customer"), "c_custkey")
    return joined.select("feed_id", "rule_id", "result", "record_key", "c_custkey", "c_name", "c_mktsegment")


def gate_rows(spark, folder):
    return layer_gate(scored_parts(spark, folder)).select("p_partkey", "p_type", "dq_status")


def category_rollup(spark, folder):
    both = check_lines(spark, folder).results.unionByName(check_parts(spark, folder).results)
    rules = frame(spark, CATALOG_RULES, RULE_SCHEMA)
    return summary.category_rollup(both, rules, frame(spark, CATEGORIES, CATEGORY_SCHEMA))


def counted_plan(spark, folder):
    """Active feeds with their rules and what each found."""
    feeds = frame(spark, PART_FEEDS + CUSTOMER_FEEDS + LINE_FEEDS, FEED_SCHEMA)
    plan = feed_plan(feeds, frame(spark, CATALOG_RULES, RULE_SCHEMA))
    found = (
        check_lines(spark, folder).results.unionByName(check_parts(spark, folder).results)
        .unionByName(check_customers(spark, folder).results)
        .groupBy("feed_id").agg(F.count(F.lit(1)).alias("_n"))
    )
    return (
        plan.join(found, "feed_id", "left")
        .select("feed_id", "table_nm", "rule_code", "rule_category", "criticality_ind",
                F.coalesce("_n", F.lit(0)).alias("violation_count"))
        .orderBy("feed_id")
    )


_ROLLUP = (
    "SELECT record_key, CASE WHEN max(CASE WHEN result = 'FAIL' THEN 1 ELSE 0 END) = 1 THEN 'FAIL' "
    "ELSE 'PASS-SOFT' END AS computed_status FROM ({}) GROUP BY record_key"
)


def _summary_sql(batch, layer, name, source, results_sql):
    return (
        f"SELECT '{batch}' AS dq_batch_id, '{layer}' AS layer, '{name}' AS table_nm, "
        f"(SELECT count(*) FROM {source}) AS overall_count, "
        f"count(DISTINCT CASE WHEN result = 'FAIL' THEN record_key END) AS failed_count, "
        f"count(*) AS violation_count, count(*) - count(record_key) AS unkeyed_violation_count, "
        f"round(count(DISTINCT CASE WHEN result = 'FAIL' THEN record_key END) * 100.0 / "
        f"(SELECT count(*) FROM {source}), 2) AS fail_pct FROM ({results_sql})"
    )


_NAMES = "SELECT CAST(p_partkey AS VARCHAR) AS record_key, 'FAIL' AS result FROM part WHERE p_name <> upper(p_name)"
_NATIONS = (
    "SELECT CAST(n_nationkey AS VARCHAR) AS record_key, 'FAIL' AS result FROM nation "
    "WHERE n_regionkey NOT IN (0, 1, 2, 3) UNION ALL SELECT CAST(n_nationkey AS VARCHAR), 'FAIL' FROM nation "
    "WHERE n_name <> upper(n_name)"
)
_GATED = (
    "SELECT *, fail_pct > threshold AS threshold_exceeded, CASE WHEN fail_pct > threshold THEN 'THRESHOLD_EXCEEDED' "
    "ELSE 'COMPLETED' END AS status FROM (SELECT dq_batch_id, layer, table_nm, overall_count, failed_count, "
    "CAST(fail_pct AS DOUBLE) AS fail_pct, CAST(CASE layer WHEN 'BRONZE' THEN 90 WHEN 'SILVER' THEN 5 ELSE 10 END "
    "AS DOUBLE) AS threshold FROM (" + union_sql(
        _summary_sql(BATCH, "BRONZE", "part", "part", _NAMES),
        _summary_sql(BATCH, "BRONZE", "nation", "nation", _NATIONS),
        _summary_sql("batch-2", "SILVER", "customer", "customer", CUSTOMER_RESULTS_SQL),
        _summary_sql("batch-3", "GOLD", "nation", "nation", _NATIONS),
    ) + "))"
)
_BOTH = f"({LINE_RESULTS_SQL} UNION ALL {PART_RESULTS_SQL})"


def _rule_values():
    return ", ".join(f"({r.rule_id}, {r.category_id})" for r in CATALOG_RULES)


def _category_values():
    return ", ".join(f"({i}, '{n}')" for i, n, _ in CATEGORIES)


def _plan_values():
    codes = {r.rule_id: r for r in CATALOG_RULES}
    return ", ".join(
        f"({f.feed_id}, '{f.table_nm}', '{codes[f.rule_id].rule_code}', '{codes[f.rule_id].rule_category}', "
        f"'{f.criticality_ind}')"
        for f in PART_FEEDS + CUSTOMER_FEEDS + LINE_FEEDS if f.active_ind == "Y"
    )


def _distribution(sql, name):
    return f"SELECT '{name}' AS tbl, dq_status, count(*) AS cnt FROM ({sql}) GROUP BY dq_status"


def _evidence_sql(feed, result, condition, where, value):
    shown = f"SELECT * FROM part WHERE TRUE AND ({condition})".replace("'", "''")
    rule = {1001: 2, 1002: 4, 1003: 101}[feed]
    return (
        f"SELECT '{BATCH}' AS dq_batch_id, 'BRONZE' AS layer, 'PARTS' AS domain, 'part' AS table_nm, CAST({rule} AS BIGINT) AS rule_id, "
        f"CAST({feed} AS BIGINT) AS feed_id, CAST(p_partkey AS VARCHAR) AS record_key, CAST({value} AS VARCHAR) AS record_value, "
        f"'{result}' AS result, TIMESTAMP '{ORDERS_CLOCK}' AS record_ins_ts, true AS record_ins_by_user, '{shown}' AS dq_check_sql "
        f"FROM part WHERE {where}"
    )


QUERIES = {
    "dq_violation_record": (violation_record, union_sql(
        _evidence_sql(1001, "FAIL", "coalesce(trim(CAST(`p_type` AS STRING)), '') = ''", "trim(coalesce(p_type, '')) = ''", "p_type"),
        _evidence_sql(1002, "PASS-SOFT", "length(trim(CAST(`p_size` AS STRING))) <> 2", "length(trim(CAST(p_size AS VARCHAR))) <> 2", "p_size"),
        _evidence_sql(1003, "FAIL", "CAST(`p_brand` AS STRING) NOT IN ('Brand#1','Brand#2')", "p_brand NOT IN ('Brand#1', 'Brand#2')",
                      "p_brand"))),
    "dq_row_errors": (row_errors, union_sql(
        "SELECT * FROM (SELECT CAST(1601 AS BIGINT) AS feed_id, 'ERROR' AS result, count(*) AS row_count FROM lineitem "
        "WHERE l_linenumber = 1) WHERE row_count > 0",
        "SELECT * FROM (SELECT 1601, 'FAIL', count(*) AS n FROM lineitem WHERE l_linenumber > 1 AND 1000 / (l_linenumber - 1) > 400) WHERE n > 0",
        "SELECT * FROM (SELECT 1602, 'ERROR', count(l_returnflag) AS n FROM lineitem) WHERE n > 0",
        "SELECT * FROM (SELECT 1603, 'PASS-SOFT', count(*) AS n FROM lineitem WHERE l_returnflag NOT IN ('A', 'N')) WHERE n > 0")),
    "dq_results": (results, LINE_RESULTS_SQL),
    "dq_status_rollup": (status_rollup, _ROLLUP.format(LINE_RESULTS_SQL)),
    "dq_status_merge": (status_merge, f"SELECT p_partkey, p_brand, dq_status FROM ({PART_STATUS_SQL})"),
    "dq_status_in_place": (status_in_place, "SELECT row_key, dq_status FROM (" + status_sql(
        LINE_RESULTS_SQL, "(SELECT * FROM " + LINES_SQL + ")", "row_key") + ")"),
    "dq_status_via_feed": (status_via_feed, _ROLLUP.format(PART_RESULTS_SQL)),
    "dq_summary": (batch_summary, "SELECT * REPLACE (CAST(fail_pct AS DOUBLE) AS fail_pct) FROM (" + _summary_sql(
        BATCH, "BRONZE", "lineitem", "lineitem", LINE_RESULTS_SQL) + ")"),
    "dq_summary_empty": (empty_summary, (
        f"SELECT '{BATCH}' AS dq_batch_id, 'BRONZE' AS layer, 'part' AS table_nm, count(*) AS overall_count, "
        "count(*) AS failed_count, count(*) AS violation_count, count(*) AS unkeyed_violation_count, "
        f"CAST(0 AS DOUBLE) AS fail_pct FROM ({PART_STATUS_SQL}) WHERE dq_status IS NULL")),
    "dq_threshold_gate": (threshold_gate, _GATED),
    "dq_gate_multi": (gate_multi, (
        "SELECT dq_batch_id, count(*) AS table_count, count_if(threshold_exceeded) AS exceeded_count, "
        "bool_or(threshold_exceeded) AS threshold_exceeded, "
        "CASE WHEN bool_or(threshold_exceeded) THEN 'FAILED' ELSE 'COMPLETED' END AS status "
        f"FROM ({_GATED}) GROUP BY dq_batch_id").replace(
            "count_if(threshold_exceeded)", "CAST(count(*) FILTER (threshold_exceeded) AS BIGINT)")),
    "status_distribution": (distribution, f"SELECT dq_status, count(*) AS cnt FROM ({PART_STATUS_SQL}) GROUP BY 1"),
    "status_distribution_all": (distribution_all, union_sql(
        _distribution(PART_STATUS_SQL, "part"), _distribution(CUSTOMER_STATUS_SQL, "customer"),
        _distribution(NATION_STATUS_SQL, "nation"))),
    "status_reset": (reset, "SELECT CAST(NULL AS VARCHAR) AS dq_status, count(*) AS cnt FROM customer"),
    "pending_rows": (pending, "SELECT c_custkey, c_mktsegment FROM customer WHERE c_acctbal < 0"),
    "violations_by_rule": (violations, (
        f"SELECT table_nm, rule_id, result, count(*) AS cnt FROM {_BOTH} GROUP BY ALL ORDER BY ALL")),
    "record_drilldown": (drilldown, (
        "SELECT feed_id, rule_id, result, record_key, c_custkey, c_name, c_mktsegment "
        f"FROM ({CUSTOMER_RESULTS_SQL}) r JOIN customer ON record_key = CAST(c_custkey AS VARCHAR)")),
    "layer_gate": (gate_rows, (
        f"SELECT p_partkey, p_type, dq_status FROM ({PART_STATUS_SQL}) WHERE dq_status IN ('PASS', 'PASS-SOFT')")),
    "dq_category_rollup": (category_rollup, (
        "SELECT CAST(category_id AS BIGINT) AS category_id, category_nm, count(DISTINCT v.rule_id) AS rule_count, "
        "count(r.rule_id) AS violation_count, CAST(count(*) FILTER (r.result = 'FAIL') AS BIGINT) AS failed_count "
        f"FROM (VALUES {_rule_values()}) AS v(rule_id, category_id) "
        f"JOIN (VALUES {_category_values()}) AS c(category_id, category_nm) USING (category_id) "
        f"LEFT JOIN {_BOTH} r ON r.rule_id = v.rule_id GROUP BY ALL")),
    "feed_plan": (counted_plan, (
        "SELECT CAST(f AS BIGINT) AS feed_id, t AS table_nm, c AS rule_code, k AS rule_category, y AS criticality_ind, "
        f"count(r.feed_id) AS violation_count FROM (VALUES {_plan_values()}) AS v(f, t, c, k, y) LEFT JOIN "
        f"({LINE_RESULTS_SQL} UNION ALL {PART_RESULTS_SQL} UNION ALL {CUSTOMER_RESULTS_SQL}) r ON r.feed_id = v.f "
        "GROUP BY ALL ORDER BY feed_id")),
}

