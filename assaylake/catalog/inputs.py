"""Rules, feeds and sources shared by the catalog queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaylake.operators.evaluate import Evaluation, evaluate
from assaylake.operators.rules import plan_checks
from assaylake.sources.metadata import RULES, Feed, Rule
from assaylake.sources.tables import table

BATCH = "batch-1"
ORDERS_CLOCK = "2001-12-01 00:00:00"
EVENTS_CLOCK = "2024-02-01 00:00:00"

SHIPPED_TOO_EARLY = (
    "SELECT l.row_key, l.l_orderkey, "
    "CASE WHEN l.l_shipdate < o.o_orderdate THEN 'FAIL' ELSE 'PASS' END AS result "
    "FROM ${TABLE_NAME} l JOIN ${JOINTBL2} o ON l.l_orderkey = o.o_orderkey"
)
LONG_BRAND = "CASE WHEN length(trim(${INPUT1})) > 7 THEN 'FAIL' ELSE 'PASS' END"

CATALOG_RULES = [
    *RULES,
    Rule(111, 6, "GN_Pattern", "Text matches a pattern", "${INPUT1} NOT RLIKE ${INPUT2}", "SIMPLE"),
    Rule(112, 3, "GN_Discount", "Discounted quantity is at most 4", "${COL1} * ${COL2} > 4", "MULTIPLE"),
    Rule(113, 3, "GN_FlagStatus", "Open lines have no return flag R", "${COL1} = 'R' AND ${COL2} = 'O'", "MULTIPLE"),
    Rule(114, 3, "GN_ShipDate", "Lines ship after they are ordered", SHIPPED_TOO_EARLY, "SQL_FEED"),
    Rule(115, 1, "GN_Balance", "Balance is not negative", "${COL1} < 0", "MULTIPLE"),
    Rule(116, 6, "GN_ShortCode", "Text has at most 7 characters", LONG_BRAND, "SIMPLE"),
    Rule(117, 1, "GN_EventValue", "Event value is at most 100", "${COL1} > 100", "MULTIPLE"),
]

# feed id, layer, domain, rule, table, key, order column, inputs, criticality, then parameters
PART_FEEDS = [
    Feed(1001, "BRONZE", "PARTS", 2, "part", "p_partkey", None, "p_type", "Y"),
    Feed(1002, "BRONZE", "PARTS", 4, "part", "p_partkey", None, "p_size", "N"),
    Feed(1003, "BRONZE", "PARTS", 101, "part", "p_partkey", None, "p_brand", "Y",
         dq_rule_input_where_col="'Brand#1','Brand#2'"),
    Feed(1004, "BRONZE", "PARTS", 5, "part", "p_partkey", None, "p_name", "Y", active_ind="N"),
]
CUSTOMER_FEEDS = [
    Feed(1101, "BRONZE", "CUSTOMERS", 115, "customer", "c_custkey", None, "c_acctbal", "Y"),
    Feed(1102, "BRONZE", "CUSTOMERS", 101, "customer", "c_custkey", None, "c_mktsegment", "N",
         dq_rule_input_where_col="'BUILDING','MACHINERY','HOUSEHOLD','FURNITURE'"),
]
NATION_FEEDS = [
    Feed(1201, "BRONZE", "CUSTOMERS", 101, "nation", "n_nationkey", None, "n_regionkey", "Y",
         dq_rule_input_where_col="'0','1','2','3'"),
    Feed(1202, "BRONZE", "CUSTOMERS", 8, "nation", "n_nationkey", None, "n_name", "Y"),
]
LINE_FEEDS = [
    Feed(1301, "BRONZE", "SALES", 2, "lineitem", "row_key", None, "l_returnflag", "Y"),
    Feed(1302, "BRONZE", "SALES", 101, "lineitem", "row_key", None, "l_linestatus", "Y",
         dq_rule_input_where_col="'O','F'"),
    Feed(1303, "BRONZE", "SALES", 101, "lineitem", "row_key", None, "l_returnflag", "N",
         dq_rule_input_where_col="'A','N'"),
    Feed(1304, "BRONZE", "SALES", 8, "lineitem", "row_key", None, "l_linestatus", "Y"),
    Feed(1305, "BRONZE", "SALES", 9, "lineitem", "row_key", None, "l_shipdate", "N"),
    Feed(1306, "BRONZE", "SALES", 112, "lineitem", "row_key", None, "l_quantity,l_discount", "Y"),
    Feed(1307, "BRONZE", "SALES", 113, "lineitem", "row_key", None, "l_returnflag,l_linestatus", "N"),
    Feed(1308, "BRONZE", "SALES", 1, "lineitem", "row_key", "l_shipdate", "l_orderkey,l_linenumber", "Y"),
    Feed(1309, "BRONZE", "SALES", 10, "lineitem", "row_key", None, "l_orderkey", "Y",
         dq_rule_input_join_tbl="orders", dq_rule_input_join_col="o_orderkey", dq_rule_input_where_col="o_orderkey"),
    Feed(1310, "BRONZE", "SALES", 114, "lineitem", "row_key", None, "l_orderkey", "N",
         dq_rule_input_join_tbl="orders"),
]
EVENT_FEEDS = [
    Feed(1401, "BRONZE", "EVENTS", 117, "events", "event_id", None, "value", "Y"),
    Feed(1402, "BRONZE", "EVENTS", 101, "events", "event_id", None, "event_type", "N",
         dq_rule_input_where_col="'view','click','signup','purchase'"),
]

VIOLATION = ["table_nm", "rule_id", "feed_id", "record_key", "record_value", "result"]


def check(
    df: DataFrame, feeds: list[Feed], clock: str = ORDERS_CLOCK, tables: dict | None = None, rules=None
) -> Evaluation:
    first = feeds[0]
    checks = plan_checks(rules or CATALOG_RULES, feeds, first.table_nm, first.layer)
    return evaluate(df, checks, batch_id=BATCH, as_of=clock, tables=tables)


def lines(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with a key of their own (order, line, part, supplier and day identify a row)."""
    day = F.unix_date(F.col("l_shipdate").cast("date"))
    key = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", day)
    return table(spark, folder, "lineitem").withColumn("row_key", key)


def check_lines(spark: SparkSession, folder: str) -> Evaluation:
    return check(lines(spark, folder), LINE_FEEDS, tables={"orders": table(spark, folder, "orders")})


def check_parts(spark: SparkSession, folder: str) -> Evaluation:
    return check(table(spark, folder, "part"), PART_FEEDS)


def check_customers(spark: SparkSession, folder: str) -> Evaluation:
    return check(table(spark, folder, "customer"), CUSTOMER_FEEDS)


def check_nations(spark: SparkSession, folder: str) -> Evaluation:
    return check(table(spark, folder, "nation"), NATION_FEEDS)


def check_events(spark: SparkSession, folder: str) -> Evaluation:
    return check(table(spark, folder, "events"), EVENT_FEEDS, EVENTS_CLOCK)


# --- the same in SQL -------------------------------------------------------------------


def violation_sql(table_nm, rule, feed, key, value, result, source, where) -> str:
    return (
        f"SELECT '{table_nm}' AS table_nm, CAST({rule} AS BIGINT) AS rule_id, CAST({feed} AS BIGINT) AS feed_id, "
        f"CAST({key} AS VARCHAR) AS record_key, CAST({value} AS VARCHAR) AS record_value, '{result}' AS result "
        f"FROM {source} WHERE {where}"
    )


def union_sql(*parts: str) -> str:
    return "\nUNION ALL\n".join(parts)


KEYED_LINES_SQL = (
    "(SELECT *, concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, "
    "date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE))) AS row_key FROM lineitem)"
)
LINES_SQL = KEYED_LINES_SQL + " AS l"
PART_RESULTS_SQL = union_sql(
    violation_sql("part", 2, 1001, "p_partkey", "p_type", "FAIL", "part", "trim(coalesce(p_type, '')) = ''"),
    violation_sql("part", 4, 1002, "p_partkey", "p_size", "PASS-SOFT", "part",
                  "length(trim(CAST(p_size AS VARCHAR))) <> 2"),
    violation_sql("part", 101, 1003, "p_partkey", "p_brand", "FAIL", "part", "p_brand NOT IN ('Brand#1', 'Brand#2')"),
)
CUSTOMER_RESULTS_SQL = union_sql(
    violation_sql("customer", 115, 1101, "c_custkey", "c_acctbal", "FAIL", "customer", "c_acctbal < 0"),
    violation_sql("customer", 101, 1102, "c_custkey", "c_mktsegment", "PASS-SOFT", "customer",
                  "c_mktsegment NOT IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD', 'FURNITURE')"),
)
LINE_RESULTS_SQL = union_sql(
    violation_sql("lineitem", 101, 1303, "row_key", "l_returnflag", "PASS-SOFT", LINES_SQL,
                  "l_returnflag NOT IN ('A', 'N')"),
    violation_sql("lineitem", 9, 1305, "row_key", "strftime(l_shipdate, '%Y-%m-%d %H:%M:%S')", "PASS-SOFT", LINES_SQL,
                  "date_diff('day', l_shipdate, TIMESTAMP '2001-12-01 00:00:00') > 365"),
    violation_sql("lineitem", 112, 1306, "row_key", "l_quantity || ', ' || l_discount", "FAIL", LINES_SQL, "l_quantity * l_discount > 4"),
    violation_sql("lineitem", 113, 1307, "row_key", "l_returnflag || ', ' || l_linestatus", "PASS-SOFT", LINES_SQL,
                  "l_returnflag = 'R' AND l_linestatus = 'O'"),
    violation_sql("lineitem", 1, 1308, "row_key", "l_orderkey || ', ' || l_linenumber", "FAIL", LINES_SQL,
                  "true QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber "
                  "ORDER BY l_shipdate DESC, row_key DESC) > 1"),
    violation_sql("lineitem", 10, 1309, "row_key", "l_orderkey", "FAIL",
                  LINES_SQL + " LEFT JOIN orders ON l_orderkey = o_orderkey", "o_orderkey IS NULL"),
    violation_sql("lineitem", 114, 1310, "row_key", "l_orderkey", "PASS-SOFT",
                  LINES_SQL + " JOIN orders ON l_orderkey = o_orderkey", "l_shipdate < o_orderdate"),
)
EVENT_RESULTS_SQL = union_sql(
    violation_sql("events", 117, 1401, "event_id", "value", "FAIL", "events", "value > 100"),
    violation_sql("events", 101, 1402, "event_id", "event_type", "PASS-SOFT", "events",
                  "event_type NOT IN ('view', 'click', 'signup', 'purchase')"),
)


def status_sql(results: str, source: str, key: str) -> str:
    """Rows of `source` with their worst status as `dq_status`."""
    return (
        f"SELECT s.*, coalesce(w.st, 'PASS') AS dq_status FROM {source} s LEFT JOIN "
        f"(SELECT record_key, CASE WHEN max(CASE WHEN result = 'FAIL' THEN 1 ELSE 0 END) = 1 "
        f"THEN 'FAIL' ELSE 'PASS-SOFT' END AS st FROM ({results}) GROUP BY record_key) w "
        f"ON CAST(s.{key} AS VARCHAR) = w.record_key"
    )


PART_STATUS_SQL = status_sql(PART_RESULTS_SQL, "part", "p_partkey")
CUSTOMER_STATUS_SQL = status_sql(CUSTOMER_RESULTS_SQL, "customer", "c_custkey")
NATION_STATUS_SQL = (
    "SELECT *, CASE WHEN n_regionkey NOT IN (0, 1, 2, 3) OR n_name <> upper(n_name) THEN 'FAIL' ELSE 'PASS' END "
    "AS dq_status FROM nation"
)
