"""The order load as a whole, metadata read from tables, evidence that is run, and keys of several kinds."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaylake.catalog.inputs import (
    BATCH,
    CATALOG_RULES,
    LINE_RESULTS_SQL,
    PART_FEEDS,
    PART_RESULTS_SQL,
    check,
    check_lines,
    lines,
    union_sql,
)
from assaylake.catalog.layers import FIRST, SECOND
from assaylake.functions.columns import ntz
from assaylake.operators.audit import EVENT_SCHEMA, step_states
from assaylake.operators.evaluate import RESULT_SCHEMA, evaluate, score_rows
from assaylake.operators.rules import plan_checks
from assaylake.operators.summary import gate, summarize
from assaylake.plans.checks import LOG_SCHEMA, run_checks
from assaylake.plans.orders import FEEDS, OrderLoad
from assaylake.sources.lake import Lake
from assaylake.sources.metadata import CONFIG_SCHEMA, FEED_SCHEMA, RULE_SCHEMA, Feed, Rule, frame, records, settings
from assaylake.sources.scratch import scratch_dir
from assaylake.sources.tables import table


def _lake(spark) -> Lake:
    return Lake(spark, f"{scratch_dir(spark)}/lake-{uuid.uuid4().hex}")


def _load(spark, folder, lake, as_of, before=None) -> OrderLoad:
    orders = table(spark, folder, "orders")
    arrived = orders.filter(F.col("o_orderdate") < ntz(before)) if before else orders
    return OrderLoad(lake, arrived, table(spark, folder, "customer"), table(spark, folder, "nation"), as_of)


def two_loads(spark, folder) -> tuple[Lake, OrderLoad, list[dict]]:
    """A full load of the early orders, an incremental one of the rest, and one that finds nothing new."""
    lake = _lake(spark)
    first = _load(spark, folder, lake, FIRST, before=FIRST).run("FULL")
    load = _load(spark, folder, lake, SECOND)
    return lake, load, [first, load.run(), load.run()]


def package_fact(spark, folder) -> DataFrame:
    _, load, _ = two_loads(spark, folder)
    return load.fact()


def _steps(lake: Lake, runs: list[dict]) -> DataFrame:
    """Step states with the runs numbered in their order."""
    events = lake.read("audit", "step_event", EVENT_SCHEMA).filter("step_id is not null")
    number = F.lit(None).cast("int")
    for i, run in enumerate(runs, 1):
        number = F.when(F.col("run_id") == run["run_id"], F.lit(i)).otherwise(number)
    errors = events.groupBy("run_id", "step_id").agg(
        F.count_if(F.col("event") == "ERROR").alias("error_count"), F.count_if(F.col("event") == "START").alias("start_count"))
    states = step_states(events).join(errors, ["run_id", "step_id"])
    return states.select(number.alias("run"), "step_name", "status", "rows_read", "rows_written", "rows_rejected",
                         "error_count", "start_count")


def package_views(spark, folder) -> DataFrame:
    """The monitoring views of a load, read by their names."""
    lake = _lake(spark)
    load = _load(spark, folder, lake, SECOND)
    load.run("FULL")
    load.register_views()
    parts = [
        "SELECT 'status' AS view_nm, concat_ws('|', tbl, dq_status) AS item, cnt FROM dq_status",
        "SELECT 'failures', concat_ws('|', table_nm, rule_id), cnt FROM dq_failures",
        "SELECT 'categories', category_nm, violation_count FROM dq_categories WHERE violation_count > 0",
        "SELECT 'log', table_nm, overall_count FROM dq_current_log",
        "SELECT 'steps', step_name, rows_read FROM step_states",
        "SELECT 'runs', run_status, completed_steps FROM run_states",
    ]
    return spark.sql(" UNION ALL ".join(parts))


def package_steps(spark, folder) -> DataFrame:
    """Counts of three good runs, and of one whose source has lost a column: its step ends with an ERROR event."""
    lake, load, runs = two_loads(spark, folder)
    load.orders = load.orders.drop("o_orderpriority")
    return _steps(lake, [*runs, load.run()])


def package_resume(spark, folder) -> DataFrame:
    """A run that fails at the gate goes on from there once the limit is raised; what came before is not repeated."""
    lake = _lake(spark)
    load = _load(spark, folder, lake, SECOND)
    load.settings = {"DQ_BRONZE_THRESHOLD": "1"}
    failed = load.run("FULL")
    load.settings = {"DQ_BRONZE_THRESHOLD": "90", "DQ_SILVER_THRESHOLD": "90"}
    load.run("RESUME", failed["run_id"])
    return _steps(lake, [failed])


def from_tables(spark, folder) -> DataFrame:
    """Rules, feeds and thresholds kept in tables: two inserted rows add a check, a setting moves the gate."""
    lake = _lake(spark)
    lake.append("config", "rules", frame(spark, CATALOG_RULES, RULE_SCHEMA))
    lake.append("config", "feeds", frame(spark, PART_FEEDS, FEED_SCHEMA))
    lake.append("config", "rules", frame(spark, [Rule(901, 6, "GN_Size", "Size is at most 45", "${COL1} > 45", "MULTIPLE")], RULE_SCHEMA))
    lake.append("config", "feeds", frame(spark, [Feed(1005, "BRONZE", "PARTS", 901, "part", "p_partkey", None, "p_size", "Y")], FEED_SCHEMA))
    lake.append("config", "settings", frame(spark, [("DQ_BRONZE_THRESHOLD", "42.50", "NUMBER", "DQ")], CONFIG_SCHEMA))
    rules = records(lake.read("config", "rules", RULE_SCHEMA), Rule)
    feeds = records(lake.read("config", "feeds", FEED_SCHEMA), Feed)
    limits = settings(lake.read("config", "settings", CONFIG_SCHEMA))
    outcome = evaluate(table(spark, folder, "part"), plan_checks(rules, feeds, "part", "BRONZE"), batch_id=BATCH, as_of=SECOND)
    gated = gate(summarize(outcome.pending, outcome.results, BATCH, "BRONZE", "part"), limits)
    return gated.select("table_nm", "overall_count", "failed_count", "violation_count", "fail_pct",
                        F.col("threshold").cast("double").alias("threshold"), "threshold_exceeded")


def evidence(spark, folder) -> DataFrame:
    """The recorded query of every feed, run again: it finds as many rows as there are violations."""
    found = check_lines(spark, folder).results
    counts = found.groupBy("feed_id", "dq_check_sql").agg(F.count(F.lit(1)).alias("violation_count"))
    counted = sorted((r["feed_id"], r["dq_check_sql"], r["violation_count"]) for r in counts.collect())  # one row per feed
    lines(spark, folder).createOrReplaceTempView("lineitem")
    table(spark, folder, "orders").createOrReplaceTempView("orders")
    try:
        parts = [spark.sql(f"SELECT CAST({feed} AS BIGINT) AS feed_id, count(*) AS evidence_count FROM ({sql})") for feed, sql, _ in counted]
    finally:
        spark.catalog.dropTempView("lineitem")
        spark.catalog.dropTempView("orders")
    rerun = parts[0]
    for part in parts[1:]:
        rerun = rerun.unionByName(part)
    once = frame(spark, [(feed, count) for feed, _, count in counted], "feed_id bigint, violation_count bigint")
    return once.join(rerun, "feed_id")


KEY_RULES = [
    Rule(911, 6, "Size", "", "${COL1} > 45", "MULTIPLE"),
    Rule(912, 6, "Brand", "", "${COL1} = 'Brand#1'", "MULTIPLE"),
]
KEY_FEEDS = [
    Feed(31, "BRONZE", "PARTS", 911, "part", "no_such_key", None, "p_size"),
    Feed(32, "BRONZE", "PARTS", 911, "part", "p_partkey", None, "p_size", "Y"),
    Feed(33, "BRONZE", "PARTS", 912, "part", "part_code", None, "p_brand", "N"),
    Feed(34, "BRONZE", "PARTS", 1, "part", "part_code", None, "p_brand,p_type,p_size", "Y"),
]


def mixed_keys(spark, folder) -> DataFrame:
    """The first feed names a missing key, the others two different ones: each row still gets its worst status."""
    parts = table(spark, folder, "part").withColumn("part_code", F.concat(F.lit("P"), F.lpad(F.col("p_partkey").cast("string"), 12, "0")))
    outcome = check(parts, KEY_FEEDS, rules=[*CATALOG_RULES, *KEY_RULES])
    return score_rows(parts, outcome).select("p_partkey", "dq_status", F.lit(len(outcome.errors)).alias("bad_feeds"))


GATE_SCHEMA = "p_partkey bigint, p_size int, dq_status string"
GATE_RULES = [
    Rule(921, 6, "Size", "", "${COL1} > 45", "MULTIPLE"),
    Rule(922, 6, "Share", "", "100 / (${COL1} % 2) < 50", "MULTIPLE"),  # fails on even sizes
]
GATE_FEEDS = [
    Feed(41, "SILVER", "PARTS", 921, "part", "p_partkey", None, "p_size", "N"),
    Feed(42, "SILVER", "PARTS", 922, "part", "p_partkey", None, "p_size", "Y"),
]


def closed_gate(spark, folder) -> DataFrame:
    """A critical feed that fails on some rows: left out and logged, or with `fail_closed` the end of the step,
    after which no row has a status and no violation is kept."""
    parts = table(spark, folder, "part").select(
        F.col("p_partkey").cast("bigint"), F.col("p_size").cast("int"), F.lit(None).cast("string").alias("dq_status"))
    checks = plan_checks(GATE_RULES, GATE_FEEDS, "part", "SILVER")
    counted = []
    for name, fail_closed in (("open", False), ("closed", True)):
        lake = _lake(spark)
        lake.append("SILVER", "part", parts)
        run_checks(lake, "SILVER", "part", GATE_SCHEMA, checks, batch_id=BATCH, as_of=SECOND,
                   settings={"DQ_SILVER_THRESHOLD": "90"}, fail_closed=fail_closed)
        for kind, found, item in (
            ("status", lake.read("SILVER", "part", GATE_SCHEMA), "dq_status"),
            ("violations", lake.read("audit", "dq_result", RESULT_SCHEMA), "result"),
            ("log", lake.read("audit", "dq_log", LOG_SCHEMA), "coalesce(error_message, status)"),
        ):
            counted.append(found.groupBy(F.lit(name).alias("gate"), F.lit(kind).alias("kind"), F.expr(item).alias("item")).agg(
                F.count(F.lit(1)).alias("cnt")))
    return reduce(DataFrame.unionByName, counted)


# --- SQL forms -------------------------------------------------------------------------

_GOOD = "o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')"
_EARLY = f"o_orderdate < TIMESTAMP '{FIRST}'"


def _state(condition):
    return (
        "SELECT o_custkey AS bk, o_orderstatus AS s, o_orderpriority AS p FROM orders JOIN customer ON o_custkey = c_custkey "
        f"WHERE {_GOOD} AND {condition} QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1"
    )


_FACT = (
    f"WITH a AS ({_state(_EARLY)}), b AS ({_state('true')}), v AS ("
    f"SELECT a.bk, a.s, a.p, a.s = b.s AND a.p = b.p AS cur, CASE WHEN a.s = b.s AND a.p = b.p THEN '9999-12-31' "
    f"ELSE '{SECOND[:10]}' END AS valid_to FROM a JOIN b ON a.bk = b.bk UNION ALL "
    "SELECT b.bk, b.s, b.p, true, '9999-12-31' FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.bk = b.bk AND a.s = b.s AND a.p = b.p)) "
    "SELECT bk AS customer_bk, CASE s WHEN 'O' THEN 'Open' WHEN 'F' THEN 'Filled' ELSE 'Unknown' END AS status_desc, "
    "p AS order_priority, cur AS is_current, valid_to, c_name AS customer_name, n_name AS nation_name "
    "FROM v JOIN customer ON bk = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey"
)


def _step(run, name, read, written, rejected, status="COMPLETED", errors=0, starts=1):
    return (
        f"SELECT {run} AS run, '{name}' AS step_name, '{status}' AS status, CAST(({read}) AS BIGINT) AS rows_read, "
        f"CAST(({written}) AS BIGINT) AS rows_written, CAST(({rejected}) AS BIGINT) AS rows_rejected, "
        f"CAST({errors} AS BIGINT) AS error_count, CAST({starts} AS BIGINT) AS start_count"
    )


def _run_sql(run, staged, bad, dim, waiting, opened, fact):
    return union_sql(
        _step(run, "STG_ORDERS", staged, staged, 0),
        _step(run, "DQ_CHECK_BRONZE", staged, 0, bad),
        _later_sql(run, dim, waiting, opened, fact),
    )


def _later_sql(run, dim, waiting, opened, fact):
    return union_sql(
        _step(run, "LOAD_DIM_CUSTOMER", dim, dim, 0),
        _step(run, "DQ_CHECK_SILVER", waiting, 0, 0),
        _step(run, "CUSTOMER_HISTORY", dim, opened, 0),
        _step(run, "LOAD_FCT_CUSTOMER", fact, fact, 0),
        _step(run, "AUDIT_REJECT_SUMMARY", 0, 0, 0),
    )


def _count(sql):
    return f"SELECT count(*) FROM ({sql})"


_A, _B = _state(_EARLY), _state("true")
_SAME = f"SELECT 1 FROM ({_A}) a JOIN ({_B}) b ON a.bk = b.bk AND a.s = b.s AND a.p = b.p"
_OPENED = f"({_count(_B)}) - ({_count(_SAME)})"
_STEPS = union_sql(
    _run_sql(1, f"SELECT count(*) FROM orders WHERE {_EARLY}", f"SELECT count(*) FROM orders WHERE {_EARLY} AND NOT {_GOOD}",
             _count(_A), _count(_A), _count(_A), _count(_A)),
    _run_sql(2, f"SELECT count(*) FROM orders WHERE NOT {_EARLY}", f"SELECT count(*) FROM orders WHERE NOT {_EARLY} AND NOT {_GOOD}",
             _count(_B), f"SELECT {_OPENED}", f"SELECT {_OPENED}", f"SELECT ({_count(_A)}) + {_OPENED}"),
    _run_sql(3, "0", "0", _count(_B), "0", "0", f"SELECT ({_count(_A)}) + {_OPENED}"),
    _step(4, "STG_ORDERS", 0, 0, 0, status="FAILED", errors=1),
)
_RESUMED = union_sql(
    _step(1, "STG_ORDERS", "SELECT count(*) FROM orders", "SELECT count(*) FROM orders", 0),
    _step(1, "DQ_CHECK_BRONZE", 0, 0, 0, starts=2),
    _later_sql(1, *[_count(_B)] * 4),
)
_SIZED = "(SELECT CAST(p_partkey AS VARCHAR) AS record_key, 'FAIL' AS result FROM part WHERE p_size > 45)"
_PART_VIOLATIONS = f"(SELECT record_key, result FROM ({PART_RESULTS_SQL}) UNION ALL SELECT * FROM {_SIZED})"

_STAGED_STATUS = (  # orders have no key twice and no NULL customer
    f"(SELECT CASE WHEN NOT {_GOOD} OR c_custkey IS NULL THEN 'FAIL' ELSE 'PASS' END AS st FROM orders LEFT JOIN customer "
    "ON o_custkey = c_custkey)"
)
_VIEWS = union_sql(
    f"SELECT 'status' AS view_nm, 'stg_orders|' || st AS item, count(*) AS cnt FROM {_STAGED_STATUS} GROUP BY st",
    f"SELECT 'status', 'dim_customer|' || CASE WHEN s IN ('O', 'F') THEN 'PASS' ELSE 'PASS-SOFT' END, count(*) FROM ({_B}) GROUP BY ALL",
    f"SELECT * FROM (SELECT 'failures', 'stg_orders|101', count(*) AS n FROM orders WHERE NOT {_GOOD}) WHERE n > 0",
    f"SELECT * FROM (SELECT 'categories', 'Validity', (SELECT count(*) FROM orders WHERE NOT {_GOOD}) + "
    f"(SELECT count(*) FROM ({_B}) WHERE s NOT IN ('O', 'F')) AS n) WHERE n > 0",
    "SELECT 'log', 'stg_orders', count(*) FROM orders",
    f"SELECT 'log', 'dim_customer', count(*) FROM ({_B})",
    f"SELECT 'steps', step_name, rows_read FROM ({_run_sql(1, 'SELECT count(*) FROM orders', '0', *[_count(_B)] * 4)})",
    "SELECT 'runs', 'COMPLETED', CAST(7 AS BIGINT)",
)

_UNEVEN = "'the expression fails on ' || count(*) || ' rows'"
_CLOSED = union_sql(
    "SELECT 'open' AS gate, 'status' AS kind, CASE WHEN p_size > 45 THEN 'PASS-SOFT' ELSE 'PASS' END AS item, count(*) AS cnt "
    "FROM part GROUP BY ALL",
    "SELECT 'closed', 'status', NULL, count(*) FROM part",
    "SELECT 'open', 'violations', 'PASS-SOFT', count(*) FROM part WHERE p_size > 45",
    f"SELECT 'open', 'log', {_UNEVEN}, 1 FROM part WHERE p_size % 2 = 0",
    "SELECT 'open', 'log', 'Success', 1",
    f"SELECT 'closed', 'log', {_UNEVEN}, 1 FROM part WHERE p_size % 2 = 0",
    "SELECT 'closed', 'log', 'critical feeds that cannot be evaluated: [42]', 1",
)

QUERIES = {
    "dq_gate_closed": (closed_gate, _CLOSED),
    "package_views": (package_views, _VIEWS),
    "package_fact": (package_fact, _FACT),
    "package_steps": (package_steps, _STEPS),
    "package_resume": (package_resume, _RESUMED),
    "dq_from_tables": (from_tables, (
        "SELECT *, round(failed_count * 100.0 / overall_count, 2)::DOUBLE AS fail_pct, 42.5::DOUBLE AS threshold, "
        "round(failed_count * 100.0 / overall_count, 2) > 42.5 AS threshold_exceeded FROM (SELECT 'part' AS table_nm, "
        "(SELECT count(*) FROM part) AS overall_count, count(DISTINCT CASE WHEN result = 'FAIL' THEN record_key END) AS failed_count, "
        f"count(*) AS violation_count FROM {_PART_VIOLATIONS})")),
    "dq_evidence": (evidence, (
        f"SELECT feed_id, count(*) AS violation_count, count(*) AS evidence_count FROM ({LINE_RESULTS_SQL}) GROUP BY feed_id")),
    "dq_key_columns": (mixed_keys, (
        "SELECT p_partkey, CASE WHEN p_size > 45 OR place > 1 THEN 'FAIL' WHEN p_brand = 'Brand#1' THEN 'PASS-SOFT' ELSE 'PASS' END "
        "AS dq_status, 1 AS bad_feeds FROM (SELECT *, row_number() OVER (PARTITION BY p_brand, p_type, p_size ORDER BY p_partkey DESC) "
        "AS place FROM part)")),
}
