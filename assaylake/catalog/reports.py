"""Profiles, metrics, scores, trends and integrity reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from assaylake.catalog.audit import daily_log
from assaylake.catalog.engine import scored_customers
from assaylake.catalog.inputs import (
    CUSTOMER_FEEDS,
    CUSTOMER_RESULTS_SQL,
    EVENTS_CLOCK,
    LINE_FEEDS,
    LINE_RESULTS_SQL,
    NATION_FEEDS,
    ORDERS_CLOCK,
    PART_FEEDS,
    PART_RESULTS_SQL,
    check_customers,
    check_lines,
    check_nations,
    check_parts,
)
from assaylake.catalog.rules import labelled
from assaylake.operators import profile
from assaylake.operators.loads import layer_gate
from assaylake.sources.metadata import frame
from assaylake.sources.tables import table

PROFILED = ["o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate"]
LAYER_WEIGHTS = {"BRONZE": 1, "SILVER": 3}


def profile_columns(spark, folder):
    return profile.profile_columns(table(spark, folder, "orders"), PROFILED)


def metric_counts(spark, folder):
    df = labelled(spark, folder)
    return profile.metric_counts(df, ["quality", "lang"], {"source": 4, "lang": 2}, ["source", "quality"])


def freshness(spark, folder):
    events = profile.freshness(table(spark, folder, "events"), "events", "ts", EVENTS_CLOCK, 1)
    return events.unionByName(
        profile.freshness(table(spark, folder, "orders"), "orders", "o_orderdate", ORDERS_CLOCK, 365)
    )


def volume_change(spark, folder):
    """Events per type and day, against the day before."""
    counts = table(spark, folder, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("row_count")
    )
    return profile.volume_change(counts, "event_type", "day", "row_count", 20.0)


def _weight(feed) -> int:
    return 10 if feed.criticality_ind == "Y" else 3


def feed_scores(spark, folder):
    feeds = [f for f in PART_FEEDS + CUSTOMER_FEEDS + NATION_FEEDS + LINE_FEEDS if f.active_ind == "Y"]
    silver = {f.table_nm for f in CUSTOMER_FEEDS + NATION_FEEDS}
    plan = frame(
        spark,
        [(f.feed_id, "SILVER" if f.table_nm in silver else "BRONZE", f.table_nm, _weight(f)) for f in feeds],
        "feed_id bigint, layer string, table_nm string, weight bigint",
    )
    outcomes = {
        "part": check_parts(spark, folder), "customer": check_customers(spark, folder),
        "nation": check_nations(spark, folder), "lineitem": check_lines(spark, folder),
    }
    totals = results = None
    for name, outcome in outcomes.items():
        count = outcome.pending.agg(F.count(F.lit(1)).alias("total")).withColumn("table_nm", F.lit(name))
        totals = count if totals is None else totals.unionByName(count)
        results = outcome.results if results is None else results.unionByName(outcome.results)
    return profile.feed_totals(plan, totals, results)


def dq_score(spark, folder):
    return profile.scorecard(feed_scores(spark, folder), LAYER_WEIGHTS)


def dq_trend(spark, folder):
    """Daily share of good events: moving mean of three days and degradation by more than one point."""
    scores = daily_log(spark, folder).select(
        "table_nm", "dq_batch_id",
        F.round((F.col("overall_count") - F.col("failed_count")).cast("double") / F.col("overall_count") * 100, 2)
        .alias("score"),
    )
    return profile.score_trend(scores, "table_nm", "dq_batch_id", 3, 1.0)


def orphans(spark, folder):
    """Order counts of customers that are not among the solvent ones."""
    solvent = table(spark, folder, "customer").filter("c_acctbal >= 0")
    return profile.orphan_keys(table(spark, folder, "orders"), "o_custkey", solvent, "c_custkey")


def fact_completeness(spark, folder):
    """Customers without an urgent order."""
    urgent = table(spark, folder, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
    return profile.uncovered(table(spark, folder, "customer"), "c_custkey", urgent, "o_custkey").select(
        "c_custkey", "c_name"
    )


def reconcile_totals(spark, folder):
    """Orders per priority in the fact of gated customers against the source."""
    price = F.col("o_totalprice").cast("decimal(18,2)").alias("price")
    source = table(spark, folder, "orders").select("o_orderpriority", "o_custkey", price)
    good = layer_gate(scored_customers(spark, folder)).select(F.col("c_custkey").alias("o_custkey"))
    found = profile.reconcile(source, source.join(good, "o_custkey"), "o_orderpriority", ["price"])
    doubles = {c: F.col(c).cast("double") for c in ("left_price", "right_price")}
    return found.withColumns(doubles)


_LABELLED = "documents LEFT JOIN labels USING (doc_id)"


def _profile_sql(column):
    text = f"strftime({{}}({column}), '%Y-%m-%d %H:%M:%S')" if column == "o_orderdate" else f"CAST({{}}({column}) AS VARCHAR)"
    return (
        f"SELECT '{column}' AS column_name, count(*) AS row_count, "
        f"round(CAST(count(*) - count({column}) AS DOUBLE) / count(*) * 100, 2) AS null_pct, "
        f"round(CAST(count(DISTINCT {column}) AS DOUBLE) / count(*) * 100, 2) AS distinct_pct, "
        f"{text.format('min')} AS min_value, {text.format('max')} AS max_value FROM orders"
    )


def _score_sql():
    parts = []
    sources = {"part": PART_FEEDS, "customer": CUSTOMER_FEEDS, "nation": NATION_FEEDS, "lineitem": LINE_FEEDS}
    for name, feeds in sources.items():
        layer = "SILVER" if name in ("customer", "nation") else "BRONZE"
        for f in feeds:
            if f.active_ind == "Y":
                parts.append(
                    f"SELECT '{layer}' AS layer, '{name}' AS table_nm, {f.feed_id} AS feed_id, {_weight(f)} AS weight, "
                    f"(SELECT count(*) FROM {name}) AS total"
                )
    nation = (
        "SELECT 1201 AS feed_id FROM nation WHERE n_regionkey NOT IN (0, 1, 2, 3) UNION ALL "
        "SELECT 1202 FROM nation WHERE n_name <> upper(n_name)"
    )
    found = (
        f"SELECT feed_id, count(*) AS failed FROM (SELECT feed_id FROM ({LINE_RESULTS_SQL}) UNION ALL "
        f"SELECT feed_id FROM ({PART_RESULTS_SQL}) UNION ALL SELECT feed_id FROM ({CUSTOMER_RESULTS_SQL}) "
        f"UNION ALL {nation}) GROUP BY feed_id"
    )
    return (
        "WITH t AS (SELECT layer, table_nm, round(CAST(sum(weight * (total - coalesce(failed, 0))) AS DOUBLE) / "
        f"sum(weight * total) * 100, 2) AS score FROM ({' UNION ALL '.join(parts)}) LEFT JOIN ({found}) "
        "USING (feed_id) GROUP BY ALL), l AS (SELECT layer, round(avg(score), 2) AS score FROM t GROUP BY layer), "
        "o AS (SELECT round(sum(score * w) / sum(w), 2) AS score FROM (SELECT score, CASE layer WHEN 'SILVER' THEN 3 "
        "ELSE 1 END AS w FROM l)), a AS (SELECT 'TABLE' AS scope, table_nm AS name, score FROM t UNION ALL "
        "SELECT 'LAYER', layer, score FROM l UNION ALL SELECT 'OVERALL', 'ALL', score FROM o) "
        "SELECT scope, name, score, CASE WHEN score >= 95 THEN 'GREEN' WHEN score >= 80 THEN 'YELLOW' ELSE 'RED' END "
        "AS band FROM a"
    )


QUERIES = {
    "profile_columns": (profile_columns, " UNION ALL ".join(_profile_sql(c) for c in PROFILED)),
    "metric_counts": (metric_counts, (
        f"WITH d AS (SELECT doc_id, source, lang, quality FROM {_LABELLED}) "
        "SELECT 'NULL_COUNT' AS metric, 'quality' AS column_name, count(*) - count(quality) AS metric_value FROM d "
        "UNION ALL SELECT 'NULL_COUNT', 'lang', count(*) - count(lang) FROM d "
        "UNION ALL SELECT 'BAD_LENGTH_COUNT', 'source', CAST(count(*) FILTER (length(trim(source)) <> 4) AS BIGINT) "
        "FROM d UNION ALL SELECT 'BAD_LENGTH_COUNT', 'lang', "
        "CAST(count(*) FILTER (length(trim(lang)) <> 2) AS BIGINT) FROM d "
        "UNION ALL SELECT 'DUPLICATE_COUNT', 'source', count(*) - count(DISTINCT source) FROM d "
        "UNION ALL SELECT 'DUPLICATE_COUNT', 'quality', "
        "count(*) - count(DISTINCT coalesce(quality, -1)) FROM d")),
    "freshness": (freshness, (
        "SELECT *, age_days > lim AS is_stale FROM (SELECT 'events' AS table_nm, max(ts) AS newest, "
        f"CAST(date_diff('day', max(ts), TIMESTAMP '{EVENTS_CLOCK}') AS INTEGER) AS age_days, 1 AS lim FROM events "
        f"UNION ALL SELECT 'orders', max(o_orderdate), CAST(date_diff('day', max(o_orderdate), TIMESTAMP "
        f"'{ORDERS_CLOCK}') AS INTEGER), 365 FROM orders)").replace(
            "SELECT *, age_days", "SELECT table_nm, newest, age_days, age_days", 1)),
    "volume_change": (volume_change, (
        "SELECT *, coalesce(abs(change_pct) > 20, false) AS is_anomaly FROM (SELECT *, "
        "round(CAST(row_count - previous_count AS DOUBLE) / previous_count * 100, 2) AS change_pct FROM ("
        "SELECT event_type, day, row_count, lag(row_count) OVER (PARTITION BY event_type ORDER BY day) "
        "AS previous_count FROM (SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS row_count FROM events "
        "GROUP BY ALL)))")),
    "dq_score": (dq_score, _score_sql()),
    "dq_trend": (dq_trend, (
        "SELECT table_nm, dq_batch_id, score, round(avg(score) OVER (ORDER BY dq_batch_id ROWS BETWEEN 2 PRECEDING "
        "AND CURRENT ROW), 2) AS moving_score, round(score - lag(score) OVER (ORDER BY dq_batch_id), 2) "
        "AS score_change, coalesce(round(score - lag(score) OVER (ORDER BY dq_batch_id), 2) < -1, false) "
        "AS is_degraded FROM (SELECT 'events' AS table_nm, strftime(date_trunc('day', ts), '%Y%m%d') AS dq_batch_id, "
        "round(CAST(count(*) FILTER (NOT value > 100) AS DOUBLE) / count(*) * 100, 2) AS score FROM events "
        "GROUP BY ALL)")),
    "orphans": (orphans, (
        "SELECT o_custkey AS foreign_key, count(*) AS row_count FROM orders WHERE NOT EXISTS (SELECT 1 FROM customer "
        "WHERE c_custkey = o_custkey AND c_acctbal >= 0) GROUP BY o_custkey")),
    "fact_completeness": (fact_completeness, (
        "SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey "
        "AND o_orderpriority = '1-URGENT')")),
    "reconcile_totals": (reconcile_totals, (
        "SELECT * FROM (SELECT o_orderpriority, count(*) AS left_rows, "
        "CAST(count(*) FILTER (c_acctbal >= 0) AS BIGINT) AS right_rows, "
        "CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS left_price, "
        "CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (c_acctbal >= 0) AS DOUBLE) AS right_price FROM orders "
        "JOIN customer ON o_custkey = c_custkey GROUP BY 1) WHERE left_rows <> right_rows OR left_price <> "
        "right_price")),
}
