"""Tables that are kept: older commits, keyed upserts, late rows, lasting numbers and keys, sketches, rollups."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaylake.catalog.inputs import CATALOG_RULES, EVENT_FEEDS, EVENT_RESULTS_SQL, EVENTS_CLOCK, union_sql
from assaylake.catalog.layers import _CHANGED, FIRST, LATE_FROM, RUN, SECOND, _upsert_sql, dim_target, last_orders
from assaylake.functions.columns import detail, ntz
from assaylake.operators import checksums, rollups, sketches
from assaylake.operators.evaluate import evaluate
from assaylake.operators.identity import number_keys
from assaylake.operators.rules import plan_checks
from assaylake.operators.uniqueness import repeated
from assaylake.plans.steps import dimension_step, stage_step
from assaylake.sources.lake import Lake
from assaylake.sources.scratch import scratch_dir
from assaylake.sources.tables import table

# Borders of three batches of events.
FIRST_DAYS, LATER_DAYS = "2024-01-10 00:00:00", "2024-01-20 00:00:00"
OVERLAP = "60 days"


def new_lake(spark) -> Lake:
    return Lake(spark, f"{scratch_dir(spark)}/lake-{uuid.uuid4().hex}")


def batches(spark, folder) -> dict[str, DataFrame]:
    """The events of three periods."""
    events, at = table(spark, folder, "events"), F.col("ts")
    return {
        "one": events.filter(at < ntz(FIRST_DAYS)),
        "two": events.filter((at >= ntz(FIRST_DAYS)) & (at < ntz(LATER_DAYS))),
        "three": events.filter(at >= ntz(LATER_DAYS)),
    }


# --- commits and keyed parts --------------------------------------------------------------


def snapshot_read(spark, folder):
    """Batches appended one by one, then replaced: what readers of the second commit still see."""
    lake = new_lake(spark)
    columns = ["event_id", "event_type", "ts"]
    versions = []
    for batch in batches(spark, folder).values():
        lake.append("bronze", "events", batch.select(*columns))
        versions.append(lake.state().version)
    schema = table(spark, folder, "events").select(*columns).schema
    lake.replace("bronze", "events", table(spark, folder, "events").select(*columns).limit(0))
    return lake.at(versions[1]).read("bronze", "events", schema)


def dim_keyed_upsert(spark, folder):
    """`dim_upsert` over a kept dimension of many parts, of which those without a changed row stay as they are."""
    lake, target = new_lake(spark), dim_target(spark, folder)
    with lake.change() as change:
        change.keyed("silver", "customer_state", "customer_bk", 32)
        change.write_keyed("silver", "customer_state", target)
    source = last_orders(spark, folder, since=LATE_FROM).withColumn("_run_id", F.lit(RUN))
    updated = ["order_status", "order_priority", "_run_id"]
    dimension_step(lake, source, "customer_state", target.schema, "customer_bk", updated, "INCREMENTAL", SECOND)
    return lake.read("silver", "customer_state", target.schema)


# --- late rows ------------------------------------------------------------------------------

STAGED_EVENTS = (
    "event_sk string, event_id bigint, user_id bigint, event_type string, _source_loaded_at timestamp_ntz, load_dt timestamp_ntz, "
    "update_dt timestamp_ntz, row_status string, dq_status string, record_hash string, job_id string, _run_id string"
)


def late_rows(spark, folder):
    """Every tenth event up to the mark arrives late, as does one that ties with it; a third load finds nothing."""
    lake = new_lake(spark)
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type", "ts")
    hashed = ["event_id", "user_id", "event_type"]

    def stage(source, run):
        stage_step(lake, source, "events", STAGED_EVENTS, "event_sk", "ts", hashed, run, "INCREMENTAL", SECOND, overlap=OVERLAP)

    stage(events.filter((F.col("ts") <= ntz(FIRST_DAYS)) & (F.col("event_id") % 10 != 0)), "run-1")
    stage(events, "run-2")
    stage(events, "run-3")
    return lake.read("bronze", "events", STAGED_EVENTS).select("event_id", "_source_loaded_at", "_run_id")


# --- keys that stay ---------------------------------------------------------------------------


def identity_keys(spark, folder):
    """Numbers of customers over two loads: those of the early orders keep theirs in the load of all."""
    lake = new_lake(spark)
    orders = table(spark, folder, "orders").select(F.col("o_custkey").alias("customer_bk"), "o_orderdate")
    early = orders.filter(F.col("o_orderdate") < ntz(FIRST)).select("customer_bk").distinct()
    number_keys(lake, "customer", early, "customer_bk", "customer_sk")
    return number_keys(lake, "customer", orders.select("customer_bk").distinct(), "customer_bk", "customer_sk")


def unique_across_batches(spark, folder):
    """A user's first event of a kind is unique, later ones repeat it, also in later batches; one batch runs twice."""
    lake, found = new_lake(spark), []
    parts = batches(spark, folder)
    for name in ("one", "two", "two", "three"):
        rows = parts[name].select("event_id", "user_id", "event_type", "ts")
        found.append((name, repeated(lake, "first_events", rows, ["user_id", "event_type"], ["ts", "event_id"], name)))
    judged = [df for i, (_, df) in enumerate(found) if i != 1]  # the second run of batch two counts
    return judged[0].unionByName(judged[1]).unionByName(judged[2]).select("event_id", "is_repeated")


# --- sketches and rollups ---------------------------------------------------------------------

PROFILED = ["o_custkey", "o_totalprice", "o_orderpriority", "o_orderdate"]


def profile_merged(spark, folder):
    """Sketches of four batches of orders, one of them loaded twice, merged and held against exact figures."""
    lake, orders = new_lake(spark), table(spark, folder, "orders")
    for turn in (0, 1, 2, 3, 1):
        batch = f"batch-{turn}"
        kept = sketches.column_sketches(orders.filter(F.pmod(F.col("o_orderkey"), F.lit(4)) == turn), PROFILED, batch)
        lake.put("audit", "column_sketch", kept, {"batch": batch})
    merged = sketches.merged_profile(lake.read("audit", "column_sketch", sketches.SKETCH_SCHEMA))
    kinds = {f.name: f.dataType for f in orders.schema.fields}
    numbers = {c: sketches.as_number(F.col(c), kinds[c]) for c in PROFILED}
    medians = F.broadcast(merged.agg(*[F.max(F.when(F.col("column_name") == c, F.col("estimated_median"))).alias(f"m_{c}") for c in PROFILED]))

    def facts(c):
        none = F.lit(None).cast("double")
        below = none if numbers[c] is None else F.count_if(numbers[c] < F.col(f"m_{c}")) / F.count(c)
        upto = none if numbers[c] is None else F.count_if(numbers[c] <= F.col(f"m_{c}")) / F.count(c)
        return F.struct(F.lit(c).alias("name"), F.countDistinct(c).alias("exact"), below.alias("below"), upto.alias("upto"))

    exact = orders.crossJoin(medians).agg(F.array(*[facts(c) for c in PROFILED]).alias("all")).select(F.inline("all"))  # one row
    joined = merged.join(exact, F.col("column_name") == F.col("name"))
    off = F.abs(F.col("estimated_distinct") - F.col("exact")) / F.col("exact")
    return joined.select(
        "column_name", "row_count", "null_pct", (off <= 0.03).alias("distinct_within"),
        ((F.col("below") <= 0.52) & (F.col("upto") >= 0.48)).alias("median_within"))


def rollup_batches(spark, folder):
    """Counts kept of three batches; the second is first loaded in part, and then again in full."""
    lake, parts = new_lake(spark), batches(spark, folder)
    checks = plan_checks(CATALOG_RULES, EVENT_FEEDS, "events", "BRONZE")
    half = parts["two"].filter(F.col("event_id") % 2 == 0)
    for name, rows in (("one", parts["one"]), ("two", half), ("three", parts["three"]), ("two", parts["two"])):
        rollups.keep_rollup(lake, evaluate(rows, checks, batch_id=name, as_of=EVENTS_CLOCK).results, name)
    kept = rollups.rollups(lake)
    rejects = rollups.reject_totals(kept).select(F.lit("REJECT").alias("report"), F.col("reject_reason").alias("item"),
                                                 F.col("reject_count").alias("cnt"))
    rules = rollups.rule_totals(kept).select(
        F.lit("RULE").alias("report"), F.concat_ws("|", "table_nm", "rule_id", "result").alias("item"), "cnt")
    return rejects.unionByName(rules)


# --- reconciliation and details ---------------------------------------------------------------


def reconcile_tree(spark, folder):
    """Orders against a copy with planted changes, losses and additions."""
    left = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    changed = F.when(F.col("o_orderkey") % 997 == 5, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    right = left.filter(F.col("o_orderkey") % 1499 != 7).withColumn("o_totalprice", changed)
    added = left.filter(F.col("o_orderkey") % 1999 == 3).withColumn("o_orderkey", -F.col("o_orderkey") - 1)
    return checksums.reconcile_rows(left, right.unionByName(added), "o_orderkey")


def event_details(spark, folder):
    """A field of the events' free-form details, read by its path."""
    k = detail(F.col("props"), "$.k", "int")
    return table(spark, folder, "events").groupBy("event_type", (k % 10).alias("digit")).agg(
        F.count(F.lit(1)).alias("event_count"), F.sum(k).alias("total"))


_EARLY_KEYS = f"SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderdate < TIMESTAMP '{FIRST}'"
_ORDER = "substr(md5(CAST(k AS VARCHAR)), 1, 4), k"
_CHANGED_PRICE, _LOST = "o_orderkey % 997 = 5", "o_orderkey % 1499 = 7"

QUERIES = {
    "snapshot_read": (snapshot_read, f"SELECT event_id, event_type, ts FROM events WHERE ts < TIMESTAMP '{LATER_DAYS}'"),
    "dim_keyed_upsert": (dim_keyed_upsert, _upsert_sql(_CHANGED)),
    "late_rows": (late_rows, (
        f"SELECT event_id, ts AS _source_loaded_at, CASE WHEN ts <= TIMESTAMP '{FIRST_DAYS}' AND event_id % 10 <> 0 THEN 'run-1' "
        "ELSE 'run-2' END AS _run_id FROM events")),
    "identity_keys": (identity_keys, (
        f"WITH e AS ({_EARLY_KEYS}), l AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_custkey NOT IN (SELECT k FROM e)) "
        f"SELECT k AS customer_bk, row_number() OVER (ORDER BY {_ORDER}) AS customer_sk FROM e UNION ALL "
        f"SELECT k, (SELECT count(*) FROM e) + row_number() OVER (ORDER BY {_ORDER}) FROM l")),
    "unique_across_batches": (unique_across_batches, (
        "SELECT event_id, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) > 1 AS is_repeated FROM events")),
    "profile_merged": (profile_merged, union_sql(*[
        f"SELECT '{c}' AS column_name, count(*) AS row_count, round(CAST(count(*) - count({c}) AS DOUBLE) / count(*) * 100, 2) AS null_pct, "
        f"true AS distinct_within, {'CAST(NULL AS BOOLEAN)' if c == 'o_orderpriority' else 'true'} AS median_within FROM orders" for c in PROFILED])),
    "rollup_batches": (rollup_batches, (
        "SELECT 'REJECT' AS report, 'RULE_' || rule_id || '_FEED_' || feed_id AS item, count(*) AS cnt "
        f"FROM ({EVENT_RESULTS_SQL}) WHERE result = 'FAIL' GROUP BY ALL UNION ALL "
        f"SELECT 'RULE', table_nm || '|' || rule_id || '|' || result, count(*) FROM ({EVENT_RESULTS_SQL}) GROUP BY ALL")),
    "reconcile_tree": (reconcile_tree, union_sql(
        f"SELECT o_orderkey, 'LEFT_ONLY' AS difference FROM orders WHERE {_LOST}",
        f"SELECT o_orderkey, 'CHANGED' FROM orders WHERE {_CHANGED_PRICE} AND NOT {_LOST}",
        "SELECT -o_orderkey - 1, 'RIGHT_ONLY' FROM orders WHERE o_orderkey % 1999 = 3")),
    "event_details": (event_details, (
        "SELECT event_type, CAST(k % 10 AS INTEGER) AS digit, count(*) AS event_count, CAST(sum(k) AS BIGINT) AS total FROM ("
        "SELECT event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events) GROUP BY ALL")),
}
