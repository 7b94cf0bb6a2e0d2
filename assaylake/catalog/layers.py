"""Layer loads: incremental and full staging, keys, dimension, history, fact."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from assaylake.catalog.engine import scored_customers, scored_nations
from assaylake.catalog.inputs import CUSTOMER_STATUS_SQL, NATION_STATUS_SQL
from assaylake.functions.columns import decode, ntz
from assaylake.operators import loads
from assaylake.operators.audit import source_row_counts
from assaylake.operators.profile import overlapping_versions
from assaylake.sources.lake import Lake
from assaylake.sources.metadata import as_schema, frame
from assaylake.sources.scratch import scratch_dir
from assaylake.sources.tables import table

MARK = "2024-01-15 00:00:00"
RUN = "run-2"
FIRST, SECOND = "1998-01-01 00:00:00", "2001-12-01 00:00:00"
LATE_FROM = FIRST  # the second load takes over where the first one ended
STATUS_NAMES = {"O": "Open", "F": "Filled"}


# --- staging ---------------------------------------------------------------------------


def loaded_events(spark, folder):
    """What an earlier run has loaded: events up to the mark."""
    return table(spark, folder, "events").filter(F.col("ts") <= ntz(MARK))


def incremental(spark, folder):
    events = table(spark, folder, "events")
    return loads.newer_than_mark(events, "ts", loaded_events(spark, folder), "ts").select("event_id", "user_id", "ts")


def window_incremental(spark, folder):
    return loads.within_window(table(spark, folder, "events"), "ts", MARK, "2024-01-20 00:00:00").select("event_id", "ts")


def staged_customers(spark, folder):
    source = table(spark, folder, "customer").withColumn("_loaded_at", ntz(MARK))
    return loads.stage(source, "_loaded_at", ["c_custkey", "c_name", "c_mktsegment"], RUN, SECOND)


def stage_rows(spark, folder):
    return staged_customers(spark, folder).select(
        "c_custkey", "c_name", "_source_loaded_at", "load_dt", "update_dt", "row_status", "dq_status", "record_hash",
        "job_id", "_run_id",
    )


def full_refresh(spark, folder):
    """Append an increment to a table, then reload it in full: only the reload is left."""
    lake = Lake(spark, f"{scratch_dir(spark)}/lake-{uuid.uuid4().hex}")
    columns = ["event_id", "event_type", "ts"]
    everything = table(spark, folder, "events").select(*columns)
    lake.append("bronze", "events", loaded_events(spark, folder).select(*columns))
    lake.append("bronze", "events", loads.newer_than(everything, "ts", MARK))
    lake.replace("bronze", "events", everything)
    return lake.read("bronze", "events", everything.schema)


def append_rows(spark, folder):
    """Two appended parts read back as one table."""
    lake = Lake(spark, f"{scratch_dir(spark)}/lake-{uuid.uuid4().hex}")
    columns = ["event_id", "event_type", "ts"]
    lake.append("bronze", "events", loaded_events(spark, folder).select(*columns))
    lake.append("bronze", "events", loads.newer_than(table(spark, folder, "events").select(*columns), "ts", MARK))
    schema = table(spark, folder, "events").select(*columns).schema
    return lake.read("bronze", "events", schema)


def row_counts(spark, folder):
    events = source_row_counts(table(spark, folder, "events"), "events", "ts", MARK)
    orders = source_row_counts(table(spark, folder, "orders"), "orders", "o_orderdate", FIRST)
    return events.unionByName(orders)


def insert_if_absent(spark, folder):
    """Customers known from early orders, plus all customers not among them."""
    early = table(spark, folder, "orders").filter(F.col("o_orderdate") < ntz("1996-01-01"))
    existing = early.select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("origin", F.lit("orders"))
    new = table(spark, folder, "customer").select("c_custkey", F.lit("customers").alias("origin"))
    return loads.insert_if_absent(existing, new, ["c_custkey"])


def surrogate_key(spark, folder):
    customers = table(spark, folder, "customer").select("c_custkey", "c_name")
    keyed = loads.dense_key(customers, "c_custkey", "customer_sk", start=100)
    return keyed.withColumn("customer_hash", loads.hash_key(["c_custkey", "c_name"]))


# --- dimension -------------------------------------------------------------------------


def dim_source(spark, folder):
    """Gated customers with their gated nation; a nation that failed leaves NULL."""
    customers = loads.layer_gate(scored_customers(spark, folder))
    nations = scored_nations(spark, folder)
    joined = loads.join_reference(customers, "c_nationkey", nations, "n_nationkey", {"n_name": "nation_name"})
    return joined.select(
        F.col("c_custkey").alias("customer_bk"), F.col("c_custkey").alias("customer_id"), "c_name", "nation_name",
        F.col("c_mktsegment").alias("segment"),
    )


ORDER_STATE = "customer_bk bigint, order_status string, order_priority string, source_system string"


def last_orders(spark, folder, before=None, since=None):
    """The state of each customer's last order in a period: source of the dimension and its history."""
    orders = table(spark, folder, "orders")
    if before:
        orders = orders.filter(F.col("o_orderdate") < ntz(before))
    if since:
        orders = orders.filter(F.col("o_orderdate") >= ntz(since))
    latest = loads.keep_latest(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return latest.select(
        F.col("o_custkey").alias("customer_bk"), F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderpriority").alias("order_priority"), F.lit(f"orders to {before or 'now'}").alias("source_system"),
    )


def keep_latest(spark, folder):
    return last_orders(spark, folder).select("customer_bk", "order_status", "order_priority")


def dim_target(spark, folder):
    """A dimension loaded from the early orders; all rows have passed their checks."""
    return last_orders(spark, folder, before=FIRST).withColumns({
        "load_dt": ntz(FIRST), "update_dt": F.lit(None).cast("timestamp_ntz"), "row_status": F.lit("ACTIVE"),
        "dq_status": F.lit("PASS"), "_run_id": F.lit("run-1"),
    })


def upserted(spark, folder, reset_unchanged=False):
    source = last_orders(spark, folder, since=LATE_FROM).withColumn("_run_id", F.lit(RUN))
    updated = ["order_status", "order_priority", "_run_id"]
    return loads.upsert(
        dim_target(spark, folder), source, "customer_bk", updated, SECOND, reset_unchanged=reset_unchanged
    )


def dim_upsert(spark, folder):
    return upserted(spark, folder)


def dim_upsert_reset(spark, folder):
    """The variant that re-opens every matched row for checks."""
    return upserted(spark, folder, reset_unchanged=True)


# --- history ---------------------------------------------------------------------------

HISTORY = (
    "scd_key string, customer_bk bigint, order_status string, order_priority string, _valid_from timestamp_ntz, "
    "_valid_to timestamp_ntz, _is_current boolean, _hash_diff string, _run_id string"
)
TRACKED = {"order_status": "order_status", "order_priority": "order_priority"}


def version_rows(spark, folder, **period):
    rows = last_orders(spark, folder, **period).withColumn("dq_status", F.lit("PASS"))
    return loads.version_source(rows, "customer_bk", TRACKED)


def history(spark, folder):
    """The history after a first load from the early orders."""
    empty = frame(spark, [], as_schema(HISTORY))
    source = version_rows(spark, folder, before=FIRST)
    return loads.merge_versions(empty, source, "customer_bk", "run-1", FIRST)


def merged(spark, folder):
    source = version_rows(spark, folder, since=LATE_FROM)
    return loads.merge_versions(history(spark, folder), source, "customer_bk", RUN, SECOND)


def scd2_hash(spark, folder):
    return version_rows(spark, folder)


def scd2_closed(spark, folder):
    source = version_rows(spark, folder, since=LATE_FROM)
    return loads.changed_versions(history(spark, folder), source, "customer_bk").select("customer_bk", "_hash_diff")


def scd2_new(spark, folder):
    source = version_rows(spark, folder, since=LATE_FROM)
    return loads.new_versions(history(spark, folder), source, "customer_bk").select("customer_bk", "_hash_diff")


def scd2_merge(spark, folder):
    return merged(spark, folder).select(
        "scd_key", "customer_bk", "order_status", "order_priority",
        F.date_format("_valid_from", "yyyy-MM-dd").alias("valid_from"),
        F.date_format("_valid_to", "yyyy-MM-dd").alias("valid_to"),
        "_is_current", "_hash_diff", "_run_id",
    )


def scd2_overlap(spark, folder):
    """Each order as a version of 60 days: those still valid when the customer's next one starts."""
    versions = table(spark, folder, "orders").select(
        "o_custkey", "o_orderkey", F.col("o_orderdate").alias("_valid_from"),
        (F.col("o_orderdate") + F.expr("INTERVAL 60 DAYS")).alias("_valid_to"),
    )
    return overlapping_versions(versions, "o_custkey").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("overlap_count"), F.min("next_valid_from").alias("first_overlap")
    )


def gold_fact(spark, folder):
    """All versions with the customer's row; the order status is decoded."""
    customers = scored_customers(spark, folder).withColumnRenamed("c_custkey", "customer_bk")
    rows = loads.denormalize(
        merged(spark, folder), customers, "customer_bk",
        [
            decode(F.col("order_status"), STATUS_NAMES, "Unknown").alias("status_desc"), "order_priority",
            F.col("_is_current").alias("is_current"),
            F.date_format("_valid_to", "yyyy-MM-dd").alias("valid_to"),
        ],
        [F.col("c_name"), F.col("c_mktsegment").alias("segment")],
    )
    return rows


# --- SQL forms -------------------------------------------------------------------------


def _last(condition="true", label="now"):
    return (
        "SELECT o_custkey AS customer_bk, o_orderstatus AS order_status, o_orderpriority AS order_priority, "
        f"'orders to {label}' AS source_system FROM orders WHERE {condition} "
        "QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1"
    )


_EARLY = _last(f"o_orderdate < TIMESTAMP '{FIRST}'", FIRST)
_LATE = _last(f"o_orderdate >= TIMESTAMP '{LATE_FROM}'")
_HASH = "md5(coalesce(order_status, '') || '|' || coalesce(order_priority, ''))"
_CUR = f"(SELECT *, {_HASH} AS h FROM ({_EARLY}))"
_SRC = f"(SELECT *, {_HASH} AS h FROM ({_LATE}))"


def _upsert_sql(changed):
    return (
        "SELECT coalesce(t.customer_bk, s.customer_bk) AS customer_bk, "
        f"CASE WHEN t.customer_bk IS NULL OR {changed} THEN s.order_status ELSE t.order_status END AS order_status, "
        f"CASE WHEN t.customer_bk IS NULL OR {changed} THEN s.order_priority ELSE t.order_priority END "
        "AS order_priority, coalesce(t.source_system, s.source_system) AS source_system, "
        f"CASE WHEN t.customer_bk IS NULL THEN TIMESTAMP '{SECOND}' ELSE TIMESTAMP '{FIRST}' END AS load_dt, "
        f"CASE WHEN t.customer_bk IS NOT NULL AND {changed} THEN TIMESTAMP '{SECOND}' END AS update_dt, "
        "'ACTIVE' AS row_status, "
        f"CASE WHEN t.customer_bk IS NOT NULL AND NOT coalesce({changed}, false) THEN 'PASS' END AS dq_status, "
        f"CASE WHEN t.customer_bk IS NULL OR {changed} THEN '{RUN}' ELSE 'run-1' END AS _run_id "
        f"FROM ({_EARLY}) t FULL JOIN ({_LATE}) s ON t.customer_bk = s.customer_bk"
    )


_CHANGED = "(s.order_status <> t.order_status OR s.order_priority <> t.order_priority)"


def _versions_sql(columns):
    """History after the second load: early versions closed or kept, then new ones."""
    return (
        "SELECT " + columns + " FROM ("
        f"SELECT md5(t.customer_bk || '|{FIRST}') AS scd_key, t.customer_bk, t.order_status, t.order_priority, "
        f"'{FIRST[:10]}' AS valid_from, "
        f"CASE WHEN s.h <> t.h THEN '{SECOND[:10]}' ELSE '9999-12-31' END AS valid_to, "
        "NOT coalesce(s.h <> t.h, false) AS _is_current, t.h AS _hash_diff, 'run-1' AS _run_id "
        f"FROM {_CUR} t LEFT JOIN {_SRC} s ON s.customer_bk = t.customer_bk UNION ALL "
        f"SELECT md5(s.customer_bk || '|{SECOND}'), s.customer_bk, s.order_status, s.order_priority, "
        f"'{SECOND[:10]}', '9999-12-31', true, s.h, '{RUN}' FROM {_SRC} s "
        f"WHERE NOT EXISTS (SELECT 1 FROM {_CUR} t WHERE t.customer_bk = s.customer_bk AND t.h = s.h)) v"
    )


QUERIES = {
    "hwm_incremental": (incremental, (
        "SELECT event_id, user_id, ts FROM events WHERE ts > (SELECT coalesce(max(ts), TIMESTAMP '1900-01-01') "
        f"FROM events WHERE ts <= TIMESTAMP '{MARK}')")),
    "window_incremental": (window_incremental, (
        f"SELECT event_id, ts FROM events WHERE ts > TIMESTAMP '{MARK}' AND ts <= TIMESTAMP '2024-01-20 00:00:00'")),
    "stage_rows": (stage_rows, (
        f"SELECT c_custkey, c_name, TIMESTAMP '{MARK}' AS _source_loaded_at, TIMESTAMP '{SECOND}' AS load_dt, "
        "CAST(NULL AS TIMESTAMP) AS update_dt, 'ACTIVE' AS row_status, CAST(NULL AS VARCHAR) AS dq_status, "
        "md5(c_custkey || '|' || coalesce(c_name, '') || '|' || coalesce(c_mktsegment, '')) AS record_hash, "
        f"'{RUN}' AS job_id, '{RUN}' AS _run_id FROM customer")),
    "full_refresh": (full_refresh, "SELECT event_id, event_type, ts FROM events"),
    "append_rows": (append_rows, "SELECT event_id, event_type, ts FROM events"),
    "source_row_counts": (row_counts, (
        "SELECT 'events' AS source_table, count(*) AS total_count, CAST(count(*) FILTER (ts > TIMESTAMP "
        f"'{MARK}') AS BIGINT) AS incremental_count FROM events UNION ALL SELECT 'orders', count(*), "
        f"CAST(count(*) FILTER (o_orderdate > TIMESTAMP '{FIRST}') AS BIGINT) FROM orders")),
    "insert_if_absent": (insert_if_absent, (
        "WITH e AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01') "
        "SELECT o_custkey AS c_custkey, 'orders' AS origin FROM e UNION ALL SELECT c_custkey, 'customers' "
        "FROM customer WHERE NOT EXISTS (SELECT 1 FROM e WHERE o_custkey = c_custkey)")),
    "surrogate_key": (surrogate_key, (
        "SELECT c_custkey, c_name, 100 + row_number() OVER (ORDER BY substr(md5(CAST(c_custkey AS VARCHAR)), 1, 4), "
        "c_custkey) AS customer_sk, md5(c_custkey || '|' || c_name) AS customer_hash FROM customer")),
    "keep_latest": (keep_latest, f"SELECT customer_bk, order_status, order_priority FROM ({_last()})"),
    "dim_source": (dim_source, (
        "SELECT c_custkey AS customer_bk, c_custkey AS customer_id, c_name, n_name AS nation_name, "
        f"c_mktsegment AS segment FROM ({CUSTOMER_STATUS_SQL}) c LEFT JOIN (SELECT * FROM ({NATION_STATUS_SQL}) "
        "WHERE dq_status IN ('PASS', 'PASS-SOFT')) n ON c_nationkey = n_nationkey "
        "WHERE c.dq_status IN ('PASS', 'PASS-SOFT')")),
    "dim_upsert": (dim_upsert, _upsert_sql(_CHANGED)),
    "dim_upsert_reset": (dim_upsert_reset, _upsert_sql("s.customer_bk IS NOT NULL")),
    "scd2_hash": (scd2_hash, (
        f"SELECT customer_bk, order_status, order_priority, {_HASH} AS _hash_diff FROM ({_last()})")),
    "scd2_closed": (scd2_closed, (
        f"SELECT customer_bk, h AS _hash_diff FROM {_CUR} t WHERE EXISTS (SELECT 1 FROM {_SRC} s "
        "WHERE s.customer_bk = t.customer_bk AND s.h <> t.h)")),
    "scd2_new": (scd2_new, (
        f"SELECT customer_bk, h AS _hash_diff FROM {_SRC} s WHERE NOT EXISTS (SELECT 1 FROM {_CUR} t "
        "WHERE t.customer_bk = s.customer_bk AND t.h = s.h)")),
    "scd2_merge": (scd2_merge, _versions_sql("*")),
    "scd2_overlap": (scd2_overlap, (
        "SELECT o_custkey, count(*) AS overlap_count, min(nxt) AS first_overlap FROM (SELECT o_custkey, o_orderdate, "
        "lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS nxt FROM orders) "
        "WHERE nxt < o_orderdate + INTERVAL 60 DAY GROUP BY o_custkey")),
    "gold_fact": (gold_fact, (
        "SELECT v.customer_bk, CASE order_status WHEN 'O' THEN 'Open' WHEN 'F' THEN 'Filled' ELSE 'Unknown' END "
        "AS status_desc, order_priority, _is_current AS is_current, valid_to, c_name, c_mktsegment AS segment FROM ("
        + _versions_sql("*") + f") v JOIN ({CUSTOMER_STATUS_SQL}) c ON v.customer_bk = c.c_custkey "
        "WHERE c.dq_status IN ('PASS', 'PASS-SOFT')")),
}
