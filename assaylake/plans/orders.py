"""The order load: orders from raw to a fact of customers' order states, over the same steps."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaylake.functions.columns import decode
from assaylake.operators.loads import denormalize, keep_latest, layer_gate
from assaylake.plans import steps
from assaylake.plans.package import run_package
from assaylake.plans.views import monitoring_views
from assaylake.sources.lake import Lake
from assaylake.sources.metadata import RULES, Feed, Rule, Step

_AUDIT = (
    "load_dt timestamp_ntz, update_dt timestamp_ntz, row_status string, dq_status string, record_hash string, "
    "job_id string, _run_id string"
)
STG_ORDERS = (
    "order_sk string, o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderpriority string, "
    "_source_loaded_at timestamp_ntz, " + _AUDIT
)
DIM_CUSTOMER = (
    "customer_bk bigint, order_status string, order_priority string, customer_name string, nation_name string, " + _AUDIT
)
HISTORY = (
    "scd_key string, customer_bk bigint, order_status string, order_priority string, _valid_from timestamp_ntz, "
    "_valid_to timestamp_ntz, _is_current boolean, _hash_diff string, _run_id string"
)
UPDATED = ["order_status", "order_priority", "customer_name", "nation_name", "_run_id"]
TRACKED = {"order_status": "order_status", "order_priority": "order_priority"}
STATUS_NAMES = {"O": "Open", "F": "Filled"}

FEEDS = [
    Feed(2001, "BRONZE", "ORDERS", 2, "stg_orders", "order_sk", None, "o_custkey", "Y"),
    Feed(2002, "BRONZE", "ORDERS", 101, "stg_orders", "order_sk", None, "o_orderpriority", "Y",
         dq_rule_input_where_col="'1-URGENT','2-HIGH','3-MEDIUM'"),
    Feed(2003, "BRONZE", "ORDERS", 10, "stg_orders", "order_sk", None, "o_custkey", "Y",
         dq_rule_input_join_tbl="customer", dq_rule_input_join_col="c_custkey"),
    Feed(2004, "BRONZE", "ORDERS", 1, "stg_orders", "order_sk", "_source_loaded_at", "o_orderkey", "Y"),
    Feed(2101, "SILVER", "ORDERS", 101, "dim_customer", "customer_bk", None, "order_status", "N",
         dq_rule_input_where_col="'O','F'"),
]
STEPS = [
    Step(1, "STG_ORDERS", "BRONZE", 1.0),
    Step(10, "DQ_CHECK_BRONZE", "DQ_BRONZE", 2.0, (1,)),
    Step(20, "LOAD_DIM_CUSTOMER", "SILVER", 3.0, (10,)),
    Step(30, "DQ_CHECK_SILVER", "DQ_SILVER", 4.0, (20,)),
    Step(40, "CUSTOMER_HISTORY", "SILVER", 5.0, (30,)),
    Step(50, "LOAD_FCT_CUSTOMER", "GOLD", 6.0, (40,)),
    Step(60, "AUDIT_REJECT_SUMMARY", "AUDIT", 7.0, (50,)),
]


@dataclass
class OrderLoad:
    """All steps over one lake. `orders` has the raw orders that have arrived by `as_of`."""

    lake: Lake
    orders: DataFrame
    customers: DataFrame
    nations: DataFrame
    as_of: str
    settings: Mapping[str, object] = field(default_factory=lambda: {"DQ_BRONZE_THRESHOLD": "90", "DQ_SILVER_THRESHOLD": "90"})
    rules: list[Rule] = field(default_factory=lambda: list(RULES))
    feeds: list[Feed] = field(default_factory=lambda: list(FEEDS))

    def stage_orders(self, run_id: str, mode: str) -> dict:
        raw = self.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
        hashed = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]
        return steps.stage_step(
            self.lake, raw, "stg_orders", STG_ORDERS, "order_sk", "o_orderdate", hashed, run_id, mode, self.as_of)

    def _check(self, layer: str, tables: dict[str, str], run_id: str) -> dict:
        return steps.check_step(
            self.lake, layer, tables, self.rules, self.feeds, run_id, self.as_of, self.settings, {"customer": self.customers})

    def check_bronze(self, run_id: str, mode: str) -> dict:
        return self._check("BRONZE", {"stg_orders": STG_ORDERS}, run_id)

    def load_dimension(self, run_id: str, mode: str) -> dict:
        staged = layer_gate(self.lake.read("bronze", "stg_orders", STG_ORDERS))
        latest = keep_latest(staged, ["o_custkey"], ["_source_loaded_at", "o_orderkey"])
        named = self.customers.join(self.nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        source = latest.join(named, F.col("o_custkey") == F.col("c_custkey")).select(
            F.col("o_custkey").alias("customer_bk"), F.col("o_orderstatus").alias("order_status"),
            F.col("o_orderpriority").alias("order_priority"), F.col("c_name").alias("customer_name"),
            F.col("n_name").alias("nation_name"), "record_hash", F.lit(run_id).alias("_run_id"))
        return steps.dimension_step(self.lake, source, "dim_customer", DIM_CUSTOMER, "customer_bk", UPDATED, mode, self.as_of)

    def check_silver(self, run_id: str, mode: str) -> dict:
        return self._check("SILVER", {"dim_customer": DIM_CUSTOMER}, run_id)

    def dimension(self) -> DataFrame:
        return self.lake.read("silver", "dim_customer", DIM_CUSTOMER)

    def track_history(self, run_id: str, mode: str) -> dict:
        return steps.history_step(
            self.lake, "dim_customer", DIM_CUSTOMER, "customer_history", HISTORY, "customer_bk", TRACKED, run_id, self.as_of)

    def fact(self) -> DataFrame:
        current, closed = self.lake.read_history("silver", "customer_history", HISTORY)
        return denormalize(
            current.unionByName(closed), self.dimension(), "customer_bk",
            [decode(F.col("order_status"), STATUS_NAMES, "Unknown").alias("status_desc"), "order_priority",
             F.col("_is_current").alias("is_current"), F.date_format("_valid_to", "yyyy-MM-dd").alias("valid_to")],
            [F.col("customer_name"), F.col("nation_name")])

    def load_fact(self, run_id: str, mode: str) -> dict:
        return steps.fact_step(self.lake, "fct_customer", self.fact())

    def summarize_rejects(self, run_id: str, mode: str) -> dict:
        return steps.reject_step(self.lake, run_id)

    def register_views(self) -> None:
        """Monitoring reports by name."""
        monitoring_views(self.lake, {
            "stg_orders": self.lake.read("bronze", "stg_orders", STG_ORDERS), "dim_customer": self.dimension()}, self.rules)

    def run(self, mode: str = "INCREMENTAL", resume_run_id: str | None = None) -> dict:
        functions = [
            self.stage_orders, self.check_bronze, self.load_dimension, self.check_silver, self.track_history,
            self.load_fact, self.summarize_rejects,
        ]
        return run_package(self.lake, list(zip(STEPS, functions)), mode, resume_run_id)
