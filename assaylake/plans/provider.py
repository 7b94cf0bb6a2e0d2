"""The provider load: registry and specialties from raw to the gold fact."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaylake.functions.columns import decode, ntz
from assaylake.operators.loads import denormalize, hash_key, join_reference, keep_latest, layer_gate
from assaylake.operators.profile import profile_columns
from assaylake.plans import steps
from assaylake.plans.package import run_package
from assaylake.plans.views import monitoring_views
from assaylake.sources.lake import Lake
from assaylake.sources.metadata import (
    FEEDS,
    RULES,
    SETTINGS,
    STEPS,
)

# Table layouts.
RAW_REGISTRY = (
    "npi_number string, provider_first_name string, provider_last_name string, provider_name string, "
    "credential string, gender string, state string, zip_code string, taxonomy_code string, phone string, "
    "npi_deactivation_flag string, enumeration_date date, source_system string, _loaded_at timestamp_ntz, "
    "address_line_1 string, city string, provider_tin string"
)
RAW_SPECIALTY = (
    "specialty_code string, specialty_name string, specialty_category string, board_certification_req string, "
    "state string, effective_date date, expiration_date date, source_system string, _loaded_at timestamp_ntz"
)
_STAGED = (
    "load_dt timestamp_ntz, update_dt timestamp_ntz, row_status string, dq_status string, record_hash string, "
    "job_id string, _run_id string"
)
STG_REGISTRY = (
    "npi_sk string, npi_number string, provider_first_name string, provider_last_name string, provider_name string, "
    "credential string, gender string, state string, zip_code string, taxonomy_code string, phone string, "
    "npi_deactivation_flag string, enumeration_date date, source_system string, _source_loaded_at timestamp_ntz, "
    "address_line_1 string, city string, provider_tin string, " + _STAGED
)
STG_SPECIALTY = (
    "specialty_sk string, specialty_code string, specialty_name string, specialty_category string, "
    "board_certification_req string, state string, effective_date date, expiration_date date, source_system string, "
    "_source_loaded_at timestamp_ntz, " + _STAGED
)
DIM_PROVIDER = (
    "provider_sk string, provider_bk string, provider_name string, provider_first_name string, "
    "provider_last_name string, credential string, gender string, primary_specialty string, "
    "specialty_category string, state string, zip_code string, phone string, address_line_1 string, city string, "
    "provider_tin string, provider_npi string, deletion_flag string, source_system string, load_dt timestamp_ntz, "
    "update_dt timestamp_ntz, row_status string, dq_status string, record_hash string, job_id string, _run_id string"
)
SCD2_PROVIDER = (
    "scd_key string, provider_bk string, provider_name string, credential string, state string, zip_code string, "
    "primary_specialty string, provider_status string, _valid_from timestamp_ntz, _valid_to timestamp_ntz, "
    "_is_current boolean, _hash_diff string, _run_id string"
)
# Columns an update of the dimension takes from its source, and tracked attributes.
UPDATED = [
    "provider_name",
    "provider_first_name",
    "provider_last_name",
    "credential",
    "gender",
    "primary_specialty",
    "specialty_category",
    "state",
    "zip_code",
    "phone",
    "address_line_1",
    "city",
    "provider_tin",
    "deletion_flag",
    "_run_id",
]
TRACKED = {
    "provider_name": "provider_name",
    "credential": "credential",
    "state": "state",
    "zip_code": "zip_code",
    "primary_specialty": "primary_specialty",
    "row_status": "provider_status",
}
GENDER_NAMES = {"M": "Male", "F": "Female"}


@dataclass
class ProviderLoad:
    """All steps of the load over one lake. `as_of` is the clock of the run."""

    lake: Lake
    registry: DataFrame
    specialties: DataFrame
    as_of: str
    settings: Mapping[str, object] = field(default_factory=lambda: {k: v for k, v, *_ in SETTINGS})
    rules: list = field(default_factory=lambda: list(RULES))
    feeds: list = field(default_factory=lambda: list(FEEDS))
    current_only: bool = False
    fail_closed: bool = False

    def enabled(self, name: str) -> bool:
        return str(self.settings.get(name, "FALSE")).upper() == "TRUE"

    # --- bronze --------------------------------------------------------------------------

    def _stage(self, source: DataFrame, table: str, schema: str, key: str, hashed: list[str], run_id: str, mode: str) -> dict:
        return steps.stage_step(self.lake, source, table, schema, key, "_loaded_at", hashed, run_id, mode, self.as_of)

    def stage_registry(self, run_id: str, mode: str) -> dict:
        hashed = ["npi_number", "provider_name", "state"]
        return self._stage(self.registry, "stg_npi_registry", STG_REGISTRY, "npi_sk", hashed, run_id, mode)

    def stage_specialties(self, run_id: str, mode: str) -> dict:
        hashed = ["specialty_code", "specialty_name", "state"]
        return self._stage(self.specialties, "stg_specialty_type", STG_SPECIALTY, "specialty_sk", hashed, run_id, mode)

    # --- checks --------------------------------------------------------------------------

    def _check(self, layer: str, tables: dict[str, str], run_id: str) -> dict:
        return steps.check_step(
            self.lake, layer, tables, self.rules, self.feeds, run_id, self.as_of, self.settings, fail_closed=self.fail_closed)

    def check_bronze(self, run_id: str, mode: str) -> dict:
        return self._check("BRONZE", {"stg_npi_registry": STG_REGISTRY, "stg_specialty_type": STG_SPECIALTY}, run_id)

    def check_silver(self, run_id: str, mode: str) -> dict:
        return self._check("SILVER", {"dim_provider": DIM_PROVIDER}, run_id)

    # --- silver --------------------------------------------------------------------------

    def dimension_source(self, run_id: str) -> DataFrame:
        """One gated registry row per provider with its gated specialty."""
        registry = layer_gate(self.lake.read("bronze", "stg_npi_registry", STG_REGISTRY))
        registry = keep_latest(registry, ["npi_number"], ["_source_loaded_at", "npi_sk"])
        specialties = layer_gate(self.lake.read("bronze", "stg_specialty_type", STG_SPECIALTY))
        specialties = keep_latest(specialties, ["specialty_code"], ["_source_loaded_at", "specialty_sk"])
        taken = {"specialty_name": "primary_specialty", "specialty_category": "specialty_category"}
        rows = join_reference(registry, "taxonomy_code", specialties, "specialty_code", taken)
        return rows.select(
            hash_key(["npi_number"]).alias("provider_sk"),
            F.col("npi_number").alias("provider_bk"),
            F.col("npi_number").alias("provider_npi"),
            F.col("npi_deactivation_flag").alias("deletion_flag"),
            *[c for c in UPDATED if c not in ("deletion_flag", "_run_id")],
            "source_system",
            "record_hash",
            F.lit(run_id).alias("_run_id"),
        )

    def load_dimension(self, run_id: str, mode: str) -> dict:
        source = self.dimension_source(run_id)
        return steps.dimension_step(self.lake, source, "dim_provider", DIM_PROVIDER, "provider_bk", UPDATED, mode, self.as_of)

    def track_history(self, run_id: str, mode: str) -> dict:
        if not self.enabled("ENABLE_SCD2"):
            return {"status": "COMPLETED"}
        return steps.history_step(
            self.lake, "dim_provider", DIM_PROVIDER, "scd2_provider_attributes", SCD2_PROVIDER, "provider_bk", TRACKED,
            run_id, self.as_of)

    def history(self) -> DataFrame:
        current, closed = self.lake.read_history("silver", "scd2_provider_attributes", SCD2_PROVIDER)
        return current.unionByName(closed)

    # --- gold and audit --------------------------------------------------------------------

    def fact(self, run_id: str) -> DataFrame:
        from_history = [
            "provider_name", "credential", "primary_specialty", "state", "zip_code", "provider_status",
            F.col("_is_current").alias("is_current"), F.col("_valid_from").alias("valid_from"),
            F.col("_valid_to").alias("valid_to"),
        ]
        from_dimension = [
            F.col("provider_sk"), decode(F.col("gender"), GENDER_NAMES, "Unknown").alias("gender_desc"),
            F.col("specialty_category"), F.col("address_line_1"), F.col("city"),
        ]
        dimension = self.lake.read("silver", "dim_provider", DIM_PROVIDER)
        rows = denormalize(self.history(), dimension, "provider_bk", from_history, from_dimension, self.current_only)
        return rows.withColumnRenamed("provider_bk", "provider_npi").withColumns(
            {"_loaded_at": ntz(self.as_of), "_run_id": F.lit(run_id)})

    def load_fact(self, run_id: str, mode: str) -> dict:
        done = steps.fact_step(self.lake, "fct_provider_360", self.fact(run_id))
        if self.enabled("ENABLE_DQ_PROFILING"):
            fact = self.lake.read("gold", "fct_provider_360", self.fact(run_id).schema)
            profile = profile_columns(fact, ["provider_npi", "credential", "primary_specialty", "state"])
            self.lake.append("audit", "column_profile", profile.withColumn("run_id", F.lit(run_id)))
        return done

    def summarize_rejects(self, run_id: str, mode: str) -> dict:
        return steps.reject_step(self.lake, run_id)

    # --- monitoring ------------------------------------------------------------------------

    def register_views(self) -> None:
        """Monitoring reports by name."""
        lake = self.lake
        monitoring_views(lake, {
            "stg_npi_registry": lake.read("bronze", "stg_npi_registry", STG_REGISTRY),
            "stg_specialty_type": lake.read("bronze", "stg_specialty_type", STG_SPECIALTY),
            "dim_provider": lake.read("silver", "dim_provider", DIM_PROVIDER),
        }, self.rules)

    def steps(self):
        functions = [
            self.stage_registry, self.stage_specialties, self.check_bronze, self.load_dimension, self.check_silver,
            self.track_history, self.load_fact, self.summarize_rejects,
        ]
        return list(zip(STEPS, functions))

    def run(self, mode: str = "INCREMENTAL", resume_run_id: str | None = None) -> dict:
        return run_package(self.lake, self.steps(), mode, resume_run_id, self.enabled("ENABLE_EMAIL_NOTIFY"))
