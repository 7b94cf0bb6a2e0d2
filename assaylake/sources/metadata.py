"""Rule, feed and step metadata: record types, Spark schemas and the seeded values.

Metadata tables hold one row per rule or per bound column, never per data row, so
reading them to the driver is bounded by what people configured.
"""

from __future__ import annotations

from dataclasses import dataclass, fields, is_dataclass
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class Rule:
    """A reusable check. `rule_exp` is a Spark SQL expression with ${...} tokens: either a
    boolean that is true for a bad row, or a text that is 'FAIL' for a bad row."""

    rule_id: int
    category_id: int
    rule_code: str
    rule_desc: str
    rule_exp: str
    rule_category: str  # SIMPLE, MULTIPLE, COMPLEX or SQL_FEED


@dataclass(frozen=True)
class Feed:
    """A rule bound to a column (or several, comma separated) of one table."""

    feed_id: int
    layer: str
    domain: str | None
    rule_id: int
    table_nm: str
    record_key_nm: str
    incremental_date_column: str | None
    dq_rule_input: str
    criticality_ind: str = "Y"
    active_ind: str = "Y"
    execution_group: str | None = None
    dq_rule_input_join_tbl: str | None = None
    dq_rule_input_join_col: str | None = None
    dq_rule_input_where_col: str | None = None

    @property
    def inputs(self) -> list[str]:
        return [c.strip() for c in self.dq_rule_input.split(",")]


@dataclass(frozen=True)
class Step:
    step_id: int
    step_name: str
    step_layer: str
    step_order: float
    depends_on: tuple[int, ...] = ()
    is_active: bool = True


RULE_SCHEMA = (
    "rule_id bigint, category_id int, rule_code string, rule_desc string, rule_exp string, rule_category string"
)
FEED_SCHEMA = (
    "feed_id bigint, layer string, domain string, rule_id bigint, table_nm string, record_key_nm string, "
    "incremental_date_column string, dq_rule_input string, criticality_ind string, active_ind string, "
    "execution_group string, dq_rule_input_join_tbl string, dq_rule_input_join_col string, "
    "dq_rule_input_where_col string"
)
STEP_SCHEMA = (
    "step_id bigint, step_name string, step_layer string, step_order decimal(5,1), depends_on array<bigint>, "
    "is_active boolean"
)
CATEGORY_SCHEMA = "category_id bigint, category_nm string, category_desc string"
CONFIG_SCHEMA = "config_key string, config_value string, config_data_type string, config_category string"
RECIPIENT_SCHEMA = "email_id int, domain string, emails string"


def as_schema(schema: StructType | str) -> StructType:
    return StructType.fromDDL(schema) if isinstance(schema, str) else schema


def frame(spark: SparkSession, rows, schema: StructType | str) -> DataFrame:
    """Inline rows (records or tuples) as a local relation: no Python worker is involved."""
    kind = as_schema(schema)
    tuples = [_values(r) for r in rows]
    layout = to_arrow_schema(kind)
    columns = [pa.array([t[i] for t in tuples], type=f.type) for i, f in enumerate(layout)]
    return spark.createDataFrame(pa.table(columns, schema=layout), kind)


def _values(row) -> tuple:
    return tuple(getattr(row, f.name) for f in fields(row)) if is_dataclass(row) else tuple(row)


def step_frame(spark: SparkSession, steps) -> DataFrame:
    rows = [
        (s.step_id, s.step_name, s.step_layer, Decimal(str(s.step_order)), list(s.depends_on) or None, s.is_active)
        for s in steps
    ]
    return frame(spark, rows, STEP_SCHEMA)


def records(df: DataFrame, kind):
    """Metadata rows of a table as `Rule` or `Feed` records."""
    names = [f.name for f in fields(kind)]
    return [kind(**row.asDict()) for row in df.select(*names).collect()]


def settings(df: DataFrame) -> dict[str, object]:
    """Settings by key, each of its declared kind; a text that is not of it is an error."""
    kinds = {"NUMBER": Decimal, "BOOLEAN": _boolean, "STRING": str}
    rows = df.select("config_key", "config_value", "config_data_type").collect()
    return {r["config_key"]: None if r["config_value"] is None else kinds[r["config_data_type"]](r["config_value"]) for r in rows}


def _boolean(text: str) -> bool:
    if text.strip().upper() not in ("TRUE", "FALSE"):
        raise ValueError(f"{text!r} is neither TRUE nor FALSE")
    return text.strip().upper() == "TRUE"


# Quality dimensions.
CATEGORIES = [
    (1, "Accuracy", "Data reflects the real-world situation it describes."),
    (2, "Completeness", "All required data is present."),
    (3, "Consistency", "Data agrees across datasets and systems."),
    (4, "Uniqueness", "Each record is present once."),
    (5, "Timeliness", "Data is recent enough for its use."),
    (6, "Validity", "Data follows its defined format or domain."),
    (7, "Integrity", "Data is related to what it refers to."),
]

# Rule ids, codes, quality dimensions and kinds. The expressions are true for a bad row.
RULES = [
    Rule(1, 4, "GN_Duplicate", "Columns hold no duplicates", "", "COMPLEX"),
    Rule(2, 2, "GN_NotNull", "Mandatory field is filled", "coalesce(trim(${INPUT1}), '') = ''", "SIMPLE"),
    Rule(3, 2, "GN_LOOKUP", "Code exists in the reference table", "", "COMPLEX"),
    Rule(4, 6, "GN_Length2", "Text has 2 characters", "length(trim(${INPUT1})) <> 2", "SIMPLE"),
    Rule(5, 6, "GN_Length9", "Text has 9 characters", "length(trim(${INPUT1})) <> 9", "SIMPLE"),
    Rule(6, 6, "GN_Length10", "Text has 10 characters", "length(trim(${INPUT1})) <> 10", "SIMPLE"),
    Rule(
        7,
        6,
        "GN_FormatTIN",
        "Text has the form xxx-xx-xxxx",
        "NOT coalesce(${INPUT1} LIKE '___-__-%' AND length(translate(${INPUT1}, '-', '')) = 9, false)",
        "SIMPLE",
    ),
    Rule(8, 1, "GN_UpperCase", "Text is in upper case", "${INPUT1} <> upper(${INPUT1})", "SIMPLE"),
    Rule(
        9,
        5,
        "GN_Timeliness",
        "Date is at most 365 days old",
        "datediff(${AS_OF}, try_cast(${COL1} AS DATE)) > 365",
        "SIMPLE",
    ),
    Rule(10, 7, "GN_RefIntegrity", "Parent row exists", "", "COMPLEX"),
    Rule(101, 6, "GN_InList", "Value is in the allowed list", "${INPUT1} NOT IN (${INPUT2})", "SIMPLE"),
    Rule(102, 6, "GN_EmailFormat", "Text looks like an e-mail address", "${INPUT1} NOT LIKE '%@%.%'", "SIMPLE"),
]

# Steps of the provider load in their order.
STEPS = [
    Step(1, "STG_NPI_REGISTRY", "BRONZE", 1.0),
    Step(2, "STG_SPECIALTY_TYPE", "BRONZE", 1.1),
    Step(10, "DQ_CHECK_BRONZE", "DQ_BRONZE", 2.0, (1, 2)),
    Step(20, "LOAD_DIM_PROVIDER", "SILVER", 3.0, (10,)),
    Step(30, "DQ_CHECK_SILVER", "DQ_SILVER", 4.0, (20,)),
    Step(40, "SCD2_PROVIDER_ATTRIBUTES", "SILVER", 5.0, (30,)),
    Step(50, "LOAD_FCT_PROVIDER_360", "GOLD", 6.0, (40,)),
    Step(60, "AUDIT_REJECT_SUMMARY", "AUDIT", 7.0, (50,)),
]

# Settings of the provider load (key, value, type, group).
SETTINGS = [
    ("ENVIRONMENT", "DEV", "STRING", "PIPELINE"),
    ("DQ_BRONZE_THRESHOLD", "90.00", "NUMBER", "DQ"),
    ("DQ_SILVER_THRESHOLD", "90.00", "NUMBER", "DQ"),
    ("ENABLE_DQ_PROFILING", "TRUE", "BOOLEAN", "DQ"),
    ("ENABLE_SCD2", "TRUE", "BOOLEAN", "PIPELINE"),
    ("ENABLE_EMAIL_NOTIFY", "FALSE", "BOOLEAN", "NOTIFICATION"),
]

# Allowed credentials and genders of the provider load.
CREDENTIALS = "'MD','DO','NP','PA','RN','APRN','DPM','DDS','PhD','PharmD','OD','DC'"
GENDERS = "'M','F'"

# Bound columns of the provider load (feed id, rule id, column, criticality, active).
_REGISTRY_FEEDS = [
    (1, 2, "npi_number", "Y", "Y"),
    (2, 2, "provider_name", "Y", "Y"),
    (3, 4, "state", "Y", "Y"),
    (4, 6, "npi_number", "Y", "Y"),
    (5, 1, "npi_number", "Y", "Y"),
    (6, 2, "phone", "N", "Y"),
    (7, 2, "taxonomy_code", "N", "Y"),
    (201, 101, "credential", "Y", "Y"),
]
_SPECIALTY_FEEDS = [
    (8, 2, "specialty_code", "Y", "Y"),
    (9, 2, "specialty_name", "Y", "Y"),
    (10, 4, "state", "Y", "Y"),
    (11, 2, "expiration_date", "N", "Y"),
    (12, 2, "board_certification_req", "N", "Y"),
]
_PROVIDER_FEEDS = [
    (101, 2, "provider_npi", "Y", "Y"),
    (102, 8, "provider_first_name", "Y", "Y"),
    (103, 8, "provider_last_name", "Y", "Y"),
    (104, 2, "address_line_1", "Y", "Y"),
    (105, 2, "city", "Y", "Y"),
    (106, 4, "state", "Y", "Y"),
    (107, 6, "provider_npi", "Y", "Y"),
    (108, 5, "provider_tin", "Y", "N"),
    (109, 7, "provider_tin", "Y", "Y"),
    (110, 1, "provider_npi", "Y", "Y"),
    (202, 101, "credential", "Y", "Y"),
    (203, 2, "phone", "N", "Y"),
    (301, 101, "gender", "N", "Y"),
]
_ALLOWED = {"credential": CREDENTIALS, "gender": GENDERS}


def _provider_feeds(layer: str, table: str, key: str, bound) -> list[Feed]:
    return [
        Feed(
            feed_id, layer, "PROVIDERS", rule_id, table, key, "load_dt", column, critical, active, "GROUP_A",
            dq_rule_input_where_col=_ALLOWED.get(column) if rule_id == 101 else None,
        )
        for feed_id, rule_id, column, critical, active in bound
    ]


FEEDS = [
    *_provider_feeds("BRONZE", "stg_npi_registry", "npi_sk", _REGISTRY_FEEDS),
    *_provider_feeds("BRONZE", "stg_specialty_type", "specialty_sk", _SPECIALTY_FEEDS),
    *_provider_feeds("SILVER", "dim_provider", "provider_sk", _PROVIDER_FEEDS),
]
