"""From rule and feed metadata to bound checks on one DataFrame."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType

from assaylake.functions.columns import FAIL, SOFT
from assaylake.sources.metadata import Feed, Rule

TOKEN = re.compile(r"\$\{(\w+)\}")


class FeedError(ValueError):
    """A feed that cannot be evaluated; the other feeds of the table still run."""


@dataclass(frozen=True)
class Check:
    """A feed together with its rule, ready to be evaluated on its table."""

    feed: Feed
    rule: Rule

    @property
    def result(self) -> str:
        return FAIL if self.feed.criticality_ind == "Y" else SOFT

    @property
    def kind(self) -> str:
        category = self.rule.rule_category.replace(" ", "_").upper()
        if category in ("SIMPLE", "MULTIPLE"):
            return "expression"
        if category == "COMPLEX":
            return "lookup" if self.feed.dq_rule_input_join_tbl else "duplicate"
        if category == "SQL_FEED":
            return "query"
        raise FeedError(f"unknown rule category {self.rule.rule_category!r}")


def plan_checks(rules: Iterable[Rule], feeds: Iterable[Feed], table: str, layer: str) -> list[Check]:
    """Active feeds of one table and layer with their rules, in feed order."""
    by_id = {r.rule_id: r for r in rules}
    chosen = [
        f
        for f in feeds
        if f.table_nm.lower() == table.lower()
        and f.layer.upper() == layer.upper()
        and f.active_ind == "Y"
        and f.rule_id in by_id
    ]
    return [Check(f, by_id[f.rule_id]) for f in sorted(chosen, key=lambda f: f.feed_id)]


def feed_plan(feeds: DataFrame, rules: DataFrame) -> DataFrame:
    """The same plan as a report over metadata tables: active feeds with their rule."""
    active = feeds.filter(F.col("active_ind") == "Y")
    return active.join(rules, "rule_id").select(
        "feed_id", "layer", "table_nm", "dq_rule_input", "dq_rule_input_where_col", "rule_id", "rule_code",
        "rule_category", "criticality_ind",
    )


def quote(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def need_columns(df: DataFrame, columns: Iterable[str]) -> None:
    known = {c.lower() for c in df.columns}
    missing = [c for c in columns if c.lower() not in known]
    if missing:
        raise FeedError(f"unknown column(s) {', '.join(missing)}")


def waiting_text(df: DataFrame) -> str:
    """The condition of a row without a status; every row of a table that keeps none."""
    return "dq_status IS NULL" if "dq_status" in df.columns else "TRUE"


def bind_template(
    check: Check, source: str, as_of: str, reference: str = "", waiting: str = "dq_status IS NULL"
) -> str:
    """Replace the ${...} tokens of a rule expression by the feed's columns and parameters."""
    feed = check.feed
    quoted = [quote(c) for c in feed.inputs]
    first = f"CAST({quoted[0]} AS STRING)"
    parameter = feed.dq_rule_input_where_col or ""
    values: Mapping[str, str] = {
        "INPUT1": first,
        "INPUT2": parameter,
        "INPUTN": ", ".join(quoted),
        "TABLE_NAME": source,
        "JOINTBL1": source,
        "JOINTBL2": reference,
        "JOINCOL1": quoted[0],
        "JOINCOL2": feed.dq_rule_input_join_col or "",
        "WHERECOL1": parameter,
        "INCREMENTAL_DATE_COLUMN": waiting,
        "AS_OF": f"TIMESTAMP_NTZ '{as_of}'",
        **{f"COL{i}": name for i, name in enumerate(quoted, 1)},
    }

    def value(match: re.Match) -> str:
        if match[1] not in values:
            raise FeedError(f"unknown token {match[0]}")
        return values[match[1]]

    return TOKEN.sub(value, check.rule.rule_exp)


def failing_condition(df: DataFrame, check: Check, as_of: str) -> tuple[Column, str]:
    """The condition of a bad row, analysed against the table's schema, and its SQL text."""
    need_columns(df, check.feed.inputs)
    text = bind_template(check, check.feed.table_nm, as_of, waiting=waiting_text(df))
    kind = df.select(F.expr(text)).schema[0].dataType  # raises AnalysisException for a bad expression
    if isinstance(kind, BooleanType):
        return F.expr(text), text
    if isinstance(kind, StringType):
        return F.expr(text) == FAIL, f"({text}) = '{FAIL}'"
    raise FeedError(f"rule {check.rule.rule_code} yields {kind.simpleString()}, not a boolean or a text")


def value_text(columns: Iterable[str]) -> Column:
    """The checked value as text; several columns are shown side by side."""
    parts = [F.col(quote(c)).cast("string") for c in columns]
    return parts[0] if len(parts) == 1 else F.concat_ws(", ", *parts)


Tables = Callable[[str], DataFrame]


def table_lookup(tables: Mapping[str, DataFrame] | Tables | None) -> Tables:
    """Reference tables by name, from a mapping or from a function that reads them."""
    if callable(tables):
        return tables
    known = {k.lower(): v for k, v in (tables or {}).items()}

    def find(name: str) -> DataFrame:
        if name.lower() not in known:
            raise FeedError(f"unknown table {name}")
        return known[name.lower()]

    return find
