"""Evaluate all checks of a table and give every row its status."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaylake.functions.columns import FAIL, PASS, SOFT, any_of, ntz
from assaylake.operators.bad_keys import (
    Probe,
    duplicate_probe,
    lookup_probe,
    older_rows,
    planned_bytes,
    probed_hits,
    superseded,
    unknown_rows,
    unmatched,
)
from assaylake.operators.row_errors import NEVER, error_condition
from assaylake.operators.rules import (
    Check,
    FeedError,
    Tables,
    bind_template,
    failing_condition,
    need_columns,
    quote,
    table_lookup,
    value_text,
    waiting_text,
)
from assaylake.sources.metadata import frame

RESULT_SCHEMA = (
    "dq_batch_id string, layer string, domain string, table_nm string, rule_id bigint, feed_id bigint, "
    "record_key string, record_value string, result string, record_ins_ts timestamp_ntz, record_ins_by string, "
    "dq_check_sql string"
)
ERROR = "ERROR"  # the result of a row on which a check has no value
# Conditions evaluated in one projection; more feeds make more projections.
CHECKS_PER_PASS = 100
# Larger tables are read once more for each duplicate and lookup check, so that less of them is shuffled.
SHARED_SCAN_BYTES = 32 * 2**20
UNKNOWN_BYTES = 2**62  # what Spark assumes of a source without a size is above this


@dataclass
class Evaluation:
    """The outcome of `evaluate`: nothing in it has been computed yet."""

    pending: DataFrame
    results: DataFrame
    checks: list[Check]
    errors: list[tuple[Check, str]]
    keys: dict[int, str] = field(default_factory=dict)  # record key column of each feed
    conditions: list[tuple[Check, Column]] = field(default_factory=list)
    joined_results: DataFrame | None = None  # violations of the checks that look at other rows
    captured: DataFrame | None = None  # `results` and a row with the result ERROR for each row that an expression fails on
    fallible: list[int] = field(default_factory=list)  # feeds that may have such rows


def pending_rows(df: DataFrame, status: str = "dq_status") -> DataFrame:
    """Rows that no check has seen yet."""
    return df.filter(F.col(status).isNull()) if status in df.columns else df


def evaluate(
    df: DataFrame,
    checks: Iterable[Check],
    *,
    batch_id: str,
    as_of: str,
    tables: Mapping[str, DataFrame] | Tables | None = None,
    unique_key: bool = True,
    duplicates_among: str = "pending",
    capture_errors: bool = False,
    found: Iterable[tuple[Check, DataFrame, str]] = (),
) -> Evaluation:
    """One row per violation of any check on the pending rows of `df`.

    A check that does not analyse is reported in `errors` and left out. All expression, duplicate and lookup
    checks share one scan, and the duplicate checks one before it that finds their repeated groups. Of tables
    above `SHARED_SCAN_BYTES` only expressions share a scan: their violations are not shuffled, and each other
    check reads and shuffles what it compares. `unique_key` states that the record keys identify rows; without it duplicates and lookups are looked for
    check by check. Duplicates are looked for among the pending rows, or among "all" rows.

    With `capture_errors` a row on which an expression would fail, such as a cast of a text that is no
    number, is no violation of that feed but a row of `captured` with the result ERROR, in the same scan.

    `found` has checks whose violations (record_key, record_value) the caller has, and a text that shows how.
    """
    checks = list(checks)
    compared = df if duplicates_among == "all" and "dq_status" in df.columns else None
    source = pending_rows(df)
    find = table_lookup(tables)
    errors: list[tuple[Check, str]] = []
    usable: list[Check] = []
    conditions: list[Condition] = []
    probes: list[tuple[Check, Probe, str]] = []
    others: list[tuple[Check, DataFrame, str]] = list(found)
    usable += [check for check, _, _ in others]
    large = SHARED_SCAN_BYTES < planned_bytes(source) < UNKNOWN_BYTES
    for check in checks:
        try:
            need_columns(source, [check.feed.record_key_nm])
            if check.kind == "expression":
                conditions.append(_condition(source, check, as_of, capture_errors))
            elif unique_key and compared is None and (probe := _probe(source, check, find)):
                if large:
                    alone = older_rows if probe.order else unknown_rows
                    others.append((check, alone(source, probe, value_text(check.feed.inputs)), _evidence(source, check, compared)))
                else:
                    probes.append((check, probe, _evidence(source, check, compared)))
            else:
                others.append((check, *_violations(source, check, as_of, find, compared)))
            usable.append(check)
        except (FeedError, PySparkException) as error:
            errors.append((check, str(error)))

    passes = [conditions[i : i + CHECKS_PER_PASS] for i in range(0, len(conditions), CHECKS_PER_PASS)] or [[]]
    parts = [_one_scan(source, own, probes if i == 0 else [], batch_id, as_of) for i, own in enumerate(passes)]
    joined = [_with_feed(hits.withColumn("_pos", F.lit(0)), [(c, sql)], batch_id, as_of) for c, hits, sql in others]
    parts = [p for p in parts if p is not None] + joined
    probed = _one_scan(source, [], probes, batch_id, as_of)
    joined += [] if probed is None else [probed]
    captured = reduce(DataFrame.unionByName, parts) if parts else frame(df.sparkSession, [], RESULT_SCHEMA)
    fallible = [c.check.feed.feed_id for c in conditions if c.raises is not None]
    return Evaluation(
        pending=source,
        results=captured.filter(F.col("result") != ERROR) if fallible else captured,
        checks=usable,
        errors=errors,
        keys={c.feed.feed_id: c.feed.record_key_nm for c in usable},
        conditions=[(c.check, c.fails) for c in conditions],
        joined_results=reduce(DataFrame.unionByName, joined) if joined else None,
        captured=captured,
        fallible=fallible,
    )


@dataclass
class Condition:
    check: Check
    fails: Column
    sql: str
    raises: Column | None = None  # true for rows on which the expression has no value


def _condition(source: DataFrame, check: Check, as_of: str, capture_errors: bool) -> Condition:
    fails, sql = failing_condition(source, check, as_of)
    if capture_errors:
        text = error_condition(source, sql)
        if text != NEVER:
            raises = F.coalesce(F.expr(text), F.lit(False))
            return Condition(check, F.when(~raises, fails), sql, raises)
    return Condition(check, fails, sql)


def _probe(source: DataFrame, check: Check, find: Tables) -> Probe | None:
    """The check as a comparison of keys; None if its columns are of kinds that have no plain text."""
    feed = check.feed
    if check.kind == "duplicate":
        need_columns(source, [*feed.inputs, *([feed.incremental_date_column] if feed.incremental_date_column else [])])
        return duplicate_probe(source, feed.inputs, feed.incremental_date_column, feed.record_key_nm)
    if check.kind == "lookup":
        need_columns(source, feed.inputs)
        reference, column, filled = _reference(check, find)
        return lookup_probe(source, feed.inputs[0], reference, column, filled, feed.record_key_nm)
    return None


def _reference(check: Check, find: Tables) -> tuple[DataFrame, str, str]:
    feed = check.feed
    reference = find(feed.dq_rule_input_join_tbl)
    if not feed.dq_rule_input_join_col:
        raise FeedError("a lookup needs a reference column")
    filled = feed.dq_rule_input_where_col or feed.dq_rule_input_join_col
    need_columns(reference, [feed.dq_rule_input_join_col, filled])
    return reference, feed.dq_rule_input_join_col, filled


def _one_scan(df: DataFrame, conditions: list[Condition], probes, batch_id: str, as_of: str) -> DataFrame | None:
    """Violations of many checks in one scan: each row becomes an array of its hits and of the keys to compare."""
    if not conditions and not probes:
        return None

    def hit(i: int, check: Check, error: bool) -> Column:
        return F.struct(
            F.lit(i).alias("_pos"), F.lit(error).alias("_error"),
            F.col(quote(check.feed.record_key_nm)).cast("string").alias("record_key"),
            value_text(check.feed.inputs).alias("record_value"),
        )

    found = []
    for i, c in enumerate(conditions):
        own = F.when(c.fails, hit(i, c.check, False))
        found.append(own if c.raises is None else F.when(c.raises, hit(i, c.check, True)).otherwise(own))
    waiting = waiting_text(df)
    shown = [(c.check, f"SELECT * FROM {c.check.feed.table_nm} WHERE {waiting} AND ({c.sql})") for c in conditions]
    shown += [(check, sql) for check, _, sql in probes]
    if probes:
        first = len(conditions)
        numbered = [(first + i, hit(first + i, check, False), probe) for i, (check, probe, _) in enumerate(probes)]
        hits = probed_hits(df, found, numbered)
    else:
        bad = df.filter(any_of(x for c in conditions for x in (c.fails, c.raises) if x is not None))
        hits = bad.select(F.explode(F.array(*found)).alias("_hit")).filter("_hit is not null").select("_hit.*")
    return _with_feed(hits, shown, batch_id, as_of, errors=any(c.raises is not None for c in conditions))


def _with_feed(
    hits: DataFrame, checks: list[tuple[Check, str]], batch_id: str, as_of: str, errors: bool = False
) -> DataFrame:
    """Attach what the feed says about a violation and the query that shows it; the feed is known by its position."""

    def constant(values, kind: str) -> Column:
        if len(values) == 1:
            return F.lit(values[0]).cast(kind)
        return F.get(F.array(*[F.lit(v).cast(kind) for v in values]), F.col("_pos"))

    only = [c for c, _ in checks]
    result = constant([c.result for c in only], "string")
    return hits.select(
        F.lit(batch_id).alias("dq_batch_id"),
        F.lit(only[0].feed.layer).alias("layer"),
        constant([c.feed.domain for c in only], "string").alias("domain"),
        F.lit(only[0].feed.table_nm).alias("table_nm"),
        constant([c.rule.rule_id for c in only], "bigint").alias("rule_id"),
        constant([c.feed.feed_id for c in only], "bigint").alias("feed_id"),
        F.col("record_key"),
        F.col("record_value"),
        (F.when(F.col("_error"), ERROR).otherwise(result) if errors else result).alias("result"),
        ntz(as_of).alias("record_ins_ts"),
        F.current_user().alias("record_ins_by"),
        constant([sql for _, sql in checks], "string").alias("dq_check_sql"),
    )


def _evidence(df: DataFrame, check: Check, compared) -> str:
    """A query that shows the violations of a duplicate or lookup check."""
    feed, waiting = check.feed, waiting_text(df)
    if check.kind == "duplicate":
        order, key = feed.incremental_date_column, quote(feed.record_key_nm)
        by = ", ".join(quote(c) for c in feed.inputs)
        inner, outer = (f"WHERE {waiting}", "") if compared is None else ("", f" AND {waiting}")
        newest = f"{quote(order)} DESC, {key} DESC" if order else f"{key} DESC"
        return (
            f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY {newest}) AS _place "
            f"FROM {feed.table_nm} {inner}) WHERE _place > 1{outer}"
        )
    filled = feed.dq_rule_input_where_col or feed.dq_rule_input_join_col
    return (
        f"SELECT a.* FROM {feed.table_nm} a LEFT JOIN {feed.dq_rule_input_join_tbl} b "
        f"ON a.{quote(feed.inputs[0])} = b.{quote(feed.dq_rule_input_join_col)} "
        f"WHERE {'a.' if waiting != 'TRUE' else ''}{waiting} AND b.{quote(filled)} IS NULL"
    )


def _violations(df, check: Check, as_of, find: Tables, compared) -> tuple[DataFrame, str]:
    """Violations of a check that looks at more than one row, and a query that shows them."""
    feed = check.feed
    if check.kind == "query":
        return _query_violations(df, check, as_of, find)
    need_columns(df, feed.inputs)
    if check.kind == "duplicate":
        order = feed.incremental_date_column
        if order:
            need_columns(df, [order])
        sql = _evidence(df, check, compared)
        if compared is not None:
            new = F.col("dq_status").isNull()
            return superseded(compared, feed.inputs, order, feed.record_key_nm, report=new), sql
        return superseded(df, feed.inputs, order, feed.record_key_nm), sql
    reference, column, filled = _reference(check, find)
    hits = unmatched(df, feed.inputs[0], reference, column, filled, feed.record_key_nm)
    return hits, _evidence(df, check, compared)


def _query_violations(df: DataFrame, check: Check, as_of, find: Tables) -> tuple[DataFrame, str]:
    """A rule that is a whole query: it yields the key, the input columns and `result`."""
    feed, spark = check.feed, df.sparkSession
    waiting = waiting_text(df)
    shown = bind_template(check, feed.table_nm, as_of, feed.dq_rule_input_join_tbl or "", waiting)
    views = [f"dq_source_{uuid.uuid4().hex}", f"dq_reference_{uuid.uuid4().hex}"]
    try:
        df.createOrReplaceTempView(views[0])
        if feed.dq_rule_input_join_tbl:
            find(feed.dq_rule_input_join_tbl).createOrReplaceTempView(views[1])
        answer = spark.sql(bind_template(check, views[0], as_of, views[1], waiting))
    finally:
        for view in views:
            spark.catalog.dropTempView(view)
    need_columns(answer, [feed.record_key_nm, *feed.inputs, "result"])
    hits = answer.filter(F.col("result") == FAIL).select(
        F.col(quote(feed.record_key_nm)).cast("string").alias("record_key"),
        value_text(feed.inputs).alias("record_value"),
    )
    return hits, f"SELECT * FROM ({shown}) WHERE result = '{FAIL}'"


def worst_by_record(results: DataFrame) -> DataFrame:
    """FAIL or PASS-SOFT per record; the worst result wins."""
    critical = F.max(F.col("result") == FAIL)
    return results.groupBy("record_key").agg(F.when(critical, FAIL).otherwise(SOFT).alias("computed_status"))


def worst_by_feed_criticality(results: DataFrame, feeds: DataFrame) -> DataFrame:
    """The same per record from the feeds' current criticality instead of the stored result."""
    joined = results.select("record_key", "feed_id").join(feeds.select("feed_id", "criticality_ind"), "feed_id")
    critical = F.sum(F.when(F.col("criticality_ind") == "Y", 1).otherwise(0)) > 0
    return joined.groupBy("record_key").agg(F.when(critical, FAIL).otherwise(SOFT).alias("computed_status"))


def merge_status(df: DataFrame, results: DataFrame, key: str, status: str = "dq_status") -> DataFrame:
    """Write statuses back: pending rows with violations get the worst one, the rest PASS.

    Rows that already have a status keep it. A row with a NULL key matches no violation
    and becomes PASS without taking part in the join.
    """
    column = F.col(quote(key))
    base = df if status in df.columns else df.withColumn(status, F.lit(None).cast("string"))
    worst = worst_by_record(results.filter("record_key is not null")).withColumnRenamed("record_key", "_record")
    keyed = base.filter(column.isNotNull()).join(worst, column.cast("string") == F.col("_record"), "left")
    merged = keyed.withColumn(status, F.coalesce(status, "computed_status", F.lit(PASS))).select(*base.columns)
    unkeyed = base.filter(column.isNull()).withColumn(status, F.coalesce(status, F.lit(PASS)))
    return merged.unionByName(unkeyed)


def merge_statuses(df: DataFrame, results: DataFrame, keys: Mapping[int, str], status: str = "dq_status") -> DataFrame:
    """`merge_status` where the feeds of a table may name different key columns.

    Violations are joined once for each key column; the worst status wins.
    """
    base = df if status in df.columns else df.withColumn(status, F.lit(None).cast("string"))
    columns = sorted(set(keys.values()))
    parts = [f"_by_{i}" for i in range(len(columns))]
    merged = base
    for column, part in zip(columns, parts):
        own = [feed for feed, key in keys.items() if key == column]
        found = results if len(columns) == 1 else results.filter(F.col("feed_id").isin(own))
        merged = merge_status(merged.withColumn(part, F.lit(None).cast("string")), found, column, part)
    judged = worst_of(*map(F.col, parts)) if parts else F.lit(PASS)
    return merged.withColumn(status, F.coalesce(status, judged)).select(*base.columns)


def worst_of(*statuses: Column) -> Column:
    """FAIL over PASS-SOFT over PASS."""
    return F.when(any_of(s == FAIL for s in statuses), FAIL).when(any_of(s == SOFT for s in statuses), SOFT).otherwise(PASS)


def score_rows(df: DataFrame, outcome: Evaluation, status: str = "dq_status") -> DataFrame:
    """`merge_statuses` for unique keys: expression checks are judged in place.

    Only violations of duplicate, lookup and query checks are joined; without any, the
    status is a plain row expression and nothing is shuffled. A violation counts only for
    rows whose key in that feed is not NULL.
    """
    base = df if status in df.columns else df.withColumn(status, F.lit(None).cast("string"))

    def hit(result: str) -> Column:
        keyed = [F.col(quote(c.feed.record_key_nm)).isNotNull() & test for c, test in outcome.conditions if c.result == result]
        return any_of(keyed)

    judged = F.when(hit(FAIL), FAIL).when(hit(SOFT), SOFT).otherwise(PASS)
    if outcome.joined_results is None:
        return base.withColumn(status, F.coalesce(status, judged))
    in_place = {check.feed.feed_id for check, _ in outcome.conditions}
    keys = {feed: key for feed, key in outcome.keys.items() if feed not in in_place}
    # Judged before the join, which then moves one word instead of the columns of all conditions.
    marked = base.withColumn("_judged", F.when(F.col(status).isNull(), judged)).withColumn("_other", F.col(status))
    joined = merge_statuses(marked, outcome.joined_results, keys, "_other")
    return joined.withColumn(status, F.coalesce(status, worst_of(F.col("_judged"), F.col("_other")))).drop("_other", "_judged")


def recorded(outcome: Evaluation, found: DataFrame) -> Evaluation:
    """The evaluation with its violations taken from where they were written, so that
    duplicate, lookup and query checks are not computed again for the statuses."""
    if outcome.joined_results is None:
        return outcome
    in_place = [check.feed.feed_id for check, _ in outcome.conditions]
    others = found.filter(~F.col("feed_id").isin(in_place)) if in_place else found
    return replace(outcome, results=found, joined_results=others)


def reset_status(df: DataFrame, status: str = "dq_status") -> DataFrame:
    """All rows pending again."""
    return df.withColumn(status, F.lit(None).cast("string"))
