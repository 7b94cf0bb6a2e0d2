"""Steps that loads have in common; each returns its status and row counts."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from assaylake.functions.columns import EPOCH_MARK, ntz
from assaylake.operators.audit import reject_summary
from assaylake.operators.evaluate import RESULT_SCHEMA
from assaylake.operators.loads import (
    load_key,
    newer_or_equal,
    newer_than,
    not_staged,
    stage,
    upsert,
    upserted_rows,
    version_changes,
    version_source,
)
from assaylake.operators.rules import plan_checks
from assaylake.plans.checks import run_checks
from assaylake.sources.lake import BUCKETS, Lake, observed
from assaylake.sources.metadata import Feed, Rule, as_schema, frame
from assaylake.sources.scratch import written_table


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("n")), seen


def _done(seen: Observation) -> dict:
    n = observed(seen, "n")["n"]
    return {"status": "COMPLETED", "rows_read": n, "rows_written": n}


def stage_step(
    lake: Lake, source: DataFrame, table: str, schema: str, key: str, loaded_at: str, hashed: Iterable[str],
    run_id: str, mode: str, as_of: str, overlap: str | None = None,
) -> dict:
    """Source rows newer than the staged ones, or all of them in a full run, with audit columns.

    The mark is kept with each part, so what was staged before is not read. With `overlap`, an interval
    such as "2 days", the source is read again from that long before the mark; rows that are not staged yet
    (late ones, and ties with the mark) are taken too. Only parts that reach into the overlap are compared.
    """
    mark = EPOCH_MARK
    if mode != "FULL":
        mark = lake.mark("bronze", table, "_source_loaded_at") or EPOCH_MARK
    hashed = list(hashed)
    if overlap and mark != EPOCH_MARK:
        since = ntz(mark) - F.expr(f"INTERVAL {overlap}")
        found = stage(source.filter(F.col(loaded_at) >= since), loaded_at, hashed, run_id, as_of)
        staged = staged_since(lake, table, schema, str(lake.spark.range(1).select(since).first()[0]))
        fresh, seen = _counted(not_staged(found, staged, ["record_hash", "_source_loaded_at"]))
    else:
        read, seen = _counted(newer_than(source, loaded_at, mark))
        fresh = stage(read, loaded_at, hashed, run_id, as_of)
    rows = fresh.withColumn(key, load_key(run_id)).select(*as_schema(schema).names)
    write = lake.replace if mode == "FULL" else lake.append
    write("bronze", table, rows, marks=("_source_loaded_at",))
    return _done(seen)


def staged_since(lake: Lake, table: str, schema: str, since: str) -> DataFrame:
    """Staged rows from `since` on; parts that end before are not read."""
    parts = [p for p in lake.parts("bronze", table) if p.tags.get("max _source_loaded_at", "") >= since]
    return newer_or_equal(lake.read("bronze", table, schema, parts), "_source_loaded_at", since)


def check_step(
    lake: Lake, layer: str, tables: Mapping[str, str], rules: list[Rule], feeds: list[Feed], run_id: str, as_of: str,
    settings: Mapping[str, object], references: Mapping[str, DataFrame] | None = None, fail_closed: bool = False,
) -> dict:
    """Checks of all tables of a layer; one exceeded threshold or unfinished check fails the step."""
    batch = f"{run_id}:{layer}:{uuid.uuid4().hex[:8]}"
    results = {
        table: run_checks(
            lake, layer, table, schema, plan_checks(rules, feeds, table, layer), batch_id=batch, as_of=as_of,
            settings=settings, tables=references, fail_closed=fail_closed,
        )
        for table, schema in tables.items()
    }
    totals = {
        "rows_read": sum(r.get("total_records", 0) for r in results.values()),
        "rows_rejected": sum(r.get("failed_records", 0) for r in results.values()),
    }
    broken = [r["error"] for r in results.values() if r["status"] == "FAILED"]
    if broken:
        return {"status": "FAILED", "error": "; ".join(broken), "tables": results, **totals}
    if any(r["threshold_exceeded"] for r in results.values()):
        return {"status": "FAILED", "reason": "DQ_THRESHOLD_EXCEEDED", "tables": results, **totals}
    return {"status": "COMPLETED", "tables": results, **totals}


def dimension_step(
    lake: Lake, source: DataFrame, table: str, schema: str, key: str, updated: Iterable[str], mode: str, as_of: str,
    buckets: int = BUCKETS,
) -> dict:
    """Update or insert into a dimension, which a full run starts anew.

    The key index names the parts that may hold a key of the source; of these only the ones with a changed
    row are written again. Changed and new rows wait for their checks in parts of their own.
    """
    counted, seen = _counted(source)
    rows = written_table(counted)
    with lake.change() as change:
        change.keyed("silver", table, key, buckets)
        if mode == "FULL" or not lake.exists("silver", table):
            empty = frame(lake.spark, [], schema)
            change.replace("silver", table, upsert(empty, rows, key, updated, as_of))
            return {**_done(seen), "parts_replaced": 0}
        near = lake.parts_with("silver", table, rows.select(key))
        target = lake.read_with_part("silver", table, schema, near)
        changed = written_table(upserted_rows(target, rows, key, updated, as_of))
        if changed.isEmpty():
            return {**_done(seen), "parts_replaced": 0}
        held = {r["_part"] for r in changed.select("_part").filter("_part is not null").distinct().collect()}
        replaced = [p for p in near if p.path in held]
        kept = lake.read("silver", table, schema, replaced).join(
            changed.select(F.col(key).alias("_key")), F.col(key) == F.col("_key"), "left_anti")
        change.remove(replaced)
        change.write_keyed("silver", table, changed.drop("_part").unionByName(kept))
    return {**_done(seen), "parts_replaced": len(replaced)}


def history_step(
    lake: Lake, dimension: str, dimension_schema: str, table: str, schema: str, key: str, tracked: Mapping[str, str],
    run_id: str, as_of: str, buckets: int = BUCKETS,
) -> dict:
    """New and closed versions of a dimension's tracked attributes.

    Read are the dimension's parts that came after the commit tracked last, and of the history the parts
    that may hold their keys. Closed versions are added; parts of current versions are written again only
    if one of theirs is closed.
    """
    now = lake.state()
    since = int(lake.properties("silver", table).get("tracked", 0))
    parts = lake.parts("silver", dimension)
    fresh = lake.read("silver", dimension, dimension_schema, [p for p in parts if p.added > since])
    source = written_table(version_source(fresh, key, tracked))
    result = {"status": "COMPLETED", "rows_read": sum(int(p.tags["qualified"]) for p in parts)}
    with lake.change() as change:
        change.keyed("silver", table, key, buckets)
        change.set("silver", table, tracked=now.version)
        current = [p for p in lake.parts("silver", table) if p.tags["_is_current"] == "true"]
        near = lake.parts_with("silver", table, source.select(key), current)
        known = lake.read_with_part("silver", table, as_schema(schema), near, flag="_is_current").select(
            F.col(key).alias("_key"), F.col("_hash_diff").alias("_known"), "_part")
        moved = written_table(source.join(known, F.col(key) == F.col("_key"), "left").filter(
            ~F.col("_hash_diff").eqNullSafe(F.col("_known"))).drop("_key", "_known"))
        held = {r["_part"] for r in moved.select("_part").filter("_part is not null").distinct().collect()}
        replaced = [p for p in near if p.path in held]
        counted = Observation()
        versions = version_changes(
            lake.read_versions("silver", table, schema, replaced), moved.drop("_part"), key, run_id, as_of
        ).observe(
            counted,
            F.count_if(F.col("_run_id") == run_id).alias("opened"),
            F.count_if(~F.col("_is_current")).alias("closed"),
        )
        change.remove(replaced)
        change.write_keyed("silver", table, versions, waiting=False, split="_is_current")
    found = observed(counted, "opened", "closed")
    opened, closed = found["opened"], found["closed"]
    return {**result, "rows_written": opened, "rows_updated": closed, "new_versions": opened, "closed_versions": closed}


def fact_step(lake: Lake, table: str, rows: DataFrame) -> dict:
    counted, seen = _counted(rows)
    lake.replace("gold", table, counted)
    return _done(seen)


def reject_step(lake: Lake, run_id: str) -> dict:
    """Critical violations of this run per table, rule and feed; results of other batches are not read."""
    results = lake.read("audit", "dq_result", RESULT_SCHEMA)
    own = results.filter(F.col("dq_batch_id").startswith(f"{run_id}:"))
    lake.append("reject", "reject_summary", reject_summary(own).withColumn("run_id", F.lit(run_id)))
    return {"status": "COMPLETED"}
