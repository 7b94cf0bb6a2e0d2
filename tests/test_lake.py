"""Commits of a lake, upkeep of its tables, keyed parts, and reads that skip what they do not need."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from assaylake.plans.steps import dimension_step, history_step
from assaylake.sources import commit_log
from assaylake.sources.commit_log import Conflict
from assaylake.sources.lake import BITMAP_BITS, Lake, _bits, _is_set
from assaylake.sources.metadata import frame

SCHEMA = "batch string, k bigint, v string"
DIMENSION = "k bigint, v string, load_dt timestamp_ntz, update_dt timestamp_ntz, row_status string, dq_status string, _run_id string"
HISTORY = (
    "scd_key string, k bigint, v string, _valid_from timestamp_ntz, _valid_to timestamp_ntz, _is_current boolean, "
    "_hash_diff string, _run_id string"
)


def rows(spark, batch, *keys):
    return frame(spark, [(batch, k, "x") for k in keys], SCHEMA)


def kept(df):
    return sorted((r["batch"], r["k"]) for r in df.select("batch", "k").collect())


def test_batches_are_pruned(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    written = lake.append("audit", "r", rows(spark, "run-1:BRONZE:a", 1, 2), ("batch",))
    assert written.columns == ["batch", "k", "v"] and kept(written) == [("run-1:BRONZE:a", 1), ("run-1:BRONZE:a", 2)]
    lake.append("audit", "r", rows(spark, "run-2:BRONZE:b", 3), ("batch",))
    lake.append("audit", "r", rows(spark, "none"), ("batch",))
    own = lake.read("audit", "r", SCHEMA).filter("startswith(batch, 'run-2:')")
    assert kept(own) == [("run-2:BRONZE:b", 3)]
    assert len(own.inputFiles()) >= 1
    plan = own._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch" in plan


def test_parts_are_compacted_and_old_ones_removed(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    for i in range(4):
        lake.append("audit", "r", rows(spark, f"b{i}", i), ("batch",))
    before = kept(lake.read("audit", "r", SCHEMA))
    lake.compact("audit", "r", SCHEMA, ("batch",), at_least=5)
    assert len(lake.parts("audit", "r")) == 4
    lake.compact("audit", "r", SCHEMA, ("batch",))
    assert kept(lake.read("audit", "r", SCHEMA)) == before and len(lake.parts("audit", "r")) == 1
    assert lake.remove_old(keep=1) == 0  # the commit before the last still needs them
    lake.append("audit", "r", rows(spark, "b9", 9), ("batch",))
    assert lake.remove_old(keep=1) == 4
    assert len(list((tmp_path / "audit/r").glob("part=*"))) == 2
    assert len(kept(lake.read("audit", "r", SCHEMA))) == 5
    lake.append("bronze", "t", rows(spark, "a", 1))
    with lake.change() as change:
        change.replace_pending("bronze", "t", rows(spark, "a", 1), lake.parts("bronze", "t"))
    with pytest.raises(ValueError, match="checked"):
        lake.compact("bronze", "t", SCHEMA)


def test_writers_at_the_same_time_lose_nothing(spark, tmp_path):
    lakes = [Lake(spark, str(tmp_path)) for _ in range(8)]
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(lambda i: lakes[i].append("audit", "r", rows(spark, f"w{i}", i)), range(8)))
    assert kept(Lake(spark, str(tmp_path)).read("audit", "r", SCHEMA)) == [(f"w{i}", i) for i in range(8)]
    assert lakes[0].state().version == 8
    # Two that replace the same part: the second one is told, and its rows stay out.
    one, other = lakes[0].change(), lakes[1].change()
    part = lakes[0].parts("audit", "r")[0]
    for change, batch in ((one, "one"), (other, "other")):
        change.remove([part])
        change.append("audit", "r", rows(spark, batch, 100))
    one.__exit__(None)
    with pytest.raises(Conflict):
        other.__exit__(None)
    assert ("one", 100) in kept(lakes[2].read("audit", "r", SCHEMA)) and ("other", 100) not in kept(lakes[2].read("audit", "r", SCHEMA))


def test_tables_change_together_or_not_at_all(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    with lake.change() as change:
        change.append("audit", "a", rows(spark, "x", 1))
        change.append("audit", "b", rows(spark, "x", 2))
    with pytest.raises(RuntimeError, match="half way"):
        with lake.change() as change:
            change.append("audit", "a", rows(spark, "y", 3))
            raise RuntimeError("half way")
    assert kept(lake.read("audit", "a", SCHEMA)) == [("x", 1)] and lake.state().version == 1


def test_earlier_commits_and_stored_states(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(commit_log, "EVERY", 3)
    lake = Lake(spark, str(tmp_path))
    for i in range(7):
        lake.append("audit", "r", rows(spark, f"b{i}", i))
    lake.replace("audit", "r", rows(spark, "new", 0))
    assert [p.name for p in sorted((tmp_path / "_log").glob("*.state"))] == ["000000000003.state", "000000000006.state"]
    fresh = Lake(spark, str(tmp_path))
    assert kept(fresh.read("audit", "r", SCHEMA)) == [("new", 0)]
    for version in (0, 1, 3, 5, 7):
        assert len(kept(fresh.at(version).read("audit", "r", SCHEMA))) == version
    with pytest.raises(ValueError, match="read-only"):
        fresh.at(3).append("audit", "r", rows(spark, "z", 1))
    lake.put("audit", "t", rows(spark, "one", 1, 2), {"batch": "one"})
    lake.put("audit", "t", rows(spark, "two", 3), {"batch": "two"})
    lake.put("audit", "t", rows(spark, "one", 4), {"batch": "one"})
    assert kept(lake.read("audit", "t", SCHEMA)) == [("one", 4), ("two", 3)]


def test_bits(spark):
    df = spark.range(50).select(F.col("id").alias("k"), *[b.alias(f"b{i}") for i, b in enumerate(_bits("id"))])
    bits = df.agg(F.bitmap_construct_agg("b0").alias("bits"))
    own = df.crossJoin(bits)
    assert own.filter(_is_set("bits", "b0")).count() == 50
    others = spark.range(BITMAP_BITS).select(F.col("id").alias("at")).crossJoin(bits)
    assert others.filter(_is_set("bits", "at")).count() == df.select("b0").distinct().count()


def load(lake, source, run, mode="INCREMENTAL"):
    df = frame(lake.spark, [(k, v, run) for k, v in source], "k bigint, v string, _run_id string")
    return dimension_step(lake, df, "d", DIMENSION, "k", ["v", "_run_id"], mode, "2024-01-01 00:00:00", buckets=8)


def check(lake):
    df, waiting = lake.read_pending("silver", "d", DIMENSION)
    with lake.change() as change:
        change.replace_pending("silver", "d", df.withColumn("dq_status", F.coalesce("dq_status", F.lit("PASS"))), waiting)


def track(lake, run, as_of):
    return history_step(lake, "d", DIMENSION, "h", HISTORY, "k", {"v": "v"}, run, as_of, buckets=8)


def test_an_upsert_leaves_untouched_parts_alone(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    state = {k: "a" for k in range(400)}
    load(lake, state.items(), "r1", "FULL")
    assert all(p.pending for p in lake.parts("silver", "d"))
    check(lake)
    assert track(lake, "r1", "2024-01-01 00:00:00")["new_versions"] == 400
    before = {p.path for p in lake.parts("silver", "d")}
    assert len(before) == 8
    source = {3: "b", 5: "a", 1000: "new"}  # one changes, one does not, one is new
    assert load(lake, source.items(), "r2")["parts_replaced"] == 1
    state |= source
    after = {p.path for p in lake.parts("silver", "d")}
    assert len(before & after) == 7
    dims = {r["k"]: (r["v"], r["dq_status"], r["_run_id"]) for r in lake.read("silver", "d", DIMENSION).collect()}
    assert {k: v for k, (v, _, _) in dims.items()} == state
    assert {k for k, (_, status, _) in dims.items() if status is None} == {3, 1000}
    assert dims[5][2] == "r1" and dims[3][2] == "r2"
    pending = lake.read_pending("silver", "d", DIMENSION)[0]
    assert sorted(r["k"] for r in pending.collect()) == [3, 1000]
    check(lake)
    assert before & {p.path for p in lake.parts("silver", "d")} == before & after
    # The history reads what came since, and closes one version.
    old = {p.path for p in lake.parts("silver", "h")}
    step = track(lake, "r2", "2024-01-02 00:00:00")
    assert (step["rows_read"], step["new_versions"], step["closed_versions"]) == (401, 2, 1)
    assert len(old - {p.path for p in lake.parts("silver", "h")}) == 1
    assert track(lake, "r3", "2024-01-03 00:00:00")["new_versions"] == 0
    current, closed = lake.read_history("silver", "h", HISTORY)
    assert {r["k"]: r["v"] for r in current.collect()} == state and current.count() == 401
    assert [(r["k"], r["v"], r["_is_current"]) for r in closed.collect()] == [(3, "a", False)]
    # Nothing new: nothing is written.
    version = lake.state().version
    load(lake, source.items(), "r4")
    assert lake.state().version == version


def test_parts_with_never_misses(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    for run in range(3):  # three loads of keys of their own: old parts hold none of the new ones
        load(lake, {run * 1000 + k: "a" for k in range(300)}.items(), f"r{run}")
    parts = lake.parts("silver", "d")
    held = {r["k"]: r["_part"] for r in lake.read_with_part("silver", "d", DIMENSION, parts).collect()}
    for keys in ([7], [1007, 2008], list(range(0, 3000, 7)), [5000], []):
        found = {p.path for p in lake.parts_with("silver", "d", frame(spark, [(k,) for k in keys], "k int"))}
        assert {held[k] for k in keys if k in held} <= found
    assert len({p.path for p in lake.parts_with("silver", "d", frame(spark, [(2007,)], "k int"))}) == 1
    load(lake, [(None, "n")], "null")
    assert lake.read("silver", "d", DIMENSION).filter("k is null").count() == 1
