"""Duplicates and references against brute force, with hot keys, NULL keys and exact copies."""

import random

import pytest

from assaylake.operators import bad_keys
from assaylake.operators.bad_keys import repeat_rows, superseded, unmatched
from assaylake.sources.metadata import frame


def made(seed, n=3000, unique=True):
    """A third of the rows share one key, another part has no key at all."""
    r = random.Random(seed)
    rows = []
    for i in range(n):
        group = "hot" if r.random() < 0.33 else None if r.random() < 0.2 else f"g{r.randrange(n)}"
        day = None if r.random() < 0.05 else r.randrange(50)
        rows.append((i if unique else r.randrange(n // 3), group, day))
    return rows


def brute(rows):
    low = float("-inf")
    groups = {}
    for k, g, o in rows:
        groups.setdefault(g, []).append((low if o is None else o, k))
    return [(str(k), g) for g, members in groups.items() for _, k in sorted(members)[:-1]]


def got(df):
    return sorted(((r["record_key"], r["record_value"]) for r in df.collect()), key=lambda t: (t[0], t[1] or ""))


def test_superseded_unique_key(spark):
    rows = made(1)
    df = frame(spark, rows, "k bigint, g string, o int").repartition(5)
    found = got(superseded(df, ["g"], "o", "k"))
    assert found == sorted(brute(rows), key=lambda t: (t[0], t[1] or ""))


def test_superseded_with_copies(spark, monkeypatch):
    monkeypatch.setattr(bad_keys, "COPIES_PER_PIECE", 7)
    rows = made(2, unique=False)
    rows += [(1, "hot", 60)] * 500  # exact copies of the latest row
    df = frame(spark, rows, "k bigint, g string, o int").repartition(5)
    found = got(superseded(df, ["g"], "o", "k"))
    assert found == sorted(brute(rows), key=lambda t: (t[0], t[1] or ""))


def test_superseded_without_order_and_with_two_columns(spark):
    rows = [(1, "a", "x"), (2, "a", "x"), (3, "a", "y"), (4, None, None), (5, None, None)]
    df = frame(spark, rows, "k bigint, g string, h string")
    assert got(superseded(df, ["g", "h"], None, "k")) == [("1", "a, x"), ("4", "")]


def test_repeat_rows(spark, monkeypatch):
    monkeypatch.setattr(bad_keys, "COPIES_PER_PIECE", 10)
    df = frame(spark, [("a", 1), ("b", 10), ("c", 11), ("d", 35)], "v string, n bigint")
    counts = {r["v"]: r["count"] for r in repeat_rows(df, "n").groupBy("v").count().collect()}
    assert counts == {"a": 1, "b": 10, "c": 11, "d": 35}


REFERENCE = [("a", "x"), ("b", None), ("c", "x"), ("c", None), (None, "x")]
ROWS = [(1, "a"), (2, "b"), (3, "c"), (4, "d"), (5, None), (6, "d"), (7, "d")]


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_unmatched(spark, threshold):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        df, ref = frame(spark, ROWS, "k bigint, v string"), frame(spark, REFERENCE, "r string, w string")
        assert got(unmatched(df, "v", ref, "r", "w", "k")) == [
            ("2", "b"), ("3", "c"), ("4", "d"), ("5", None), ("6", "d"), ("7", "d"),
        ]
        assert got(unmatched(df, "v", ref, "r", None, "k")) == [
            ("4", "d"), ("5", None), ("6", "d"), ("7", "d"),
        ]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_hot_group_with_copies_of_its_latest_row(spark, monkeypatch):
    monkeypatch.setattr(bad_keys, "COPIES_PER_PIECE", 7)
    rows = made(3, unique=False) + [(1, "hot", 60)] * 500
    df = frame(spark, rows, "k bigint, g string, o int").repartition(5)
    found = got(superseded(df, ["g"], "o", "k"))
    assert found == sorted(brute(rows), key=lambda t: (t[0], t[1] or ""))


def test_hot_group_without_order(spark):
    rows = [(i, g, None) for i, g, _ in made(4)]
    df = frame(spark, rows, "k bigint, g string, o int")
    found = got(superseded(df, ["g"], None, "k"))
    assert found == sorted(brute(rows), key=lambda t: (t[0], t[1] or ""))


def test_hot_group_loses_all_but_one(spark):
    df = frame(spark, [(i, "hot", i % 7) for i in range(2000)], "k bigint, g string, o int")
    losers = superseded(df, ["g"], "o", "k")
    assert losers.count() == 1999
    latest = max(((i % 7, i) for i in range(2000)))[1]
    assert losers.filter(f"record_key = '{latest}'").count() == 0


def test_the_table_is_read_twice(spark, tmp_path):
    rows = frame(spark, made(5), "k bigint, g string, o int")
    rows.write.parquet(f"{tmp_path}/t")
    plan = superseded(spark.read.parquet(f"{tmp_path}/t"), ["g"], "o", "k")._jdf.queryExecution().executedPlan().toString()
    initial = plan.split("== Initial Plan ==")[-1]
    assert initial.count("FileScan parquet") <= 2
