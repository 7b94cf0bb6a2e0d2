import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from assaylake.llm.common import numbered_copies
from assaylake.llm.sharding import NO_KEY, shard_rows
from tests.llm.cases import frame, full, tables


def jump(key, shards):
    b, j = -1, 0
    key %= 1 << 64
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return b


def test_against_brute_force(spark):
    for name, df, rows in tables(spark):
        got = shard_rows(df, 40).collect()
        expected = Counter(
            (i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode()), "key",
             jump(NO_KEY if i is None else i, 40), jump(NO_KEY if i is None else i, 41)) for i, t, _ in rows)
        assert Counter((r.doc_id, r["size"], r.text_crc32, r.law, r.shard, r.grown_shard) for r in got) == expected, name
        slots = defaultdict(list)
        for r in got:
            slots[r.shard].append(r.slot)
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        assert all(r.grown_shard in (r.shard, 40) for r in got)


def test_one_id_on_a_third_of_the_rows(spark):
    """Copies of one row, and rows of one id or without any, lie in many buckets: the largest task stays small."""
    rows = [full(5, "copy", None, None, 4)] * 3000 + [full(5, f"text {i}", None, None, 4) for i in range(3000)]
    rows += [full(None, f"text {i}", None, None, 4) for i in range(3000)] + [full(i, "x", None, None, 4) for i in range(100, 3100)]
    got = shard_rows(frame(spark, rows), 4).collect()
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert len(got) == 12_000 and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len({r.shard for r in got if r.doc_id == 5}) == 1


def test_copies_are_numbered_in_pieces(spark):
    df = spark.createDataFrame([("a", 1), ("b", 25_000), ("c", 10_000)], "k string, n long")
    got = numbered_copies(df, "n", "copy")
    assert {r.k: (r.n, r.low, r.high) for r in got.groupBy("k").agg(
        F.countDistinct("copy").alias("n"), F.min("copy").alias("low"), F.max("copy").alias("high")).collect()} == {
            "a": (1, 0, 0), "b": (25_000, 0, 24_999), "c": (10_000, 0, 9_999)}
