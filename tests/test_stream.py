"""The checks over a file stream: only new files, repeated batches leave no copies."""

from assaylake.operators.rules import plan_checks
from assaylake.sources.lake import Lake
from assaylake.sources.metadata import RULES, Feed, as_schema, frame
from assaylake.streaming.stream import check_stream

SCHEMA = "k bigint, v string"
CHECKS = plan_checks(
    RULES,
    [Feed(1, "BRONZE", "D", 2, "t", "k", None, "v"), Feed(2, "BRONZE", "D", 1, "t", "k", None, "v", "N")],
    "t",
    "BRONZE",
)


def test_stream(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))

    def run():
        query = check_stream(spark, source, as_schema(SCHEMA), CHECKS, out, state, "2024-01-01 00:00:00")
        query.awaitTermination()

    frame(spark, [(1, "a"), (2, None), (3, "a")], SCHEMA).coalesce(1).write.mode("append").parquet(source)
    run()
    run()  # nothing new
    frame(spark, [(4, " "), (5, "b")], SCHEMA).coalesce(1).write.mode("append").parquet(source)
    run()
    rows = {r["k"]: r["dq_status"] for r in spark.read.parquet(f"{out}/rows").collect()}
    assert rows == {1: "PASS-SOFT", 2: "FAIL", 3: "PASS", 4: "FAIL", 5: "PASS"}
    found = spark.read.parquet(f"{out}/results").groupBy("record_key").count().collect()
    assert {r[0]: r[1] for r in found} == {"1": 1, "2": 1, "4": 1}


def test_keys_of_earlier_batches(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    lake, unique = Lake(spark, str(tmp_path / "lake")), [CHECKS[1]]

    def run(*rows):
        frame(spark, rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        query = check_stream(spark, source, as_schema(SCHEMA), CHECKS[:1], out, state, "2024-01-01 00:00:00", unique=(lake, unique))
        query.awaitTermination()

    run((1, "a"), (2, None), (3, "b"))
    run((4, "a"), (5, "c"), (6, "c"))
    run((7, "c"), (8, "d"))
    rows = {r["k"]: r["dq_status"] for r in spark.read.parquet(f"{out}/rows").collect()}
    assert rows == {1: "PASS", 2: "FAIL", 3: "PASS", 4: "PASS-SOFT", 5: "PASS", 6: "PASS-SOFT", 7: "PASS-SOFT", 8: "PASS"}
