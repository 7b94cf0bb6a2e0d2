"""The same checks over a stream of files: each micro-batch is one batch of pending rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from assaylake.operators.evaluate import evaluate, recorded, score_rows
from assaylake.operators.rules import Check, quote, value_text
from assaylake.operators.uniqueness import repeated
from assaylake.sources.lake import Lake


def _repeated(lake: Lake, rows: DataFrame, check: Check, batch: str) -> tuple[Check, DataFrame, str]:
    """Rows whose key came before, in this micro-batch or in an earlier one."""
    feed = check.feed
    order = [feed.incremental_date_column] if feed.incremental_date_column else []
    table = f"feed_{feed.feed_id}"
    judged = repeated(lake, table, rows, feed.inputs, [*order, feed.record_key_nm], batch)
    hits = judged.filter("is_repeated").select(
        F.col(quote(feed.record_key_nm)).cast("string").alias("record_key"), value_text(feed.inputs).alias("record_value"))
    return check, hits, f"keys of {', '.join(feed.inputs)} kept in {table}"


def check_stream(
    spark: SparkSession,
    source: str,
    schema: StructType,
    checks: list[Check],
    output: str,
    checkpoint: str,
    as_of: str,
    tables: dict[str, DataFrame] | None = None,
    unique: tuple[Lake, list[Check]] | None = None,
) -> StreamingQuery:
    """Check all files that arrived since the last start, then stop.

    Duplicate checks among `checks` look inside a micro-batch. Those given with a lake in `unique` look at all
    that came before too: the lake keeps their keys.

    The stream's checkpoint takes the place of the high-water mark. Each micro-batch
    overwrites its own directories, so a repeated batch leaves no copies.
    """

    def handle(rows: DataFrame, number: int) -> None:
        batch = f"stream-{number}"
        found = [_repeated(unique[0], rows, check, batch) for check in unique[1]] if unique else []
        outcome = evaluate(rows, checks, batch_id=batch, as_of=as_of, tables=tables, found=found)
        place = f"{output}/results/batch={number}"
        outcome.results.write.mode("overwrite").parquet(place)
        written = spark.read.schema(outcome.results.schema).parquet(place)
        score_rows(rows, recorded(outcome, written)).write.mode("overwrite").parquet(f"{output}/rows/batch={number}")

    return (
        spark.readStream.schema(schema)
        .parquet(source)
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
