"""Profiles, metrics, scores, trends and integrity reports."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assaylake.functions.columns import ntz, percent

# Lower bounds of the score bands.
GREEN_FROM, YELLOW_FROM = 95, 80


def band(score: Column) -> Column:
    return F.when(score >= GREEN_FROM, "GREEN").when(score >= YELLOW_FROM, "YELLOW").otherwise("RED")


def profile_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Row count, NULL %, distinct %, minimum and maximum per column.

    Each column is counted by value and these counts are summed up, so a scan reads one
    column and rows combine before they are shuffled.
    """
    per_column = []
    for name in columns:
        value = F.col("_value")
        by_value = df.groupBy(F.col(name).alias("_value")).agg(F.count(F.lit(1)).alias("_n"))
        total = by_value.agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("_rows"),
            F.coalesce(F.sum(F.when(value.isNull(), F.col("_n"))), F.lit(0)).alias("_nulls"),
            F.count(value).alias("_distinct"),
            F.min(value).cast("string").alias("min_value"),
            F.max(value).cast("string").alias("max_value"),
        )
        per_column.append(total.select(
            F.lit(name).alias("column_name"),
            F.col("_rows").alias("row_count"),
            percent(F.col("_nulls"), F.col("_rows")).alias("null_pct"),
            percent(F.col("_distinct"), F.col("_rows")).alias("distinct_pct"),
            "min_value",
            "max_value",
        ))
    return reduce(DataFrame.unionByName, per_column)


def metric_counts(df: DataFrame, nulls: list[str], lengths: Mapping[str, int], duplicates: list[str]) -> DataFrame:
    """NULL counts, wrong-length counts and duplicate counts, one row per metric and column."""
    named = [("NULL_COUNT", c, F.count_if(F.col(c).isNull())) for c in nulls]
    named += [
        ("BAD_LENGTH_COUNT", c, F.count_if(F.length(F.trim(F.col(c).cast("string"))) != n)) for c, n in lengths.items()
    ]
    plain = df.agg(*[m.alias(f"_m{i}") for i, (_, _, m) in enumerate(named)])
    rows = [
        F.struct(F.lit(metric).alias("metric"), F.lit(c).alias("column_name"), F.col(f"_m{i}").alias("metric_value"))
        for i, (metric, c, _) in enumerate(named)
    ]
    result = plain.select(F.inline(F.array(*rows)))
    for c in duplicates:
        sizes = df.groupBy(F.col(c)).agg(F.count(F.lit(1)).alias("_n"))
        result = result.unionByName(
            sizes.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("metric_value")).select(
                F.lit("DUPLICATE_COUNT").alias("metric"), F.lit(c).alias("column_name"), "metric_value"
            )
        )
    return result


def freshness(df: DataFrame, name: str, column: str, as_of: str, max_days: int) -> DataFrame:
    """Age of the newest row in days; an empty table is stale."""
    newest = F.max(column)
    age = F.datediff(ntz(as_of), newest)
    return df.agg(newest.alias("newest"), age.alias("age_days")).select(
        F.lit(name).alias("table_nm"),
        "newest",
        "age_days",
        F.coalesce(F.col("age_days") > max_days, F.lit(True)).alias("is_stale"),
    )


def volume_change(counts: DataFrame, table: str, order: str, count: str, alert_pct: float) -> DataFrame:
    """Change of the row count against the run before, per table. One row per run comes in."""
    runs = Window.partitionBy(table).orderBy(order)
    before = F.lag(count).over(runs)
    change = F.when(before > 0, F.round((F.col(count) - before).cast("double") / before * 100, 2))
    return counts.withColumns({"previous_count": before, "change_pct": change}).withColumn(
        "is_anomaly", F.coalesce(F.abs(F.col("change_pct")) > alert_pct, F.lit(False))
    )


def feed_totals(plan: DataFrame, totals: DataFrame, results: DataFrame) -> DataFrame:
    """Evaluated and failed rows per feed: (layer, table_nm, feed_id, weight, total, failed)."""
    failed = results.groupBy("feed_id").agg(F.count(F.lit(1)).alias("failed"))
    return (
        plan.join(totals, "table_nm")
        .join(failed, "feed_id", "left")
        .select("layer", "table_nm", "feed_id", "weight", "total", F.coalesce("failed", F.lit(0)).alias("failed"))
    )


def table_scores(per_feed: DataFrame, by: tuple[str, ...] = ("layer", "table_nm")) -> DataFrame:
    """Weighted share of passed evaluations, with its band."""
    passed = F.sum(F.col("weight") * (F.col("total") - F.col("failed")))
    score = percent(passed, F.sum(F.col("weight") * F.col("total")))
    return per_feed.groupBy(*by).agg(score.alias("score")).withColumn("band", band(F.col("score")))


def scorecard(per_feed: DataFrame, layer_weights: Mapping[str, int]) -> DataFrame:
    """Scores of tables, of layers (mean of tables) and overall (weighted mean of layers).

    The totals per feed are computed once: each level keeps the rows below it, a row per table at most.
    """
    weight = F.lit(None).cast("int")
    for layer, value in layer_weights.items():
        weight = F.when(F.col("layer") == layer, F.lit(value)).otherwise(weight)
    weight = F.coalesce(weight, F.lit(1))

    def row(scope: str, name: Column, score: Column) -> Column:
        return F.struct(F.lit(scope).alias("scope"), name.alias("name"), score.alias("score"))

    layers = table_scores(per_feed).groupBy("layer").agg(
        F.round(F.avg("score"), 2).alias("score"),
        F.collect_list(row("TABLE", F.col("table_nm"), F.col("score"))).alias("rows"))
    whole = layers.agg(
        F.round(F.sum(F.col("score") * weight) / F.sum(weight), 2).alias("score"),
        F.flatten(F.collect_list("rows")).alias("tables"),
        F.collect_list(row("LAYER", F.col("layer"), F.col("score"))).alias("layers"))
    rows = F.concat("tables", "layers", F.array(row("OVERALL", F.lit("ALL"), F.col("score"))))
    return whole.select(F.inline(rows)).withColumn("band", band(F.col("score")))


def score_trend(scores: DataFrame, series: str, order: str, window: int, drop: float) -> DataFrame:
    """Moving mean over the last runs, change to the run before, and degradation alerts.

    One row per table and run comes in, so a series is as long as the number of runs.
    """
    runs = Window.partitionBy(series).orderBy(order)
    mean = F.round(F.avg("score").over(runs.rowsBetween(-(window - 1), 0)), 2)
    change = F.round(F.col("score") - F.lag("score").over(runs), 2)
    return scores.withColumns({"moving_score": mean, "score_change": change}).withColumn(
        "is_degraded", F.coalesce(F.col("score_change") < -drop, F.lit(False))
    )


def overlapping_versions(history: DataFrame, key: str, start: str = "_valid_from", end: str = "_valid_to") -> DataFrame:
    """Versions that end after the next version of the same key starts.

    Each key is ordered day by day: the next start inside the day, or else the first
    start of the key's next day. A key with very many versions is therefore spread over
    its days, and only one row per key and day is ordered across days.
    """
    day = F.date_trunc("day", F.col(start)).cast("timestamp_ntz")
    rows = history.withColumn("_day", day)
    firsts = rows.groupBy(key, "_day").agg(F.min(start).alias("_first"))
    following = firsts.select(
        F.col(key).alias("_key"),
        F.col("_day").alias("_key_day"),
        F.lead("_first").over(Window.partitionBy(key).orderBy("_day")).alias("_next_first"),
    )
    inside = F.lead(start).over(Window.partitionBy(key, "_day").orderBy(start, end))
    joined = rows.withColumn("_inside", inside).join(
        following, (F.col(key) == F.col("_key")) & (F.col("_day") == F.col("_key_day"))
    )
    following_start = F.coalesce("_inside", "_next_first")
    return joined.withColumn("next_valid_from", following_start).filter(F.col("next_valid_from") < F.col(end)).select(
        *history.columns, "next_valid_from"
    )


def orphan_keys(facts: DataFrame, foreign_key: str, dimension: DataFrame, key: str) -> DataFrame:
    """Foreign keys without a dimension row and how many fact rows carry them.

    Facts are reduced to one row per key before the join, so a hot key costs one row.
    """
    per_key = facts.groupBy(F.col(foreign_key).alias("foreign_key")).agg(F.count(F.lit(1)).alias("row_count"))
    known = dimension.select(F.col(key).alias("_key"))
    return per_key.join(known, F.col("foreign_key") == F.col("_key"), "left_anti")


def uncovered(dimension: DataFrame, key: str, facts: DataFrame, foreign_key: str) -> DataFrame:
    """Dimension rows that no fact row refers to."""
    used = facts.select(F.col(foreign_key).alias("_key")).distinct()
    return dimension.join(used, F.col(key) == F.col("_key"), "left_anti")


def reconcile(left: DataFrame, right: DataFrame, key: str, measures: list[str]) -> DataFrame:
    """Sums of both sides per key; rows where a key or a sum differs."""
    sides = []
    for df, side in ((left, "left"), (right, "right")):
        sides.append(
            df.groupBy(F.col(key).alias(f"_{side}"))
            .agg(F.count(F.lit(1)).alias(f"{side}_rows"), *[F.sum(m).alias(f"{side}_{m}") for m in measures])
        )
    both = sides[0].join(sides[1], F.col("_left").eqNullSafe(F.col("_right")), "full_outer")
    differs = ~F.col("left_rows").eqNullSafe(F.col("right_rows"))
    for m in measures:
        differs = differs | ~F.col(f"left_{m}").eqNullSafe(F.col(f"right_{m}"))
    return both.filter(differs).select(
        F.coalesce("_left", "_right").alias(key),
        *[c for m in ["rows", *measures] for c in (f"left_{m}", f"right_{m}")],
    )


def register_views(spark_views: Mapping[str, DataFrame]) -> None:
    """Make reports available to SQL by name."""
    for name, df in spark_views.items():
        df.createOrReplaceTempView(name)
