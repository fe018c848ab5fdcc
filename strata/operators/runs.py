"""Checks over runs and files: row-count anomalies and freshness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.checks import RESULT
from strata.params import QUALITY, QualityParams


def row_count_anomaly(
    history: DataFrame, by: list[str], order: list[str], count: str, params: QualityParams = QUALITY
) -> DataFrame:
    """Compare the row count of each run with the runs before it.

    Adds ``points, mean, stddev, z``, ``enough_rows`` and ``anomaly_ok``. With too few runs before it,
    ``z`` and ``anomaly_ok`` are null. A history that never changed counts as deviating by one.
    """
    before = Window.partitionBy(*by).orderBy(*order).rowsBetween(-params.lookback_runs, -1)
    judged = F.col("points") >= params.anomaly_min_points
    spread = F.when(F.col("stddev") == 0, 1.0).otherwise(F.col("stddev"))
    return (
        history.withColumns(
            {
                "points": F.count(count).over(before),
                "mean": F.avg(count).over(before),
                "stddev": F.stddev_samp(count).over(before),
            }
        )
        .withColumn("z", F.when(judged, F.abs(F.col(count) - F.col("mean")) / spread))
        .withColumns(
            {
                "enough_rows": F.col(count) >= params.min_row_count,
                "anomaly_ok": F.col("z") <= params.anomaly_zscore,
            }
        )
    )


def count_check(history: DataFrame, current: Column, position: int, params: QualityParams = QUALITY) -> Column:
    """The anomaly check of one count against its history (``run_date, row_count``), as a struct.

    Null when the history is too short to judge.
    """
    recent = history.orderBy(F.col("run_date").desc()).limit(params.lookback_runs)
    past = recent.agg(
        F.struct(
            F.count("row_count").alias("points"),
            F.avg("row_count").alias("mean"),
            F.stddev_samp("row_count").alias("stddev"),
        )
    ).scalar()
    spread = F.when(past["stddev"] == 0, 1.0).otherwise(past["stddev"])
    z = F.abs(current - past["mean"]) / spread
    text = f"z-score=%.2f (mean=%.0f, stddev=%.0f) — threshold {params.anomaly_zscore}"
    row = F.struct(
        F.lit(position).alias("position"),
        F.lit("row_count_anomaly").alias("check"),
        (z <= params.anomaly_zscore).alias("passed"),
        F.format_string(text, z, past["mean"], spread).alias("detail"),
        z.alias("value"),
    )
    return F.when(past["points"] >= params.anomaly_min_points, row)


def age_hours(newest: Column, as_of: Column) -> Column:
    seconds = F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(newest.cast("timestamp"))
    return seconds / F.lit(3_600_000_000)


def freshness(
    df: DataFrame, ts: str, as_of: Column, by: list[str] = (), max_hours: int = QUALITY.max_age_hours
) -> DataFrame:
    """Age of the newest row or file per group; nothing to look at is not fresh."""
    newest = df.groupBy(*by).agg(F.max(ts).alias("newest"))
    return newest.withColumn("age_hours", age_hours(F.col("newest"), as_of)).withColumn(
        "fresh", F.coalesce(F.col("age_hours") <= max_hours, F.lit(False))
    )


def freshness_check(
    files: DataFrame, as_of: Column, suite: str, position: int = 0, max_hours: int = QUALITY.max_age_hours
) -> DataFrame:
    """Freshness of a file listing as a check row."""
    seen = freshness(files, "modified_at", as_of, max_hours=max_hours)
    detail = F.format_string(f"Latest file %.1fh old (max {max_hours}h)", "age_hours")
    return seen.select(
        F.lit(suite).alias("suite"),
        F.lit(position).alias("position"),
        F.lit("freshness_check").alias("check"),
        F.col("fresh").alias("passed"),
        F.when(F.col("newest").isNull(), "No files found").otherwise(detail).alias("detail"),
        F.col("age_hours").alias("value"),
    )


def no_files(spark, suite: str) -> DataFrame:
    """What is left to say about a layer without files."""
    return spark.createDataFrame([(suite, 0, "freshness_check", False, "No files found", None)], RESULT)
