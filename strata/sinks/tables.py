"""Writers of the layers, reports, metrics and run history."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from strata.functions.dates import folder_of, partition_parts
from strata.params import QUALITY
from strata.session import delete_path

ROWS = "_rows"

#: Columns of the run history.
HISTORY = "row_count bigint, layer string, dataset string, run_date date"


def write_partitioned(df: DataFrame, path: str, by: list[str], seen: Observation | None = None) -> None:
    """Replace the partitions that ``df`` has rows for and leave the others alone.

    The rebalance hint gathers each partition's rows in few files, and lets Spark split a partition
    that is much larger than the others over several tasks. ``seen`` gets the row count and null counts.
    """
    spread = df.hint("rebalance", *by)
    if seen is not None:
        spread = observed(spread, seen)
    (
        spread.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(*by)
        .parquet(path)
    )


def observed(df: DataFrame, seen: Observation) -> DataFrame:
    """``df`` with its row count and null counts taken along by whatever action reads it next.

    Ask for them behind the last shuffle only: Spark counts a task of the last stage once, but those
    of an earlier stage again when a lost executor has them redone.
    """
    nulls = [F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in df.columns]
    return df.observe(seen, F.count(F.lit(1)).alias(ROWS), *nulls)


def write_cleaned(df: DataFrame, path: str, date: str = "date", seen: Observation | None = None) -> None:
    write_partitioned(partition_parts(df, date), path, ["year", "month", "day"], seen)


def write_curated(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    if by:
        write_partitioned(df, path, by)
    else:
        df.write.mode("overwrite").option("compression", "snappy").parquet(path)


def write_report(report: DataFrame, base: str, layer: str, date: str, stamp: str) -> str:
    """Write a validation report as JSON; returns its folder."""
    path = f"{base}/validation_reports/{layer}/{folder_of(date)}/report_{stamp}.json"
    report.write.mode("overwrite").json(path)
    return path


def emit_metrics(points: DataFrame, path: str) -> None:
    """Append metric points, partitioned by their day."""
    dated = points.withColumn("metric_date", F.to_date("ts")).hint("rebalance", "metric_date")
    dated.write.mode("append").partitionBy("metric_date").parquet(path)


def record_history(counts: DataFrame, path: str, keep: int = QUALITY.history_runs) -> None:
    """Keep the row count of a run: a rerun of the same date replaces its count.

    ``counts`` has ``layer, dataset, run_date, row_count``; there is one row per dataset and run. The
    newest ``keep`` runs of each dataset stay, and the folders of older ones are removed. Without counts,
    as when no dataset had files, nothing changes.
    """
    by = ["layer", "dataset", "run_date"]
    write_partitioned(counts, path, by)
    spark = counts.sparkSession
    newest = Window.partitionBy("layer", "dataset").orderBy(F.desc("run_date"))
    runs = spark.read.schema(HISTORY).parquet(path).select(*by).distinct().withColumn("_age", F.row_number().over(newest))
    for run in runs.filter(F.col("_age") > keep).collect():
        delete_path(spark, f"{path}/layer={run.layer}/dataset={run.dataset}/run_date={run.run_date}")
