"""Alarms on a stream of metric points."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.checks import Suite
from strata.operators.clean import dedup_latest
from strata.operators.monitor import AlarmRule, alarms
from strata.sinks.publish import exists, recover, write_audit_publish

TOTALS = "name string, start timestamp, total double, batch bigint, day date"


def alarm_stream(metrics: DataFrame, rule: AlarmRule, delay: str) -> DataFrame:
    """One row per period of ``rule`` once the watermark has passed its end.

    Points later than ``delay`` are dropped, so the state holds only open periods.
    """
    chosen = metrics.filter(F.col("name") == rule.metric).withColumn("ts", F.col("ts").cast("timestamp"))
    return (
        chosen.withWatermark("ts", delay)
        .groupBy(F.window("ts", f"{rule.period_seconds} seconds").alias("_period"))
        .agg(F.sum("value").alias("total"))
        .select(
            F.lit(rule.name).alias("alarm"),
            F.col("_period.start").alias("period_start"),
            "total",
            rule.breached(F.col("total")).alias("breached"),
        )
    )


def running_totals(metrics: DataFrame, rules: list[AlarmRule], delay: str) -> DataFrame:
    """``name, start, total`` of the metrics of all ``rules``, in steps that make up the periods of each.

    One state serves all rules. In update mode a step is told again with its new total whenever points arrive
    for it, also before the watermark has passed its end; points later than ``delay`` are dropped.
    """
    step = math.gcd(*[r.period_seconds for r in rules])
    chosen = metrics.filter(F.col("name").isin([r.metric for r in rules])).withColumn("ts", F.col("ts").cast("timestamp"))
    return (
        chosen.withWatermark("ts", delay)
        .groupBy(F.window("ts", f"{step} seconds").alias("_step"), "name")
        .agg(F.sum("value").alias("total"))
        .select("name", F.col("_step.start").alias("start"), "total")
    )


def keep_totals(totals: DataFrame, target: str, checkpoint: str) -> None:
    """Bring the totals of a stream up to date in the table ``target``, by day, and stop at the end of the input.

    Each batch replaces the days it has totals for, by theirs and what was there before. A batch that is
    handed out again, as its run broke off, has the same totals and changes nothing.
    """

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        recover(spark, target)
        new = batch.select("name", "start", "total", F.lit(number).cast("bigint").alias("batch"), F.to_date("start").alias("day"))
        days = [r.day for r in new.select("day").distinct().collect()]
        if not days:
            return
        if exists(spark, target):
            new = new.unionByName(stored_totals(spark, target).filter(F.col("day").isin(days)))
        merged = dedup_latest(new, ["name", "start"], [F.desc("batch")])
        write_audit_publish(merged, target, ["day"], Suite("alarm_totals").unique(["name", "start"]))

    query = (
        totals.writeStream.outputMode("update")
        .foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def stored_totals(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.schema(TOTALS).parquet(target)


def current_alarms(spark: SparkSession, target: str, rules: list[AlarmRule]) -> DataFrame:
    """`alarms` of all periods so far, the open ones included, from the kept totals."""
    kept = stored_totals(spark, target).select("name", F.col("start").alias("ts"), F.col("total").alias("value"))
    return alarms(kept, rules)
