"""Queries over the metrics table: daily series, pass rates, alarms, run figures, retention.

A metric point is ``name, value, unit, dimensions, ts``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.checks import count_if
from strata.operators.clean import exact_quantiles, null_safe_join
from strata.params import RetentionRule


def points(
    df: DataFrame, name: Column, value: Column, unit: Column, dimensions: dict[str, Column], ts: Column
) -> DataFrame:
    """Rows of ``df`` as metric points."""
    pairs = [part for key, c in dimensions.items() for part in (F.lit(key), c.cast("string"))]
    return df.select(
        name.alias("name"),
        value.cast("double").alias("value"),
        unit.alias("unit"),
        F.create_map(*pairs).alias("dimensions"),
        ts.cast("timestamp").alias("ts"),
    )


def day_of(ts: str = "ts") -> Column:
    return F.to_date(ts).alias("day")


def dimension(name: str) -> Column:
    return F.col("dimensions")[name].alias(name)


def daily(metrics: DataFrame, names: list[str], stat: str, dimensions: list[str] = (), since: str | None = None) -> DataFrame:
    """One row per day, metric and dimensions with the ``sum`` or ``avg`` of the points."""
    chosen = metrics.filter(F.col("name").isin(names))
    if since:
        chosen = chosen.filter(F.col("ts") >= F.lit(since).cast("timestamp"))
    agg = {"sum": F.sum, "avg": F.avg}[stat]("value").alias("value")
    return chosen.groupBy(day_of(), "name", *[dimension(d) for d in dimensions]).agg(agg)


def daily_pivot(metrics: DataFrame, names: list[str], dimensions: list[str] = (), since: str | None = None) -> DataFrame:
    """Daily sums with one column per metric; a metric without points that day is null."""
    chosen = metrics.filter(F.col("name").isin(names))
    if since:
        chosen = chosen.filter(F.col("ts") >= F.lit(since).cast("timestamp"))
    return chosen.groupBy(day_of(), *[dimension(d) for d in dimensions]).pivot("name", names).agg(F.sum("value"))


def pass_rate(
    metrics: DataFrame, by: list[Column] = (), passed: str = "ValidationPassed", failed: str = "ValidationFailed"
) -> DataFrame:
    """Passed share of all checks in percent; null where none was made."""
    total = {n: F.coalesce(F.sum(F.when(F.col("name") == n, F.col("value"))), F.lit(0.0)) for n in (passed, failed)}
    return (
        metrics.filter(F.col("name").isin(passed, failed))
        .groupBy(*by)
        .agg(total[passed].alias("passed"), total[failed].alias("failed"))
        .withColumn("pass_rate", F.try_divide(100 * F.col("passed"), F.col("passed") + F.col("failed")))
    )


@dataclass(frozen=True)
class AlarmRule:
    """Breached when the sum of ``metric`` over a period reaches (or with ``>`` exceeds) ``threshold``."""

    name: str
    metric: str
    period_seconds: int
    comparator: str
    threshold: float

    def breached(self, total: Column) -> Column:
        if self.comparator not in (">=", ">"):
            raise ValueError(f"comparator is '>=' or '>', not {self.comparator!r}")
        return total >= self.threshold if self.comparator == ">=" else total > self.threshold


# The published alarms.
ALARM_RULES = [
    AlarmRule("pipeline-failure", "PipelineFailure", 3600, ">=", 1),
    AlarmRule("validation-failure", "ValidationFailed", 86400, ">", 5),
    AlarmRule("ingestion-errors", "IngestionErrors", 3600, ">", 3),
]


def period_start(ts: Column, seconds: Column) -> Column:
    at = F.unix_seconds(ts)
    return F.timestamp_seconds(at - F.pmod(at, seconds.cast("bigint")))


def alarms(metrics: DataFrame, rules: list[AlarmRule]) -> DataFrame:
    """``alarm, period_start, total, breached`` for each rule and period that has points.

    All rules share one pass and one shuffle. A period without points is not a breach and has no row.
    """
    listed = F.array(
        *[
            F.struct(
                F.lit(r.name).alias("alarm"), F.lit(r.metric).alias("metric"), F.lit(r.period_seconds).alias("seconds")
            )
            for r in rules
        ]
    )
    breached = F.coalesce(*[F.when(F.col("alarm") == r.name, r.breached(F.col("total"))) for r in rules])
    return (
        metrics.filter(F.col("name").isin([r.metric for r in rules]))
        .withColumn("_rule", F.explode(F.filter(listed, lambda r: r["metric"] == F.col("name"))))
        .groupBy(
            F.col("_rule.alarm").alias("alarm"),
            period_start(F.col("ts"), F.col("_rule.seconds")).alias("period_start"),
        )
        .agg(F.sum("value").alias("total"))
        .withColumn("breached", breached)
    )


def alarm_transitions(evaluated: DataFrame, rules: list[AlarmRule], as_of: Column) -> DataFrame:
    """``alarm, at, state``: when each alarm of `alarms` went to ALARM, and when back to OK.

    An alarm rings from the start of a breached period until the first one that is not; a period without
    points is none. One that would end after ``as_of`` still rings and has no end yet.
    """
    seconds = F.coalesce(*[F.when(F.col("alarm") == r.name, F.lit(r.period_seconds)) for r in rules])
    along = Window.partitionBy("alarm").orderBy("_start")
    rings = evaluated.filter("breached").select("alarm", F.unix_seconds("period_start").alias("_start"), seconds.alias("_length"))
    rings = rings.withColumns({"_before": F.lag("_start").over(along), "_after": F.lead("_start").over(along)})
    begins = F.col("_before").isNull() | (F.col("_before") + F.col("_length") < F.col("_start"))
    end = F.col("_start") + F.col("_length")
    ends = (F.col("_after").isNull() | (F.col("_after") > end)) & (F.timestamp_seconds(end) <= as_of)

    def change(when: Column, at: Column, state: str) -> Column:
        return F.when(when, F.struct(F.timestamp_seconds(at).alias("at"), F.lit(state).alias("state")))

    changes = F.array_compact(F.array(change(begins, F.col("_start"), "ALARM"), change(ends, end, "OK")))
    return rings.select("alarm", F.inline(changes))


def active_alarms(evaluated: DataFrame, rules: list[AlarmRule], as_of: Column) -> DataFrame:
    """Alarms breached in the period that holds ``as_of``; missing data is no breach."""
    seconds = F.coalesce(*[F.when(F.col("alarm") == r.name, F.lit(r.period_seconds)) for r in rules])
    return evaluated.filter(F.col("breached") & (F.col("period_start") == period_start(as_of, seconds)))


def run_kpis(runs: DataFrame, by: list[str] = ()) -> DataFrame:
    """Number of runs, success rate in percent, exact median duration of the successful runs, mean records."""
    ok, by = F.col("status") == "PASS", list(by)
    totals = runs.groupBy(*by).agg(
        F.count(F.lit(1)).alias("runs"),
        (100.0 * count_if(ok) / F.count(F.lit(1))).alias("success_rate"),
        F.avg("records").alias("avg_records"),
    )
    durations = runs.filter(ok).select(*by, F.col("duration").alias("p50_duration"))
    medians = exact_quantiles(durations, ["p50_duration"], 0.5, by)
    median = F.col("p50_duration") if by else medians.select("p50_duration").scalar()
    if by:
        totals = null_safe_join(totals, medians, by, "left")
    return totals.select(*by, "runs", "success_rate", median.alias("p50_duration"), "avg_records")


def status_summary(results: DataFrame, by: list[str] = ()) -> DataFrame:
    """Number of successful, failed and all results."""
    return results.groupBy(*by).agg(
        count_if(F.col("status") == "success").alias("success"),
        count_if(F.col("status") == "failed").alias("failed"),
        F.count(F.lit(1)).alias("total"),
    )


def volume_pct(volumes: DataFrame, records: str, most: Column) -> DataFrame:
    """Records as a whole percentage of a maximum."""
    share = F.try_divide(100.0 * F.col(records), most)
    return volumes.withColumn("pct", F.floor(share + 0.5).cast("bigint"))


def parse_log(lines: DataFrame, prefix: str, schema: T.StructType | str, ts: str = "ts", n: int = 20) -> DataFrame:
    """The newest ``n`` log lines that carry ``prefix``, with their JSON body read as ``schema``.

    Ties are ordered by message, so the same lines come out on each run.
    """
    body = F.regexp_extract("message", rf"{prefix}: (.*)$", 1)
    return (
        lines.filter(F.col("message").contains(prefix))
        .orderBy(F.col(ts).desc(), F.col("message"))
        .limit(n)
        .withColumn("body", F.from_json(body, schema))
    )


def retention_tier(df: DataFrame, date: str, as_of: Column, rule: RetentionRule) -> DataFrame:
    """Age in days of each partition date and the storage tier it belongs to."""
    age = F.date_diff(as_of.cast("date"), F.col(date))
    tier = F.lit("standard")
    steps = [(rule.infrequent_days, "infrequent"), (rule.archive_days, "archive"), (rule.expire_days, "expired")]
    for days, name in steps:
        if days is not None:
            tier = F.when(F.col("age_days") >= days, name).otherwise(tier)
    return df.withColumn("age_days", age).withColumn("tier", tier)
