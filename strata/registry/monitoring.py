"""Metric points, alarms, run figures, logs and retention."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions.numeric import rnd
from strata.operators import monitor
from strata.operators.checks import log_line, null_log_line
from strata.operators.monitor import ALARM_RULES
from strata.params import RETENTION
from strata.registry import query
from strata.registry.views import (
    METRICS,
    RATES,
    READINGS,
    metric_points,
    prop_k,
    rates,
    readings,
    sql_pct,
    sql_rnd,
    table,
)
from strata.session import scratch_dir
from strata.sinks.tables import emit_metrics


@query(
    "metric_emit",
    f"""WITH {METRICS} SELECT ts::date::varchar AS metric_date, name, unit, layer, count(*) AS n,
      {sql_rnd('sum(value)', 2)} AS total FROM metrics GROUP BY ALL""",
)
def metric_emit(spark, sf_dir):
    path = scratch_dir(spark, "metrics")
    emit_metrics(metric_points(spark, sf_dir), path)
    stored = spark.read.parquet(path)
    return stored.groupBy("metric_date", "name", "unit", monitor.dimension("Layer").alias("layer")).agg(
        F.count(F.lit(1)).alias("n"), rnd(F.sum("value"), 2).alias("total")
    )


@query(
    "metric_log_json",
    f"""WITH {READINGS}, a AS (SELECT count(*) AS n, count(*) FILTER (WHERE temperature_c IS NULL) AS t,
      count(*) FILTER (WHERE windspeed_kmh IS NULL) AS w FROM readings)
    SELECT 'DQ_METRICS: {{"dataset":"weather","total_rows":' || n || ',"null_rates":{{"temperature_c":"' ||
      {sql_pct('t / n::double', 2)} || '","windspeed_kmh":"' || {sql_pct('w / n::double', 2)} ||
      '"}},"processed_at":"2024-02-01T03:00:00"}}' AS message FROM a
    UNION ALL SELECT 'CURATED_METRICS: {{"stage":"cleaned_to_curated","daily_summary_rows":' || count(DISTINCT l_shipdate)
      || '}}' FROM lineitem""",
)
def metric_log_json(spark, sf_dir):
    cleaned = readings(spark, sf_dir).select("temperature_c", "windspeed_kmh")
    days = table(spark, sf_dir, "lineitem").agg(F.countDistinct("l_shipdate").alias("days"))
    curated = log_line(days, "CURATED_METRICS", stage=F.lit("cleaned_to_curated"), daily_summary_rows=F.col("days"))
    return null_log_line(cleaned, "weather", "2024-02-01T03:00:00").unionByName(curated)


@query(
    "log_query_topn",
    """SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, event_type AS dataset, (props->>'k')::bigint AS total_rows
    FROM events WHERE event_type IN ('click', 'error', 'view')
    ORDER BY events.ts DESC, 'DQ_METRICS: {"dataset":"' || event_type || '","total_rows":' || (props->>'k') || '}' LIMIT 20""",
)
def log_query_topn(spark, sf_dir):
    body = F.to_json(F.struct(F.col("event_type").alias("dataset"), prop_k().cast("bigint").alias("total_rows")))
    prefix = F.when(F.col("event_type").isin("click", "error", "view"), "DQ_METRICS: ").otherwise("INFO ")
    lines = table(spark, sf_dir, "events").select("ts", F.concat(prefix, body).alias("message"))
    found = monitor.parse_log(lines, "DQ_METRICS", "dataset string, total_rows bigint")
    return found.select("ts", "body.dataset", "body.total_rows")


@query(
    "metric_daily_pivot",
    f"""WITH {METRICS} SELECT ts::date::varchar AS day, sum(value) FILTER (WHERE name = 'PipelineSuccess') AS "PipelineSuccess",
      sum(value) FILTER (WHERE name = 'PipelineFailure') AS "PipelineFailure",
      sum(value) FILTER (WHERE name = 'RecordsIngested') AS "RecordsIngested"
    FROM metrics WHERE name IN ('PipelineSuccess', 'PipelineFailure', 'RecordsIngested') GROUP BY 1""",
)
def metric_daily_pivot(spark, sf_dir):
    return monitor.daily_pivot(metric_points(spark, sf_dir), ["PipelineSuccess", "PipelineFailure", "RecordsIngested"])


@query(
    "metric_daily_avg",
    f"""WITH {METRICS} SELECT ts::date::varchar AS day, name, layer AS "Layer", dataset AS "Dataset",
      {sql_rnd('avg(value)', 4)} AS value
    FROM metrics WHERE name IN ('RowCount', 'IngestionDurationSeconds') GROUP BY ALL""",
)
def metric_daily_avg(spark, sf_dir):
    names = ["RowCount", "IngestionDurationSeconds"]
    means = monitor.daily(metric_points(spark, sf_dir), names, "avg", ["Layer", "Dataset"])
    return means.withColumn("value", rnd("value", 4))


PASS_SQL = """coalesce(sum(value) FILTER (WHERE name = 'ValidationPassed'), 0) AS passed,
  coalesce(sum(value) FILTER (WHERE name = 'ValidationFailed'), 0) AS failed"""


@query(
    "pass_rate",
    f"""WITH {METRICS}, t AS (SELECT ts::date AS day, {PASS_SQL} FROM metrics
      WHERE name IN ('ValidationPassed', 'ValidationFailed') GROUP BY 1)
    SELECT day::varchar AS day, passed, failed, 100 * passed / nullif(passed + failed, 0) AS pass_rate FROM t""",
)
def pass_rate(spark, sf_dir):
    return monitor.pass_rate(metric_points(spark, sf_dir), [monitor.day_of()])


@query(
    "quality_score",
    f"""WITH {METRICS}, t AS (SELECT {PASS_SQL} FROM metrics)
    SELECT passed, failed, 100 * passed / nullif(passed + failed, 0) AS pass_rate FROM t""",
)
def quality_score(spark, sf_dir):
    return monitor.pass_rate(metric_points(spark, sf_dir))


@query(
    "layer_pass_fail",
    f"""WITH {METRICS} SELECT ts::date::varchar AS day, layer AS "Layer",
      sum(value) FILTER (WHERE name = 'ValidationPassed') AS "ValidationPassed",
      sum(value) FILTER (WHERE name = 'ValidationFailed') AS "ValidationFailed"
    FROM metrics WHERE name IN ('ValidationPassed', 'ValidationFailed') GROUP BY 1, 2""",
)
def layer_pass_fail(spark, sf_dir):
    return monitor.daily_pivot(metric_points(spark, sf_dir), ["ValidationPassed", "ValidationFailed"], ["Layer"])


ALARMS = f"""{METRICS}, evaluated AS (
  SELECT 'pipeline-failure' AS alarm, date_trunc('hour', ts) AS start, sum(value) AS total, sum(value) >= 1 AS breached
    FROM metrics WHERE name = 'PipelineFailure' GROUP BY ALL
  UNION ALL SELECT 'validation-failure', date_trunc('day', ts), sum(value), sum(value) > 5
    FROM metrics WHERE name = 'ValidationFailed' GROUP BY ALL
  UNION ALL SELECT 'ingestion-errors', date_trunc('hour', ts), sum(value), sum(value) > 3
    FROM metrics WHERE name = 'IngestionErrors' GROUP BY ALL)"""
ALARM_COLUMNS = "alarm, strftime(start, '%Y-%m-%d %H:%M:%S') AS period_start, total, breached"


@query("alarm_eval", f"WITH {ALARMS} SELECT {ALARM_COLUMNS} FROM evaluated")
def alarm_eval(spark, sf_dir):
    return monitor.alarms(metric_points(spark, sf_dir), ALARM_RULES)


@query(
    "active_alarms",
    f"""WITH {ALARMS}, m AS (SELECT max(ts) AS as_of FROM events) SELECT {ALARM_COLUMNS} FROM evaluated, m
    WHERE breached AND start = CASE WHEN alarm = 'validation-failure' THEN date_trunc('day', as_of)
      ELSE date_trunc('hour', as_of) END""",
)
def active_alarms(spark, sf_dir):
    as_of = table(spark, sf_dir, "events").agg(F.max("ts")).scalar()
    evaluated = monitor.alarms(metric_points(spark, sf_dir), ALARM_RULES)
    return monitor.active_alarms(evaluated, ALARM_RULES, as_of)


def runs(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_type",
        F.when(F.col("event_id") % 11 == 0, "FAIL").otherwise("PASS").alias("status"),
        F.col("value").alias("duration"),
        prop_k().cast("double").alias("records"),
    )


@query(
    "run_kpis",
    f"""WITH r AS (SELECT event_type, event_id % 11 <> 0 AS ok, value, (props->>'k')::double AS k FROM events)
    SELECT event_type, count(*) AS runs, {sql_rnd('100.0::double * count(*) FILTER (WHERE ok) / count(*)', 4)} AS success_rate,
      quantile_disc(value, 0.5) FILTER (WHERE ok) AS p50_duration, {sql_rnd('avg(k)', 4)} AS avg_records
    FROM r GROUP BY event_type""",
)
def run_kpis(spark, sf_dir):
    kpis = monitor.run_kpis(runs(spark, sf_dir), ["event_type"])
    return kpis.withColumns({c: rnd(c, 4) for c in ("success_rate", "avg_records")})


@query(
    "status_summary",
    """SELECT event_type, count(*) FILTER (WHERE event_id % 11 <> 0) AS success,
      count(*) FILTER (WHERE event_id % 11 = 0) AS failed, count(*) AS total FROM events GROUP BY event_type""",
)
def status_summary(spark, sf_dir):
    status = F.when(F.col("event_id") % 11 == 0, "failed").otherwise("success")
    return monitor.status_summary(table(spark, sf_dir, "events").withColumn("status", status), ["event_type"])


@query(
    "layer_volume_pct",
    f"""WITH {METRICS}, v AS (SELECT layer, dataset, sum(value)::bigint AS records FROM metrics WHERE name = 'RowCount'
      GROUP BY ALL)
    SELECT layer, dataset, records, floor(100.0::double * records / (SELECT max(records) FROM v) + 0.5)::bigint AS pct
    FROM v""",
)
def layer_volume_pct(spark, sf_dir):
    counted = metric_points(spark, sf_dir).filter(F.col("name") == "RowCount")
    volumes = counted.groupBy(
        monitor.dimension("Layer").alias("layer"), monitor.dimension("Dataset").alias("dataset")
    ).agg(F.sum("value").cast("bigint").alias("records"))
    return monitor.volume_pct(volumes, "records", volumes.agg(F.max("records")).scalar())


def tier_sql(layer: str) -> str:
    rule = RETENTION[layer]
    steps = [(rule.expire_days, "expired"), (rule.archive_days, "archive"), (rule.infrequent_days, "infrequent")]
    cases = " ".join(f"WHEN age >= {days} THEN '{name}'" for days, name in steps if days)
    return f"""SELECT '{layer}' AS layer, date::varchar AS date, age AS age_days,
      CASE {cases} ELSE 'standard' END AS tier, rows FROM d"""


@query(
    "retention_tier",
    f"""WITH {RATES}, d AS (SELECT date, datediff('day', date, DATE '2001-09-01')::int AS age, count(*) AS rows
      FROM rates GROUP BY date) {tier_sql('raw')} UNION ALL {tier_sql('cleaned')}""",
)
def retention_tier(spark, sf_dir):
    days = rates(spark, sf_dir).groupBy("date").agg(F.count(F.lit(1)).alias("rows"))
    as_of = F.lit("2001-09-01")
    tiers = [
        monitor.retention_tier(days, "date", as_of, RETENTION[layer]).withColumn("layer", F.lit(layer))
        for layer in ("raw", "cleaned")
    ]
    return tiers[0].unionByName(tiers[1]).select("layer", "date", "age_days", "tier", "rows")
