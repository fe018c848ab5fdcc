"""Incremental ingest and alarms on a stream."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from strata.operators.monitor import ALARM_RULES, alarm_transitions
from strata.functions.dates import folder_of
from strata.registry import query
from strata.registry.cleaning import LATEST_HOUR, TYPED_HOURLY
from strata.registry.monitoring import ALARM_COLUMNS, ALARMS
from strata.registry.views import LANDED_ON, METRICS, hourly_documents, metric_points, table
from strata.schemas import METRIC
from strata.session import scratch_dir
from strata.sinks.tables import emit_metrics
from strata.sources.files import read_layer
from strata.streaming.alarms import alarm_stream as alarms_on
from strata.streaming.alarms import current_alarms, keep_totals, running_totals
from strata.streaming.cleaning import clean_new_files, committed
from strata.streaming.ingest import append, ingest_new_files


@query("incremental_ingest", "SELECT event_id, user_id, event_type, value, props FROM events")
def incremental_ingest(spark, sf_dir):
    """Three runs: the first files, the same again, and more files. Each row arrives once."""
    landing, target, checkpoint = (scratch_dir(spark, n) for n in ("landing", "ingested", "ingest-state"))
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "props")
    errors = F.col("event_type") == "error"
    events.filter(errors).write.mode("append").json(landing)
    ingest_new_files(spark, events.schema, landing, target, checkpoint)
    ingest_new_files(spark, events.schema, landing, target, checkpoint)
    events.filter(~errors).write.mode("append").json(landing)
    ingest_new_files(spark, events.schema, landing, target, checkpoint)
    return spark.read.schema(events.schema).parquet(target)


@query(
    "alarm_stream",
    f"""WITH {METRICS}, e AS (SELECT ts, value FROM metrics WHERE name = 'IngestionErrors')
    SELECT 'ingestion-errors' AS alarm, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS period_start,
      sum(value) AS total, sum(value) > 3 AS breached
    FROM e GROUP BY date_trunc('hour', ts)
    HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT date_trunc('milliseconds', max(ts)) FROM e) - INTERVAL 2 HOUR""",
)
def alarm_stream(spark, sf_dir):
    """Hourly alarms on the stored metric points; the hours the watermark has not passed stay open."""
    stored, target, checkpoint = (scratch_dir(spark, n) for n in ("metrics", "alarms", "alarm-state"))
    emit_metrics(metric_points(spark, sf_dir), stored)
    rule = next(r for r in ALARM_RULES if r.name == "ingestion-errors")
    append(alarms_on(spark.readStream.schema(METRIC).parquet(stored), rule, "2 hours"), target, checkpoint)
    return spark.read.parquet(target)


def kept_totals(spark, sf_dir):
    """Totals of the metric points that a stream got in two portions, each with points of all days."""
    stored, target, checkpoint = (scratch_dir(spark, n) for n in ("metrics", "totals", "totals-state"))
    points = metric_points(spark, sf_dir)
    for portion in range(2):
        emit_metrics(points.filter(F.pmod(F.xxhash64("ts", "name"), F.lit(2)) == portion), stored)
        stream = spark.readStream.schema(METRIC).parquet(stored)
        keep_totals(running_totals(stream, ALARM_RULES, "40 days"), target, checkpoint)
    spark.catalog.refreshByPath(target)
    return target


@query("alarm_updates", f"WITH {ALARMS} SELECT {ALARM_COLUMNS} FROM evaluated")
def alarm_updates(spark, sf_dir):
    """All rules on one stream of points that come late, with the hours and days that are still open."""
    return current_alarms(spark, kept_totals(spark, sf_dir), ALARM_RULES)


@query(
    "alarm_transitions",
    f"""WITH {ALARMS}, b AS (
      SELECT alarm, start, CASE WHEN alarm = 'validation-failure' THEN INTERVAL 1 DAY ELSE INTERVAL 1 HOUR END AS len
      FROM evaluated WHERE breached),
    w AS (SELECT *, lag(start) OVER a AS before, lead(start) OVER a AS after FROM b WINDOW a AS (PARTITION BY alarm ORDER BY start)),
    t AS (
      SELECT alarm, start AS moment, 'ALARM' AS state FROM w WHERE before IS NULL OR before + len < start
      UNION ALL SELECT alarm, start + len, 'OK' FROM w
      WHERE (after IS NULL OR after > start + len) AND start + len <= (SELECT max(ts) FROM events))
    SELECT alarm, strftime(moment, '%Y-%m-%d %H:%M:%S') AS moment, state FROM t""",
)
def transitions(spark, sf_dir):
    """When each rule went to ALARM and back, from the totals of the stream."""
    as_of = table(spark, sf_dir, "events").agg(F.max("ts")).scalar()
    found = alarm_transitions(current_alarms(spark, kept_totals(spark, sf_dir), ALARM_RULES), ALARM_RULES, as_of)
    return found.withColumnRenamed("at", "moment")


@query(
    "incremental_cleaning",
    f"""WITH {TYPED_HOURLY} SELECT date::varchar AS date, hour, temperature_c, precipitation_mm, windspeed_kmh, source,
      ingested_at, execution_date, 3 AS batches FROM typed
    WHERE temperature_c BETWEEN -89 AND 57 AND windspeed_kmh >= 0 AND precipitation_mm >= 0 {LATEST_HOUR}""",
)
def incremental_cleaning(spark, sf_dir):
    """Documents that land in three portions, each cleaned when it arrives, as if cleaned at once.

    The portions share all days, so later ones replace rows of earlier ones. The run of the second breaks off
    between publishing and the record of its batch, and is repeated.
    """
    base = scratch_dir(spark, "lake")
    documents = hourly_documents(spark, sf_dir)

    def lost(spark, path, record):
        raise OSError("lost before the record")

    for portion in range(3):
        own = documents.filter(F.col("event_id") % 3 == portion).select("envelope")
        own.write.mode("append").text(f"{base}/raw/weather/{folder_of(LANDED_ON)}")
        if portion == 1:
            try:
                clean_new_files(spark, base, "weather", commit=lost)
            except StreamingQueryException:
                pass
        clean_new_files(spark, base, "weather")
    path = f"{base}/cleaned/weather"
    spark.catalog.refreshByPath(path)
    return read_layer(spark, path).withColumn("batches", F.lit(len(committed(spark, base, "weather"))))
