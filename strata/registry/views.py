"""Bindings of the given tables to the feeds, as DataFrames and as SQL.

Events serve as hourly readings, as landed documents and as metric points; orders as prices. The
tables hold no nulls, so some readings are blanked by a rule.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.dates import HOURLY_FORMAT, folder_of
from strata.functions.jsondoc import wrap_envelope
from strata.functions.numeric import rnd
from strata.operators.monitor import points
from strata.schemas import HOURLY_PAYLOAD, PRICE_PAYLOAD
from strata.session import scratch_dir
from strata.sources.files import read_envelopes

PROCESSED_AT = dt.datetime(2024, 2, 1, 3, 0, 0)
PROCESSED_SQL = "'2024-02-01 03:00:00'"


def present(df: DataFrame) -> DataFrame:
    """Dates and timestamps as text, so that engines print them alike."""
    shown = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DateType):
            shown.append(F.col(f.name).cast("string").alias(f.name))
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            shown.append(F.date_format(f.name, "yyyy-MM-dd HH:mm:ss").alias(f.name))
        else:
            shown.append(F.col(f.name))
    return df.select(*shown)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # The tables hold times without a zone; the feeds are in UTC.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    times = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in times}) if times else df


def prop_k() -> F.Column:
    return F.get_json_object("props", "$.k")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    blank = F.lit(None).cast("double")
    temperature = F.when(F.col("event_id") % 37 == 0, blank).otherwise(F.col("value") * 2 - 100)
    precipitation = (
        F.when(F.col("event_id") % 41 == 0, blank)
        .when(F.col("event_id") % 43 == 0, -1.0)
        .otherwise(prop_k().cast("double") / 10)
    )
    wind = F.when(F.col("event_id") % 53 == 0, blank).otherwise(F.col("value") * 0.25)
    return table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        "ts",
        F.to_date("ts").alias("date"),
        F.hour("ts").alias("hour"),
        F.col("event_type").alias("source"),
        temperature.alias("temperature_c"),
        precipitation.alias("precipitation_mm"),
        wind.alias("windspeed_kmh"),
    )


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings per source, date and hour: at most one row per hour of the calendar and source."""
    return (
        readings(spark, sf_dir)
        .groupBy("source", "date", "hour")
        .agg(
            rnd(F.avg("temperature_c"), 2).alias("temperature_c"),
            rnd(F.avg("precipitation_mm"), 3).alias("precipitation_mm"),
            rnd(F.avg("windspeed_kmh"), 2).alias("windspeed_kmh"),
        )
    )


def rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order as a quoted price."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.to_date("o_orderdate").alias("date"),
        F.col("o_orderstatus").alias("currency"),
        F.col("o_totalprice").alias("rate_usd"),
        (F.col("o_totalprice") * 0.8).alias("rate_gbp"),
        (F.col("o_totalprice") * 0.9).alias("rate_eur"),
    )


def price_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean quote per currency and date."""
    means = [rnd(F.avg(c), 2).alias(c) for c in ("rate_usd", "rate_gbp", "rate_eur")]
    return rates(spark, sf_dir).groupBy("currency", "date").agg(*means)


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order line as a reading of its shipping date."""
    return table(spark, sf_dir, "lineitem").select(
        F.to_date("l_shipdate").alias("date"),
        (F.col("l_extendedprice") / 1000).alias("temperature_c"),
        F.col("l_tax").alias("precipitation_mm"),
        F.col("l_quantity").alias("windspeed_kmh"),
    )


def hourly_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event as one landed document of four hourly readings, some arrays shorter."""
    k, at = prop_k().cast("int"), F.unix_seconds("ts")

    def slots(n: int, value) -> F.Column:
        return F.array(*[value(i) for i in range(n)])

    def wind_at(i: int) -> F.Column:
        return F.col("value") * 0.25 + i

    time = slots(4, lambda i: F.date_format(F.timestamp_seconds(at + i * 3600), HOURLY_FORMAT))
    temperature = slots(4, lambda i: F.col("value") * 2 - 100 + i)
    precipitation = slots(3, lambda i: k / 10 + i)
    wind = F.when(k % 2 == 0, slots(2, wind_at)).otherwise(slots(4, wind_at))
    payload = F.to_json(
        F.struct(
            F.struct(
                time.alias("time"),
                temperature.alias("temperature_2m"),
                precipitation.alias("precipitation"),
                wind.alias("windspeed_10m"),
            ).alias("hourly")
        )
    )
    documents = table(spark, sf_dir, "events").withColumn("payload", payload)
    return wrap_envelope(documents, "payload", F.col("event_type"), F.to_date("ts"), iso_time("ts")).select(
        "event_id", "envelope"
    )


def price_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order as one landed price document; some prices are negative."""
    usd = F.when(F.col("o_orderkey") % 29 == 0, -F.col("o_totalprice")).otherwise(F.col("o_totalprice"))
    orders = table(spark, sf_dir, "orders").withColumn("usd", usd)
    quote = F.struct(
        F.struct(F.col("usd").alias("rate_float"), F.col("o_orderpriority").alias("description")).alias("USD"),
        F.struct((F.col("usd") * 0.8).alias("rate_float")).alias("GBP"),
        F.struct((F.col("usd") * 0.9).alias("rate_float")).alias("EUR"),
    )
    landed = F.timestamp_seconds(F.unix_seconds("o_orderdate") + F.col("o_orderkey") % 86400)
    documents = orders.withColumns({"payload": F.to_json(F.struct(quote.alias("bpi"))), "landed": landed})
    return wrap_envelope(
        documents, "payload", F.col("o_orderstatus"), F.to_date("o_orderdate"), iso_time("landed")
    ).select("o_orderkey", "envelope")


def iso_time(ts: str) -> F.Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


LANDED_ON = "2024-02-01"


def landed(spark: SparkSession, documents: DataFrame, dataset: str, payload: T.StructType) -> DataFrame:
    """The documents written to the raw layer, one per line, and read back."""
    base = scratch_dir(spark, "raw")
    documents.select("envelope").write.text(f"{base}/{dataset}/{folder_of(LANDED_ON)}")
    return read_envelopes(spark, base, dataset, LANDED_ON, payload, multi_line=False, pattern="*.txt")


def landed_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed(spark, hourly_documents(spark, sf_dir), "weather", HOURLY_PAYLOAD)


def landed_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed(spark, price_documents(spark, sf_dir), "crypto", PRICE_PAYLOAD)


LAYERS = ("raw", "cleaned", "curated")


def metric_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event as the metric points of one run: its outcome, duration and row count."""
    k = prop_k().cast("double")

    def point(name: str, value, unit: str = "Count"):
        return F.struct(F.lit(name).alias("name"), value.cast("double").alias("value"), F.lit(unit).alias("unit"))

    one = F.lit(1.0)
    outcome = (
        F.when(F.col("event_type") == "click", F.array(point("RecordsIngested", k)))
        .when(F.col("event_type") == "error", F.array(point("PipelineFailure", one), point("IngestionErrors", one)))
        .when(F.col("event_type") == "purchase", F.array(point("PipelineSuccess", one)))
        .when(F.col("event_type") == "signup", F.array(point("ValidationFailed", one)))
        .otherwise(F.array(point("ValidationPassed", one)))
    )
    always = F.array(point("IngestionDurationSeconds", F.col("value"), "Seconds"), point("RowCount", k))
    layer = F.element_at(F.array(*[F.lit(n) for n in LAYERS]), (F.col("user_id") % 3 + 1).cast("int"))
    dataset = F.when(F.col("user_id") % 2 == 0, "weather").otherwise("crypto")
    emitted = (
        table(spark, sf_dir, "events")
        .select("ts", layer.alias("layer"), dataset.alias("dataset"), F.explode(F.concat(outcome, always)).alias("p"))
    )
    dims = {"Layer": F.col("layer"), "Dataset": F.col("dataset")}
    return points(emitted, F.col("p.name"), F.col("p.value"), F.col("p.unit"), dims, F.col("ts"))


# --- the same views as SQL -------------------------------------------------------------------------


def sql_rnd(x: str, digits: int) -> str:
    return f"round(({x})::decimal(38,6), {digits})::double"


def sql_pct(rate: str, digits: int) -> str:
    return f"(round((({rate}) * 100)::decimal(38,6), {digits})::decimal(38,{digits})::varchar || '%')"


READINGS = """readings AS (
  SELECT event_id, user_id, ts, ts::date AS date, hour(ts)::int AS hour, event_type AS source,
    CASE WHEN event_id % 37 = 0 THEN NULL ELSE value * 2 - 100 END AS temperature_c,
    CASE WHEN event_id % 41 = 0 THEN NULL WHEN event_id % 43 = 0 THEN -1.0::double
         ELSE (props->>'k')::double / 10 END AS precipitation_mm,
    CASE WHEN event_id % 53 = 0 THEN NULL ELSE value * 0.25::double END AS windspeed_kmh
  FROM events)"""

HOURLY = f"""{READINGS}, hourly AS (
  SELECT source, date, hour, {sql_rnd('avg(temperature_c)', 2)} AS temperature_c,
    {sql_rnd('avg(precipitation_mm)', 3)} AS precipitation_mm, {sql_rnd('avg(windspeed_kmh)', 2)} AS windspeed_kmh
  FROM readings GROUP BY source, date, hour)"""

RATES = """rates AS (
  SELECT o_orderkey AS order_id, o_orderdate::date AS date, o_orderstatus AS currency, o_totalprice AS rate_usd,
    o_totalprice * 0.8::double AS rate_gbp, o_totalprice * 0.9::double AS rate_eur
  FROM orders)"""

PRICES = f"""{RATES}, prices AS (
  SELECT currency, date, {sql_rnd('avg(rate_usd)', 2)} AS rate_usd, {sql_rnd('avg(rate_gbp)', 2)} AS rate_gbp,
    {sql_rnd('avg(rate_eur)', 2)} AS rate_eur
  FROM rates GROUP BY currency, date)"""

SHIPMENTS = """shipments AS (
  SELECT l_shipdate::date AS date, l_extendedprice / 1000 AS temperature_c, l_tax AS precipitation_mm,
    l_quantity AS windspeed_kmh
  FROM lineitem)"""

# One row per document and array position.
HOURLY_ROWS = """flat AS (
  SELECT event_id, event_type AS source, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS ingested_at,
    strftime(ts, '%Y-%m-%d') AS execution_date, i,
    strftime(date_trunc('second', ts) + to_hours(i), '%Y-%m-%dT%H:%M') AS time_str,
    value * 2 - 100 + i AS temperature_c,
    CASE WHEN i < 3 THEN (props->>'k')::int / 10.0::double + i END AS precipitation_mm,
    CASE WHEN i < 2 OR (props->>'k')::int % 2 = 1 THEN value * 0.25::double + i END AS windspeed_kmh
  FROM events, unnest([0, 1, 2, 3]) AS slot(i))"""

METRICS = """points AS (
  SELECT ts, ['raw', 'cleaned', 'curated'][(user_id % 3 + 1)::int] AS layer,
    CASE WHEN user_id % 2 = 0 THEN 'weather' ELSE 'crypto' END AS dataset, event_type, value AS v,
    (props->>'k')::double AS k
  FROM events),
metrics AS (
  SELECT CASE event_type WHEN 'click' THEN 'RecordsIngested' WHEN 'error' THEN 'PipelineFailure'
      WHEN 'purchase' THEN 'PipelineSuccess' WHEN 'signup' THEN 'ValidationFailed'
      ELSE 'ValidationPassed' END AS name,
    CASE event_type WHEN 'click' THEN k ELSE 1.0::double END AS value, 'Count' AS unit, layer, dataset, ts FROM points
  UNION ALL SELECT 'IngestionErrors', 1.0::double, 'Count', layer, dataset, ts FROM points WHERE event_type = 'error'
  UNION ALL SELECT 'IngestionDurationSeconds', v, 'Seconds', layer, dataset, ts FROM points
  UNION ALL SELECT 'RowCount', k, 'Count', layer, dataset, ts FROM points)"""
