"""Parsing, filtering, deduplication and imputation."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions.dates import HOURLY_FORMAT, calendar_parts, date_path, parse_ts, partition_parts
from strata.functions.numeric import rnd
from strata.operators.clean import (
    dedup_latest,
    enforce_schema,
    exact_quantiles,
    impute,
    positive,
    range_filter,
)
from strata.plans import hourly as hourly_plan
from strata.plans import price as price_plan
from strata.registry import query
from strata.registry.views import (
    HOURLY_ROWS,
    RATES,
    READINGS,
    landed_hourly,
    landed_prices,
    rates,
    readings,
    sql_rnd,
    table,
)
from strata.schemas import DATE, DOUBLE, INT, LONG, struct

TIME_TEXT = "CASE WHEN event_id % 41 = 0 THEN 'not a time' ELSE strftime(ts, '%Y-%m-%dT%H:%M') END"


def with_time_text(df):
    text = F.when(F.col("event_id") % 41 == 0, "not a time").otherwise(F.date_format("ts", HOURLY_FORMAT))
    return df.withColumn("time_str", text)


@query(
    "parse_timestamp",
    f"""SELECT event_id, strftime(try_strptime({TIME_TEXT}, '%Y-%m-%dT%H:%M'), '%Y-%m-%d %H:%M:%S') AS at
    FROM events""",
)
def parse_timestamp(spark, sf_dir):
    texts = with_time_text(table(spark, sf_dir, "events"))
    return texts.select("event_id", parse_ts("time_str", HOURLY_FORMAT).alias("at"))


@query(
    "date_parts",
    """SELECT event_id, ts::date::varchar AS date, hour(ts)::int AS hour, year(ts)::int AS year,
      month(ts)::int AS month, day(ts)::int AS day FROM events""",
)
def date_parts(spark, sf_dir):
    parts = partition_parts(calendar_parts(table(spark, sf_dir, "events"), "ts"))
    return parts.select("event_id", "date", "hour", "year", "month", "day")


@query(
    "date_path",
    """SELECT o_orderkey AS order_id, strftime(o_orderdate, '%Y/%m/%d') AS folder FROM orders""",
)
def date_folder(spark, sf_dir):
    return rates(spark, sf_dir).select("order_id", date_path("date").alias("folder"))


@query(
    "cast_round",
    f"""SELECT event_id, {sql_rnd('value::varchar::double / 7', 2)} AS two, {sql_rnd('value / 7', 3)} AS three,
      {sql_rnd('value / 7', 4)} AS four FROM events""",
)
def cast_round(spark, sf_dir):
    seventh = F.col("value").cast("string").cast("double") / 7
    return table(spark, sf_dir, "events").select(
        "event_id", rnd(seventh, 2).alias("two"), rnd(seventh, 3).alias("three"), rnd(seventh, 4).alias("four")
    )


BOUNDS = hourly_plan.RANGES
READING_COLUMNS = ["event_id", "temperature_c", "precipitation_mm", "windspeed_kmh"]


@query(
    "range_filter",
    f"""WITH {READINGS} SELECT event_id, temperature_c, precipitation_mm, windspeed_kmh FROM readings
    WHERE temperature_c BETWEEN -89 AND 57 AND windspeed_kmh >= 0 AND precipitation_mm >= 0""",
)
def drop_out_of_range(spark, sf_dir):
    return range_filter(readings(spark, sf_dir), BOUNDS).select(*READING_COLUMNS)


@query(
    "range_filter_keep_nulls",
    f"""WITH {READINGS} SELECT event_id, temperature_c, precipitation_mm, windspeed_kmh FROM readings
    WHERE (temperature_c BETWEEN -89 AND 57 OR temperature_c IS NULL) AND (windspeed_kmh >= 0 OR windspeed_kmh IS NULL)
      AND (precipitation_mm >= 0 OR precipitation_mm IS NULL)""",
)
def drop_out_of_range_keep_nulls(spark, sf_dir):
    return range_filter(readings(spark, sf_dir), BOUNDS, "keep").select(*READING_COLUMNS)


@query(
    "positive_filter",
    f"""WITH {READINGS} SELECT event_id, precipitation_mm FROM readings WHERE precipitation_mm > 0""",
)
def positive_filter(spark, sf_dir):
    return positive(readings(spark, sf_dir), "precipitation_mm").select("event_id", "precipitation_mm")


LINE_ORDER = ["l_shipdate", "l_extendedprice", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax"]
LINE_SQL_ORDER = ", ".join(f"{c} DESC" for c in LINE_ORDER)


@query(
    "dedup_latest",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
      strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate
    FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_SQL_ORDER}) = 1""",
)
def dedup_lines(spark, sf_dir):
    kept = dedup_latest(
        table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], [F.desc(c) for c in LINE_ORDER]
    )
    return kept.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"
    )


@query(
    "dedup_keys",
    f"""WITH {RATES} SELECT date::varchar AS date, currency, rate_usd FROM rates
    QUALIFY row_number() OVER (PARTITION BY date, currency ORDER BY rate_usd DESC, order_id) = 1""",
)
def dedup_prices(spark, sf_dir):
    order = [F.desc("rate_usd"), F.col("order_id")]
    return dedup_latest(rates(spark, sf_dir), price_plan.KEYS, order).select(*price_plan.KEYS, "rate_usd")


@query(
    "median_exact",
    f"""WITH {READINGS} SELECT quantile_disc(temperature_c, 0.5) AS temperature_c,
      quantile_disc(windspeed_kmh, 0.5) AS windspeed_kmh FROM readings""",
)
def median_exact(spark, sf_dir):
    return exact_quantiles(readings(spark, sf_dir), ["temperature_c", "windspeed_kmh"])


@query(
    "median_by_source",
    f"""WITH {READINGS} SELECT source, quantile_disc(temperature_c, 0.5) AS temperature_c,
      quantile_disc(windspeed_kmh, 0.5) AS windspeed_kmh FROM readings GROUP BY source""",
)
def median_by_source(spark, sf_dir):
    return exact_quantiles(readings(spark, sf_dir), ["temperature_c", "windspeed_kmh"], by=["source"])


@query(
    "median_impute",
    f"""WITH {READINGS}, m AS (SELECT quantile_disc(temperature_c, 0.5) AS t, quantile_disc(windspeed_kmh, 0.5) AS w
      FROM readings)
    SELECT event_id, coalesce(temperature_c, t, 15.0) AS temperature_c,
      coalesce(precipitation_mm, 0.0) AS precipitation_mm, coalesce(windspeed_kmh, w, 10.0) AS windspeed_kmh
    FROM readings, m""",
)
def median_impute(spark, sf_dir):
    rows = readings(spark, sf_dir)
    filled = impute(rows, hourly_plan.DEFAULTS, exact_quantiles(rows, hourly_plan.MEDIAN_FILLED))
    return filled.select(*READING_COLUMNS)


@query(
    "median_impute_by_source",
    f"""WITH {READINGS}, m AS (SELECT source, quantile_disc(temperature_c, 0.5) AS t,
      quantile_disc(windspeed_kmh, 0.5) AS w FROM readings GROUP BY source)
    SELECT event_id, coalesce(temperature_c, t, 15.0) AS temperature_c,
      coalesce(precipitation_mm, 0.0) AS precipitation_mm, coalesce(windspeed_kmh, w, 10.0) AS windspeed_kmh
    FROM readings JOIN m USING (source)""",
)
def median_impute_by_source(spark, sf_dir):
    rows = readings(spark, sf_dir)
    medians = exact_quantiles(rows, hourly_plan.MEDIAN_FILLED, by=["source"])
    return impute(rows, hourly_plan.DEFAULTS, medians, by=["source"]).select(*READING_COLUMNS)


SCHEMA = struct(("event_id", "date", "hour"), event_id=LONG, date=DATE, hour=INT, reading=DOUBLE)


@query(
    "schema_enforce",
    f"""WITH t AS (SELECT event_id, try_cast(CASE WHEN event_id % 41 = 0 THEN 'unknown'
          ELSE ts::date::varchar END AS date) AS date,
        CASE WHEN event_id % 43 = 0 THEN NULL ELSE hour(ts)::int END AS hour,
        CASE WHEN event_id % 37 = 0 THEN NULL ELSE value END AS reading FROM events)
    SELECT event_id, date::varchar AS date, hour, reading, '' AS rejected FROM t
    WHERE date IS NOT NULL AND hour IS NOT NULL
    UNION ALL SELECT event_id, NULL, NULL, NULL, concat_ws(',', CASE WHEN date IS NULL THEN 'date' END,
        CASE WHEN hour IS NULL THEN 'hour' END) FROM t WHERE date IS NULL OR hour IS NULL""",
)
def schema_enforce(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_id") % 41 == 0, "unknown").otherwise(F.to_date("ts").cast("string")).alias("date"),
        F.when(F.col("event_id") % 43 != 0, F.hour("ts").cast("string")).alias("hour"),
        F.when(F.col("event_id") % 37 == 0, "n/a").otherwise(F.col("value").cast("string")).alias("reading"),
    )
    good, rejected = enforce_schema(rows, SCHEMA)
    none = {c: F.lit(None).cast(t) for c, t in [("date", "date"), ("hour", "int"), ("reading", "double")]}
    refused = rejected.withColumns(none).withColumn("rejected", F.array_join("rejected", ","))
    return good.withColumn("rejected", F.lit("")).unionByName(refused.select("event_id", *none, "rejected"))


@query(
    "flatten_hourly",
    f"""WITH {HOURLY_ROWS} SELECT source, ingested_at, execution_date, time_str, temperature_c, precipitation_mm,
      windspeed_kmh FROM flat""",
)
def flatten_hourly(spark, sf_dir):
    return hourly_plan.flatten(landed_hourly(spark, sf_dir))


TYPED_HOURLY = f"""{HOURLY_ROWS}, typed AS (
  SELECT strptime(time_str, '%Y-%m-%dT%H:%M')::date AS date, hour(strptime(time_str, '%Y-%m-%dT%H:%M'))::int AS hour,
    {sql_rnd('temperature_c', 2)} AS temperature_c, {sql_rnd('precipitation_mm', 3)} AS precipitation_mm,
    {sql_rnd('windspeed_kmh', 2)} AS windspeed_kmh, source,
    strftime(strptime(ingested_at, '%Y-%m-%dT%H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS ingested_at, execution_date
  FROM flat)"""
LATEST_HOUR = """QUALIFY row_number() OVER (PARTITION BY date, hour, source ORDER BY ingested_at DESC NULLS LAST,
  temperature_c DESC NULLS LAST, precipitation_mm DESC NULLS LAST, windspeed_kmh DESC NULLS LAST,
  execution_date DESC NULLS LAST) = 1"""


@query(
    "cleaned_hourly",
    f"""WITH {TYPED_HOURLY} SELECT date::varchar AS date, hour, temperature_c, precipitation_mm, windspeed_kmh, source,
      ingested_at, execution_date FROM typed
    WHERE temperature_c BETWEEN -89 AND 57 AND windspeed_kmh >= 0 AND precipitation_mm >= 0 {LATEST_HOUR}""",
)
def cleaned_hourly(spark, sf_dir):
    return hourly_plan.clean(landed_hourly(spark, sf_dir))[0]


@query(
    "cleaned_hourly_imputed",
    f"""WITH {TYPED_HOURLY}, kept AS (SELECT * FROM typed
      WHERE (temperature_c BETWEEN -89 AND 57 OR temperature_c IS NULL) AND (windspeed_kmh >= 0 OR windspeed_kmh IS NULL)
        AND (precipitation_mm >= 0 OR precipitation_mm IS NULL) {LATEST_HOUR}),
    m AS (SELECT quantile_disc(temperature_c, 0.5) AS t, quantile_disc(windspeed_kmh, 0.5) AS w FROM kept)
    SELECT date::varchar AS date, hour, coalesce(temperature_c, t, 15.0) AS temperature_c,
      coalesce(precipitation_mm, 0.0) AS precipitation_mm, coalesce(windspeed_kmh, w, 10.0) AS windspeed_kmh, source,
      ingested_at, execution_date FROM kept, m""",
)
def cleaned_hourly_imputed(spark, sf_dir):
    return hourly_plan.clean(landed_hourly(spark, sf_dir), "keep")[0]


@query(
    "cleaned_price",
    """WITH q AS (SELECT o_orderdate::date AS date,
        CASE WHEN o_orderkey % 29 = 0 THEN -o_totalprice ELSE o_totalprice END AS rate_usd,
        o_orderpriority AS description, o_orderdate + to_seconds(o_orderkey % 86400) AS landed FROM orders)
    SELECT date::varchar AS date, 'BTC' AS currency, rate_usd, rate_usd * 0.8::double AS rate_gbp,
      rate_usd * 0.9::double AS rate_eur, description, strftime(landed, '%Y-%m-%d %H:%M:%S') AS ingested_at,
      date::varchar AS execution_date
    FROM q WHERE rate_usd > 0
    QUALIFY row_number() OVER (PARTITION BY date ORDER BY landed DESC, rate_usd DESC, description DESC) = 1""",
)
def cleaned_price(spark, sf_dir):
    return price_plan.clean(landed_prices(spark, sf_dir))[0]
