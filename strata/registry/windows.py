"""Rolling windows over the hourly and price series."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions.numeric import rnd
from strata.operators.series import even_chunks, look_back, rolling
from strata.plans import hourly as hourly_plan
from strata.plans import price
from strata.plans.tails import leave_tail, rows_before
from strata.registry import query
from strata.registry.views import (
    HOURLY,
    PRICES,
    PROCESSED_AT,
    PROCESSED_SQL,
    READINGS,
    hourly,
    price_series,
    readings,
    sql_rnd,
)
from strata.session import scratch_dir
from strata.sinks.tables import write_cleaned
from strata.sources.files import read_layer

DAY = "(PARTITION BY source, date ORDER BY hour ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)"
ALL_DAYS = "(PARTITION BY source ORDER BY date, hour ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)"
SIX = f"""{sql_rnd(f'avg(temperature_c) OVER {DAY}', 2)} AS temp_6h_rolling_avg,
  {sql_rnd(f'avg(windspeed_kmh) OVER {DAY}', 2)} AS wind_6h_rolling_avg"""
DAYLONG = f"{sql_rnd(f'avg(temperature_c) OVER {ALL_DAYS}', 2)} AS temp_24h_rolling_avg"
INDEX = sql_rnd("temperature_c + (0.33::double * 40) - 0.7::double * windspeed_kmh / 3.6::double - 4", 2)
FLAGS = f"{INDEX} AS heat_index_c, precipitation_mm > 0 AS is_rainy, windspeed_kmh > 30 AS is_windy"
BASE = "source, date::varchar AS date, hour, temperature_c, precipitation_mm, windspeed_kmh"


@query("rolling_6", f"WITH {HOURLY} SELECT source, date::varchar AS date, hour, {SIX} FROM hourly")
def rolling_6(spark, sf_dir):
    specs = {"temp_6h_rolling_avg": ("avg", "temperature_c", 2), "wind_6h_rolling_avg": ("avg", "windspeed_kmh", 2)}
    out = rolling(hourly(spark, sf_dir), ["source", "date"], ["hour"], 6, specs)
    return out.select("source", "date", "hour", *specs)


@query("rolling_24", f"WITH {HOURLY} SELECT source, date::varchar AS date, hour, {DAYLONG} FROM hourly")
def rolling_24(spark, sf_dir):
    specs = {"temp_24h_rolling_avg": ("avg", "temperature_c", 2)}
    out = rolling(hourly(spark, sf_dir), ["source"], ["date", "hour"], 24, specs, chunk=F.trunc("date", "month"))
    return out.select("source", "date", "hour", *specs)


@query(
    "rolling_events",
    f"""WITH {READINGS} SELECT event_id, source, count(temperature_c) OVER w AS seen,
      {sql_rnd('avg(temperature_c) OVER w', 2)} AS rolling_avg, min(temperature_c) OVER w AS rolling_min,
      {sql_rnd('stddev_samp(temperature_c) OVER w', 4)} AS rolling_stddev
    FROM readings WINDOW w AS (PARTITION BY source ORDER BY ts, event_id ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)""",
)
def rolling_events(spark, sf_dir):
    """The 24-row window over single events, whose series grow with the table: cut evenly."""

    def framed(agg):
        return lambda w: agg.over(w.rowsBetween(-23, 0))

    exprs = {
        "seen": framed(F.count("temperature_c")),
        "rolling_avg": lambda w: rnd(F.avg("temperature_c").over(w.rowsBetween(-23, 0)), 2),
        "rolling_min": framed(F.min("temperature_c")),
        "rolling_stddev": lambda w: rnd(F.stddev_samp("temperature_c").over(w.rowsBetween(-23, 0)), 4),
    }
    rows = readings(spark, sf_dir).select("event_id", "source", "ts", "temperature_c")
    by, order = ["source"], ["ts", "event_id"]
    parts = even_chunks(rows, by, order, chunks=16)
    out = look_back(parts, by, order, 23, exprs, chunk=F.col("_part"), coarser=F.floor(F.col("_part") / 4))
    return out.select("event_id", "source", *exprs)


@query(
    "rolling_range",
    f"""WITH {READINGS}, r AS (SELECT *, date_trunc('hour', ts) AS moment FROM readings)
    SELECT event_id, source, strftime(moment, '%Y-%m-%d %H:%M:%S') AS moment, count(temperature_c) OVER w AS seen,
      {sql_rnd('avg(temperature_c) OVER w', 2)} AS rolling_avg, min(temperature_c) OVER w AS rolling_min,
      max(windspeed_kmh) OVER w AS rolling_max, {sql_rnd('stddev_samp(temperature_c) OVER w', 4)} AS rolling_stddev
    FROM r WINDOW w AS (PARTITION BY source ORDER BY moment RANGE BETWEEN INTERVAL 6 HOURS PRECEDING AND CURRENT ROW)""",
)
def rolling_by_time(spark, sf_dir):
    """The last six hours before each reading, whatever their number; readings of an hour share one frame."""
    specs = {
        "seen": ("count", "temperature_c", None),
        "rolling_avg": ("avg", "temperature_c", 2),
        "rolling_min": ("min", "temperature_c", None),
        "rolling_max": ("max", "windspeed_kmh", None),
        "rolling_stddev": ("stddev", "temperature_c", 4),
    }
    rows = readings(spark, sf_dir).withColumn("moment", F.date_trunc("hour", "ts"))
    out = rolling(rows, ["source"], ["moment"], 6 * 3600, specs, frame="range")
    return out.select("event_id", "source", "moment", *specs)


@query(
    "rebuild_from_tails",
    f"""WITH {HOURLY}, w AS (SELECT {BASE}, {SIX}, {DAYLONG}, {FLAGS} FROM hourly)
    SELECT * FROM w WHERE date >= '2024-01-20'""",
)
def rebuild_from_tails(spark, sf_dir):
    """The curated hours of the days from one day on. Of what lies before, only the newest rows of each
    series are read, which the run up to that day has left."""
    base = scratch_dir(spark, "lake")
    table, tails, start = f"{base}/cleaned/weather", f"{base}/tails/weather", "2024-01-20"
    how = (["source"], ["date", "hour"], hourly_plan.LOOK_BACK)
    write_cleaned(hourly(spark, sf_dir), table)
    leave_tail(read_layer(spark, table, end="2024-01-19"), tails, *how, None)
    later = read_layer(spark, table, start)
    series = later.unionByName(rows_before(spark, table, tails, *how, start))
    out = hourly_plan.enriched(series, PROCESSED_AT).drop("processed_at")
    return out.filter(F.col("date") >= F.lit(start).cast("date"))


@query("heat_index_flags", f"WITH {HOURLY} SELECT source, date::varchar AS date, hour, {FLAGS} FROM hourly")
def heat_index_flags(spark, sf_dir):
    flagged = hourly_plan.weather_flags(hourly(spark, sf_dir))
    return flagged.select("source", "date", "hour", "heat_index_c", "is_rainy", "is_windy")


@query(
    "hourly_enriched",
    f"WITH {HOURLY} SELECT {BASE}, {SIX}, {DAYLONG}, {FLAGS}, {PROCESSED_SQL} AS processed_at FROM hourly",
)
def hourly_enriched(spark, sf_dir):
    return hourly_plan.enriched(hourly(spark, sf_dir), PROCESSED_AT)


@query(
    "price_stats",
    f"""WITH {PRICES}, s AS (
      SELECT *, {sql_rnd('avg(rate_usd) OVER week', 2)} AS rate_usd_7d_avg,
        {sql_rnd('stddev_samp(rate_usd) OVER week', 4)} AS rate_usd_7d_stddev,
        lag(rate_usd) OVER (PARTITION BY currency ORDER BY date) AS before
      FROM prices WINDOW week AS (PARTITION BY currency ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))
    SELECT currency, date::varchar AS date, rate_usd, rate_gbp, rate_eur, rate_usd_7d_avg, rate_usd_7d_stddev,
      {sql_rnd('(rate_usd - before) / nullif(before, 0) * 100', 4)} AS price_change_pct,
      {sql_rnd('rate_usd_7d_avg + 2 * rate_usd_7d_stddev', 2)} AS volatility_band_upper,
      {sql_rnd('rate_usd_7d_avg - 2 * rate_usd_7d_stddev', 2)} AS volatility_band_lower,
      {PROCESSED_SQL} AS processed_at
    FROM s""",
)
def price_stats(spark, sf_dir):
    return price.stats(price_series(spark, sf_dir), PROCESSED_AT)
