"""Daily aggregates and their join."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.sketches import keep_sketches, quantiles
from strata.plans import price, summary
from strata.registry import query
from strata.registry.views import (
    PROCESSED_AT,
    PROCESSED_SQL,
    RATES,
    READINGS,
    SHIPMENTS,
    rates,
    readings,
    shipments,
    sql_rnd,
)
from strata.session import scratch_dir

DAILY_COLUMNS = f"""{sql_rnd('avg(temperature_c)', 2)} AS avg_temp_c, {sql_rnd('max(temperature_c)', 2)} AS max_temp_c,
  {sql_rnd('min(temperature_c)', 2)} AS min_temp_c, {sql_rnd('stddev_samp(temperature_c)', 4)} AS stddev_temp_c,
  {sql_rnd('sum(precipitation_mm)', 3)} AS total_precip_mm, {sql_rnd('avg(windspeed_kmh)', 2)} AS avg_windspeed_kmh,
  max(windspeed_kmh) AS max_windspeed_kmh, count(*) AS hourly_records"""

PRICE_COLUMNS = f"""{sql_rnd('avg(rate_usd)', 2)} AS btc_usd_avg, {sql_rnd('max(rate_usd)', 2)} AS btc_usd_high,
  {sql_rnd('min(rate_usd)', 2)} AS btc_usd_low, {sql_rnd('avg(rate_gbp)', 2)} AS btc_gbp_avg,
  {sql_rnd('avg(rate_eur)', 2)} AS btc_eur_avg"""


@query(
    "daily_rollup",
    f"WITH {READINGS} SELECT date::varchar AS date, source, {DAILY_COLUMNS} FROM readings GROUP BY date, source",
)
def daily_rollup(spark, sf_dir):
    return summary.daily_hourly(readings(spark, sf_dir), ["date", "source"])


@query("daily_price", f"WITH {RATES} SELECT date::varchar AS date, {PRICE_COLUMNS} FROM rates GROUP BY date")
def daily_price(spark, sf_dir):
    return price.daily(rates(spark, sf_dir))


@query(
    "daily_summary",
    f"""WITH {SHIPMENTS}, {RATES}, w AS (SELECT date, {DAILY_COLUMNS} FROM shipments GROUP BY date),
    p AS (SELECT date, {PRICE_COLUMNS} FROM rates GROUP BY date)
    SELECT w.date::varchar AS date, avg_temp_c, max_temp_c, min_temp_c, stddev_temp_c, total_precip_mm,
      avg_windspeed_kmh, max_windspeed_kmh, hourly_records, btc_usd_avg, btc_usd_high, btc_usd_low, btc_gbp_avg,
      btc_eur_avg, {PROCESSED_SQL} AS processed_at, '1.0.0' AS pipeline_version
    FROM w LEFT JOIN p ON w.date = p.date ORDER BY w.date""",
)
def daily_summary(spark, sf_dir):
    return summary.build(shipments(spark, sf_dir), rates(spark, sf_dir), PROCESSED_AT)


@query(
    "sketch_medians",
    f"""WITH {READINGS}, v AS (
      SELECT date, source, unnest(['temperature_c', 'windspeed_kmh']) AS "column", unnest([temperature_c, windspeed_kmh]) AS x FROM readings)
    SELECT 'day' AS period, date::varchar AS start, source, "column", count(x) AS n, quantile_disc(x, 0.5) AS median FROM v GROUP BY ALL
    UNION ALL SELECT 'month', date_trunc('month', date)::date::varchar, source, "column", count(x), quantile_disc(x, 0.5) FROM v GROUP BY ALL""",
)
def sketch_medians(spark, sf_dir):
    """Medians of days and months from sketches that two runs have stored, the second in place of some days."""
    path, cols = scratch_dir(spark, "sketches"), ["temperature_c", "windspeed_kmh"]
    rows = readings(spark, sf_dir)
    keep_sketches(rows.withColumn("temperature_c", F.lit(0.0)), path, ["source"], cols)
    keep_sketches(rows, path, ["source"], cols)
    stored = spark.read.parquet(path)
    days = quantiles(stored, ["date", "source"]).select(F.lit("day").alias("period"), F.col("date").alias("start"), "source", "column", "n", "value")
    months = quantiles(stored.withColumn("start", F.trunc("date", "month")), ["start", "source"])
    months = months.select(F.lit("month").alias("period"), "start", "source", "column", "n", "value")
    return days.unionByName(months).withColumnRenamed("value", "median")


@query(
    "sketch_rank_error",
    f"""WITH {READINGS}, q AS (SELECT unnest([0.05, 0.25, 0.5, 0.75, 0.95]::double[]) AS q)
    SELECT q, (SELECT count(temperature_c) FROM readings) AS n, true AS close FROM q""",
)
def sketch_rank_error(spark, sf_dir):
    """Quantiles of all readings from the stored sketches of days and sources, whose true ranks are counted."""
    path = scratch_dir(spark, "sketches")
    rows = readings(spark, sf_dir).select("date", "source", "temperature_c")
    keep_sketches(rows, path, ["source"], ["temperature_c"])
    stored = spark.read.parquet(path)
    ranks = [0.05, 0.25, 0.5, 0.75, 0.95]
    found = [quantiles(stored, [], q).select(F.lit(q).alias("q"), "n", "value") for q in ranks]
    values = reduce(DataFrame.unionByName, found)
    table = values.agg(F.collect_list(F.struct("q", "n", "value")).alias("at")).scalar()
    each = rows.where("temperature_c IS NOT NULL").select("temperature_c", F.explode(table).alias("at"))
    counted = each.groupBy("at.q", "at.n").agg(
        F.avg((F.col("temperature_c") < F.col("at.value")).cast("double")).alias("below"),
        F.avg((F.col("temperature_c") <= F.col("at.value")).cast("double")).alias("upto"),
    )
    close = (F.col("below") <= F.col("q") + 0.005) & (F.col("upto") >= F.col("q") - 0.005)
    return counted.select("q", "n", close.alias("close"))
