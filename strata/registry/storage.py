"""Scans and writes: every query writes a given table to the scratch folder and reads it back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from strata.functions.dates import partition_parts
from strata.functions.numeric import rnd
from strata.operators.runs import row_count_anomaly
from strata.params import RetentionRule
from strata.plans import price, summary
from strata.plans.layers import PARTS
from strata.registry import query
from strata.registry.rollups import PRICE_COLUMNS
from strata.registry.views import (
    PROCESSED_AT,
    RATES,
    READINGS,
    landed_hourly,
    rates,
    readings,
    shipments,
    sql_rnd,
    table,
)
from strata.session import scratch_dir
from strata.sinks.publish import expire_partitions
from strata.sinks.tables import write_cleaned, write_curated, write_partitioned
from strata.sources.catalog import open_catalog, register_table
from strata.sources.files import (
    file_inventory,
    inventory_totals,
    land_csv,
    read_csv_upload,
    read_layer,
)
from strata.sources.footers import footer_counts

DAY_STATS = f"""count(*) AS n, {sql_rnd('avg(temperature_c)', 3)} AS avg_temp, max(windspeed_kmh) AS max_wind,
  max(event_id) AS last_event"""


def day_stats(df, *by):
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        rnd(F.avg("temperature_c"), 3).alias("avg_temp"),
        F.max("windspeed_kmh").alias("max_wind"),
        F.max("event_id").alias("last_event"),
    )


@query(
    "scan_json_envelope",
    """SELECT event_type AS source, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS ingested_at,
      strftime(ts, '%Y-%m-%d') AS execution_date,
      (11 + CASE WHEN (props->>'k')::int % 2 = 0 THEN 2 ELSE 4 END)::bigint AS record_count, 4 AS times,
      value * 2 - 100 AS first_temperature
    FROM events""",
)
def scan_json_envelope(spark, sf_dir):
    documents = landed_hourly(spark, sf_dir)
    return documents.filter(F.col("_corrupt_record").isNull()).select(
        "source",
        "ingested_at",
        "execution_date",
        "record_count",
        F.size("data.hourly.time").alias("times"),
        F.col("data.hourly.temperature_2m")[0].alias("first_temperature"),
    )


def cleaned_readings(spark, sf_dir):
    path = scratch_dir(spark, "cleaned")
    write_cleaned(readings(spark, sf_dir), path)
    return path


@query(
    "scan_partitioned_parquet",
    f"""WITH {READINGS} SELECT year(date)::int AS year, month(date)::int AS month, day(date)::int AS day, {DAY_STATS}
    FROM readings GROUP BY ALL""",
)
def scan_partitioned_parquet(spark, sf_dir):
    layer = read_layer(spark, cleaned_readings(spark, sf_dir), keep_partition_columns=True)
    return day_stats(layer, "year", "month", "day")


@query(
    "scan_date_range",
    f"""WITH {READINGS} SELECT date::varchar AS date, {DAY_STATS} FROM readings
    WHERE date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20' GROUP BY date""",
)
def scan_date_range(spark, sf_dir):
    """Partition pruning: only the folders of the asked dates are opened."""
    return day_stats(read_layer(spark, cleaned_readings(spark, sf_dir), "2024-01-10", "2024-01-20"), "date")


@query("scan_csv", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def scan_csv(spark, sf_dir):
    """An upload with its columns in another order, one column more, quotes and line breaks in a value."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    upload, raw = scratch_dir(spark, "upload"), scratch_dir(spark, "raw")
    note = F.concat(F.lit('a "quoted", long\nnote of '), "c_custkey")
    shuffled = customers.select(note.alias("note"), *reversed(customers.columns))
    shuffled.write.option("header", True).option("escape", '"').csv(upload)
    status = land_csv(spark, upload, raw, "customers", "2024-02-01", "20240201T020000Z")
    return read_csv_upload(spark, status.head().uri, customers.schema, multi_line=True)


FOLDER = "'year=' || year(date) || '/month=' || month(date) || '/day=' || day(date)"


def by_folder(files):
    return files.withColumn("folder", F.regexp_extract("path", r"(year=.*)/[^/]*$", 1))


@query("file_inventory", f"WITH {READINGS} SELECT {FOLDER} AS folder, count(*) AS rows FROM readings GROUP BY ALL")
def inventory(spark, sf_dir):
    """The rows that the listed files of a written layer hold, per partition folder."""
    path = cleaned_readings(spark, sf_dir)
    listed = by_folder(file_inventory(spark, path, "*.parquet")).filter("bytes > 0 AND modified_at IS NOT NULL")
    below = lambda at: F.regexp_extract(at, r"(year=.*)$", 1).alias("file")
    listed = listed.select("folder", below(F.col("path")))
    held = spark.read.parquet(path).groupBy(below(F.col("_metadata.file_path"))).agg(F.count(F.lit(1)).alias("n"))
    return listed.join(held, "file").groupBy("folder").agg(F.sum("n").alias("rows"))


LINES_PER_FILE = 200


@query(
    "file_totals",
    f"""SELECT strftime(ts, '%Y/%m/%d') AS folder, ceil(count(*) / {LINES_PER_FILE}.0)::bigint AS files,
      sum(strlen(event_id || ' ' || event_type || ' ' || props) + 1)::bigint AS bytes
    FROM events GROUP BY 1""",
)
def totals(spark, sf_dir):
    """Files and bytes of each folder of landed text: a byte for each character and line break."""
    base = scratch_dir(spark, "landed")
    line = F.concat_ws(" ", "event_id", "event_type", "props")
    lines = table(spark, sf_dir, "events").select(line.alias("value"), F.date_format("ts", "yyyy-MM-dd").alias("day"))
    writer = lines.repartition("day").write.option("maxRecordsPerFile", LINES_PER_FILE)
    writer.partitionBy("day").text(base)
    found = inventory_totals(file_inventory(spark, base, "*.txt").withColumn("day", F.regexp_extract("path", "day=([0-9-]+)", 1)), "day")
    return found.select(F.translate("day", "-", "/").alias("folder"), "files", "bytes")


@query(
    "write_cleaned_roundtrip",
    f"""WITH {READINGS} SELECT event_id, date::varchar AS date, hour, source,
      CASE WHEN date >= DATE '2024-01-21' THEN temperature_c + 1 ELSE temperature_c END AS temperature_c
    FROM readings""",
)
def write_cleaned_roundtrip(spark, sf_dir):
    """A second write of some dates replaces their partitions and leaves the others alone."""
    path = cleaned_readings(spark, sf_dir)
    again = readings(spark, sf_dir).filter(F.col("date") >= F.lit("2024-01-21").cast("date"))
    write_cleaned(again.withColumn("temperature_c", F.col("temperature_c") + 1), path)
    return read_layer(spark, path).select("event_id", "date", "hour", "source", "temperature_c")


@query(
    "write_curated_roundtrip",
    f"WITH {RATES} SELECT date::varchar AS date, {PRICE_COLUMNS} FROM rates GROUP BY date",
)
def write_curated_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "curated")
    daily = price.daily(rates(spark, sf_dir))
    # Partitioned by month here: the 2,399 order dates would be as many files of one row.
    write_curated(daily.withColumn("month", F.date_format("date", "yyyy-MM")), path, ["month"])
    return read_layer(spark, path).drop("month")


@query(
    "catalog_sql",
    f"""SELECT event_type, count(*) AS n, count(*) FILTER (WHERE hour(ts) >= 12) AS with_props,
      {sql_rnd('sum(value::decimal(18,2))', 2)} AS total FROM events GROUP BY event_type""",
)
def catalog_sql(spark, sf_dir):
    """Files of two schemas as one table, the older half of each day lacks a column; read by name in a
    later session, which finds the table in the catalog folder."""
    path, folder = scratch_dir(spark, "events"), scratch_dir(spark, "catalog")
    events = table(spark, sf_dir, "events")
    afternoon = F.hour("ts") >= 12
    events.filter(~afternoon).drop("props").write.parquet(f"{path}/part=old")
    events.filter(afternoon).write.parquet(f"{path}/part=new")
    name = f"events_{uuid.uuid4().hex}"
    register_table(spark, name, path, folder)
    spark.sql(f"DROP TABLE {name}")  # what the end of an application does to a catalog in memory
    later = spark.newSession()
    open_catalog(later, folder)
    return later.sql(
        f"""SELECT event_type, count(*) AS n, count(props) AS with_props,
          CAST(round(sum(CAST(value AS decimal(18,2))), 2) AS double) AS total FROM {name} GROUP BY event_type"""
    )


@query(
    "curated_summary_roundtrip",
    """SELECT year(l_shipdate)::int AS year, count(DISTINCT l_shipdate) AS days, count(*) AS lines,
      count(DISTINCT l_shipdate) FILTER (WHERE l_shipdate::date NOT IN (SELECT o_orderdate::date FROM orders))
        AS days_without_price
    FROM lineitem GROUP BY 1""",
)
def curated_summary_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "curated")
    built = summary.build(shipments(spark, sf_dir), rates(spark, sf_dir), PROCESSED_AT)
    write_curated(built.withColumn("year", F.year("date")), path, ["year"])
    return (
        spark.read.parquet(path)
        .groupBy("year")
        .agg(
            F.count(F.lit(1)).alias("days"),
            F.sum("hourly_records").alias("lines"),
            F.count(F.when(F.col("btc_usd_avg").isNull(), 1)).alias("days_without_price"),
        )
    )


@query(
    "footer_counts",
    f"""WITH {READINGS}, r AS (
      SELECT source, date, count(*) AS rows, min(event_id) AS min_event_id, max(event_id) AS max_event_id, min(hour)::int AS min_hour,
        max(hour)::int AS max_hour, min(windspeed_kmh) AS min_windspeed_kmh, max(windspeed_kmh) AS max_windspeed_kmh
      FROM readings GROUP BY source, date),
    w AS (SELECT *, count(rows) OVER p AS points, avg(rows) OVER p AS mean, stddev_samp(rows) OVER p AS sd FROM r
      WINDOW p AS (PARTITION BY source ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
    SELECT source, date::varchar AS date, rows, min_event_id, max_event_id, min_hour, max_hour, min_windspeed_kmh, max_windspeed_kmh, points,
      {sql_rnd('CASE WHEN points >= 3 THEN abs(rows - mean) / CASE WHEN sd = 0 THEN 1 ELSE sd END END', 4)} AS z
    FROM w""",
)
def footers(spark, sf_dir):
    """Rows and extremes of each source and day of a layer, and whether its count is unusual, without reading a row."""
    path, extremes = scratch_dir(spark, "by-source"), ["event_id", "hour", "windspeed_kmh"]
    write_partitioned(partition_parts(readings(spark, sf_dir)), path, ["source", *PARTS])
    counts = footer_counts(spark, path, ["source", *PARTS], extremes)
    dated = counts.withColumn("date", F.make_date(*PARTS)).drop(*PARTS)
    judged = row_count_anomaly(dated, ["source"], ["date"], "rows")
    return judged.select("source", "date", "rows", *[f"{end}_{c}" for c in extremes for end in ("min", "max")], "points", rnd("z", 4).alias("z"))


@query(
    "retention_expired",
    f"""WITH {READINGS} SELECT date::varchar AS date, count(*) AS rows FROM readings
    WHERE date >= (SELECT max(date) FROM readings) - 10 GROUP BY date""",
)
def retention_expired(spark, sf_dir):
    """What is left of a layer once partitions of more than ten days before its newest are deleted."""
    path = cleaned_readings(spark, sf_dir)
    newest = readings(spark, sf_dir).agg(F.max("date")).head()[0]
    expire_partitions(spark, path, RetentionRule(3, 7, 10), newest)
    return read_layer(spark, path).groupBy("date").agg(F.count(F.lit(1)).alias("rows"))
