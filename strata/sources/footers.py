"""Row counts and extremes of Parquet tables from the footers of their files; no rows are read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Settings under which Spark answers such aggregates from footers.
SETTINGS = {"spark.sql.parquet.aggregatePushdown": "true", "spark.sql.sources.useV1SourceList": ""}


def footer_counts(spark: SparkSession, path: str, by: list[str], extremes: list[str] = ()) -> DataFrame:
    """``by``, ``rows``, and ``min_`` and ``max_`` of each column of ``extremes``, for partition columns ``by``.

    ``extremes`` may be numbers, booleans and dates, for which footers hold them. Partitions without files
    have no row. The frame belongs to a session of its own that has the settings this needs.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    for key, value in SETTINGS.items():
        own.conf.set(key, value)
    table = own.read.parquet(path)
    wanted = [F.min(c).alias(f"min_{c}") for c in extremes] + [F.max(c).alias(f"max_{c}") for c in extremes]
    return table.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), *wanted)
