"""The daily summary: hourly readings and prices joined per day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.checks import Suite
from strata.operators.rollup import Spec, daily_rollup, daily_summary
from strata.plans import price

# The columns of the daily roll-up and their decimals.
DAILY: Spec = {
    "avg_temp_c": ("avg", "temperature_c", 2),
    "max_temp_c": ("max", "temperature_c", 2),
    "min_temp_c": ("min", "temperature_c", 2),
    "stddev_temp_c": ("stddev", "temperature_c", 4),
    "total_precip_mm": ("sum", "precipitation_mm", 3),
    "avg_windspeed_kmh": ("avg", "windspeed_kmh", 2),
    "max_windspeed_kmh": ("max", "windspeed_kmh", None),
}


def daily_hourly(df: DataFrame, keys: list[str] = ("date",)) -> DataFrame:
    return daily_rollup(df, list(keys), DAILY, count_as="hourly_records")


def build(hourly: DataFrame, prices: DataFrame, processed_at: dt.datetime) -> DataFrame:
    """Days with readings, with that day's prices where there are any."""
    return daily_summary(daily_hourly(hourly), price.daily(prices), ["date"], processed_at)


def suite() -> Suite:
    # The published checks of the daily summary.
    def max_reaches_min(df: DataFrame):
        highest = F.col("max_temp_c") if "max_temp_c" in df.columns else F.lit(0.0)
        lowest = F.col("min_temp_c") if "min_temp_c" in df.columns else F.lit(0.0)
        return highest >= lowest

    return (
        Suite("daily_summary_validation")
        .not_empty()
        .if_any_rows()
        .required(["date", "avg_temp_c", "max_temp_c", "min_temp_c", "total_precip_mm", "btc_usd_avg"])
        .null_rate("avg_temp_c")
        .custom("max_temp_gte_min_temp", max_reaches_min, "max_temp_c >= min_temp_c for all records")
    )
