"""The hourly feed: raw documents to cleaned rows to rolling means."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.dates import HOURLY_FORMAT, calendar_parts, parse_ts
from strata.functions.numeric import rnd
from strata.operators.checks import Suite
from strata.operators.clean import dedup_latest, enforce_schema, exact_quantiles, impute, range_filter
from strata.operators.flatten import explode_parallel
from strata.operators.series import flags, rolling
from strata.schemas import HOURLY_CLEANED
from strata.session import stage

KEYS = ["date", "hour", "source"]
ARRAYS = {
    "time_str": "data.hourly.time",
    "temperature_c": "data.hourly.temperature_2m",
    "precipitation_mm": "data.hourly.precipitation",
    "windspeed_kmh": "data.hourly.windspeed_10m",
}

# Accepted ranges, decimals, fill values and heat-index terms of the hourly feed.
RANGES = {"temperature_c": (-89, 57), "windspeed_kmh": (0, None), "precipitation_mm": (0, None)}
DECIMALS = {"temperature_c": 2, "precipitation_mm": 3, "windspeed_kmh": 2}
DEFAULTS = {"temperature_c": 15.0, "precipitation_mm": 0.0, "windspeed_kmh": 10.0}
MEDIAN_FILLED = ["temperature_c", "windspeed_kmh"]
HUMIDITY_TERM, WIND_TERM, KMH_PER_MS, OFFSET = 0.33 * 40, 0.7, 3.6, 4.0
WINDY_KMH = 30

#: Rows before a row that its widest window takes in.
LOOK_BACK = 23


def payload_rows() -> Column:
    """Readings of an envelope; null if it has none or its lists differ in length."""
    n = F.size("data.hourly.time")
    alike = F.forall(F.array(*[F.size(path) for path in ARRAYS.values()]), lambda size: size.eqNullSafe(n))
    return F.when((n > 0) & alike, n)


def flatten(envelopes: DataFrame) -> DataFrame:
    """One row per document and array position, as landed."""
    return explode_parallel(envelopes, ARRAYS, ["source", "ingested_at", "execution_date"])


def typed(rows: DataFrame) -> DataFrame:
    """Parse times and round the readings; an unreadable time gives a null date and hour."""
    rows = rows.withColumns(
        {
            "_at": parse_ts("time_str", HOURLY_FORMAT),
            "ingested_at": parse_ts("ingested_at"),
            "execution_date": F.col("execution_date").try_cast("date"),
            **{c: rnd(c, digits) for c, digits in DECIMALS.items()},
        }
    )
    return calendar_parts(rows, "_at").drop("_at", "time_str")


def newest_first() -> list[Column]:
    readings = ["temperature_c", "precipitation_mm", "windspeed_kmh"]
    return [F.col(c).desc_nulls_last() for c in ["ingested_at", *readings, "execution_date"]]


def clean(envelopes: DataFrame, null_policy: str = "drop") -> tuple[DataFrame, DataFrame]:
    """Cleaned hourly rows, and the rows rejected for want of a date or hour.

    ``null_policy="drop"`` removes rows lacking a reading; ``"keep"`` fills them with the column's
    median, or with 0 for the precipitation.
    """
    good, rejected = enforce_schema(typed(flatten(envelopes)), HOURLY_CLEANED)
    kept = dedup_latest(range_filter(good, RANGES, null_policy), KEYS, newest_first())
    if null_policy == "keep":
        kept = stage(kept, "deduplicated")  # the medians read it twice before it is filled
        kept = impute(kept, DEFAULTS, exact_quantiles(kept, MEDIAN_FILLED))
    return kept, rejected


def heat_index(temperature: str = "temperature_c", wind: str = "windspeed_kmh") -> Column:
    return rnd(F.col(temperature) + HUMIDITY_TERM - WIND_TERM * F.col(wind) / KMH_PER_MS - OFFSET, 2)


def weather_flags(df: DataFrame) -> DataFrame:
    tests = {"is_rainy": F.col("precipitation_mm") > 0, "is_windy": F.col("windspeed_kmh") > WINDY_KMH}
    return flags(df.withColumn("heat_index_c", heat_index()), tests)


def enriched(df: DataFrame, processed_at: dt.datetime, by: list[str] = ("source",)) -> DataFrame:
    """Six-row means within each day, 24-row means across days, heat index and flags.

    The series across days is cut at months, so a source with very many rows spans many tasks.
    """
    by = list(by)
    within_day = {"temp_6h_rolling_avg": ("avg", "temperature_c", 2), "wind_6h_rolling_avg": ("avg", "windspeed_kmh", 2)}
    across_days = {"temp_24h_rolling_avg": ("avg", "temperature_c", 2)}
    out = rolling(df, [*by, "date"], ["hour"], 6, within_day)
    out = rolling(out, by, ["date", "hour"], LOOK_BACK + 1, across_days, chunk=F.trunc("date", "month"))
    return weather_flags(out).withColumn("processed_at", F.lit(processed_at))


def suite(keys: list[str] = ("date", "hour"), least: int = 24) -> Suite:
    # The published checks of the hourly feed.
    return (
        Suite("weather_validation")
        .not_empty()
        .min_count(least)
        .if_any_rows()
        .required(["date", "hour", "temperature_c", "precipitation_mm", "windspeed_kmh"])
        .null_rate("temperature_c")
        .null_rate("precipitation_mm")
        .value_range("temperature_c", -89, 57)
        .value_range("hour", 0, 23)
        .value_range("precipitation_mm", 0, 2000)
        .unique(list(keys))
    )
