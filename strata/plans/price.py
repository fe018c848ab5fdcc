"""The price feed: raw documents to cleaned rates to rolling statistics."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.dates import parse_ts
from strata.functions.jsondoc import extract_typed
from strata.operators.checks import Suite
from strata.operators.clean import dedup_latest, enforce_schema, positive
from strata.operators.rollup import AGGREGATES, Spec, daily_rollup, rounded
from strata.operators.series import bands, change_pct, look_back
from strata.schemas import PRICE_CLEANED

KEYS = ["date", "currency"]
FIELDS = {
    "rate_usd": ("data.bpi.USD.rate_float", "double"),
    "rate_gbp": ("data.bpi.GBP.rate_float", "double"),
    "rate_eur": ("data.bpi.EUR.rate_float", "double"),
    "description": ("data.bpi.USD.description", "string"),
}
# The asset of the feed and the statistics kept per day and per week.
CURRENCY = "BTC"
WEEK_ROWS = 7

#: Rows before a row that its widest window takes in.
LOOK_BACK = WEEK_ROWS - 1
DAILY: Spec = {
    "btc_usd_avg": ("avg", "rate_usd", 2),
    "btc_usd_high": ("max", "rate_usd", 2),
    "btc_usd_low": ("min", "rate_usd", 2),
    "btc_gbp_avg": ("avg", "rate_gbp", 2),
    "btc_eur_avg": ("avg", "rate_eur", 2),
}
WEEKLY: Spec = {"rate_usd_7d_avg": ("avg", "rate_usd", 2), "rate_usd_7d_stddev": ("stddev", "rate_usd", 4)}


def payload_rows() -> Column:
    """One rate of an envelope; null if it has none."""
    return F.when(F.col("data.bpi.USD.rate_float").isNotNull(), 1)


def typed(envelopes: DataFrame) -> DataFrame:
    rates = extract_typed(envelopes, FIELDS)
    day = F.col("execution_date").try_cast("date")
    return rates.select(
        day.alias("date"),
        F.lit(CURRENCY).alias("currency"),
        *FIELDS,
        parse_ts("ingested_at").alias("ingested_at"),
        day.alias("execution_date"),
    )


def newest_first() -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in ["ingested_at", *FIELDS]]


def clean(envelopes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One rate per day and currency, the newest landed; and the rows rejected for want of a date."""
    good, rejected = enforce_schema(typed(envelopes), PRICE_CLEANED)
    return dedup_latest(positive(good, "rate_usd"), KEYS, newest_first()), rejected


def daily(df: DataFrame, keys: list[str] = ("date",)) -> DataFrame:
    return daily_rollup(df, list(keys), DAILY)


def stats(df: DataFrame, processed_at: dt.datetime, by: list[str] = ("currency",)) -> DataFrame:
    """Seven-row mean and deviation, change to the row before, and bands of two deviations.

    The series is cut at years, so one currency with very many rows spans many tasks.
    """
    exprs = {
        alias: (lambda w, s=spec: rounded(AGGREGATES[s[0]](s[1]).over(w.rowsBetween(1 - WEEK_ROWS, 0)), s[2]))
        for alias, spec in WEEKLY.items()
    }
    exprs["price_change_pct"] = change_pct("rate_usd", 4)
    out = look_back(df, list(by), ["date"], LOOK_BACK, exprs, chunk=F.trunc("date", "year"))
    out = bands(
        out, "rate_usd_7d_avg", "rate_usd_7d_stddev", 2, 2, "volatility_band_upper", "volatility_band_lower"
    )
    return out.withColumn("processed_at", F.lit(processed_at))


def suite() -> Suite:
    # The published checks of the price feed.
    return (
        Suite("crypto_validation")
        .not_empty()
        .min_count(1)
        .if_any_rows()
        .required(["date", "currency", "rate_usd", "rate_gbp", "rate_eur"])
        .null_rate("rate_usd", 0.0)
        .value_range("rate_usd", 1, 10000000)
        .value_range("rate_gbp", 1, 10000000)
        .unique(["date", "currency"])
    )
