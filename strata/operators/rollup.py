"""Daily roll-ups and the join of two of them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.numeric import rnd
from strata.params import OUTPUT_VERSION

AGGREGATES: dict[str, Callable[[str], Column]] = {
    "avg": F.avg,
    "max": F.max,
    "min": F.min,
    "sum": F.sum,
    "stddev": F.stddev_samp,
}
# alias -> (aggregate, column, decimals or None for no rounding)
Spec = dict[str, tuple[str, str, int | None]]


def rounded(col: Column, digits: int | None) -> Column:
    return col if digits is None else rnd(col, digits)


def daily_rollup(df: DataFrame, keys: list[str], specs: Spec, count_as: str | None = None) -> DataFrame:
    """One row per key with the aggregates of ``specs``; partly aggregated before the shuffle."""
    aggs = [rounded(AGGREGATES[fn](col), digits).alias(alias) for alias, (fn, col, digits) in specs.items()]
    if count_as:
        aggs.append(F.count(F.lit(1)).alias(count_as))
    return df.groupBy(*keys).agg(*aggs)


def daily_summary(
    left: DataFrame, right: DataFrame, on: list[str], processed_at: dt.datetime, version: str = OUTPUT_VERSION
) -> DataFrame:
    """All rows of ``left`` with the columns of ``right`` where its key exists, sorted by key."""
    return (
        left.join(right, on, "left")
        .withColumns({"processed_at": F.lit(processed_at), "pipeline_version": F.lit(version)})
        .orderBy(*on)
    )
