"""Parsing and splitting of dates and timestamps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOURLY_FORMAT = "yyyy-MM-dd'T'HH:mm"


def parse_ts(col: Column | str, fmt: str | None = None) -> Column:
    """Text to timestamp; text that does not fit gives null."""
    c = F.col(col) if isinstance(col, str) else col
    return F.try_to_timestamp(c, F.lit(fmt)) if fmt else F.try_to_timestamp(c)


def calendar_parts(df: DataFrame, ts: str) -> DataFrame:
    """Add ``date`` and ``hour`` of a timestamp column."""
    return df.withColumns({"date": F.to_date(ts), "hour": F.hour(ts)})


def partition_parts(df: DataFrame, date: str = "date") -> DataFrame:
    """Add the ``year``, ``month`` and ``day`` that the cleaned layer is partitioned by."""
    return df.withColumns({"year": F.year(date), "month": F.month(date), "day": F.dayofmonth(date)})


def date_path(col: Column | str) -> Column:
    """Date column as the folder ``yyyy/MM/dd`` of the raw layer."""
    return F.date_format(col, "yyyy/MM/dd")


def folder_of(date: str | dt.date) -> str:
    """One execution date as the folder ``yyyy/MM/dd`` of the raw layer."""
    return (date if isinstance(date, dt.date) else dt.date.fromisoformat(date)).strftime("%Y/%m/%d")
