"""The newest rows of every series, kept from run to run so that a rebuild need not read history.

A run leaves, in a folder named by the last day it has seen, the newest rows of each series up to that day, as
many as the widest window looks back over. A rebuild from a day takes the newest such tail before that
day, and of the table only the days between the two, most often none. Tails hold what the table held when
they were written: whoever changes a day makes those of that day and later invalid, which `forget_tails` does.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.clean import first_n
from strata.session import delete_path
from strata.sinks.publish import children, exists
from strata.sources.files import read_layer

UP_TO = "up_to="


def tail_days(spark: SparkSession, path: str) -> dict[str, str]:
    """The folders of whole tails by the day they reach."""
    found = {at.rsplit(UP_TO, 1)[1]: at for at in children(spark, path) if UP_TO in at}
    return {day: at for day, at in found.items() if exists(spark, f"{at}/_SUCCESS")}


def newest(df: DataFrame, by: list[str], order: list[str], n: int) -> DataFrame:
    """The newest ``n`` rows of each series, limited per task before the shuffle."""
    return first_n(df, by, [F.desc(c) for c in order], n)


def rows_before(spark: SparkSession, layer: str, tails: str, by: list[str], order: list[str], n: int, start: str) -> DataFrame:
    """The newest ``n`` rows of each series before the day ``start``, as the windows of later rows need.

    Read from the newest tail that ends before ``start``, and from the partitions of the cleaned table
    ``layer`` after it; without a tail from all partitions before ``start``.
    """
    last = (dt.date.fromisoformat(start) - dt.timedelta(1)).isoformat()
    days = [day for day in tail_days(spark, tails) if day <= last]
    if not days:
        return newest(read_layer(spark, layer, end=last), by, order, n)
    day = max(days)
    tail = spark.read.parquet(f"{tails}/{UP_TO}{day}")
    if day == last:
        return tail
    after = (dt.date.fromisoformat(day) + dt.timedelta(1)).isoformat()
    return newest(tail.unionByName(read_layer(spark, layer, after, last), allowMissingColumns=True), by, order, n)


def leave_tail(series: DataFrame, tails: str, by: list[str], order: list[str], n: int, start: str | None) -> None:
    """Keep the newest ``n`` rows of each series of ``series``, which holds those of a run and before it.

    Older tails that reach ``start`` or later, all of them without it, are replaced.
    """
    spark = series.sparkSession
    for day, at in tail_days(spark, tails).items():
        if start is None or day >= start:
            delete_path(spark, at)
    last = series.agg(F.max("date")).head()[0]
    if last is not None:
        newest(series, by, order, n).write.mode("overwrite").parquet(f"{tails}/{UP_TO}{last.isoformat()}")


def forget_tails(spark: SparkSession, tails: str, partitions: list[str]) -> None:
    """Remove the tails that partitions (``year=/month=/day=`` folders) written anew may have made wrong."""
    changed = [re.findall(r"=(\d+)", p) for p in partitions]
    days = [dt.date(*map(int, parts)).isoformat() for parts in changed if len(parts) == 3]
    for day, at in tail_days(spark, tails).items():
        if days and day >= min(days):
            delete_path(spark, at)
