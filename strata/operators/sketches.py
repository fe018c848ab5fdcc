"""Quantiles from stored sketches, so that no row is read twice.

A sketch of a column is some kilobytes, whatever the number of values it has seen, and sketches of parts merge
to that of the whole. Each partition of a table keeps one for each group; medians of days, months or all
groups come from merging them. While a group has at most ``ACCURACY`` values its quantiles are exact;
beyond it their rank is off by about ``2.3 / ACCURACY ** 0.9`` of the values at most, 99 times in 100.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.sinks.tables import write_partitioned

#: Size of a sketch: the values it holds before it begins to thin them out.
ACCURACY = 4096


def sketches(df: DataFrame, by: list[str], cols: list[str], accuracy: int = ACCURACY) -> DataFrame:
    """``by``, ``column``, ``sketch``: one row per group and column; nulls are not counted.

    A group without any value has a sketch of none, whose quantiles are null.
    """
    values = F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("_v")) for c in cols]))
    return df.select(*by, values).groupBy(*by, "column").agg(F.kll_sketch_agg_double("_v", accuracy).alias("sketch"))


def keep_sketches(df: DataFrame, path: str, by: list[str], cols: list[str], date: str = "date", accuracy: int = ACCURACY) -> None:
    """Store the sketches of the days that ``df`` holds, in place of those days' older ones."""
    write_partitioned(sketches(df, [date, *by], cols, accuracy), path, [date])


def merged(stored: DataFrame, by: list[str]) -> DataFrame:
    """The stored sketches put together to one per group of ``by`` and column."""
    return stored.groupBy(*by, "column").agg(F.kll_merge_agg_double("sketch").alias("sketch"))


def quantiles(stored: DataFrame, by: list[str], q: float = 0.5) -> DataFrame:
    """``by``, ``column``, ``n``, ``value``: count and quantile of each group, merged from stored sketches."""
    n = F.kll_sketch_get_n_double("sketch")
    value = F.when(n > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(float(q))))
    return merged(stored, by).select(*by, "column", n.alias("n"), value.alias("value"))
