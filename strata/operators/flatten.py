"""Parallel arrays to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_parallel(df: DataFrame, arrays: dict[str, str], keep: list[str | Column]) -> DataFrame:
    """One row per position of the arrays ``{column: path}``, beside the ``keep`` columns.

    Shorter arrays are padded with nulls. The array columns are addressed by their own names.
    """
    zipped = F.arrays_zip(*[F.col(path).alias(name) for name, path in arrays.items()])
    return df.select(*keep, F.inline(zipped))
