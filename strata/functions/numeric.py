"""Rounding and number-to-text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SNAP = "decimal(38,6)"


def rnd(col: Column | str, digits: int) -> Column:
    """Round half up after snapping to six decimals.

    A mean summed in another order differs in its last bit, which flips plain ``round`` at a tie.
    Snapping first makes the result independent of how Spark splits the sum. NaN, infinities and
    numbers too large to snap take the plain rounding.
    """
    x = F.col(col) if isinstance(col, str) else col
    x = x.cast("double")
    return F.coalesce(F.round(x.try_cast(SNAP), digits).cast("double"), F.round(x, digits))


def percent_text(rate: Column, digits: int) -> Column:
    """``0.0512`` as ``5.1%``."""
    return F.concat(F.round((rate * 100).cast(SNAP), digits).cast(f"decimal(38,{digits})").cast("string"), F.lit("%"))
