"""Sets of whole numbers as pages of bits, which tasks look keys up in without a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a page, as Spark's bitmap aggregate makes it; 4 KB.
PAGE_BITS = 1 << 15

#: Most bits of a set that is sent to all tasks; 16 MB.
LARGEST = 1 << 27


def page_of(at: Column) -> Column:
    return F.floor(at / F.lit(PAGE_BITS)).cast("bigint")


def place_of(at: Column) -> Column:
    return F.pmod(at, F.lit(PAGE_BITS)).cast("bigint")


def bit_pages(positions: DataFrame, at: Column) -> DataFrame:
    """(_page, _bits): the pages of the bits at ``at``, from 0 on, one row for each page with any."""
    placed = positions.select(page_of(at).alias("_page"), place_of(at).alias("_place"))
    return placed.groupBy("_page").agg(F.bitmap_construct_agg("_place").alias("_bits"))


def bit_set(bits: Column, place: Column) -> Column:
    """Whether a page has the bit at ``place``."""
    byte = F.substring(bits, (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))
    return F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), F.pmod(place, F.lit(8)).cast("int")) == 1
