"""Records of CSV text found in parallel, also where quoted values hold line breaks.

A line begins a record if the quotes before it in its file are even in number. Files are read as lines, in as many
blocks as Spark splits them; each block counts its quotes, a running sum over a file's blocks tells
with which parity a block begins, and every line then knows whether it begins a record. Lines of one record
are put together by the place of its beginning, also across blocks; all others stay where they are.

This asks for files as RFC 4180 has them: a quote inside a value is doubled and the value quoted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Folder names that landing gives to an upload and to its blocks.
UPLOAD, BLOCK = "upload", "block"

FILE = ["file", "part", "start"]


def lines_of(spark: SparkSession, path: str) -> DataFrame:
    """(file, part, start, line, value): the lines of the files below ``path``, in blocks (part, start).

    The blocks of a landed upload are one file, in order of their ``part``. ``line`` rises within a block.
    """
    at = F.col("_metadata.file_path")
    upload = F.regexp_extract(at, f"^(.*/{UPLOAD}=[^/]*)/{BLOCK}=[0-9]+/", 1)
    part = F.regexp_extract(at, f"/{UPLOAD}=[^/]*/{BLOCK}=([0-9]+)/", 1).try_cast("bigint")
    return (
        spark.read.option("lineSep", "\n")
        .option("recursiveFileLookup", True)
        .text(path)
        .select(
            F.when(upload != "", upload).otherwise(at).alias("file"),
            F.coalesce(part, F.lit(0)).alias("part"),
            F.col("_metadata.file_block_start").alias("start"),
            F.monotonically_increasing_id().alias("line"),
            "value",
        )
    )


def records(lines: DataFrame) -> DataFrame:
    """(file, first, record): the records of the lines; ``first`` marks that of the header.

    A record whose quotes never close goes on to the end of its file.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    upto = Window.partitionBy(*FILE).orderBy("line")
    counted = lines.withColumn("odd", quotes % 2 == 1)
    before = F.coalesce(F.sum(F.col("odd").cast("long")).over(upto.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counted = counted.withColumn("even_here", before % 2 == 0)
    # The records that begin up to a line if the block itself begins outside (or inside) quotes.
    outside = F.count_if("even_here").over(upto)
    inside = F.count_if(~F.col("even_here")).over(upto)
    counted = counted.withColumns({"outside": outside, "inside": inside})

    blocks = counted.groupBy(*FILE).agg(
        F.count_if("odd").alias("odds"), F.max("outside").alias("outside"), F.max("inside").alias("inside")
    )
    along = Window.partitionBy("file").orderBy("part", "start")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("within", F.coalesce(F.sum("odds").over(earlier), F.lit(0)) % 2 == 1)
    begun = F.when(F.col("within"), F.col("inside")).otherwise(F.col("outside"))
    last = F.when(begun > 0, F.struct("part", "start", begun.alias("nth")))
    blocks = blocks.withColumn("open", F.last(last, ignorenulls=True).over(earlier)).select(*FILE, "within", "open")

    known = counted.join(blocks, FILE)
    begins = F.col("even_here") != F.col("within")
    nth = F.when(F.col("within"), F.col("inside")).otherwise(F.col("outside"))
    # A line before the first beginning of its block belongs to the record that an earlier block left open.
    owner = F.when(nth > 0, F.struct("part", "start", nth.alias("nth"))).otherwise(F.col("open"))
    placed = known.select(*FILE, "line", "value", owner.alias("owner"), (begins & ~F.col("odd")).alias("whole"))
    header = (F.col("owner.part") == 0) & (F.col("owner.start") == 0) & (F.col("owner.nth") == 1)
    alone = placed.where("whole").select("file", header.alias("first"), F.col("value").alias("record"))
    pieces = F.sort_array(F.collect_list(F.struct("part", "start", "line", "value")))
    joined = placed.where("NOT whole").groupBy("file", "owner").agg(F.array_join(F.transform(pieces, lambda p: p["value"]), "\n").alias("record"))
    found = alone.unionByName(joined.select("file", header.alias("first"), "record"))
    return found.select("file", "first", F.regexp_replace("record", "\r$", "").alias("record"))


def single_lines(lines: DataFrame) -> DataFrame:
    """(file, first, record) where every line is a record, whatever its quotes."""
    heads = lines.where("part = 0 AND start = 0").groupBy("file").agg(F.min("line").alias("head"))
    known = lines.join(heads, "file", "left")
    first = F.coalesce(F.col("line") == F.col("head"), F.lit(False))
    return known.select("file", first.alias("first"), F.regexp_replace("value", "\r$", "").alias("record"))
