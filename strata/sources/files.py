"""Reading landed documents, CSV uploads, layer tables and file listings."""

from __future__ import annotations

import csv
import io

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.dates import folder_of
from strata.schemas import envelope
from strata.sources.csvtext import BLOCK, UPLOAD, lines_of, records, single_lines

DATE_COLUMNS = ("year", "month", "day")

#: Names of the files that `land_documents` writes.
LANDED_FILES = "part-*.txt*"


def read_envelopes(
    spark: SparkSession,
    base: str,
    dataset: str,
    date: str,
    payload_schema: T.StructType,
    multi_line: bool | None = None,
    pattern: str | None = None,
) -> DataFrame:
    """The documents landed for one dataset and execution date.

    The schema is given, so nothing is read to infer it. ``multi_line`` files hold one document each;
    with ``multi_line=False`` each line is one and Spark splits large files. By default both are read:
    files named ``pattern`` (``*.json``) of one document, and those that landing has written, of one to a
    line. A missing folder raises.
    """
    def read(whole: bool, names: str) -> DataFrame:
        return (
            spark.read.schema(envelope(payload_schema))
            .option("multiLine", whole)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt_record")
            .option("pathGlobFilter", names)
            .json(f"{base}/{dataset}/{folder_of(date)}")
        )

    if multi_line is None:
        return read(True, pattern or "*.json").unionByName(read(False, LANDED_FILES))
    return read(multi_line, pattern or "*.json")


def read_layer(
    spark: SparkSession,
    path: str,
    start: str | None = None,
    end: str | None = None,
    keep_partition_columns: bool = False,
) -> DataFrame:
    """A cleaned or curated table, cut to the dates ``start`` to ``end``.

    The bounds are compared to the partition columns alone, so Spark lists and opens only the
    folders inside them.
    """
    df = spark.read.parquet(path)
    by_parts = set(DATE_COLUMNS) <= set(df.columns)
    day = F.make_date(*[F.col(c).cast("int") for c in DATE_COLUMNS]) if by_parts else F.col("date")
    if start:
        df = df.filter(day >= F.lit(start).cast("date"))
    if end:
        df = df.filter(day <= F.lit(end).cast("date"))
    return df.drop(*DATE_COLUMNS) if by_parts and not keep_partition_columns else df


def read_csv_upload(
    spark: SparkSession, path: str, schema: T.StructType | str, multi_line: bool = False, corrupt: str | None = None
) -> DataFrame:
    """The columns of ``schema`` from CSV files, found by the names in the header, in whatever order.

    Columns the files have besides are left out, those they lack are null. The files below ``path``
    must have the same header, or reading raises. ``multi_line`` lets quoted values hold line breaks; large
    files are read by many tasks all the same, see `csvtext`. ``corrupt`` names a column for the text of
    records that do not fit: their unfit values are null.
    """
    declared = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    lines = lines_of(spark, path)
    found = (records(lines) if multi_line else single_lines(lines)).where("record <> ''")
    heads = found.where("first").select("record").distinct().limit(2).collect()
    if not heads:
        empty = spark.createDataFrame([], declared)
        return empty.withColumn(corrupt, F.lit(None).cast("string")) if corrupt else empty
    if len(heads) > 1:
        raise ValueError(f"files with different headers: {heads[0].record!r} and {heads[1].record!r}")
    names = next(csv.reader(io.StringIO(heads[0].record, newline=""), doublequote=True))
    types = {f.name: f.dataType for f in declared}
    read = T.StructType([T.StructField(n, types.get(n, T.StringType())) for n in names])
    options = {"escape": '"', "multiLine": "true", "mode": "PERMISSIVE"}
    if corrupt:
        read = read.add(corrupt, T.StringType())
        options["columnNameOfCorruptRecord"] = corrupt
    layout = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in read)
    parsed = found.where("NOT first").select(F.from_csv("record", layout, options).alias("row"))
    columns = [F.col(f"row.`{c}`").alias(c) if c in names else F.lit(None).cast(t).alias(c) for c, t in types.items()]
    return parsed.select(*columns, *([f"row.`{corrupt}`"] if corrupt else []))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists; nothing is listed."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def land_csv(spark: SparkSession, path: str, raw_base: str, name: str, date: str, stamp: str) -> DataFrame:
    """Copy an uploaded CSV file, or a folder of them, into the raw layer and give one status row.

    The text is not parsed, and its order kept: each block in which Spark reads a file becomes one file, in a
    folder ``upload=/block=`` named by its file and its place there, so that the blocks of an upload in
    order are the upload. Nothing is shuffled, and a large file is copied by many tasks. A last line
    without a line break gets one. An empty or missing path is no failure: the row then says ``skipped`` and why.
    """
    target, reason, size_kb = None, None, None
    if not path:
        reason = "no path provided"
    elif not path_exists(spark, path):
        reason = "file not found"
    else:
        target = f"{raw_base}/flat_files/{folder_of(date)}/{name}_{stamp}.csv"
        lines = lines_of(spark, path)
        upload, block = F.hex(F.xxhash64("file")).alias(UPLOAD), F.lpad(F.col("start").cast("string"), 18, "0").alias(BLOCK)
        ordered = lines.select("value", upload, block, "line").sortWithinPartitions(UPLOAD, BLOCK, "line")
        ordered.drop("line").write.mode("overwrite").option("lineSep", "\n").partitionBy(UPLOAD, BLOCK).text(target)
        size_kb = inventory_totals(file_inventory(spark, path)).head().bytes / 1024
    return spark.createDataFrame(
        [(name, "skipped" if reason else "success", target, reason, size_kb)],
        "source string, status string, uri string, reason string, size_kb double",
    )


def file_inventory(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Path, size and change time of the files below ``path``; their content is not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(path)
        .select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified_at"))
    )


def inventory_totals(files: DataFrame, *by: str) -> DataFrame:
    """File count, bytes and newest change per group."""
    return files.groupBy(*by).agg(
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
        F.max("modified_at").alias("newest"),
    )


def register(spark: SparkSession, name: str, path: str, merge: bool = True) -> DataFrame:
    """Make the files below ``path`` queryable as ``name``, with the columns of all of them."""
    df = spark.read.option("mergeSchema", merge).parquet(path)
    df.createOrReplaceTempView(name)
    return df
