"""Incremental reading of new files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def ingest_new_files(
    spark: SparkSession,
    schema: T.StructType,
    source: str,
    target: str,
    checkpoint: str,
    fmt: str = "json",
    files_per_batch: int | None = None,
) -> None:
    """Append the files not seen before to ``target`` and stop.

    The checkpoint remembers the files taken, so a rerun adds nothing and a run that broke off goes on
    where it stopped. ``files_per_batch`` bounds the size of one batch after a long pause.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    append(reader.load(source), target, checkpoint)


def append(stream: DataFrame, target: str, checkpoint: str) -> None:
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(target)
    )
    query.awaitTermination()
