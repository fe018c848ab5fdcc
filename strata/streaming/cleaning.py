"""Cleaning of newly landed documents, each exactly once.

A file stream remembers which landed files it has taken. Every batch of new files is cleaned, merged with the
rows that the cleaned partitions it falls in already hold, checked, and published partition by
partition; then the batch's number is recorded with the partitions it replaced. Spark hands out a batch
again, with the same number and files, until its run has ended well. A batch whose record exists is
passed over; one that broke off before it is merged again, and as a merge keeps one row of each key by a
total order, rows that had been published already neither double nor get lost.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.dates import partition_parts
from strata.operators.clean import dedup_latest
from strata.plans.layers import FEEDS, PARTS, Feed, keep_rejected, publish_cleaned
from strata.schemas import envelope
from strata.session import stage, unstage
from strata.sinks.publish import Outcome, children, exists, get_text, put_text, recover
from strata.sources.files import LANDED_FILES, path_exists

Commit = Callable[[SparkSession, str, dict], None]


def ingest_path(base: str, dataset: str) -> str:
    """Where the stream's checkpoint and the records of its batches lie, together."""
    return f"{base}/_ingest/{dataset}"


def record_batch(spark: SparkSession, path: str, record: dict) -> None:
    put_text(spark, path, json.dumps(record))


def committed(spark: SparkSession, base: str, dataset: str) -> list[dict]:
    """The records of the batches that ended well, in order: number, status, partitions and counts."""
    records = children(spark, f"{ingest_path(base, dataset)}/batches")
    return sorted((json.loads(get_text(spark, at)) for at in records if at.endswith(".json")), key=lambda r: r["batch"])


def new_documents(
    spark: SparkSession, base: str, feed: Feed, multi_line: bool | None, pattern: str | None, files_per_batch: int | None
) -> DataFrame:
    """The landed documents of all dates as a stream, told apart as `read_envelopes` does."""

    def read(whole: bool, names: str) -> DataFrame:
        reader = (
            spark.readStream.schema(envelope(feed.payload))
            .option("multiLine", whole)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt_record")
            .option("pathGlobFilter", names)
            .option("recursiveFileLookup", True)
        )
        if files_per_batch:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        return reader.json(f"{base}/raw/{feed.dataset}")

    if multi_line is None:
        return read(True, pattern or "*.json").unionByName(read(False, LANDED_FILES))
    return read(multi_line, pattern or "*.json")


def held_rows(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame | None:
    """What the cleaned table holds in the partitions that ``rows`` fall in; other folders are not opened."""
    if not path_exists(spark, path):
        return None
    days = [r.date for r in rows.select("date").distinct().collect()]
    part = F.make_date(*[F.col(c).cast("int") for c in PARTS])
    held = spark.read.schema(partition_parts(rows).schema).parquet(path)
    return held.filter(part.isin(days)).drop(*PARTS)


def clean_batch(batch: DataFrame, number: int, base: str, feed: Feed, null_policy: str, on_failure: str) -> tuple[Outcome, dict[str, int]]:
    """Clean one batch of documents into the table; the same batch again changes nothing."""
    spark = batch.sparkSession
    path = f"{base}/cleaned/{feed.dataset}"
    recover(spark, path)
    raw = stage(batch, "parsed")
    good, rejected = feed.clean(raw, null_policy)
    counts = keep_rejected(raw, rejected, f"{base}/rejected/{feed.dataset}", f"batch={number}")
    fresh = stage(good, "fresh")
    held = held_rows(spark, path, fresh)
    merged = fresh if held is None else dedup_latest(fresh.unionByName(held), feed.keys, feed.newest())
    outcome = publish_cleaned(merged, base, feed, on_failure)
    unstage(raw, fresh)
    return outcome, counts


def clean_new_files(
    spark: SparkSession,
    base: str,
    dataset: str,
    null_policy: str = "drop",
    multi_line: bool | None = None,
    pattern: str | None = None,
    files_per_batch: int | None = None,
    on_failure: str = "raise",
    commit: Commit = record_batch,
) -> list[dict]:
    """Clean the documents of ``dataset`` that landed since the last run, and stop; gives the new records.

    Batches hold at most ``files_per_batch`` files of a kind. A batch that fails the suite raises, and is tried
    again by the next run; with ``on_failure="quarantine"`` its partitions are put aside, which its record
    says, and later batches go on. ``null_policy="keep"`` fills nulls with the medians of the batch. A
    dataset of which nothing has landed yet gives no records. ``commit`` writes a record.
    """
    feed = FEEDS[dataset]
    if not path_exists(spark, f"{base}/raw/{dataset}"):
        return []
    before = len(committed(spark, base, dataset))
    state = ingest_path(base, dataset)

    def take(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        record = f"{state}/batches/{number:09d}.json"
        if exists(session, record):
            return
        outcome, counts = clean_batch(batch, number, base, feed, null_policy, on_failure)
        told = {"batch": number, "status": outcome.status, "path": outcome.path, "partitions": outcome.partitions}
        commit(session, record, told | counts)

    query = (
        new_documents(spark, base, feed, multi_line, pattern, files_per_batch)
        .writeStream.foreachBatch(take)
        .option("checkpointLocation", f"{state}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return committed(spark, base, dataset)[before:]
