"""Landing of fetched documents in the raw layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.dates import folder_of
from strata.functions.jsondoc import wrap_envelope
from strata.operators.monitor import points
from strata.session import stage, unstage


def land_documents(
    df: DataFrame,
    payload: str,
    source: Column,
    base: str,
    dataset: str,
    date: str,
    ingested_at: Column,
    compress: bool = True,
    per_file: int = 20_000,
) -> DataFrame:
    """Write the documents of a run to the raw layer, one envelope per line, and give their statuses.

    One row per source and status (``success``, ``failed``) with the number of documents and of
    records. A document that is not JSON is counted as failed and kept under ``rejected`` with its
    source instead. A file holds at most ``per_file`` documents, as a compressed one is read by a
    single task.
    """
    wrapped = wrap_envelope(df, payload, source, F.lit(date), ingested_at)
    failed = F.col("status") == "failed"
    kept = F.when(failed, F.col(payload)).alias("payload")
    wrapped = stage(wrapped.select(source.alias("source"), "status", "record_count", "envelope", kept), "landing")
    writer = wrapped.filter(~failed).select("envelope").write.mode("append").option("maxRecordsPerFile", per_file)
    if compress:
        writer = writer.option("compression", "gzip")
    writer.text(f"{base}/raw/{dataset}/{folder_of(date)}")
    refused = wrapped.filter(failed).select("source", "payload")
    refused.write.mode("append").parquet(f"{base}/rejected/{dataset}/refused/{folder_of(date)}")
    counted = wrapped.groupBy("source", "status").agg(
        F.count(F.lit(1)).alias("documents"), F.coalesce(F.sum("record_count"), F.lit(0)).alias("records")
    )
    counted = stage(counted, "landing-statuses")
    unstage(wrapped)
    return counted


def landing_metrics(statuses: DataFrame, date: str, ts: Column) -> DataFrame:
    """Records ingested and errors met, as metric points."""
    ok = F.col("status") == "success"
    name = F.when(ok, "RecordsIngested").otherwise("IngestionErrors")
    value = F.when(ok, F.col("records")).otherwise(F.col("documents"))
    dims = {"Pipeline": F.lit("Ingestion"), "Source": F.col("source"), "ExecutionDate": F.lit(date)}
    return points(statuses, name, value, F.lit("Count"), dims, ts)
