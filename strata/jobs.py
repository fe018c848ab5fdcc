"""Command line of the daily jobs: ``python -m strata.jobs raw-to-cleaned --base /lake --date 2024-01-05``."""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from strata.operators.checks import null_log_line
from strata.operators.monitor import points
from strata.plans.landing import land_documents, landing_metrics
from strata.plans.layers import PAYLOADS, cleaned_to_curated, raw_to_cleaned, run_validation
from strata.session import build_session
from strata.sinks.tables import emit_metrics
from strata.sources.files import land_csv, read_layer
from strata.streaming.cleaning import clean_new_files


def land(spark: SparkSession, args: argparse.Namespace, now: dt.datetime) -> None:
    """Lands the documents, one to a file or with ``--json-lines`` one to a line, and their metric points."""
    documents = spark.read.text(args.input, wholetext=not args.json_lines)
    stamp = F.lit(now.isoformat(timespec="seconds"))
    statuses = land_documents(documents, "value", F.lit(args.source), args.base, args.dataset, args.date, stamp)
    emit_metrics(landing_metrics(statuses, args.date, F.lit(now)), f"{args.base}/metrics")
    statuses.show(truncate=False)


def emit(spark: SparkSession, args: argparse.Namespace, values: dict[str, tuple[float, str]], now: dt.datetime) -> None:
    """Metric points of this run of a job: ``{name: (value, unit)}``."""
    rows = spark.createDataFrame([(name, float(value), unit) for name, (value, unit) in values.items()], "name string, value double, unit string")
    dims = {"Pipeline": F.lit(args.job), "ExecutionDate": F.lit(args.date)}
    emit_metrics(points(rows, F.col("name"), F.col("value"), F.col("unit"), dims, F.lit(now)), f"{args.base}/metrics")


def log_nulls(spark: SparkSession, args: argparse.Namespace, layer: str, datasets: list[str], prefix: str, now: dt.datetime) -> None:
    """One log line per dataset on the nulls of the rows of the date."""
    for dataset in datasets:
        rows = read_layer(spark, f"{args.base}/{layer}/{dataset}", args.date, args.date)
        print(null_log_line(rows, dataset, now.isoformat(timespec="seconds"), prefix).head().message)


def run(spark: SparkSession, args: argparse.Namespace, now: dt.datetime) -> int:
    lines = False if args.json_lines else None
    if args.job == "land":
        land(spark, args, now)
    elif args.job == "land-csv":
        land_csv(spark, args.input, f"{args.base}/raw", args.dataset, args.date, now.strftime("%Y%m%dT%H%M%SZ")).show(truncate=False)
    elif args.job == "raw-to-cleaned" and args.incremental:
        for dataset in PAYLOADS:
            for record in clean_new_files(spark, args.base, dataset, args.null_policy, lines, args.pattern, args.files_per_batch, args.on_failure):
                print(dataset, record)
    elif args.job == "raw-to-cleaned":
        print(raw_to_cleaned(spark, args.base, args.date, args.null_policy, lines, args.pattern, args.on_failure))
        log_nulls(spark, args, "cleaned", list(PAYLOADS), "DQ_METRICS", now)
    elif args.job == "cleaned-to-curated":
        cleaned_to_curated(spark, args.base, now, None if args.all_dates else args.date, args.on_failure)
        log_nulls(spark, args, "curated", ["daily_summary"], "CURATED_METRICS", now)
    else:
        status = run_validation(spark, args.base, args.layer, args.date, now, multi_line=lines, pattern=args.pattern)
        print(status)
        return 0 if status == "PASS" else 1
    return 0


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("job", choices=["land", "land-csv", "raw-to-cleaned", "cleaned-to-curated", "validate"])
    parser.add_argument("--base", required=True, help="folder of the layers")
    parser.add_argument("--date", required=True, help="execution date, yyyy-mm-dd; curated tables are rebuilt from it on")
    parser.add_argument("--all-dates", action="store_true", help="rebuild the curated tables of all dates")
    parser.add_argument("--input", default="", help="files to land")
    parser.add_argument("--dataset", default="weather", help="dataset, or name of the upload, to land")
    parser.add_argument("--source", default="files", help="source named in landed documents")
    parser.add_argument("--layer", default="raw", choices=["raw", "cleaned", "curated"])
    parser.add_argument("--null-policy", default="drop", choices=["drop", "keep"])
    parser.add_argument("--incremental", action="store_true", help="clean the documents of all dates that landed since the last run")
    parser.add_argument("--files-per-batch", type=int, help="most files of a kind in a batch of incremental cleaning")
    parser.add_argument("--on-failure", default="raise", choices=["raise", "quarantine"], help="what becomes of a table that fails its suite")
    parser.add_argument("--json-lines", action="store_true", help="raw files hold one document per line")
    parser.add_argument("--pattern", help="names of the raw files; landed lines and *.json if not given")
    args = parser.parse_args(argv)
    spark = build_session(args.job)
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    try:
        code = run(spark, args, now)
    except Exception:
        emit(spark, args, {"PipelineFailure": (1, "Count")}, now)
        raise
    seconds = (dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) - now).total_seconds()
    done = {"PipelineSuccess": (1, "Count"), "PipelineDurationSeconds": (seconds, "Seconds")}
    if args.job == "land":
        done["IngestionDurationSeconds"] = (seconds, "Seconds")
    emit(spark, args, done, now)
    return code


if __name__ == "__main__":
    raise SystemExit(main())
