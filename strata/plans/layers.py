"""Layer validation, gated promotion, and the two daily jobs."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.dates import folder_of, partition_parts
from strata.operators.checks import RESULT, QualityGateError, Suite, SuiteReport, summarize
from strata.operators.monitor import points
from strata.operators.runs import count_check, freshness_check, no_files
from strata.params import LEAST_ROWS, QUALITY, QualityParams
from strata.plans import hourly, price, summary
from strata.schemas import EXPECTED_FIELDS, HOURLY_PAYLOAD, PRICE_PAYLOAD
from strata.session import stage, unstage
from strata.plans.tails import forget_tails, leave_tail, rows_before
from strata.sinks.publish import Outcome, write_audit_publish
from strata.sinks.tables import HISTORY, ROWS, emit_metrics, observed, record_history, write_report
from strata.sources.files import file_inventory, inventory_totals, path_exists, read_envelopes, read_layer


PAYLOADS = {"weather": HOURLY_PAYLOAD, "crypto": PRICE_PAYLOAD}
#: Payload rows of an envelope; null where there are none.
PAYLOAD_ROWS = "payload_rows"
PAYLOAD_COUNTS = {"weather": hourly.payload_rows, "crypto": price.payload_rows}
RESULT_COLUMNS = ["suite", "position", "check", "passed", "detail", "value"]


class MissingLayerError(RuntimeError):
    """Raised when a layer has no files to go on with."""


def promote(df: DataFrame, suite: Suite, write: Callable[[DataFrame], None], staged: bool = True) -> SuiteReport:
    """Write ``df`` only if it passes ``suite``.

    ``staged`` first writes the table once to the shared scratch folder, so that the checks and the
    final write read it from there instead of each working it out again.
    """
    if staged:
        df = stage(df, "staged")
    try:
        report = suite.run(df)
        if report.failed:
            raise QualityGateError(report)
        write(df)
    finally:
        if staged:
            unstage(df)
    return report


def require_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """File count and bytes of a folder that must hold some."""
    if path_exists(spark, path):
        totals = inventory_totals(file_inventory(spark, path, pattern))
        if totals.head().files:
            return totals
    raise MissingLayerError(f"no files at {path}")


def layer_suite(name: str, expected: list[str], params: QualityParams) -> Suite:
    least = min(LEAST_ROWS.get(name, params.min_row_count), params.min_row_count)
    suite = (
        Suite(name)
        .min_count(least, "min_row_count", f"%d rows (min {least})")
        .if_any_rows()
        .required(expected, "schema_check", lead="Missing fields")
    )
    for col in expected:
        suite.null_rate(col, params.max_null_rate, word=" null")
    return suite


@dataclass(frozen=True)
class LayerCheck:
    """What one dataset of a layer is checked with."""

    layer: str
    dataset: str
    files: DataFrame | None
    rows: DataFrame | None
    expected: list[str] | None = None
    history: DataFrame | None = None

    @property
    def name(self) -> str:
        return f"{self.layer}/{self.dataset}"


def validate_layer(check: LayerCheck, as_of: Column, params: QualityParams = QUALITY) -> DataFrame:
    """Check rows for one dataset: freshness, row count, its history, columns and null rates.

    A dataset without files gets the one failed freshness row.
    """
    spark = SparkSession.active()
    if check.files is None or check.rows is None:
        return no_files(spark, check.name)
    expected = check.expected or EXPECTED_FIELDS.get(check.layer, {}).get(check.dataset, [])
    fresh = freshness_check(check.files, as_of, check.name, max_hours=params.max_age_hours)
    suite = layer_suite(check.name, expected, params)
    if PAYLOAD_ROWS in check.rows.columns:
        suite.null_rate(PAYLOAD_ROWS, params.max_null_rate, word=" null")

    def row(position: Column, name: Column, passed: Column, detail: Column, value: Column) -> Column:
        return F.struct(
            position.alias("position"), name.alias("check"), passed.alias("passed"), detail.alias("detail"), value.alias("value")
        )

    own = row(F.col("position") + 1, F.col("check"), F.col("passed"), F.col("detail"), F.col("value"))
    counted = F.col("position") == 0
    rows = [own]
    # An empty table has nothing to look at: its two checks fail.
    for i, name, why in [(2, "schema_check", "No records to validate"), (3, "null_rate_check", "No records")]:
        unmet = row(F.lit(i), F.lit(name), F.lit(False), F.lit(why), F.lit(None).cast("double"))
        rows.append(F.when(counted & (F.col("value") == 0), unmet))
    if check.history is not None:
        rows.append(F.when(counted, count_check(check.history, F.col("value"), 100, params)))
    found = suite.evaluate(check.rows).select("suite", F.inline(F.array(*rows)))
    return fresh.unionByName(found.filter(F.col("check").isNotNull()))


def validation_report(checks: DataFrame, layer: str, execution_date: str, validated_at: dt.datetime) -> DataFrame:
    """One nested document of all datasets of a layer. PASS unless a check failed."""
    results = checks.groupBy("suite").agg(
        F.sort_array(
            F.collect_list(
                F.struct("position", "check", F.when(F.col("passed"), "PASS").otherwise("FAIL").alias("status"), "detail")
            )
        ).alias("_checks")
    )
    per_dataset = results.join(summarize(checks), "suite").select(
        F.struct(
            F.element_at(F.split("suite", "/"), -1).alias("dataset"),
            F.lit(layer).alias("layer"),
            "overall",
            "passed",
            "failed",
            F.transform("_checks", lambda c: F.struct(c["check"], c["status"], c["detail"])).alias("checks"),
        ).alias("_dataset")
    )
    return per_dataset.agg(F.sort_array(F.collect_list("_dataset")).alias("datasets")).select(
        F.lit(execution_date).alias("execution_date"),
        F.lit(layer).alias("layer"),
        F.when(F.exists("datasets", lambda d: d["overall"] == "FAIL"), "FAIL").otherwise("PASS").alias("overall_status"),
        F.lit(validated_at).alias("validated_at"),
        "datasets",
    )


def validation_metrics(checks: DataFrame, layer: str, execution_date: str, ts: Column) -> DataFrame:
    """The passed and failed checks and the row count of each dataset as metric points."""
    counted = checks.groupBy("suite").agg(F.max(F.when(F.col("check") == "min_row_count", F.col("value"))).alias("RowCount"))
    per_dataset = summarize(checks).join(counted, "suite").select(
        F.element_at(F.split("suite", "/"), -1).alias("dataset"),
        F.col("passed").cast("double").alias("ValidationPassed"),
        F.col("failed").cast("double").alias("ValidationFailed"),
        "RowCount",
    )
    names = ["ValidationPassed", "ValidationFailed", "RowCount"]
    long = per_dataset.unpivot(["dataset"], names, "name", "n").filter(F.col("n").isNotNull())
    name = F.col("name")
    dims = {"Layer": F.lit(layer), "Dataset": F.col("dataset"), "ExecutionDate": F.lit(execution_date)}
    return points(long, name, F.col("n"), F.lit("Count"), dims, ts)


def partition_folder(base: str, layer: str, dataset: str, date: str) -> str:
    """Where one date of a dataset lies in a layer."""
    day = dt.date.fromisoformat(date)
    tail = {
        "raw": folder_of(day),
        "cleaned": f"year={day.year}/month={day.month}/day={day.day}",
        "curated": f"date={day.isoformat()}",
    }[layer]
    return f"{base}/{layer}/{dataset}/{tail}"


def layer_check(
    spark: SparkSession, base: str, layer: str, dataset: str, date: str, multi_line: bool | None = None, pattern: str | None = None
) -> LayerCheck:
    """One date of a dataset, read in the format of its layer, with the row counts of earlier runs."""
    folder = partition_folder(base, layer, dataset, date)
    if not path_exists(spark, folder):
        return LayerCheck(layer, dataset, None, None)
    if layer == "raw":
        rows = read_envelopes(spark, f"{base}/raw", dataset, date, PAYLOADS[dataset], multi_line, pattern)
        rows = rows.withColumn(PAYLOAD_ROWS, PAYLOAD_COUNTS[dataset]()).drop("_corrupt_record")
    else:
        rows = read_layer(spark, f"{base}/{layer}/{dataset}", date, date)
    history = None
    if path_exists(spark, f"{base}/history"):
        runs = spark.read.schema(HISTORY).parquet(f"{base}/history")
        earlier = F.col("run_date") < F.lit(date).cast("date")
        history = runs.filter((F.col("layer") == layer) & (F.col("dataset") == dataset) & earlier)
    files = file_inventory(spark, folder, (pattern or "*") if layer == "raw" else "*.parquet")
    return LayerCheck(layer, dataset, files, rows, history=history)


def run_validation(
    spark: SparkSession,
    base: str,
    layer: str,
    date: str,
    as_of: dt.datetime,
    datasets: list[str] | None = None,
    multi_line: bool | None = None,
    pattern: str | None = None,
) -> str:
    """Validate datasets of a layer for one date; returns the overall PASS or FAIL.

    Writes the report, the metric points and the row counts that later runs are compared with. Only
    the check results, some ten short rows per dataset, come to the driver.
    """
    names = list(EXPECTED_FIELDS.get(layer, {})) if datasets is None else datasets
    now = F.lit(as_of)
    results = []
    for dataset in names:
        check = layer_check(spark, base, layer, dataset, date, multi_line, pattern)
        results += [tuple(r) for r in validate_layer(check, now).select(*RESULT_COLUMNS).collect()]
    if not results:
        return "PASS"
    checks = spark.createDataFrame(results, RESULT)
    write_report(
        validation_report(checks, layer, date, as_of), base, layer, date, as_of.strftime("%H%M%S")
    )
    emit_metrics(validation_metrics(checks, layer, date, now), f"{base}/metrics")
    counted = checks.filter(F.col("check") == "min_row_count")
    record_history(
        counted.select(
            F.lit(layer).alias("layer"),
            F.element_at(F.split("suite", "/"), -1).alias("dataset"),
            F.lit(date).cast("date").alias("run_date"),
            F.col("value").cast("bigint").alias("row_count"),
        ),
        f"{base}/history",
    )
    return "FAIL" if any(not r[RESULT_COLUMNS.index("passed")] for r in results) else "PASS"


@dataclass(frozen=True)
class Feed:
    """How the documents of a dataset are cleaned, and what a cleaned table must pass.

    ``clean`` gives good and rejected rows. ``keys`` name a row, of which that first in ``newest`` stays;
    ``series`` and ``order`` are those of its windows, which look back over ``look_back`` rows.
    """

    dataset: str
    payload: T.StructType
    clean: Callable[[DataFrame, str], tuple[DataFrame, DataFrame]]
    suite: Callable[[], Suite]
    keys: list[str]
    newest: Callable[[], list[Column]]
    series: list[str]
    order: list[str]
    look_back: int


FEEDS = {
    "weather": Feed(
        "weather",
        HOURLY_PAYLOAD,
        hourly.clean,
        lambda: hourly.suite(hourly.KEYS, QUALITY.min_row_count),
        hourly.KEYS,
        hourly.newest_first,
        ["source"],
        ["date", "hour"],
        hourly.LOOK_BACK,
    ),
    "crypto": Feed(
        "crypto",
        PRICE_PAYLOAD,
        lambda raw, null_policy: price.clean(raw),
        price.suite,
        price.KEYS,
        price.newest_first,
        ["currency"],
        ["date"],
        price.LOOK_BACK,
    ),
}

PARTS = ["year", "month", "day"]


def raw_to_cleaned(
    spark: SparkSession,
    base: str,
    date: str,
    null_policy: str = "drop",
    multi_line: bool | None = None,
    pattern: str | None = None,
    on_failure: str = "raise",
) -> dict[str, dict[str, int]]:
    """Clean the documents landed on ``date`` and replace the cleaned partitions they fall in.

    Returns the row and null counts of each dataset, taken along while writing, and under ``_rejected``
    and ``_unreadable`` the rows without a key and the documents that are no JSON. Both are kept under
    ``rejected`` in the lake. The text is parsed once, and a cleaned table is written once: its partitions
    are checked beside the table and then moved into it. A dataset without files raises. One that fails
    its suite, as it does when no row can be kept, raises too; with ``on_failure="quarantine"`` its
    partitions are kept under ``_quarantine`` instead, and its counts hold ``_quarantined``.
    """
    counts = {}
    for dataset in FEEDS:
        require_files(spark, partition_folder(base, "raw", dataset, date))
    for dataset, feed in FEEDS.items():
        parsed = read_envelopes(spark, f"{base}/raw", dataset, date, feed.payload, multi_line, pattern)
        raw = stage(parsed, "parsed")
        good, rejected = feed.clean(raw, null_policy)
        counts[dataset] = keep_rejected(raw, rejected, f"{base}/rejected/{dataset}", folder_of(date))
        seen = Observation(f"cleaned_{dataset}")
        outcome = publish_cleaned(good, base, feed, on_failure, seen)
        unstage(raw)
        counts[dataset] = {c: n for c, n in seen.get.items() if c not in PARTS} | counts[dataset]
        if outcome.status == "quarantined":
            counts[dataset]["_quarantined"] = counts[dataset].pop(ROWS)
    return counts


def publish_cleaned(rows: DataFrame, base: str, feed: Feed, on_failure: str, seen: Observation | None = None) -> Outcome:
    """Write, check and publish cleaned partitions; tails that these days may have made wrong go first."""
    tails = tails_path(base, feed.dataset)
    return write_audit_publish(
        partition_parts(rows),
        f"{base}/cleaned/{feed.dataset}",
        PARTS,
        feed.suite(),
        on_failure,
        f"{base}/_quarantine",
        seen,
        before=lambda partitions: forget_tails(rows.sparkSession, tails, partitions),
    )


def keep_rejected(raw: DataFrame, rejected: DataFrame, path: str, run: str) -> dict[str, int]:
    """Writes the rows without a key and the unreadable documents of a run, in place of those of an
    earlier try, and gives their numbers."""
    counts = {}
    for kind, rows in {"_rejected": rejected, "_unreadable": raw.filter(F.col("_corrupt_record").isNotNull())}.items():
        counted = Observation(f"{kind}-{uuid.uuid4().hex}")
        observed(rows, counted).write.mode("overwrite").parquet(f"{path}/{kind.strip('_')}/{run}")
        counts[kind] = counted.get[ROWS]
    return counts


def tails_path(base: str, dataset: str) -> str:
    return f"{base}/tails/{dataset}"


def cleaned_to_curated(
    spark: SparkSession, base: str, processed_at: dt.datetime, start: str | None = None, on_failure: str = "raise"
) -> dict[str, Outcome]:
    """Rebuild the curated tables from the cleaned rows of ``start`` and later, or from all of them.

    Days before ``start`` stay as they are. Of their rows only those that windows reach back to take part:
    they come from the tails that earlier runs left, so older folders of the cleaned layer are not
    read (see `rows_before`). Each table must pass its suite before it replaces anything, and is written
    once. With ``on_failure="quarantine"`` a failing one is put aside, the others go on.
    """
    cleaned = {d: f"{base}/cleaned/{d}" for d in FEEDS}
    for path in cleaned.values():
        require_files(spark, path)
    rows, series = {}, {}
    for dataset, feed in FEEDS.items():
        rows[dataset] = read_layer(spark, cleaned[dataset], start)
        series[dataset] = rows[dataset]
        if start:
            before = rows_before(spark, cleaned[dataset], tails_path(base, dataset), feed.series, feed.order, feed.look_back, start)
            series[dataset] = series[dataset].unionByName(before, allowMissingColumns=True)
    tables = {
        "daily_summary": (summary.build(rows["weather"], rows["crypto"], processed_at), summary.suite()),
        "weather_hourly_agg": (
            hourly.enriched(series["weather"], processed_at),
            Suite("weather_hourly_agg").not_empty().unique(hourly.KEYS).value_range("hour", 0, 23),
        ),
        "crypto_stats": (
            price.stats(series["crypto"], processed_at),
            Suite("crypto_stats").not_empty().unique(price.KEYS).null_rate("rate_usd", 0.0),
        ),
    }
    outcomes = {}
    for name, (df, suite) in tables.items():
        new = df.filter(F.col("date") >= F.lit(start).cast("date")) if start else df
        path = f"{base}/curated/{name}"
        outcomes[name] = write_audit_publish(new, path, ["date"], suite, on_failure, f"{base}/_quarantine")
    for dataset, feed in FEEDS.items():
        leave_tail(series[dataset], tails_path(base, dataset), feed.series, feed.order, feed.look_back, start)
    return outcomes
