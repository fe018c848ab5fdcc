"""Checks, suites, run history, layer validation and the gate."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from strata.functions.dates import folder_of
from strata.functions.numeric import rnd
from strata.operators.checks import QualityGateError, Suite, null_profile, summarize
from strata.operators.clean import first_n
from strata.operators.runs import freshness as freshness_of
from strata.operators.runs import row_count_anomaly as anomalies
from strata.params import QUALITY
from strata.plans import hourly as hourly_plan
from strata.plans import price as price_plan
from strata.plans import summary
from strata.plans.layers import LayerCheck, run_validation, validate_layer
from strata.plans.layers import validation_report as report_of
from strata.registry import query
from strata.registry.rollups import DAILY_COLUMNS, PRICE_COLUMNS
from strata.registry.views import (
    HOURLY,
    PRICES,
    PROCESSED_AT,
    RATES,
    READINGS,
    SHIPMENTS,
    hourly,
    price_series,
    rates,
    readings,
    shipments,
    sql_pct,
    sql_rnd,
    table,
)
from strata.session import scratch_dir
from strata.sinks.publish import write_audit_publish
from strata.sinks.tables import write_cleaned, write_report
from strata.sources.files import file_inventory


def checks_sql(ctes: str, suite: str, rows: list[tuple[str, str, str, str]]) -> str:
    """One SELECT per check from ``(check, passed, detail, value)`` expressions over one row ``a``."""
    selects = [
        f"SELECT '{suite}' AS suite, {i} AS position, '{check}' AS \"check\", ({passed})::boolean AS passed,"
        f" ({detail})::varchar AS detail, ({value})::double AS value FROM a"
        for i, (check, passed, detail, value) in enumerate(rows)
    ]
    return f"WITH {ctes} " + " UNION ALL ".join(selects)


def null_row(col: str, nulls: str, most: float = 0.05, n: str = "n"):
    rate = f"{nulls} / {n}::double"
    detail = f"{sql_pct(rate, 1)} || ' (' || {nulls} || '/' || {n} || ') — threshold {most:.0%}'"
    return (f"null_rate_{col}", f"{rate} <= {most}", detail, rate)


def range_row(col: str, bad: str, lo, hi):
    detail = f"CASE WHEN {bad} = 0 THEN 'All in [{lo}, {hi}]' ELSE {bad} || ' out-of-range values found' END"
    return (f"range_{col}", f"{bad} = 0", detail, bad)


def unique_row(keys: str, dupes: str):
    detail = f"CASE WHEN {dupes} = 0 THEN 'No duplicates' ELSE {dupes} || ' duplicate key(s) found' END"
    return (f"uniqueness_({keys})", f"{dupes} = 0", detail, dupes)


def outside(col: str, lo, hi) -> str:
    return f"count(*) FILTER (WHERE {col} IS NOT NULL AND NOT {col} BETWEEN {lo} AND {hi})"


def blanks(col: str) -> str:
    return f"count(*) FILTER (WHERE {col} IS NULL)"


NOT_EMPTY = ("not_empty", "n > 0", "n || ' records'", "n")


def least(n: int):
    return ("min_count", f"n >= {n}", f"n || ' >= {n}'", "n")


def fields(n: int):
    return ("required_fields", "true", f"'All {n} fields present'", "0")


@query(
    "check_counts",
    checks_sql(f"{READINGS}, a AS (SELECT count(*) AS n FROM readings)", "counts", [NOT_EMPTY, least(24), least(10**12)]),
)
def check_counts(spark, sf_dir):
    return Suite("counts").not_empty().min_count(24).min_count(10**12).evaluate(readings(spark, sf_dir))


@query(
    "check_required_fields",
    checks_sql(
        "a AS (SELECT 1)",
        "columns",
        [
            ("required_fields", "true", "'All 2 fields present'", "0"),
            ("required_more", "false", "'Missing: [''rate_usd'']'", "1"),
            ("required_keys", "false", "'Missing: [''q'']'", "1"),
        ],
    ),
)
def check_required_fields(spark, sf_dir):
    """Columns of the table, and keys of the JSON objects in a column of it."""
    suite = (
        Suite("columns")
        .required(["event_id", "value"])
        .required(["event_id", "rate_usd"], name="required_more")
        .required_keys("props", ["k", "q"], name="required_keys")
    )
    return suite.evaluate(table(spark, sf_dir, "events"))


@query(
    "check_null_rate",
    checks_sql(
        f"""{READINGS}, a AS (SELECT count(*) AS n, {blanks('temperature_c')} AS t, {blanks('precipitation_mm')} AS p,
        count(*) FILTER (WHERE event_id % 7 = 0) AS s FROM readings)""",
        "nulls",
        [null_row("temperature_c", "t"), null_row("precipitation_mm", "p", 0.02), null_row("label", "s", 0.1)],
    ),
)
def check_null_rate(spark, sf_dir):
    """Nulls in numbers, and empty text in a text column."""
    labelled = readings(spark, sf_dir).withColumn("label", F.when(F.col("event_id") % 7 == 0, "").otherwise("x"))
    suite = Suite("nulls").null_rate("temperature_c").null_rate("precipitation_mm", 0.02).null_rate("label", 0.1)
    return suite.evaluate(labelled)


@query(
    "check_value_range",
    checks_sql(
        f"""{READINGS}, a AS (SELECT {outside('temperature_c', -89, 57)} AS t, {outside('hour', 0, 23)} AS h,
        {outside('precipitation_mm', 0, 2000)} AS p FROM readings)""",
        "ranges",
        [
            range_row("temperature_c", "t", -89, 57),
            range_row("hour", "h", 0, 23),
            range_row("precipitation_mm", "p", 0, 2000),
        ],
    ),
)
def check_value_range(spark, sf_dir):
    suite = (
        Suite("ranges")
        .value_range("temperature_c", -89, 57)
        .value_range("hour", 0, 23)
        .value_range("precipitation_mm", 0, 2000)
    )
    return suite.evaluate(readings(spark, sf_dir))


@query(
    "check_uniqueness",
    checks_sql(
        """a AS (SELECT (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM
          (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS d)""",
        "keys",
        [unique_row("l_orderkey_l_linenumber", "d")],
    ),
)
def check_uniqueness(spark, sf_dir):
    return Suite("keys").unique(["l_orderkey", "l_linenumber"]).evaluate(table(spark, sf_dir, "lineitem"))


@query(
    "check_ref_integrity",
    checks_sql(
        """a AS (SELECT (SELECT count(*) FROM documents) AS n,
          (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)) AS d,
          (SELECT count(*) FROM orders) AS m,
          (SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)) AS o)""",
        "references",
        [
            (
                "labelled",
                "d = 0",
                "CASE WHEN d = 0 THEN 'All ' || n || ' records have valid references' ELSE d || ' orphan records' END",
                "d",
            ),
            (
                "ordered",
                "o = 0",
                "CASE WHEN o = 0 THEN 'All ' || m || ' records have valid references' ELSE o || ' orphan records' END",
                "o",
            ),
        ],
    ),
)
def check_ref_integrity(spark, sf_dir):
    labels, customers = table(spark, sf_dir, "labels"), table(spark, sf_dir, "customer")
    documents = Suite("references").references("doc_id", labels, "doc_id", "labelled")
    orders = Suite("references").references("o_custkey", customers, "c_custkey", "ordered")
    second = orders.evaluate(table(spark, sf_dir, "orders")).withColumn("position", F.lit(1))
    return documents.evaluate(table(spark, sf_dir, "documents")).unionByName(second)


@query(
    "check_custom",
    checks_sql(
        f"""{READINGS}, a AS (SELECT count(*) FILTER (WHERE hour < 24 IS NOT TRUE) AS h,
        count(*) FILTER (WHERE (temperature_c > -1000) IS NOT TRUE) AS t FROM readings)""",
        "own",
        [
            ("hour_in_day", "h = 0", "'hour below 24'", "h"),
            ("has_temperature", "t = 0", "CASE WHEN t = 0 THEN 'PASS' ELSE 'FAIL' END", "t"),
        ],
    ),
)
def check_custom(spark, sf_dir):
    suite = (
        Suite("own")
        .custom("hour_in_day", F.col("hour") < 24, "hour below 24")
        .custom("has_temperature", lambda df: df["temperature_c"] > -1000)
    )
    return suite.evaluate(readings(spark, sf_dir))


SUITE_HOURLY = checks_sql(
    f"""{HOURLY}, a AS (SELECT count(*) AS n, {blanks('temperature_c')} AS t, {blanks('precipitation_mm')} AS p,
    {outside('temperature_c', -89, 57)} AS rt, {outside('hour', 0, 23)} AS rh,
    {outside('precipitation_mm', 0, 2000)} AS rp, count(*) - count(DISTINCT (date, hour)) AS d FROM hourly)""",
    "weather_validation",
    [
        NOT_EMPTY,
        least(24),
        fields(5),
        null_row("temperature_c", "t"),
        null_row("precipitation_mm", "p"),
        range_row("temperature_c", "rt", -89, 57),
        range_row("hour", "rh", 0, 23),
        range_row("precipitation_mm", "rp", 0, 2000),
        unique_row("date_hour", "d"),
    ],
)


@query("suite_hourly", SUITE_HOURLY)
def suite_hourly(spark, sf_dir):
    return hourly_plan.suite().evaluate(hourly(spark, sf_dir))


@query(
    "suite_price",
    checks_sql(
        f"""{PRICES}, a AS (SELECT count(*) AS n, {blanks('rate_usd')} AS u, {outside('rate_usd', 1, 10000000)} AS ru,
        {outside('rate_gbp', 1, 10000000)} AS rg, count(*) - count(DISTINCT (date, currency)) AS d FROM prices)""",
        "crypto_validation",
        [
            NOT_EMPTY,
            least(1),
            fields(5),
            null_row("rate_usd", "u", 0.0),
            range_row("rate_usd", "ru", 1, 10000000),
            range_row("rate_gbp", "rg", 1, 10000000),
            unique_row("date_currency", "d"),
        ],
    ),
)
def suite_price(spark, sf_dir):
    return price_plan.suite().evaluate(price_series(spark, sf_dir))


@query(
    "suite_daily_summary",
    checks_sql(
        f"""{SHIPMENTS}, {RATES}, w AS (SELECT date, {DAILY_COLUMNS} FROM shipments GROUP BY date),
        p AS (SELECT date, {PRICE_COLUMNS} FROM rates GROUP BY date),
        a AS (SELECT count(*) AS n, {blanks('avg_temp_c')} AS t,
          count(*) FILTER (WHERE (max_temp_c >= min_temp_c) IS NOT TRUE) AS m FROM w LEFT JOIN p USING (date))""",
        "daily_summary_validation",
        [
            NOT_EMPTY,
            fields(6),
            null_row("avg_temp_c", "t"),
            ("max_temp_gte_min_temp", "m = 0", "'max_temp_c >= min_temp_c for all records'", "m"),
        ],
    ),
)
def suite_daily_summary(spark, sf_dir):
    return summary.suite().evaluate(summary.build(shipments(spark, sf_dir), rates(spark, sf_dir), PROCESSED_AT))


@query(
    "suite_summary",
    f"""SELECT suite, count(*) AS total_checks, count(*) FILTER (WHERE passed) AS passed,
      count(*) FILTER (WHERE NOT passed) AS failed, 100.0::double * count(*) FILTER (WHERE passed) / count(*)
        AS success_rate, CASE WHEN bool_and(passed) THEN 'PASS' ELSE 'FAIL' END AS overall
    FROM ({SUITE_HOURLY}) GROUP BY suite""",
)
def suite_summary(spark, sf_dir):
    return summarize(hourly_plan.suite().evaluate(hourly(spark, sf_dir)))


PROFILED = ["event_id", "source", "temperature_c", "precipitation_mm", "windspeed_kmh"]


@query(
    "null_profile",
    f"WITH {READINGS}, a AS (SELECT count(*) AS n, "
    + ", ".join(f"{blanks(c)} AS {c}" for c in PROFILED)
    + " FROM readings) "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", n AS total_rows, {c} AS nulls, {sql_pct(f'{c} / n::double', 2)} AS null_rate FROM a"
        for c in PROFILED
    ),
)
def nulls(spark, sf_dir):
    return null_profile(readings(spark, sf_dir).select(*PROFILED))


def daily_runs(spark, sf_dir):
    return readings(spark, sf_dir).groupBy("source", "date").agg(F.count(F.lit(1)).alias("row_count"))


RUNS = f"{READINGS}, runs AS (SELECT source, date, count(*) AS row_count FROM readings GROUP BY source, date)"


@query(
    "row_count_anomaly",
    f"""WITH {RUNS}, h AS (SELECT *, count(row_count) OVER w AS points, avg(row_count) OVER w AS mean,
        stddev_samp(row_count) OVER w AS sd FROM runs
        WINDOW w AS (PARTITION BY source ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)),
      j AS (SELECT *, CASE WHEN points >= 3 THEN abs(row_count - mean) / CASE WHEN sd = 0 THEN 1.0 ELSE sd END END AS z
        FROM h)
    SELECT source, date::varchar AS date, row_count, points, {sql_rnd('mean', 4)} AS mean, {sql_rnd('sd', 4)} AS stddev,
      {sql_rnd('z', 4)} AS z, row_count >= 10 AS enough_rows, z <= 3.0 AS anomaly_ok FROM j""",
)
def row_count_anomaly(spark, sf_dir):
    judged = anomalies(daily_runs(spark, sf_dir), ["source"], ["date"], "row_count")
    return judged.withColumns({c: rnd(c, 4) for c in ("mean", "stddev", "z")})


@query(
    "history_last_n",
    f"""WITH {RUNS} SELECT source, date::varchar AS date, row_count FROM runs
    QUALIFY row_number() OVER (PARTITION BY source ORDER BY date DESC) <= 7""",
)
def history_last_n(spark, sf_dir):
    return first_n(daily_runs(spark, sf_dir), ["source"], [F.desc("date")], QUALITY.lookback_runs)


AS_OF = "2024-01-31 06:00:00"


@query(
    "freshness",
    f"""SELECT user_id, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS newest,
      (epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(max(ts))) / 3600000000 AS age_hours,
      (epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(max(ts))) / 3600000000 <= 26 AS fresh
    FROM events GROUP BY user_id""",
)
def freshness(spark, sf_dir):
    return freshness_of(table(spark, sf_dir, "events"), "ts", F.lit(AS_OF).cast("timestamp"), ["user_id"])


def layer_check(spark, sf_dir, dataset, rows, history=None):
    files = file_inventory(spark, sf_dir, "*.parquet")
    expected = {
        "weather": ["date", "hour", "temperature_c", "precipitation_mm", "windspeed_kmh"],
        "crypto": ["date", "currency", "rate_usd", "rate_gbp", "rate_eur"],
    }[dataset]
    return LayerCheck("cleaned", dataset, files, rows, expected, history)


def hour_after_newest(spark, sf_dir):
    """A moment an hour after the newest file, whenever the files were made."""
    newest = file_inventory(spark, sf_dir, "*.parquet").agg(F.max("modified_at").alias("newest"))
    return newest.select(F.col("newest") + F.expr("INTERVAL 1 HOUR")).scalar()


def layer_row(i: int, check: str, passed: str, detail: str) -> str:
    return f"SELECT {i} AS position, '{check}' AS \"check\", ({passed})::boolean AS passed, ({detail}) AS detail FROM a"


def layer_null(i: int, col: str) -> str:
    rate = f"{col} / n::double"
    text = f"{sql_pct(rate, 1)} || ' null (' || {col} || '/' || n || ') — threshold 5%'"
    return layer_row(i, f"null_rate_{col}", f"{rate} <= 0.05", text)


LAYER_COLUMNS = ["date", "hour", "temperature_c", "precipitation_mm", "windspeed_kmh"]


@query(
    "layer_validation",
    f"WITH {READINGS}, h AS (SELECT date, count(*) AS c FROM readings GROUP BY date ORDER BY date DESC LIMIT 7),"
    " a AS (SELECT count(*) AS n, "
    + ", ".join(f"{blanks(c)} AS {c}" for c in LAYER_COLUMNS)
    + ", (SELECT avg(c) FROM h) AS mean, (SELECT stddev_samp(c) FROM h) AS sd FROM readings) "
    + " UNION ALL ".join(
        [
            layer_row(0, "freshness_check", "true", "'Latest file 1.0h old (max 26h)'"),
            layer_row(1, "min_row_count", "n >= 10", "n || ' rows (min 10)'"),
            layer_row(2, "schema_check", "true", "'All 5 fields present'"),
            *[layer_null(3 + i, c) for i, c in enumerate(LAYER_COLUMNS)],
            layer_row(
                100,
                "row_count_anomaly",
                "abs(n - mean) / sd <= 3.0",
                "printf('z-score=%.2f (mean=%.0f, stddev=%.0f) — threshold 3.0', abs(n - mean) / sd, mean, sd)",
            ),
        ]
    ),
)
def layer_validation(spark, sf_dir):
    rows = readings(spark, sf_dir)
    history = rows.groupBy(F.col("date").alias("run_date")).agg(F.count(F.lit(1)).alias("row_count"))
    check = layer_check(spark, sf_dir, "weather", rows, history)
    found = validate_layer(check, hour_after_newest(spark, sf_dir))
    return found.select("position", "check", "passed", "detail")


@query(
    "validation_report",
    f"""WITH {READINGS}, {RATES},
    w AS (SELECT 'weather' AS dataset, 3 + ({blanks('date')} / count(*) <= 0.05)::int + ({blanks('hour')} / count(*) <= 0.05)::int
      + ({blanks('temperature_c')} / count(*) <= 0.05)::int + ({blanks('precipitation_mm')} / count(*) <= 0.05)::int
      + ({blanks('windspeed_kmh')} / count(*) <= 0.05)::int AS passed FROM readings),
    c AS (SELECT 'crypto' AS dataset, 3 + ({blanks('date')} / count(*) <= 0.05)::int + ({blanks('currency')} / count(*) <= 0.05)::int
      + ({blanks('rate_usd')} / count(*) <= 0.05)::int + ({blanks('rate_gbp')} / count(*) <= 0.05)::int
      + ({blanks('rate_eur')} / count(*) <= 0.05)::int AS passed FROM rates),
    u AS (SELECT * FROM w UNION ALL SELECT * FROM c)
    SELECT '2024-02-01' AS execution_date, 'cleaned' AS layer,
      CASE WHEN (SELECT bool_and(passed = 8) FROM u) THEN 'PASS' ELSE 'FAIL' END AS overall_status, dataset,
      CASE WHEN passed = 8 THEN 'PASS' ELSE 'FAIL' END AS overall, passed::bigint AS passed, (8 - passed)::bigint AS failed,
      8 AS checks
    FROM u""",
)
def validation_report(spark, sf_dir):
    as_of = hour_after_newest(spark, sf_dir)
    weather = validate_layer(layer_check(spark, sf_dir, "weather", readings(spark, sf_dir)), as_of)
    crypto = validate_layer(layer_check(spark, sf_dir, "crypto", rates(spark, sf_dir)), as_of)
    report = report_of(weather.unionByName(crypto), "cleaned", "2024-02-01", PROCESSED_AT)
    path = write_report(report, scratch_dir(spark, "reports"), "cleaned", "2024-02-01", "030000")
    read = spark.read.schema(report.schema).json(path)
    return read.select("execution_date", "layer", "overall_status", F.explode("datasets").alias("d")).select(
        "execution_date",
        "layer",
        "overall_status",
        "d.dataset",
        "d.overall",
        "d.passed",
        "d.failed",
        F.size("d.checks").alias("checks"),
    )


@query(
    "quality_gate",
    f"""WITH {READINGS} SELECT source, count(*) AS promoted, true AS bad_suite_blocked,
      count(*) FILTER (WHERE temperature_c IS NULL) AS blanks_aside FROM readings GROUP BY source""",
)
def quality_gate(spark, sf_dir):
    """One write each: a suite that passes publishes, one that fails raises and changes nothing, or puts aside."""
    base = scratch_dir(spark, "gate")
    path = f"{base}/readings"
    rows = readings(spark, sf_dir).select("event_id", "source", "hour", "temperature_c")
    write_audit_publish(rows, path, ["source"], Suite("good").not_empty().value_range("hour", 0, 23))
    strict = Suite("bad").null_rate("temperature_c", 0.0)
    blank = rows.filter(F.col("temperature_c").isNull())
    try:
        write_audit_publish(blank, path, ["source"], strict)
        raised = False
    except QualityGateError:
        raised = True
    aside = write_audit_publish(blank, path, ["source"], strict, "quarantine")
    counted = lambda at, name: spark.read.schema(rows.schema).parquet(at).groupBy("source").agg(F.count(F.lit(1)).alias(name))
    both = counted(path, "promoted").join(counted(f"{aside.path}/data", "blanks_aside"), "source", "left")
    blocked = raised and aside.status == "quarantined"
    return both.select("source", "promoted", F.lit(blocked).alias("bad_suite_blocked"), F.coalesce("blanks_aside", F.lit(0)).alias("blanks_aside"))


@query(
    "validation_without_files",
    f"""WITH {READINGS}, d AS (SELECT * FROM readings WHERE date = DATE '2024-01-10'),
    w AS (SELECT 3 + ({blanks('temperature_c')} / count(*)::double <= 0.05)::int + ({blanks('precipitation_mm')} / count(*)::double <= 0.05)::int
      + ({blanks('windspeed_kmh')} / count(*)::double <= 0.05)::int + 3 AS passed FROM d)
    SELECT 'FAIL' AS overall_status, 'crypto' AS dataset, 'FAIL' AS overall, 0::bigint AS passed, 1::bigint AS failed, NULL::double AS rows
    UNION ALL SELECT 'FAIL', 'weather', CASE WHEN passed = 9 THEN 'PASS' ELSE 'FAIL' END, passed::bigint, (9 - passed)::bigint,
      (SELECT count(*) FROM d)::double FROM w""",
)
def validation_without_files(spark, sf_dir):
    """A layer of which one dataset has files and the other none: both are reported, with their metrics."""
    base, date = scratch_dir(spark, "lake"), "2024-01-10"
    write_cleaned(readings(spark, sf_dir).withColumn("ingested_at", F.col("ts")), f"{base}/cleaned/weather")
    as_of = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) + dt.timedelta(minutes=1)
    run_validation(spark, base, "cleaned", date, as_of)
    path = f"{base}/validation_reports/cleaned/{folder_of(date)}/report_{as_of.strftime('%H%M%S')}.json"
    shape = "overall_status string, datasets array<struct<dataset string, overall string, passed bigint, failed bigint>>"
    told = spark.read.schema(shape).json(path).select("overall_status", F.inline("datasets"))
    counts = spark.read.parquet(f"{base}/metrics").filter("name = 'RowCount'")
    counts = counts.select(F.col("dimensions")["Dataset"].alias("dataset"), F.col("value").alias("rows"))
    return told.join(counts, "dataset", "left").select("overall_status", "dataset", "overall", "passed", "failed", "rows")
