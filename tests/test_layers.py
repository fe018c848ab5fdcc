"""The layers end to end: landing, cleaning, curating, validating and the gate."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from strata.jobs import main
from strata.operators.checks import Suite
from strata.plans.layers import (
    LayerCheck,
    MissingLayerError,
    QualityGateError,
    cleaned_to_curated,
    promote,
    raw_to_cleaned,
    require_files,
    run_validation,
    validate_layer,
)
from strata.sources.files import path_exists, read_layer

NOW = dt.datetime(2024, 2, 1, 3)
ASOF = dt.datetime.now()


def land(base, date, hot=None, usd=100.0, stamp="a", holes=()):
    folder = date.replace("-", "/")
    hourly = {
        "time": [f"{date}T{h:02}:00" for h in range(24)],
        "temperature_2m": [None if h in holes else 10.0 + h for h in range(24)],
        "precipitation": [0.1] * 24,
        "windspeed_10m": [12.0] * 24,
    }
    if hot is not None:
        hourly["temperature_2m"][hot] = 99.0
    bpi = {"USD": {"rate_float": usd, "description": "d"}, "GBP": {"rate_float": 80.0}, "EUR": {"rate_float": 90.0}}
    for dataset, data in (("weather", {"hourly": hourly}), ("crypto", {"bpi": bpi})):
        at = base / "raw" / dataset / folder
        at.mkdir(parents=True, exist_ok=True)
        head = {"source": "src", "ingested_at": f"{date}T02:00:0{len(list(at.iterdir()))}", "execution_date": date}
        (at / f"src_{stamp}.json").write_text(json.dumps({**head, "record_count": 1, "data": data}))


@pytest.fixture
def lake(spark, tmp_path):
    for day in ("2024-01-05", "2024-01-06"):
        land(tmp_path, day, usd=100.0 if day.endswith("5") else 110.0)
        raw_to_cleaned(spark, str(tmp_path), day)
    return tmp_path


def test_cleaning_keeps_the_newest_and_drops_what_is_out_of_range(spark, tmp_path):
    land(tmp_path, "2024-01-05", usd=100.0, stamp="a")
    land(tmp_path, "2024-01-05", hot=3, usd=120.0, stamp="b")
    counts = raw_to_cleaned(spark, str(tmp_path), "2024-01-05")
    assert counts["weather"]["_rows"] == 24 and counts["weather"]["temperature_c"] == 0 and counts["crypto"]["_rows"] == 1
    weather = read_layer(spark, f"{tmp_path}/cleaned/weather")
    assert weather.count() == 24 and weather.filter("temperature_c > 57").count() == 0
    assert weather.filter("hour = 4").head().ingested_at == dt.datetime(2024, 1, 5, 2, 0, 1)
    assert weather.filter("hour = 3").head().ingested_at == dt.datetime(2024, 1, 5, 2, 0, 0)
    assert read_layer(spark, f"{tmp_path}/cleaned/crypto").head().rate_usd == 120.0


def test_null_policies(spark, tmp_path):
    land(tmp_path, "2024-01-05", holes=(0, 1))
    assert raw_to_cleaned(spark, str(tmp_path), "2024-01-05")["weather"]["_rows"] == 22
    assert raw_to_cleaned(spark, str(tmp_path), "2024-01-05", "keep")["weather"]["_rows"] == 24
    filled = read_layer(spark, f"{tmp_path}/cleaned/weather").filter("hour < 2").collect()
    assert [r.temperature_c for r in filled] == [22.0, 22.0]  # the 11th of 22 values


def test_curated_tables(spark, lake):
    cleaned_to_curated(spark, str(lake), NOW)
    days = spark.read.parquet(f"{lake}/curated/daily_summary").orderBy("date").collect()
    assert [(r.hourly_records, r.avg_temp_c, r.btc_usd_avg) for r in days] == [(24, 21.5, 100.0), (24, 21.5, 110.0)]
    assert days[0].pipeline_version == "1.0.0" and days[0].processed_at == NOW
    hourly = spark.read.parquet(f"{lake}/curated/weather_hourly_agg")
    assert hourly.count() == 48
    assert hourly.filter("hour = 0").orderBy("date").collect()[1].temp_24h_rolling_avg == 21.5
    stats = spark.read.parquet(f"{lake}/curated/crypto_stats").orderBy("date").collect()
    assert [r.price_change_pct for r in stats] == [None, 10.0]
    assert "year" not in stats[0].asDict()


def test_rerun_changes_nothing(spark, lake):
    base = str(lake)
    for _ in range(2):
        raw_to_cleaned(spark, base, "2024-01-06")
        cleaned_to_curated(spark, base, NOW)
    assert read_layer(spark, f"{base}/cleaned/weather").count() == 48
    assert spark.read.parquet(f"{base}/curated/weather_hourly_agg").count() == 48


def statuses(spark, base, layer, date):
    path = f"{base}/validation_reports/{layer}/{date.replace('-', '/')}"
    report = spark.read.option("recursiveFileLookup", True).json(path).head()
    return report, {d.dataset: {c.check: c.status for c in d.checks} for d in report.datasets}


def test_validation_of_each_layer(spark, lake):
    base = str(lake)
    cleaned_to_curated(spark, base, NOW)
    as_of = dt.datetime.now() + dt.timedelta(minutes=1)
    assert run_validation(spark, base, "raw", "2024-01-06", as_of) == "PASS"
    _, raw = statuses(spark, base, "raw", "2024-01-06")
    assert raw["weather"]["schema_check"] == raw["weather"]["null_rate_payload_rows"] == "PASS"
    assert run_validation(spark, base, "cleaned", "2024-01-06", as_of, ["weather"]) == "PASS"
    report, cleaned = statuses(spark, base, "cleaned", "2024-01-06")
    assert report.overall_status == "PASS" and report.datasets[0].passed == len(cleaned["weather"]) == 9
    assert run_validation(spark, base, "cleaned", "2024-01-06", as_of, ["crypto"]) == "PASS"
    assert run_validation(spark, base, "curated", "2024-01-06", as_of) == "PASS"
    late = as_of + dt.timedelta(hours=27)
    assert run_validation(spark, base, "curated", "2024-01-06", late) == "FAIL"
    assert statuses(spark, base, "curated", "2024-01-06")[0].overall_status in ("PASS", "FAIL")
    points = spark.read.parquet(f"{base}/metrics")
    assert points.filter("name = 'RowCount' AND dimensions['Dataset'] = 'weather'").agg(F.max("value")).head()[0] == 24.0


def test_unreadable_documents_show_as_nulls(spark, tmp_path):
    land(tmp_path, "2024-01-05")
    (tmp_path / "raw/weather/2024/01/05/broken.json").write_text('{"source": "s", ')
    as_of = dt.datetime.now() + dt.timedelta(minutes=1)
    run_validation(spark, str(tmp_path), "raw", "2024-01-05", as_of, ["weather"])
    report, found = statuses(spark, str(tmp_path), "raw", "2024-01-05")
    assert found["weather"]["null_rate_data"] == "FAIL"
    assert any(c.detail == "50.0% null (1/2) — threshold 5%" for c in report.datasets[0].checks)


def test_payloads_without_rows_show_as_nulls(spark, tmp_path):
    land(tmp_path, "2024-01-05")
    path = next((tmp_path / "raw/weather/2024/01/05").glob("*.json"))
    text = json.loads(path.read_text())
    text["data"]["hourly"]["windspeed_10m"].pop()
    path.write_text(json.dumps(text))
    assert run_validation(spark, str(tmp_path), "raw", "2024-01-05", ASOF, ["crypto"]) == "PASS"
    assert run_validation(spark, str(tmp_path), "raw", "2024-01-05", ASOF, ["weather"]) == "FAIL"


def test_nothing_is_cleaned_that_fails_its_suite(spark, tmp_path):
    base = str(tmp_path)
    with pytest.raises(MissingLayerError):
        raw_to_cleaned(spark, base, "2024-01-05")
    land(tmp_path, "2024-01-05")
    raw_to_cleaned(spark, base, "2024-01-05")
    land(tmp_path, "2024-01-05", usd=-1.0, holes=range(24))
    (tmp_path / "raw/weather/2024/01/05/src_a.json").unlink(missing_ok=True)
    land(tmp_path, "2024-01-05", usd=-1.0, holes=range(24))
    with pytest.raises(QualityGateError):
        raw_to_cleaned(spark, base, "2024-01-05")
    assert read_layer(spark, f"{base}/cleaned/weather").count() == 24


def test_rebuild_from_a_day_equals_a_full_rebuild(spark, tmp_path):
    base = str(tmp_path)
    days = ["2024-01-02", "2024-01-03", "2024-01-09", "2024-01-10"]
    for i, day in enumerate(days):
        land(tmp_path, day, usd=100.0 + 7 * i, holes=range(i * 3, 12))
        raw_to_cleaned(spark, base, day)
    tables = ["daily_summary", "weather_hourly_agg", "crypto_stats"]
    content = lambda: [sorted(map(str, spark.read.parquet(f"{base}/curated/{t}").collect())) for t in tables]
    cleaned_to_curated(spark, base, NOW)
    whole = content()
    cleaned_to_curated(spark, base, NOW, "2024-01-09")
    assert content() == whole
    cleaned_to_curated(spark, base, NOW + dt.timedelta(1), "2024-01-09")
    summary = spark.read.parquet(f"{base}/curated/daily_summary").orderBy("date").collect()
    assert [r.processed_at.day for r in summary] == [1, 1, 2, 2]


def test_jobs_from_landing_to_curated(spark, tmp_path):
    base, day = tmp_path / "lake", "2024-01-05"
    land(tmp_path / "fetched", day)
    for dataset in ("weather", "crypto"):
        envelope = next((tmp_path / f"fetched/raw/{dataset}/2024/01/05").glob("*.json"))
        payload = tmp_path / f"{dataset}.json"
        payload.write_text(json.dumps(json.loads(envelope.read_text())["data"], indent=1))
        common = ["--base", str(base), "--date", day]
        assert main(["land", "--dataset", dataset, "--input", str(payload), "--source", "api", *common]) == 0
    for job in (["validate"], ["raw-to-cleaned"], ["cleaned-to-curated"], ["validate", "--layer", "curated"]):
        assert main([*job, *common]) == 0
    assert main(["raw-to-cleaned", "--incremental", *common]) == 0
    with pytest.raises(MissingLayerError):
        main(["raw-to-cleaned", "--base", str(base), "--date", "2024-01-06"])
    names = spark.read.parquet(f"{base}/metrics").groupBy("name").count().collect()
    found = {r.name: r["count"] for r in names}
    assert (found["PipelineSuccess"], found["PipelineFailure"], found["RecordsIngested"]) == (7, 1, 2)
    assert spark.read.parquet(f"{base}/curated/daily_summary").head().avg_temp_c == 21.5


def test_validation_without_files_or_datasets(spark, tmp_path):
    as_of = dt.datetime.now()
    assert run_validation(spark, str(tmp_path), "raw", "2024-01-05", as_of, []) == "PASS"
    assert run_validation(spark, str(tmp_path), "raw", "2024-01-05", as_of, ["weather"]) == "FAIL"
    _, found = statuses(spark, str(tmp_path), "raw", "2024-01-05")
    assert found == {"weather": {"freshness_check": "FAIL"}}


def test_history_makes_anomalies(spark, tmp_path):
    as_of = dt.datetime.now() + dt.timedelta(minutes=1)
    base = str(tmp_path)
    for day in range(1, 6):
        date = f"2024-01-0{day}"
        land(tmp_path, date, hot=day % 2 if day < 5 else None, holes=range(12) if day == 5 else ())
        raw_to_cleaned(spark, base, date)
        run_validation(spark, base, "cleaned", date, as_of, ["weather"])
    _, fourth = statuses(spark, base, "cleaned", "2024-01-04")
    _, third = statuses(spark, base, "cleaned", "2024-01-03")
    _, fifth = statuses(spark, base, "cleaned", "2024-01-05")
    assert "row_count_anomaly" not in third["weather"]
    assert fourth["weather"]["row_count_anomaly"] == "PASS"
    assert fifth["weather"]["row_count_anomaly"] == "FAIL"


def test_empty_table_fails_its_checks(spark):
    files = spark.createDataFrame([("f", 1, ASOF)], "path string, bytes bigint, modified_at timestamp")
    rows = spark.createDataFrame([], "date date, hour int")
    found = validate_layer(LayerCheck("cleaned", "weather", files, rows), F.lit(ASOF)).orderBy("position").collect()
    assert [(r.check, r.passed) for r in found] == [
        ("freshness_check", True),
        ("min_row_count", False),
        ("schema_check", False),
        ("null_rate_check", False),
    ]


def test_missing_fields_are_named(spark):
    files = spark.createDataFrame([("f", 1, ASOF)], "path string, bytes bigint, modified_at timestamp")
    rows = spark.range(20).select(F.current_date().alias("date"), F.col("id").alias("hour"))
    found = {r.check: r for r in validate_layer(LayerCheck("cleaned", "weather", files, rows), F.lit(ASOF)).collect()}
    assert "Missing fields: ['temperature_c'" in found["schema_check"].detail
    assert found["null_rate_temperature_c"].detail == "100.0% null (20/20) — threshold 5%"
    assert len(found) == 3 + 6


@pytest.mark.parametrize("staged", [True, False])
def test_gate(spark, tmp_path, staged):
    df = spark.range(10)
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    report = promote(df, Suite("s").min_count(10), lambda d: d.write.parquet(good), staged)
    assert report.overall == "PASS" and spark.read.parquet(good).count() == 10
    with pytest.raises(QualityGateError, match="10 >= 11") as caught:
        promote(df, Suite("s").min_count(11), lambda d: d.write.parquet(bad), staged)
    assert caught.value.report.failed == 1 and not path_exists(spark, bad)


def test_layer_must_have_files(spark, tmp_path):
    with pytest.raises(MissingLayerError):
        require_files(spark, str(tmp_path / "raw"))
    with pytest.raises(MissingLayerError):
        require_files(spark, str(tmp_path))
    (tmp_path / "a.json").write_text("{}")
    assert require_files(spark, str(tmp_path)).head().bytes == 2
