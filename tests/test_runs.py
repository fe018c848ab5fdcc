from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.operators import monitor
from strata.operators.monitor import ALARM_RULES, AlarmRule
from strata.operators.runs import freshness, row_count_anomaly
from strata.params import RETENTION
from strata.schemas import METRIC

T0 = dt.datetime(2024, 1, 5, 10, 30)


def history(spark, counts):
    rows = [("raw", "weather", i, c) for i, c in enumerate(counts)] + [("raw", "other", 0, 5)]
    return spark.createDataFrame(rows, "layer string, dataset string, run int, row_count bigint")


def judged(spark, counts):
    out = row_count_anomaly(history(spark, counts), ["layer", "dataset"], ["run"], "row_count")
    return out.filter("dataset = 'weather'").orderBy("run").collect()


def test_anomalies_of_a_short_history(spark):
    rows = judged(spark, [4, 8, 6, 10, 2, 300, 6])
    assert [r.points for r in rows] == [0, 1, 2, 3, 4, 5, 6]
    # Of 4, 8, 6 the mean is 6 and the deviation 2; of 4, 8, 6, 10 they are 7 and the root of 20/3.
    assert [r.z if r.z is None else round(r.z, 3) for r in rows] == [None, None, None, 2.0, 1.936, 92.971, 0.408]
    assert [r.anomaly_ok for r in rows] == [None, None, None, True, True, False, True]
    assert [r.enough_rows for r in rows] == [False, False, False, True, False, True, False]


def test_constant_history_deviates_by_one(spark):
    rows = judged(spark, [50, 50, 50, 53, 50])
    assert rows[3].z == 3.0 and rows[3].anomaly_ok is True
    assert judged(spark, [50, 50, 50, 54])[3].anomaly_ok is False


@pytest.mark.parametrize("hours, fresh", [(25.9, True), (26.0, True), (26.01, False)])
def test_freshness_bound_is_inclusive(spark, hours, fresh):
    df = spark.createDataFrame([(T0 - dt.timedelta(hours=hours),), (T0 - dt.timedelta(days=9),)], "ts timestamp")
    row = freshness(df, "ts", F.lit(T0)).head()
    assert row.fresh is fresh and row.age_hours == pytest.approx(hours)


def test_nothing_is_not_fresh(spark):
    row = freshness(spark.createDataFrame([], "ts timestamp"), "ts", F.lit(T0)).head()
    assert row.fresh is False and row.newest is None


def metrics(spark, *rows):
    return spark.createDataFrame([(n, float(v), "Count", {"Layer": "raw"}, ts) for n, v, ts in rows], METRIC)


def at(hours):
    return T0 + dt.timedelta(hours=hours)


def test_alarm_comparators(spark):
    rows = [("PipelineFailure", 1, T0)] + [("IngestionErrors", 1, T0)] * 3 + [("IngestionErrors", 4, at(1))]
    rows += [("ValidationFailed", 5, T0), ("ValidationFailed", 6, at(24)), ("RowCount", 99, T0)]
    got = {(r.alarm, r.period_start): (r.total, r.breached) for r in monitor.alarms(metrics(spark, *rows), ALARM_RULES).collect()}
    hour, day = T0.replace(minute=0), T0.replace(hour=0, minute=0)
    assert got == {
        ("pipeline-failure", hour): (1.0, True),
        ("ingestion-errors", hour): (3.0, False),
        ("ingestion-errors", hour + dt.timedelta(hours=1)): (4.0, True),
        ("validation-failure", day): (5.0, False),
        ("validation-failure", day + dt.timedelta(days=1)): (6.0, True),
    }


def test_two_rules_on_one_metric(spark):
    rules = [AlarmRule("hourly", "m", 3600, ">=", 2), AlarmRule("daily", "m", 86400, ">", 2)]
    rows = monitor.alarms(metrics(spark, ("m", 2, T0), ("m", 2, at(1))), rules).collect()
    assert sorted((r.alarm, r.total, r.breached) for r in rows) == [("daily", 4.0, True), ("hourly", 2.0, True), ("hourly", 2.0, True)]


def test_unknown_comparator():
    with pytest.raises(ValueError):
        AlarmRule("a", "m", 60, "<", 1).breached(None)


def test_missing_data_ends_an_alarm(spark):
    evaluated = monitor.alarms(metrics(spark, ("PipelineFailure", 1, T0)), ALARM_RULES)
    assert monitor.active_alarms(evaluated, ALARM_RULES, F.lit(at(0.2))).count() == 1
    assert monitor.active_alarms(evaluated, ALARM_RULES, F.lit(at(1))).count() == 0


def test_pass_rate(spark):
    df = metrics(spark, ("ValidationPassed", 3, T0), ("ValidationFailed", 1, T0), ("ValidationPassed", 0, at(24)))
    rows = monitor.pass_rate(df, [monitor.day_of()]).orderBy("day").collect()
    assert [(r.passed, r.failed, r.pass_rate) for r in rows] == [(3.0, 1.0, 75.0), (0.0, 0.0, None)]


def test_daily_since(spark):
    df = metrics(spark, ("m", 1, T0), ("m", 3, at(1)), ("m", 9, at(48)), ("other", 1, T0))
    rows = monitor.daily(df, ["m"], "sum", ["Layer"]).orderBy("day").collect()
    assert [(str(r.day), r.Layer, r.value) for r in rows] == [("2024-01-05", "raw", 4.0), ("2024-01-07", "raw", 9.0)]
    assert monitor.daily(df, ["m"], "avg", since="2024-01-06").head().value == 9.0
    pivoted = monitor.daily_pivot(df, ["m", "other"]).orderBy("day").collect()
    assert [(r.m, r.other) for r in pivoted] == [(4.0, 1.0), (9.0, None)]


def test_run_kpis_leave_failed_durations_out(spark):
    df = spark.createDataFrame([("PASS", 17.0, 10.0), ("PASS", 21.0, 20.0), ("FAIL", None, 0.0), ("PASS", 18.0, 10.0)], "status string, duration double, records double")
    row = monitor.run_kpis(df).head()
    assert (row.runs, row.success_rate, row.p50_duration, row.avg_records) == (4, 75.0, 18.0, 10.0)


def test_volume_rounds_half_up(spark):
    df = spark.createDataFrame([(14112, 15000), (1, 200), (5, 0)], "n bigint, most bigint")
    rows = monitor.volume_pct(df, "n", F.col("most")).collect()
    assert [r.pct for r in rows] == [94, 1, None]


@pytest.mark.parametrize(
    "layer, age, tier",
    [("raw", 29, "standard"), ("raw", 30, "infrequent"), ("raw", 90, "archive"), ("raw", 365, "expired"),
     ("cleaned", 59, "standard"), ("cleaned", 60, "infrequent"), ("cleaned", 5000, "archive")],
)
def test_retention(spark, layer, age, tier):
    today = dt.date(2024, 6, 1)
    df = spark.createDataFrame([(today - dt.timedelta(days=age),)], "date date")
    row = monitor.retention_tier(df, "date", F.lit(today), RETENTION[layer]).head()
    assert (row.age_days, row.tier) == (age, tier)


def test_log_lines(spark):
    rows = [(at(i), f'x DQ_METRICS: {{"dataset":"d{i}","total_rows":{i}}}') for i in range(30)]
    rows += [(at(99), "something else"), (at(98), "DQ_METRICS: broken")]
    found = monitor.parse_log(spark.createDataFrame(rows, "ts timestamp, message string"), "DQ_METRICS", "dataset string, total_rows bigint").collect()
    assert len(found) == 20
    assert found[0].body.dataset is None and found[1].body.total_rows == 29
