from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from strata.operators.monitor import AlarmRule, alarm_transitions
from strata.schemas import METRIC, struct, LONG
from strata.sinks.tables import emit_metrics
from strata.streaming import alarms as alarm_stream_module
from strata.streaming.alarms import alarm_stream, current_alarms, keep_totals, running_totals
from strata.streaming.ingest import append, ingest_new_files

T0 = dt.datetime(2024, 1, 5, 10)


def test_files_are_taken_once(spark, tmp_path):
    src, dst, state = (str(tmp_path / n) for n in ("src", "dst", "state"))
    schema = struct(id=LONG)
    spark.range(10).repartition(3).write.mode("append").json(src)
    for _ in range(2):
        ingest_new_files(spark, schema, src, dst, state, files_per_batch=2)
        assert spark.read.parquet(dst).count() == 10
    spark.range(10, 15).write.mode("append").json(src)
    ingest_new_files(spark, schema, src, dst, state)
    assert sorted(r.id for r in spark.read.parquet(dst).collect()) == list(range(15))


def test_alarms_of_closed_hours_only(spark, tmp_path):
    src, dst, state = (str(tmp_path / n) for n in ("src", "dst", "state"))
    rule = AlarmRule("errors", "IngestionErrors", 3600, ">", 3)

    def feed(*rows):
        points = [(n, float(v), "Count", {}, T0 + dt.timedelta(minutes=m)) for n, v, m in rows]
        emit_metrics(spark.createDataFrame(points, METRIC), src)
        append(alarm_stream(spark.readStream.schema(METRIC).parquet(src), rule, "1 hour"), dst, state)
        found = spark.read.parquet(dst).collect()
        return {(r.period_start - T0) / dt.timedelta(hours=1): (r.total, r.breached) for r in found}

    assert feed(("IngestionErrors", 2, 5), ("IngestionErrors", 2, 59), ("RowCount", 50, 5)) == {}
    assert feed(("IngestionErrors", 3, 61)) == {}
    # Past 12:00 less the hour of delay, the first hour is closed; its points came in two runs.
    assert feed(("IngestionErrors", 1, 125)) == {0: (4.0, True)}
    # A point of the closed hour is too late; one of an open hour still counts.
    assert feed(("IngestionErrors", 9, 10), ("IngestionErrors", 1, 65)) == {0: (4.0, True)}
    assert feed(("IngestionErrors", 1, 300)) == {0: (4.0, True), 1: (4.0, True), 2: (1.0, False)}


HOURLY, DAILY = AlarmRule("errors", "IngestionErrors", 3600, ">", 3), AlarmRule("failures", "ValidationFailed", 86400, ">=", 2)


def test_open_periods_and_transitions_of_several_rules(spark, tmp_path):
    src, dst, state = (str(tmp_path / n) for n in ("src", "dst", "state"))

    def feed(*rows):
        points = [(n, float(v), "Count", {}, T0 + dt.timedelta(minutes=m)) for n, v, m in rows]
        emit_metrics(spark.createDataFrame(points, METRIC), src)
        stream = spark.readStream.schema(METRIC).parquet(src)
        keep_totals(running_totals(stream, [HOURLY, DAILY], "3 hours"), dst, state)
        spark.catalog.refreshByPath(dst)
        found = current_alarms(spark, dst, [HOURLY, DAILY])
        told = {(r.alarm, (r.period_start - T0) / dt.timedelta(hours=1)): (r.total, r.breached) for r in found.collect()}
        newest = max(m for _, _, m in rows)
        as_of = F.lit(T0 + dt.timedelta(minutes=newest))
        changes = alarm_transitions(found, [HOURLY, DAILY], as_of).orderBy("alarm", "at").collect()
        return told, [(r.alarm, (r.at - T0) / dt.timedelta(hours=1), r.state) for r in changes]

    day = ("failures", -10.0)
    told, changes = feed(("IngestionErrors", 2, 5), ("IngestionErrors", 2, 59), ("RowCount", 50, 5), ("ValidationFailed", 1, 5))
    assert told == {("errors", 0): (4.0, True), day: (1.0, False)} and changes == [("errors", 0, "ALARM")]
    told, changes = feed(("IngestionErrors", 3, 61), ("IngestionErrors", 9, 130), ("ValidationFailed", 1, 61))
    assert told == {("errors", 0): (4.0, True), ("errors", 1): (3.0, False), ("errors", 2): (9.0, True), day: (2.0, True)}
    assert changes == [("errors", 0, "ALARM"), ("errors", 1, "OK"), ("errors", 2, "ALARM"), ("failures", -10, "ALARM")]
    # A late point joins the hours to one alarm; a run without new points changes nothing.
    told, changes = feed(("IngestionErrors", 1, 62), ("RowCount", 1, 300))
    assert told["errors", 1] == (4.0, True)
    assert changes == [("errors", 0, "ALARM"), ("errors", 3, "OK"), ("failures", -10, "ALARM")]
    keep_totals(running_totals(spark.readStream.schema(METRIC).parquet(src), [HOURLY, DAILY], "3 hours"), dst, state)
    assert current_alarms(spark, dst, [HOURLY, DAILY]).count() == len(told)
    # Behind the watermark points are too late; the next day has no alarm, so the day's ends.
    told, changes = feed(("IngestionErrors", 1, 60 * 30), ("RowCount", 1, 60 * 30))
    told, changes = feed(("IngestionErrors", 50, 3), ("RowCount", 1, 60 * 31))
    assert told["errors", 0] == (4.0, True)
    assert changes[-2:] == [("failures", -10, "ALARM"), ("failures", 14, "OK")]


def test_totals_that_were_told_twice(spark, tmp_path, monkeypatch):
    """A run that breaks off after publishing hands its batch out again."""
    src, dst, state = (str(tmp_path / n) for n in ("src", "dst", "state"))

    def emit(v, m):
        emit_metrics(spark.createDataFrame([("IngestionErrors", float(v), "Count", {}, T0 + dt.timedelta(minutes=m))], METRIC), src)

    def run():
        keep_totals(running_totals(spark.readStream.schema(METRIC).parquet(src), [HOURLY], "3 hours"), dst, state)

    emit(2, 5)
    run()
    emit(3, 6)
    publish = alarm_stream_module.write_audit_publish

    def lost(*args):
        publish(*args)
        raise OSError("lost")

    monkeypatch.setattr(alarm_stream_module, "write_audit_publish", lost)
    with pytest.raises(StreamingQueryException):
        run()
    monkeypatch.undo()
    run()
    spark.catalog.refreshByPath(dst)
    assert [(r.total, r.breached) for r in current_alarms(spark, dst, [HOURLY]).collect()] == [(5.0, True)]
