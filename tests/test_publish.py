"""Write, audit, publish; and cleaning of new files that is broken off at every place."""

from __future__ import annotations

import json

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from strata.operators.checks import QualityGateError, Suite
from strata.plans.layers import raw_to_cleaned
from strata.sinks import publish as publishing
from strata.sinks.publish import recover, write_audit_publish
from strata.sources.files import read_layer
from strata.streaming import cleaning
from strata.streaming.cleaning import clean_new_files, committed, record_batch
from tests.test_layers import land

GOOD, BAD = Suite("good").not_empty().value_range("v", 0, 99), Suite("bad").value_range("v", 0, 1)


def rows(spark, ids, day="2024-01-05", add=0):
    return spark.createDataFrame([(i, i + add) for i in ids], "id long, v long").withColumn("day", F.lit(day))


def content(spark, path, day=None):
    df = spark.read.parquet(path)
    return sorted((r.id, r.v) for r in (df.filter(F.col("day") == day) if day else df).collect())


def test_passing_partitions_replace_those_of_the_table(spark, tmp_path):
    path = f"{tmp_path}/table"
    two = rows(spark, range(3)).unionByName(rows(spark, range(5), "2024-01-06"))
    done = write_audit_publish(two, path, ["day"], GOOD)
    assert (done.status, done.partitions) == ("published", ["day=2024-01-05", "day=2024-01-06"])
    done = write_audit_publish(rows(spark, range(4), add=10), path, ["day"], GOOD)
    assert done.partitions == ["day=2024-01-05"]
    assert content(spark, path, "2024-01-05") == [(i, i + 10) for i in range(4)]
    assert content(spark, path, "2024-01-06") == [(i, i) for i in range(5)]
    assert not list((tmp_path / "_audit").rglob("*.parquet"))


def test_a_table_without_partitions_is_replaced_whole(spark, tmp_path):
    path = f"{tmp_path}/whole"
    for n in (5, 3):
        assert write_audit_publish(rows(spark, range(n)), path, [], GOOD).partitions == [""]
        assert spark.read.parquet(path).count() == n


def test_failing_partitions_are_raised_or_put_aside(spark, tmp_path):
    path = f"{tmp_path}/table"
    write_audit_publish(rows(spark, range(3)), path, ["day"], GOOD)
    with pytest.raises(QualityGateError):
        write_audit_publish(rows(spark, range(9)), path, ["day"], BAD)
    assert not list((tmp_path / "_audit").rglob("*.parquet"))
    aside = write_audit_publish(rows(spark, range(9)), path, ["day"], BAD, "quarantine")
    assert aside.status == "quarantined" and aside.path.startswith(f"{tmp_path}/_quarantine/table/")
    assert spark.read.parquet(f"{aside.path}/data").count() == 9
    report = json.loads(open(f"{aside.path}/report.json").read())
    assert [c["passed"] for c in report["checks"]] == [False]
    elsewhere = write_audit_publish(rows(spark, range(4)), path, ["day"], BAD, "quarantine", f"{tmp_path}/q")
    assert elsewhere.status == "quarantined" and elsewhere.path.startswith(f"{tmp_path}/q/table/")
    assert content(spark, path) == [(i, i) for i in range(3)]
    with pytest.raises(ValueError, match="on_failure"):
        write_audit_publish(rows(spark, [1]), path, ["day"], GOOD, "ignore")


def test_an_empty_frame(spark, tmp_path):
    path = f"{tmp_path}/table"
    write_audit_publish(rows(spark, range(3)), path, ["day"], GOOD)
    assert write_audit_publish(rows(spark, []), path, ["day"], Suite("any")).partitions == []
    with pytest.raises(QualityGateError):
        write_audit_publish(rows(spark, []), path, ["day"], GOOD)
    assert content(spark, path) == [(i, i) for i in range(3)]


@pytest.mark.parametrize("moves", range(3))
def test_a_publication_that_broke_off_is_finished(spark, tmp_path, monkeypatch, moves):
    path = f"{tmp_path}/table"
    both = lambda add: rows(spark, range(3), add=add).unionByName(rows(spark, range(3), "2024-01-06", add))
    write_audit_publish(both(0), path, ["day"], GOOD)
    move, done = publishing._move, []

    def failing(*args):
        if len(done) == moves:
            raise OSError("lost")
        done.append(args)
        move(*args)

    monkeypatch.setattr(publishing, "_move", failing)
    if moves < 2:
        with pytest.raises(OSError):
            write_audit_publish(both(50), path, ["day"], GOOD)
    else:
        write_audit_publish(both(50), path, ["day"], GOOD)
    monkeypatch.setattr(publishing, "_move", move)
    recover(spark, path)
    spark.catalog.refreshByPath(path)
    assert content(spark, path) == sorted([(i, i + 50) for i in range(3)] * 2)


def test_a_copy_that_was_never_judged_is_removed(spark, tmp_path):
    path = f"{tmp_path}/table"
    rows(spark, range(3)).write.partitionBy("day").parquet(f"{tmp_path}/_audit/table/lost/data")
    write_audit_publish(rows(spark, range(2)), path, ["day"], GOOD)
    assert content(spark, path) == [(0, 0), (1, 1)] and not (tmp_path / "_audit/table/lost").exists()


@pytest.fixture
def days(tmp_path):
    """Documents in three portions; the second and third bring newer rows for days already cleaned."""

    def portion(n):
        if n == 0:
            land(tmp_path, "2024-01-05", usd=100.0)
            land(tmp_path, "2024-01-06", usd=110.0, holes=(0, 1))
        elif n == 1:
            land(tmp_path, "2024-01-06", usd=111.0, stamp="b", hot=5)
            land(tmp_path, "2024-01-07", usd=120.0)
            (tmp_path / "raw/weather/2024/01/07/broken.json").write_text("{")
        else:
            land(tmp_path, "2024-01-05", usd=99.0, stamp="c", hot=23)

    return portion


def whole(spark, base):
    out = {}
    for dataset in ("weather", "crypto"):
        spark.catalog.refreshByPath(f"{base}/cleaned/{dataset}")
        out[dataset] = sorted(map(str, read_layer(spark, f"{base}/cleaned/{dataset}").collect()))
    return out


def lost(*args):
    raise OSError("lost before the record")


def test_new_files_are_cleaned_once_wherever_a_run_breaks_off(spark, tmp_path, days, monkeypatch):
    base = str(tmp_path)
    assert clean_new_files(spark, base, "weather") == []
    days(0)
    assert [len(clean_new_files(spark, base, d)) for d in ("weather", "crypto")] == [1, 1]
    days(1)
    # Broken off after publishing, before the record of the batch.
    for dataset in ("weather", "crypto"):
        with pytest.raises(StreamingQueryException):
            clean_new_files(spark, base, dataset, commit=lost)
        assert len(committed(spark, base, dataset)) == 1
    # Broken off after the record, before the stream noted the end of the batch.
    def late(spark, path, record):
        record_batch(spark, path, record)
        raise OSError("lost after the record")

    with pytest.raises(StreamingQueryException):
        clean_new_files(spark, base, "weather", commit=late)
    assert len(committed(spark, base, "weather")) == 2
    days(2)
    # Broken off before anything is published.
    monkeypatch.setattr(cleaning, "publish_cleaned", lost)
    with pytest.raises(StreamingQueryException):
        clean_new_files(spark, base, "crypto")
    monkeypatch.undo()
    assert clean_new_files(spark, base, "weather")[-1]["partitions"] == ["year=2024/month=1/day=5"]
    clean_new_files(spark, base, "crypto")
    assert all(clean_new_files(spark, base, d) == [] for d in ("weather", "crypto"))
    assert [r["_unreadable"] for r in committed(spark, base, "weather")] == [0, 1, 0]
    found = whole(spark, base)

    other = tmp_path / "other"
    (other / "raw").parent.mkdir()
    (other / "raw").symlink_to(tmp_path / "raw")
    for day in ("2024-01-05", "2024-01-06", "2024-01-07"):
        raw_to_cleaned(spark, str(other), day)
    assert found == whole(spark, str(other))


def test_a_failing_batch_is_tried_again_or_put_aside(spark, tmp_path):
    base = str(tmp_path)
    land(tmp_path, "2024-01-05")
    clean_new_files(spark, base, "weather")
    land(tmp_path, "2024-01-06", holes=range(20))  # four rows, fewer than a run needs
    with pytest.raises(StreamingQueryException):
        clean_new_files(spark, base, "weather")
    aside = clean_new_files(spark, base, "weather", on_failure="quarantine")
    assert [r["status"] for r in aside] == ["quarantined"]
    assert spark.read.parquet(f"{aside[0]['path']}/data").count() == 4
    land(tmp_path, "2024-01-07")
    assert [r["status"] for r in clean_new_files(spark, base, "weather")] == ["published"]
    spark.catalog.refreshByPath(f"{base}/cleaned/weather")
    assert read_layer(spark, f"{base}/cleaned/weather").count() == 48


def test_quarantine_of_a_daily_run(spark, tmp_path):
    base = str(tmp_path)
    land(tmp_path, "2024-01-05", holes=range(20))
    counts = raw_to_cleaned(spark, base, "2024-01-05", on_failure="quarantine")
    assert counts["weather"]["_quarantined"] == 4 and counts["crypto"]["_rows"] == 1
