"""Look-back by time against plain Python, and rebuilding from the tails of series."""

from __future__ import annotations

import datetime as dt
import random
import statistics
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from strata.operators import series
from strata.operators.series import rolling
from strata.plans import hourly
from strata.plans.layers import cleaned_to_curated, raw_to_cleaned, tails_path
from strata.plans.tails import forget_tails, leave_tail, newest, rows_before, tail_days
from strata.sinks.tables import write_cleaned
from strata.sources.files import read_layer
from strata.streaming.cleaning import clean_new_files
from tests.test_layers import NOW, land
from tests.test_plans import physical

T0 = dt.datetime(2024, 1, 5)
SPECS = {
    "n": ("count", "v", None),
    "total": ("sum", "v", 3),
    "mean": ("avg", "v", 3),
    "least": ("min", "v", None),
    "most": ("max", "w", None),
    "sd": ("stddev", "v", 3),
}


def some_rows(seed, length=250):
    """A series of two thirds of the rows, a null one, gaps, moments that many rows share, rows without one."""
    pick = random.Random(seed)
    rows = []
    for name, n in [("hot", length), (None, length // 4), ("short", 3)]:
        at = -40
        for _ in range(n):
            at += pick.choice([0, 0, 1, 1, 1, 3, 90])
            v = None if pick.random() < 0.15 else round(pick.uniform(-50, 50) + 1e6 * (name == "hot"), 2)
            rows.append((name, None if pick.random() < 0.03 else at, v, pick.randint(0, 9)))
    return rows


def framed(rows, row, width):
    name, at = row[0], row[1]
    own = [r for r in rows if r[0] == name and (r[1] is None if at is None else r[1] is not None and at - width <= r[1] <= at)]
    v, w = [r[2] for r in own if r[2] is not None], [r[3] for r in own]
    sd = round(statistics.stdev(v), 3) if len(v) > 1 else None
    return (len(v), sum(v) if v else None, statistics.fmean(v) if v else None, min(v, default=None), max(w), sd)


def same(got, want):
    return all((a is None and b is None) or (a is not None and b is not None and abs(a - b) < 2e-3) for a, b in zip(got, want))


@pytest.mark.parametrize("kind", ["long", "timestamp", "date"])
@pytest.mark.parametrize("width,chunk", [(0, 16), (1, 1), (2, 3), (7, 2), (300, 16)])
def test_frames_by_value(spark, monkeypatch, kind, width, chunk):
    monkeypatch.setattr(series, "CHUNK_WIDTHS", chunk)
    if width == 0 and kind != "long":
        pytest.skip("a width of nothing is the same for all kinds")
    rows = some_rows(width)
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id long, name string, at int, v double, w int").repartition(5)
    at = {"long": F.col("at"), "date": F.date_add(F.lit(T0.date()), F.col("at")), "timestamp": F.timestamp_seconds(F.col("at") * 60)}[kind]
    df = df.withColumn("at", at)
    got = rolling(df, ["name"], ["at"], width * 60 if kind == "timestamp" else width, SPECS, frame="range")
    assert got.columns == [*df.columns, *SPECS]
    found = got.collect()
    assert sorted(r.id for r in found) == list(range(len(rows)))
    for r in found:
        want = framed(rows, rows[r.id], width)
        assert same([r[c] for c in SPECS], want), (rows[r.id], want)


def test_a_hot_series_spreads_over_tasks(spark):
    df = spark.range(20_000).select(F.lit("hot").alias("name"), F.col("id").alias("at"), F.rand(1).alias("v"))
    got = rolling(df, ["name"], ["at"], 10, {"mean": ("avg", "v", 4)}, frame="range")
    assert "Window" in physical(got) and "_chunk" in physical(got)
    chunks = df.select(F.floor(F.col("at") / 160)).distinct().count()
    assert chunks == 125 and got.count() == 20_000


def test_frames_are_named(spark):
    df = spark.range(3)
    with pytest.raises(ValueError, match="frame is"):
        rolling(df, [], ["id"], 3, {}, frame="groups")
    with pytest.raises(ValueError, match="one order column"):
        rolling(df, [], ["id", "id"], 3, {}, frame="range")
    empty = df.limit(0).withColumn("v", F.lit(1.0))
    assert rolling(empty, [], ["id"], 3, {"m": ("avg", "v", 2)}, frame="range").collect() == []


@pytest.fixture
def hours(spark, tmp_path):
    """Ten days of three series, of which one stops early and one has gaps."""
    rows = []
    for day in range(10):
        for hour in range(0, 24, 2):
            for name, present in (("a", True), ("b", day < 2), ("c", (day * 24 + hour) % 10 == 0)):
                if present:
                    rows.append(((T0 + dt.timedelta(day)).date(), hour, name, float(day * 24 + hour), 0.5, 3.0))
    df = spark.createDataFrame(rows, "date date, hour int, source string, temperature_c double, precipitation_mm double, windspeed_kmh double")
    write_cleaned(df, f"{tmp_path}/cleaned")
    return f"{tmp_path}/cleaned", f"{tmp_path}/tails"


HOW = (["source"], ["date", "hour"], hourly.LOOK_BACK)


def only(layer, days):
    """Makes all other days of the table unreadable."""
    for part in Path(layer).rglob("*.parquet"):
        if int(part.parent.name.split("=")[1]) not in days:
            part.write_bytes(b"not to be read")


def test_rows_before_come_from_the_tail(spark, hours):
    layer, tails = hours
    want = sorted(map(tuple, newest(read_layer(spark, layer, end="2024-01-11"), *HOW).collect()))
    plain = rows_before(spark, layer, tails, *HOW, "2024-01-12")
    assert sorted(map(tuple, plain.collect())) == want
    # A run up to the ninth leaves its tail; the tenth and eleventh are read besides.
    leave_tail(read_layer(spark, layer, end="2024-01-09"), tails, *HOW, None)
    bridged = rows_before(spark, layer, tails, *HOW, "2024-01-12")
    assert sorted(map(tuple, bridged.collect())) == want
    scans = [line for line in physical(bridged).splitlines() if "FileScan" in line and "year#" in line]
    assert scans and all("PartitionFilters: []" not in line for line in scans)
    series_rows = read_layer(spark, layer, "2024-01-10", "2024-01-11").unionByName(rows_before(spark, layer, tails, *HOW, "2024-01-10"))
    leave_tail(series_rows, tails, *HOW, "2024-01-10")
    assert sorted(tail_days(spark, tails)) == ["2024-01-09", "2024-01-11"]
    exact = rows_before(spark, layer, tails, *HOW, "2024-01-12")
    assert sorted(map(tuple, exact.collect())) == want
    only(layer, [])
    exact = rows_before(spark, layer, tails, *HOW, "2024-01-12")
    assert sorted(map(tuple, exact.collect())) == want
    # A series that ended long ago is still in the tail.
    assert exact.filter("source = 'b'").count() == 23


def test_changed_days_make_tails_invalid(spark, hours):
    layer, tails = hours
    for last, start in (("2024-01-07", None), ("2024-01-09", "2024-01-08"), ("2024-01-11", "2024-01-10")):
        leave_tail(read_layer(spark, layer, end=last), tails, *HOW, start)
    forget_tails(spark, tails, [])
    assert sorted(tail_days(spark, tails)) == ["2024-01-07", "2024-01-09", "2024-01-11"]
    forget_tails(spark, tails, ["year=2024/month=1/day=9", "year=2024/month=1/day=10"])
    assert sorted(tail_days(spark, tails)) == ["2024-01-07"]
    leave_tail(read_layer(spark, layer, end="2024-01-06"), tails, *HOW, "2024-01-06")
    assert sorted(tail_days(spark, tails)) == ["2024-01-06"]


def curated(spark, base):
    out = []
    for name in ("daily_summary", "weather_hourly_agg", "crypto_stats"):
        spark.catalog.refreshByPath(f"{base}/curated/{name}")
        out.append(sorted(map(str, spark.read.parquet(f"{base}/curated/{name}").collect())))
    return out


def test_daily_runs_equal_a_full_rebuild(spark, tmp_path):
    """Each day is rebuilt from the tail of the day before; a late document invalidates what it changes."""
    base = str(tmp_path)
    days = [f"2024-01-0{d}" for d in range(1, 6)]
    for i, day in enumerate(days):
        land(tmp_path, day, usd=100.0 + 7 * i, holes=range(i * 3, 12))
        raw_to_cleaned(spark, base, day)
        cleaned_to_curated(spark, base, NOW, day)
        assert max(tail_days(spark, tails_path(base, "weather"))) == day
    step_by_step = curated(spark, base)
    cleaned_to_curated(spark, base, NOW)
    assert curated(spark, base) == step_by_step
    assert list(tail_days(spark, tails_path(base, "weather"))) == [days[-1]]
    for day in days[1:]:  # tails of the single days again
        cleaned_to_curated(spark, base, NOW, day)
    for dataset in ("weather", "crypto"):
        clean_new_files(spark, base, dataset)
    land(tmp_path, "2024-01-03", usd=55.0, stamp="late", hot=20)
    for dataset in ("weather", "crypto"):
        clean_new_files(spark, base, dataset)
        assert not [d for d in tail_days(spark, tails_path(base, dataset)) if d >= "2024-01-03"]
    cleaned_to_curated(spark, base, NOW, "2024-01-03")
    from_there = curated(spark, base)
    cleaned_to_curated(spark, base, NOW)
    assert curated(spark, base) == from_there != step_by_step
