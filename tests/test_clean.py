from __future__ import annotations

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from strata.functions.dates import HOURLY_FORMAT, date_path, folder_of, parse_ts
from strata.functions.numeric import percent_text, rnd
from strata.operators import clean
from strata.operators.clean import (
    approx_quantiles,
    dedup_latest,
    enforce_schema,
    exact_quantiles,
    first_n,
    impute,
    positive,
    range_filter,
)
from strata.operators.flatten import explode_parallel
from strata.schemas import DATE, DOUBLE, INT, struct

NAN = float("nan")


def values(df, col="v"):
    return [r[col] for r in df.collect()]


@pytest.mark.parametrize(
    "x, digits, wanted",
    [(1.005, 2, 1.01), (2.675, 2, 2.68), (-1.005, 2, -1.01), (12.344999999999999, 2, 12.35), (None, 2, None), (1e40, 2, 1e40)],
)
def test_rounding_is_half_up(spark, x, digits, wanted):
    assert values(spark.createDataFrame([(x,)], "v double").select(rnd("v", digits).alias("v"))) == [wanted]


def test_rounding_keeps_nan_and_infinity(spark):
    got = values(spark.createDataFrame([(NAN,), (math.inf,)], "v double").select(rnd("v", 2).alias("v")))
    assert math.isnan(got[0]) and got[1] == math.inf


def test_percent_text(spark):
    assert values(spark.range(1).select(percent_text(F.lit(0.05123), 1).alias("v"))) == ["5.1%"]


def test_bad_times_are_null(spark):
    df = spark.createDataFrame([("2024-01-05T07:00",), ("2024-13-05T07:00",), ("soon",), (None,)], "s string")
    got = values(df.select(parse_ts("s", HOURLY_FORMAT).alias("v")))
    assert got == [dt.datetime(2024, 1, 5, 7), None, None, None]


def test_date_folders(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 5),)], "d date")
    assert values(df.select(date_path("d").alias("v"))) == ["2024/01/05"] == [folder_of("2024-01-05")]


def test_parallel_arrays_are_padded(spark):
    df = spark.sql("SELECT 7 AS id, struct(array('a', 'b', 'c') AS t, array(1.5) AS v) AS d")
    rows = explode_parallel(df, {"time": "d.t", "value": "d.v"}, ["id"]).collect()
    assert [(r.id, r.time, r.value) for r in rows] == [(7, "a", 1.5), (7, "b", None), (7, "c", None)]


def test_range_filter_bounds_nulls_and_nan(spark):
    df = spark.createDataFrame([(-89.0,), (57.0,), (57.1,), (-90.0,), (None,), (NAN,)], "v double")
    assert values(range_filter(df, {"v": (-89, 57)})) == [-89.0, 57.0]
    assert values(range_filter(df, {"v": (-89, 57)}, "keep")) == [-89.0, 57.0, None]
    assert values(range_filter(df, {"v": (0, None)})) == [57.0, 57.1]
    assert values(range_filter(df, {"v": (0, None)}, "keep")) == [57.0, 57.1, None]
    with pytest.raises(ValueError):
        range_filter(df, {"v": (0, 1)}, "maybe")


def test_positive(spark):
    df = spark.createDataFrame([(0.0,), (0.1,), (-1.0,), (None,), (NAN,)], "v double")
    assert values(positive(df, "v")) == [0.1]


def test_dedup_takes_the_first_in_order(spark):
    rows = [(1, 5, "a"), (1, 9, "b"), (1, 9, "c"), (2, None, "d"), (2, 1, "e"), (None, 1, "f"), (None, 2, "g")]
    df = spark.createDataFrame(rows, "k int, at int, v string")
    kept = dedup_latest(df, ["k"], [F.col("at").desc_nulls_last(), F.col("v")])
    assert sorted(values(kept)) == ["b", "e", "g"]


def test_dedup_limits_each_key_before_the_shuffle(spark):
    hot = spark.range(1000, numPartitions=4).select(F.when(F.col("id") < 900, 0).otherwise(F.col("id")).alias("k"), "id")
    plan = dedup_latest(hot, ["k"], [F.desc("id")])._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_first_n(spark):
    df = spark.createDataFrame([(k, v) for k in "ab" for v in range(40)], "k string, v int")
    kept = first_n(df, ["k"], [F.desc("v")], 30)
    assert kept.count() == 60 and kept.agg(F.min("v")).head()[0] == 10


def brute_quantile(xs, q):
    xs = sorted(x for x in xs if x is not None)
    return xs[max(math.ceil(len(xs) * q), 1) - 1] if xs else None


@pytest.mark.parametrize("q", [0.0, 0.1, 0.5, 0.99, 1.0])
def test_exact_quantiles_against_brute_force(spark, q):
    pick = random.Random(7)
    rows = []
    for i in range(6000):
        group = "hot" if i % 3 else f"g{i % 5}"
        rows.append((group, pick.choice([None, 1.0, 1.0, pick.gauss(0, 10), float(pick.randint(0, 9))]), pick.random()))
    rows += [("empty", None, 1.0), (None, 4.0, None)]
    df = spark.createDataFrame(rows, "g string, x double, y double").repartition(7)
    got = {r.g: (r.x, r.y) for r in exact_quantiles(df, ["x", "y"], q, ["g"], accuracy=200).collect()}
    for group in {r[0] for r in rows}:
        want = tuple(brute_quantile([r[i] for r in rows if r[0] == group], q) for i in (1, 2))
        assert got[group] == want, group
    whole = exact_quantiles(df, ["x", "y"], q, accuracy=200).head()
    assert (whole.x, whole.y) == tuple(brute_quantile([r[i] for r in rows], q) for i in (1, 2))


def test_approx_quantile_is_an_element_close_by(spark):
    df = spark.range(10001).select(F.col("id").cast("double").alias("v"))
    assert abs(approx_quantiles(df, ["v"]).head().v - 5000) <= 10


def test_impute_takes_median_then_default(spark):
    df = spark.createDataFrame([(1, None, None), (2, 0.0, None), (3, 0.0, None), (4, 9.0, None)], "id int, a double, b double")
    filled = impute(df, {"a": 15.0, "b": 10.0}, exact_quantiles(df, ["a", "b"])).orderBy("id").collect()
    assert [(r.a, r.b) for r in filled] == [(0.0, 10.0), (0.0, 10.0), (0.0, 10.0), (9.0, 10.0)]


def test_impute_by_group(spark):
    df = spark.createDataFrame([("x", 1.0), ("x", None), ("y", None), (None, None)], "g string, v double")
    filled = impute(df, {"v": 7.0}, exact_quantiles(df, ["v"], by=["g"]), by=["g"])
    assert sorted((r.g or "", r.v) for r in filled.collect()) == [("", 7.0), ("x", 1.0), ("x", 1.0), ("y", 7.0)]
    assert filled.columns == ["g", "v"] or set(filled.columns) == {"g", "v"}


def test_impute_of_nothing(spark):
    df = spark.createDataFrame([], "v double")
    assert impute(df, {"v": 1.0}, exact_quantiles(df, ["v"])).count() == 0


def test_enforce_schema(spark):
    schema = struct(("date", "hour"), date=DATE, hour=INT, v=DOUBLE)
    rows = [("x", "5", "2024-01-05", "1.5"), ("x", "5", "bad", "1"), ("x", None, None, "2"), ("x", "6", "2024-01-05", "n/a")]
    df = spark.createDataFrame(rows, "extra string, hour string, date string, v string")
    good, rejected = enforce_schema(df, schema)
    assert good.columns == ["date", "hour", "v"]
    assert [f.dataType for f in good.schema.fields] == [DATE, INT, DOUBLE]
    day = dt.date(2024, 1, 5)
    assert [tuple(r) for r in good.collect()] == [(day, 5, 1.5), (day, 6, None)]
    assert [r.rejected for r in rejected.collect()] == [["date"], ["date", "hour"]]


def test_null_groups_are_filled_with_their_own_median(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), (None, None), ("a", 5.0), ("a", None), ("b", None)], "g string, v double")
    filled = impute(df, {"v": 99.0}, exact_quantiles(df, ["v"], by=["g"]), ["g"])
    got = sorted((r.g or "", r.v) for r in filled.collect())
    assert got == [("", 1.0), ("", 1.0), ("", 3.0), ("a", 5.0), ("a", 5.0), ("b", 99.0)]


@pytest.mark.parametrize("most", [50_000, 2])
def test_medians_of_groups_by_broadcast_and_by_join(spark, monkeypatch, most):
    monkeypatch.setattr(clean, "MOST_GROUPS", most)
    rows = [(g, float(i * i % 101)) for g in ("a", "b", None) for i in range(40)] + [("none", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    found = clean.exact_quantiles(df, ["v"], by=["g"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert ("BroadcastHashJoin [coalesce(g" in plan) == (most > 2)
    want = {g: sorted(v for h, v in rows if h == g)[19] for g in ("a", "b", None)}
    assert {r.g: r.v for r in found.collect()} == want
