from __future__ import annotations

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from strata.functions.numeric import rnd
from strata.operators.series import bands, change_pct, even_chunks, look_back, rolling
from strata.plans import hourly, price

NOW = dt.datetime(2024, 2, 1)


def series(spark, seed, length=400):
    """One series of two thirds of the rows, with gaps, and some short ones."""
    pick = random.Random(seed)
    rows = []
    for entity, n in [("hot", length), ("short", 3), ("mid", length // 3), ("one", 1)]:
        at = 0
        for _ in range(n):
            at += pick.choice([1, 1, 1, 2, 50])
            rows.append((entity, at, None if pick.random() < 0.1 else round(pick.uniform(-50, 50), 2)))
    return rows, spark.createDataFrame(rows, "entity string, at int, v double").repartition(5)


EXPRS = {
    "mean": lambda w: rnd(F.avg("v").over(w.rowsBetween(-6, 0)), 4),
    "n": lambda w: F.count("v").over(w.rowsBetween(-6, 0)),
    "before": lambda w: F.lag("v").over(w),
    "third": lambda w: F.lag("v", 3).over(w),
}


@pytest.mark.parametrize("width", [1, 2, 5, 7, 30, 1000, 10**6])
def test_chunks_do_not_change_the_result(spark, width):
    rows, df = series(spark, width)
    plain = look_back(df, ["entity"], ["at"], 6, EXPRS)
    cut = look_back(df, ["entity"], ["at"], 6, EXPRS, chunk=F.floor(F.col("at") / width))
    assert cut.columns == plain.columns
    assert cut.exceptAll(plain).count() == 0 and plain.exceptAll(cut).count() == 0
    assert cut.count() == len(rows)


def crowded(spark):
    """A third of the rows in one moment of one series, another third in the rest of that series."""
    at = F.when(F.col("id") % 3 == 0, 500).otherwise(F.col("id") % 1000)
    entity = F.when(F.col("id") % 3 < 2, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 7))
    return spark.range(30000).select("id", entity.alias("entity"), at.alias("at"), (F.col("id") * 7 % 101).alias("v"))


def test_even_chunks_do_not_change_the_result(spark):
    df, by, order = crowded(spark), ["entity"], ["at", "id"]
    plain = look_back(df, by, order, 6, EXPRS)
    cut = look_back(even_chunks(df, by, order, 60), by, order, 6, EXPRS, F.col("_part"), F.floor(F.col("_part") / 7)).drop("_part")
    assert cut.exceptAll(plain).count() == 0 and plain.exceptAll(cut).count() == 0


def test_even_chunks_split_a_crowded_moment(spark):
    parts = even_chunks(crowded(spark), ["entity"], ["at", "id"], 60)
    sizes = parts.groupBy("entity", "_part").count()
    assert sizes.agg(F.max("count")).head()[0] < 2500
    assert parts.select("_part").distinct().count() > 30


def test_rolling_against_brute_force(spark):
    rows, df = series(spark, 3)
    got = {
        (r.entity, r.at): (r.mean, r.sd)
        for r in rolling(
            df, ["entity"], ["at"], 7, {"mean": ("avg", "v", 2), "sd": ("stddev", "v", 4)}, F.floor(F.col("at") / 20)
        ).collect()
    }
    for entity in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == entity]
        for i, (_, at, _) in enumerate(own):
            frame = [r[2] for r in own[max(0, i - 6) : i + 1] if r[2] is not None]
            mean, sd = got[(entity, at)]
            assert mean == pytest.approx(statistics.mean(frame), abs=0.0051) if frame else mean is None
            assert sd == pytest.approx(statistics.stdev(frame), abs=0.000051) if len(frame) > 1 else sd is None


def test_change_after_nothing_and_after_zero(spark):
    df = spark.createDataFrame([(1, 10.0), (2, 12.5), (3, 0.0), (4, 5.0), (5, 4.0)], "at int, v double")
    out = look_back(df.withColumn("k", F.lit(1)), ["k"], ["at"], 1, {"c": change_pct("v", 4)}).orderBy("at")
    assert [r.c for r in out.collect()] == [None, 25.0, -100.0, None, -20.0]


def test_bands_use_the_rounded_parts(spark):
    row = bands(spark.sql("SELECT 10.12D AS a, 0.0061D AS s"), "a", "s", 2, 2, "up", "low").head()
    assert (row.up, row.low) == (10.13, 10.11)


def test_price_stats_of_one_row(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 5), "BTC", 100.0)], "date date, currency string, rate_usd double")
    row = price.stats(df, NOW).head()
    assert row.rate_usd_7d_avg == 100.0 and row.processed_at == NOW
    assert row.rate_usd_7d_stddev is None and row.price_change_pct is None and row.volatility_band_upper is None


def test_price_stats_keep_currencies_apart(spark):
    rows = [(dt.date(2023, 12, 31 - i), c, v * (i + 1)) for i in range(3) for c, v in (("A", 1.0), ("B", 1000.0))]
    rows += [(dt.date(2024, 1, 1), "A", 2.0)]
    df = spark.createDataFrame(rows, "date date, currency string, rate_usd double")
    last = {r.currency: r for r in price.stats(df, NOW).filter("date >= '2023-12-31'").orderBy("date").collect()}
    assert last["A"].price_change_pct == 100.0 and last["A"].rate_usd_7d_avg == 2.0
    assert last["B"].rate_usd_7d_avg == 2000.0


def test_hourly_windows_cross_days_and_months(spark):
    start = dt.datetime(2024, 1, 31)
    rows = []
    for h in range(48):
        at = start + dt.timedelta(hours=h)
        rows.append((at.date(), at.hour, float(h), 0.0 if h else None, 31.0 if h == 5 else 30.0, "s"))
    df = spark.createDataFrame(
        rows, "date date, hour int, temperature_c double, precipitation_mm double, windspeed_kmh double, source string"
    )
    out = hourly.enriched(df, NOW).orderBy("date", "hour").collect()
    assert len(out) == 48
    assert out[24].temp_6h_rolling_avg == 24.0  # starts anew at midnight
    assert out[24].temp_24h_rolling_avg == 12.5  # goes on across the month's end
    assert out[47].temp_24h_rolling_avg == 35.5
    assert out[0].is_rainy is None and out[1].is_rainy is False
    assert out[5].is_windy is True and out[4].is_windy is False
    assert out[0].heat_index_c == round(0 + 13.2 - 0.7 * 30 / 3.6 - 4.0, 2)
