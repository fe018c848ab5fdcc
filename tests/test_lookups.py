"""Stored sketches, references by bits, counts from footers, expired partitions."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from strata.functions.bits import PAGE_BITS, bit_pages, bit_set, page_of, place_of
from strata.operators import checks
from strata.operators.checks import Suite, orphan_counts, orphan_rows
from strata.operators.sketches import keep_sketches, merged, quantiles, sketches
from strata.params import RetentionRule
from strata.sinks.publish import expire_partitions
from strata.sinks.tables import write_cleaned
from strata.sources.files import read_layer
from strata.sources.footers import footer_counts
from tests.test_plans import physical
from tests.test_storage import DAYS, daily


def test_sketches_replace_days_and_merge(spark, tmp_path):
    path, rng = f"{tmp_path}/sketches", random.Random(1)
    rows = [(d, s, None if rng.random() < 0.1 else round(rng.uniform(-9, 9), 3)) for d in DAYS for s in ("a", None) for _ in range(60)]
    df = spark.createDataFrame(rows, "date date, source string, v double")
    keep_sketches(df.withColumn("v", F.lit(0.0)), path, ["source"], ["v"])
    keep_sketches(df, path, ["source"], ["v"])
    stored = spark.read.parquet(path)
    for by, key in ((["date", "source"], lambda r: (r[0], r[1])), (["source"], lambda r: (r[1],)), ([], lambda r: ())):
        for q in (0.25, 0.5, 1.0):
            want = {}
            for r in rows:
                want.setdefault(key(r), []).append(r[2])
            for r in quantiles(stored, by, q).collect():
                values = sorted(v for v in want[tuple(r[c] for c in by)] if v is not None)
                assert r.n == len(values) and r.value == values[max(0, -int(-len(values) * q // 1) - 1)]


def test_a_sketch_of_nothing(spark):
    df = spark.createDataFrame([("a", None), ("b", 1.5)], "k string, v double")
    found = {r.k: (r.n, r.value) for r in quantiles(sketches(df, ["k"], ["v"]), ["k"]).collect()}
    assert found == {"a": (0, None), "b": (1, 1.5)}
    assert quantiles(sketches(df.limit(0), ["k"], ["v"]), ["k"]).collect() == []


def test_ranks_of_thinned_sketches(spark):
    df = spark.range(60_000).select((F.col("id") % 9).alias("part"), F.shuffle(F.array("id"))[0].cast("double").alias("v"))
    stored = sketches(df, ["part"], ["v"], 512)
    assert merged(stored, []).select(F.octet_length("sketch")).head()[0] < 20_000
    for q in (0.01, 0.5, 0.9):
        assert abs(quantiles(stored, [], q).head().value / 60_000 - q) < 0.01


def test_bits_of_pages(spark):
    kept = {0, 1, 7, 8, 9, 4095, PAGE_BITS - 1, PAGE_BITS, 3 * PAGE_BITS + 13}
    pages = bit_pages(spark.createDataFrame([(i,) for i in kept], "i long"), F.col("i"))
    asked = spark.range(4 * PAGE_BITS).withColumn("_page", page_of(F.col("id"))).join(pages, "_page")
    assert {r.id for r in asked.where(bit_set(F.col("_bits"), place_of(F.col("id")))).collect()} == kept


CHILD = [None, 1, 1, 2, 5, 70_000, -3, 2**31 - 1, 9] + [4] * 500 + [8] * 300


@pytest.mark.parametrize("parent", [[1, 2, 4], [None, 4], [-3, 70_000, 70_000], [], [None], [2**31 - 1, -(2**31)]])
@pytest.mark.parametrize("kinds", [("long", "int"), ("int", "long"), ("string", "int"), ("long", "string")])
def test_orphans_by_bits_are_those_of_the_join(spark, parent, kinds):
    cast = lambda v, kind: None if v is None else str(v) if kind == "string" else v
    child = spark.createDataFrame([(cast(v, kinds[0]),) for v in CHILD], f"k {kinds[0]}")
    known = spark.createDataFrame([(cast(v, kinds[1]),) for v in parent], f"id {kinds[1]}")
    want = sum(v not in parent for v in CHILD)
    assert orphan_rows(child, "k", known, "id").head().orphans == want
    assert orphan_counts(child, "k", known, "id").agg(F.coalesce(F.sum("rows"), F.lit(0))).head()[0] == want
    assert orphan_rows(child, "absent", known, "id").head().orphans == (0 if None in parent else len(CHILD))
    report = Suite("s").references("k", known, "id").run(child)
    assert [r.value for r in report.results] == [float(want)]


def test_child_rows_are_not_shuffled(spark, monkeypatch):
    child = spark.range(1000).select((F.col("id") % 3).alias("k"))
    known = spark.range(100)
    plan = physical(orphan_rows(child, "k", known, "id"))
    # The parent's pages are put together by a shuffle and broadcast; the child's rows only meet one partial count.
    assert plan.count("Exchange hashpartitioning(") == 1 and "hashpartitioning(_page" in plan and "LeftAnti" not in plan
    monkeypatch.setattr(checks, "LARGEST", 50)
    joined = orphan_rows(child, "k", known, "id")
    assert "LeftAnti" in physical(joined)
    assert joined.head().orphans == 0


def test_counts_from_footers(spark, tmp_path):
    path = f"{tmp_path}/cleaned"
    write_cleaned(daily(spark).withColumn("v", F.when(F.col("hour") > 0, F.col("v") + F.col("hour"))), path)
    found = footer_counts(spark, path, ["year", "month", "day"], ["hour", "v", "date"])
    plan = physical(found)
    assert "PushedAggregation: [COUNT(*), MIN(hour)" in plan and "PushedGroupBy: [year, month, day]" in plan
    rows = sorted(map(tuple, found.collect()))
    assert rows == [(d.year, d.month, d.day, 3, 0, 2.0, d, 2, 3.0, d) for d in DAYS]
    assert [r.rows for r in footer_counts(spark, path, []).collect()] == [12]


def test_expired_partitions(spark, tmp_path):
    path = f"{tmp_path}/cleaned"
    write_cleaned(daily(spark), path)
    rule = RetentionRule(1, 1, 1)
    assert expire_partitions(spark, path, RetentionRule(1, 1), DAYS[-1]) == []
    assert expire_partitions(spark, path, rule, DAYS[-1]) == ["year=2024/month=1/day=30", "year=2024/month=1/day=31"]
    assert {r.date for r in read_layer(spark, path).select("date").collect()} == set(DAYS[2:])
    for day in ("2024/01/01", "2024/02/02", "other/x/y"):
        (tmp_path / "raw" / day).mkdir(parents=True)
    assert expire_partitions(spark, f"{tmp_path}/raw", rule, dt.date(2024, 2, 2)) == ["2024/01/01"]
    daily(spark).write.partitionBy("date").parquet(f"{tmp_path}/curated")
    assert expire_partitions(spark, f"{tmp_path}/curated", rule, DAYS[-1]) == ["date=2024-01-30", "date=2024-01-31"]
