"""Recorded tables: merged columns, clashes, new partitions, and sessions that come later."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from strata.sinks.tables import write_cleaned
from strata.sources.catalog import SchemaClashError, drop_table, open_catalog, partition_columns, register_table
from tests.test_storage import daily


@pytest.fixture
def folder(tmp_path):
    return f"{tmp_path}/catalog"


def test_a_later_session_reads_by_name(spark, tmp_path, folder):
    path = f"{tmp_path}/cleaned"
    write_cleaned(daily(spark), path)
    assert partition_columns(spark, path) == ["year", "month", "day"]
    assert register_table(spark, "lake_cleaned.daily", path, folder).count() == 12
    later = spark.newSession()
    assert later.sql("SELECT count(*) AS n FROM lake_cleaned.daily WHERE month = 2").head().n == 6
    # An application without the entry finds it in the folder, partitions written since included.
    spark.sql("DROP TABLE lake_cleaned.daily")
    write_cleaned(daily(spark).withColumn("date", F.col("date") + F.expr("INTERVAL 1 YEAR")), path)
    assert open_catalog(later, folder) == ["lake_cleaned.daily"]
    found = later.sql("SELECT year, count(*) AS n FROM lake_cleaned.daily GROUP BY year ORDER BY year").collect()
    assert [tuple(r) for r in found] == [(2024, 12), (2025, 12)]
    plan = later.sql("SELECT v FROM lake_cleaned.daily WHERE year = 2025 AND day = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    drop_table(later, "lake_cleaned.daily", folder)
    assert open_catalog(later, folder) == [] and not later.catalog.tableExists("lake_cleaned.daily")
    assert spark.read.parquet(path).count() == 24


def test_columns_of_all_files_and_runs(spark, tmp_path, folder):
    path = f"{tmp_path}/t"
    spark.range(2).write.parquet(f"{path}/p=1")
    spark.range(3).withColumn("extra", F.lit("x")).write.parquet(f"{path}/p=2")
    register_table(spark, "merged", path, folder)
    assert spark.table("merged").columns == ["id", "extra", "p"]
    assert spark.sql("SELECT count(*) AS n, count(extra) AS x FROM merged").head() == (5, 3)
    spark.range(4).withColumn("more", F.lit(1.5)).write.parquet(f"{path}/p=3")
    register_table(spark, "merged", path, folder)
    assert spark.sql("SELECT count(*) AS n, count(extra) AS x, sum(more) AS m FROM merged").head() == (9, 3, 6.0)
    drop_table(spark, "merged", folder)


def test_clashing_types_are_refused(spark, tmp_path, folder):
    path = f"{tmp_path}/t"
    spark.range(2).write.parquet(f"{path}/p=1")
    register_table(spark, "clash", path, folder)
    spark.createDataFrame([("a",)], "id string").write.parquet(f"{path}/p=2")
    with pytest.raises(SchemaClashError):
        register_table(spark, "clash", path, folder)
    # Also where all files agree, but not with what was recorded; the entry stays.
    other = f"{tmp_path}/other"
    spark.createDataFrame([("a",)], "id string").write.parquet(f"{other}/p=1")
    with pytest.raises(SchemaClashError, match="id is string, recorded as bigint"):
        register_table(spark, "clash", other, folder)
    spark.range(1).write.parquet(f"{tmp_path}/flat")
    with pytest.raises(SchemaClashError, match="partitioned by"):
        register_table(spark, "clash", f"{tmp_path}/flat", folder)
    assert spark.sql("SELECT count(*) AS n FROM clash WHERE p = 1").head().n == 2
    drop_table(spark, "clash", folder)


def test_an_unpartitioned_table(spark, tmp_path, folder):
    spark.range(3).write.parquet(f"{tmp_path}/flat")
    assert register_table(spark, "flat", f"{tmp_path}/flat", folder).count() == 3
    drop_table(spark, "flat", folder)
