from __future__ import annotations

import csv
import datetime as dt
import gzip
import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from strata.schemas import HOURLY_PAYLOAD
from strata.session import scratch_dir, stage
from strata.sinks.tables import emit_metrics, record_history, write_cleaned, write_curated, write_partitioned
from strata.sources.csvtext import lines_of, records
from strata.sources.files import (
    file_inventory,
    inventory_totals,
    land_csv,
    path_exists,
    read_csv_upload,
    read_envelopes,
    read_layer,
    register,
)
from tests.test_plans import physical

DAYS = [dt.date(2024, 1, 30) + dt.timedelta(days=i) for i in range(4)]


def daily(spark, days=DAYS, value=1.0):
    return spark.createDataFrame([(d, h, value) for d in days for h in range(3)], "date date, hour int, v double")


def test_scratch_is_under_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    a, b = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert a != b and a.startswith(root) and b.startswith(root)


def test_stage_reads_back_the_same(spark):
    df = daily(spark)
    staged = stage(df, "t")
    assert staged.schema == df.schema and staged.exceptAll(df).count() == 0
    assert "FileScan" in staged._jdf.queryExecution().executedPlan().toString()


def test_cleaned_write_replaces_only_touched_dates(spark, tmp_path):
    path = str(tmp_path / "cleaned")
    write_cleaned(daily(spark), path)
    write_cleaned(daily(spark, DAYS[:1], 9.0).limit(2), path)
    rows = read_layer(spark, path).groupBy("date").agg(F.count("v").alias("n"), F.max("v").alias("v")).orderBy("date")
    assert [(r.date, r.n, r.v) for r in rows.collect()] == [(DAYS[0], 2, 9.0)] + [(d, 3, 1.0) for d in DAYS[1:]]
    assert read_layer(spark, path).columns == ["date", "hour", "v"]


def test_rewriting_the_same_rows_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "curated")
    for _ in range(2):
        write_curated(daily(spark), path, ["date"])
    assert read_layer(spark, path).count() == 12


def test_curated_write_without_partitions(spark, tmp_path):
    path = str(tmp_path / "plain")
    write_curated(daily(spark), path)
    write_curated(daily(spark, DAYS[:1]), path)
    assert spark.read.parquet(path).count() == 3


@pytest.mark.parametrize("write", [write_cleaned, lambda df, path: write_curated(df, path, ["date"])])
def test_date_range_opens_only_its_folders(spark, tmp_path, write):
    path = str(tmp_path / "layer")
    write(daily(spark), path)
    part = read_layer(spark, path, "2024-01-31", "2024-02-01")
    assert {r.date for r in part.collect()} == set(DAYS[1:3])
    scan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: []" not in scan
    assert len(part.inputFiles()) <= len(read_layer(spark, path).inputFiles())


def test_documents_one_per_file(spark, tmp_path):
    folder = tmp_path / "weather" / "2024" / "01" / "05"
    folder.mkdir(parents=True)
    hourly = {"time": ["2024-01-05T00:00"], "temperature_2m": [1.5], "precipitation": [], "windspeed_10m": [2]}
    good = {"source": "s", "ingested_at": "t", "execution_date": "2024-01-05", "record_count": 1, "data": {"hourly": hourly}}
    (folder / "a.json").write_text(json.dumps(good, indent=2))
    (folder / "b.json").write_text('{"source": "broken", ')
    (folder / "c.txt").write_text("not read")
    with gzip.open(folder / "d.json.gz", "wt") as packed:
        packed.write(json.dumps(good))
    assert read_envelopes(spark, str(tmp_path), "weather", "2024-01-05", HOURLY_PAYLOAD, pattern="*.gz").count() == 1
    rows = read_envelopes(spark, str(tmp_path), "weather", "2024-01-05", HOURLY_PAYLOAD).collect()
    assert len(rows) == 2
    whole = next(r for r in rows if r._corrupt_record is None)
    assert whole.data.hourly.temperature_2m == [1.5] and whole.data.hourly.windspeed_10m == [2.0]


def test_documents_of_a_missing_date_raise(spark, tmp_path):
    with pytest.raises(AnalysisException):
        read_envelopes(spark, str(tmp_path), "weather", "2024-01-05", HOURLY_PAYLOAD)


def test_landed_csv(spark, tmp_path):
    upload = tmp_path / "up.csv"
    upload.write_text('id,name\n1,"a, ""b"""\n2,\n')
    schema = "id int, name string"
    row = land_csv(spark, str(upload), str(tmp_path / "raw"), "orders", "2024-01-05", "T").head()
    assert row.size_kb == upload.stat().st_size / 1024
    assert row.status == "success" and row.uri.endswith("raw/flat_files/2024/01/05/orders_T.csv")
    rows = read_csv_upload(spark, row.uri, schema).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, 'a, "b"'), (2, None)]


def test_csv_is_landed_byte_for_byte(spark, tmp_path):
    texts = {
        "a.csv": b'name,id,extra\r\n"bo\nb",7,z\r\n"c ""q""\n\n,d",8,\r\n',
        "b.csv": b"name,id,extra\nbad,x,\nshort\n\xff\xfe,9,y\n",
    }
    (tmp_path / "up").mkdir()
    for name, text in texts.items():
        (tmp_path / "up" / name).write_bytes(text)
    row = land_csv(spark, str(tmp_path / "up"), str(tmp_path / "raw"), "people", "2024-01-05", "T").head()
    landed = [p.read_bytes() for p in (tmp_path / "raw").rglob("part-*")]
    assert sorted(landed) == sorted(texts.values())
    rows = read_csv_upload(spark, row.uri, "id int, name string, absent date", True, "_bad").collect()
    found = {r.name: (r.id, r.absent, r._bad is not None) for r in rows}
    assert found["bo\nb"] == (7, None, False) and found['c "q"\n\n,d'] == (8, None, False)
    assert found["bad"] == (None, None, True) and found["short"] == (None, None, True) and len(rows) == 5


def test_a_csv_of_many_parts_keeps_its_order(spark, tmp_path):
    upload = tmp_path / "long.csv"
    upload.write_text("id\n" + "\n".join(str(i) for i in range(50_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        row = land_csv(spark, str(upload), str(tmp_path / "raw"), "ids", "2024-01-05", "T").head()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    landed = sorted((tmp_path / "raw").rglob("part-*"))
    assert len(landed) > 10  # one for each block that the file was read in
    assert "".join(p.read_text() for p in landed) == upload.read_text() + "\n"
    assert read_csv_upload(spark, row.uri, "id int").count() == 50_000


def quoted_upload(path, n):
    """Records of which many have quoted values with line breaks, commas, quotes and blank lines."""
    rows = []
    for i in range(n):
        note = ["plain", "two\nlines", 'a "quoted"\n\n, one', "\n" * (i % 9), "x,y", "", "long\n" * (i % 40)][i % 7]
        rows.append((i, note, i % 10))
    with open(path, "w", newline="") as out:
        writer = csv.writer(out, lineterminator="\r\n" if n % 2 else "\n")
        writer.writerow(["note", "extra\nname", "id", "k"])
        writer.writerows([note, "", i, k] for i, note, k in rows)
    return [(i, note or None, k) for i, note, k in rows]


@pytest.mark.parametrize("block", ["500", "4000", "10000000"])
@pytest.mark.parametrize("land", [True, False])
def test_records_with_line_breaks_are_found_in_all_blocks(spark, tmp_path, block, land):
    (tmp_path / "up").mkdir()
    want = quoted_upload(tmp_path / "up" / "a.csv", 700) + quoted_upload(tmp_path / "up" / "b.csv", 351)
    (tmp_path / "up" / "c.csv").write_text("")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        path = str(tmp_path / "up")
        if land:
            path = land_csv(spark, path, str(tmp_path / "raw"), "notes", "2024-01-05", "T").head().uri
        rows = read_csv_upload(spark, path, "id int, note string, k int, absent date", multi_line=True).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted((r.id, r.note or "", r.k) for r in rows) == sorted((i, note or "", k) for i, note, k in want)
    assert all(r.absent is None for r in rows)


def test_a_quote_that_never_closes(spark, tmp_path):
    (tmp_path / "open.csv").write_text('id,note\n1,a\n2,"b\n3,c\n')
    rows = read_csv_upload(spark, str(tmp_path / "open.csv"), "id int, note string", multi_line=True, corrupt="_bad").collect()
    assert (rows[0].id, rows[0].note) == (1, "a") and len(rows) == 2


def test_files_with_different_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,note\n1,a\n")
    (tmp_path / "b.csv").write_text("note,id\na,1\n")
    with pytest.raises(ValueError, match="different headers"):
        read_csv_upload(spark, str(tmp_path), "id int")


def test_one_large_upload_is_read_by_many_tasks(spark, tmp_path):
    quoted_upload(tmp_path / "a.csv", 4000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        lines = lines_of(spark, str(tmp_path / "a.csv"))
        assert lines.select("start").distinct().count() > 10
        found = records(lines).select("record")
        assert "Exchange hashpartitioning(file" in physical(found) and found.count() == 4001
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_csv_without_a_line(spark, tmp_path):
    (tmp_path / "none.csv").write_text("")
    row = land_csv(spark, str(tmp_path / "none.csv"), str(tmp_path / "raw"), "none", "2024-01-05", "T").head()
    assert row.status == "success" and read_csv_upload(spark, row.uri, "id int").count() == 0


@pytest.mark.parametrize("path, reason", [("", "no path provided"), ("absent.csv", "file not found")])
def test_csv_that_is_not_there_is_skipped(spark, tmp_path, path, reason):
    at = str(tmp_path / path) if path else ""
    row = land_csv(spark, at, str(tmp_path / "raw"), "orders", "2024-01-05", "T").head()
    assert (row.status, row.reason, row.uri) == ("skipped", reason, None)
    assert not (tmp_path / "raw").exists()


def test_inventory(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.json").write_text("12345")
    (tmp_path / "y.json").write_text("123")
    (tmp_path / "z.csv").write_text("1")
    total = inventory_totals(file_inventory(spark, str(tmp_path), "*.json")).head()
    assert (total.files, total.bytes) == (2, 8) and total.newest is not None
    assert path_exists(spark, str(tmp_path)) and not path_exists(spark, str(tmp_path / "none"))


def test_registered_table_has_the_columns_of_all_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(2).write.parquet(f"{path}/p=1")
    spark.range(3).withColumn("extra", F.lit("x")).write.parquet(f"{path}/p=2")
    register(spark, "merged_files", path)
    assert spark.sql("SELECT count(*) AS n, count(extra) AS e FROM merged_files").head() == (5, 3)


def test_counts_taken_while_writing(spark, tmp_path):
    df = spark.createDataFrame([(1, None, "p"), (2, "x", "p"), (None, None, "q")], "a int, b string, part string")
    seen = Observation("counts")
    write_partitioned(df, str(tmp_path / "t"), ["part"], seen)
    assert seen.get == {"_rows": 3, "a": 1, "b": 2, "part": 0}


def test_history_of_a_rerun(spark, tmp_path):
    path = str(tmp_path / "history")
    schema = "layer string, dataset string, run_date date, row_count bigint"
    for count in (10, 12):
        record_history(spark.createDataFrame([("raw", "weather", DAYS[0], count)], schema), path)
    record_history(spark.createDataFrame([("raw", "weather", DAYS[1], 7)], schema), path)
    rows = spark.read.parquet(path).orderBy("run_date").collect()
    assert [r.row_count for r in rows] == [12, 7]


def test_metrics_are_appended_by_day(spark, tmp_path):
    path = str(tmp_path / "metrics")
    point = spark.sql("SELECT 'n' AS name, 1D AS value, 'Count' AS unit, map('Layer', 'raw') AS dimensions, timestamp'2024-01-05 10:00:00' AS ts")
    emit_metrics(point, path)
    emit_metrics(point, path)
    assert spark.read.parquet(path).count() == 2
    assert (tmp_path / "metrics" / "metric_date=2024-01-05").exists()
