"""Layers as named tables whose entries outlast a session.

A table's entry, its place, columns and partition columns, is a small file in a catalog folder. Registering a
table reads the columns of all its files, joins them with those recorded before, and refuses a column
whose type has changed; then it enters an external table with its partitions into the session catalog. A
later session, of the same application or another, enters all recorded tables from the folder. No
metastore is needed; where one is configured, the tables are entered there.
"""

from __future__ import annotations

import json
import re

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from strata.session import delete_path
from strata.sinks.publish import children, exists, get_text, put_text


class SchemaClashError(ValueError):
    """Raised when files hold a column in two types, or in another type than recorded."""


def catalog_folder(spark: SparkSession) -> str:
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_catalog"


def register_table(spark: SparkSession, name: str, path: str, folder: str | None = None) -> DataFrame:
    """Enter the Parquet files below ``path`` as the table ``name``, with the columns of all files and runs.

    Columns that files lack are null. Registering again adds new columns and partitions; columns that
    no file has any more stay. Clashing types raise `SchemaClashError`, and the entry stays as it was.
    """
    folder = folder or catalog_folder(spark)
    try:
        found = spark.read.option("mergeSchema", True).parquet(path).schema
    except (PySparkException, Py4JJavaError) as error:
        if "CANNOT_MERGE_SCHEMAS" not in str(error):
            raise
        raise SchemaClashError(f"{name}: files hold a column in two types") from error
    at = f"{folder}/{name}.json"
    known = json.loads(get_text(spark, at)) if exists(spark, at) else None
    by = partition_columns(spark, path)
    if known:
        if known["partitions"] != by:
            raise SchemaClashError(f"{name}: partitioned by {by}, recorded by {known['partitions']}")
        found = joined(name, T.StructType.fromJson(known["schema"]), found)
    data = [f for f in found if f.name not in by]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in [*data, *[found[c] for c in by]]])
    entry = {"path": path, "partitions": by, "schema": schema.jsonValue()}
    put_text(spark, at, json.dumps(entry))
    return _enter(spark, name, entry)


def open_catalog(spark: SparkSession, folder: str | None = None) -> list[str]:
    """Enter all recorded tables into the session catalog, with the partitions they have now; their names."""
    folder = folder or catalog_folder(spark)
    entries = [at for at in children(spark, folder) if at.endswith(".json")]
    names = [at.rsplit("/", 1)[1].removesuffix(".json") for at in entries]
    for name, at in zip(names, entries):
        _enter(spark, name, json.loads(get_text(spark, at)))
    return names


def drop_table(spark: SparkSession, name: str, folder: str | None = None) -> None:
    """Forget a table; its files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {quoted(name)}")
    delete_path(spark, f"{folder or catalog_folder(spark)}/{name}.json")


def joined(name: str, known: T.StructType, found: T.StructType) -> T.StructType:
    """The columns of both, in the recorded order first; a column of two types raises."""
    types = {f.name: f.dataType for f in known}
    clashes = [f"{f.name} is {f.dataType.simpleString()}, recorded as {types[f.name].simpleString()}" for f in found if types.get(f.name, f.dataType) != f.dataType]
    if clashes:
        raise SchemaClashError(f"{name}: {'; '.join(clashes)}")
    return T.StructType([*known.fields, *[f for f in found if f.name not in types]])


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """Names of the partition folders on the way to the first file; folders with ``_`` and ``.`` hold none."""
    by, at = [], path.rstrip("/")
    while below := [x for x in children(spark, at) if re.match(r"[^_.][^=/]*=", x.rsplit("/", 1)[1])]:
        at = below[0]
        by.append(at.rsplit("/", 1)[1].split("=")[0])
    return by


def quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def _enter(spark: SparkSession, name: str, entry: dict) -> DataFrame:
    """The external table of an entry, in place of an older one of its name."""
    by, table = entry["partitions"], quoted(name)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in T.StructType.fromJson(entry["schema"]))
    parted = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in by)})" if by else ""
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(name.rsplit('.', 1)[0])}")
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    path = entry["path"].replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet{parted} LOCATION '{path}'")
    if by:
        spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    return spark.table(name)
