"""Session settings and the shared scratch folder."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "strata", master: str | None = None, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own machine: executors elsewhere could
    neither see it nor find it again after a restart.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):  # local-cluster has executors of its own
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="strata-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as a table in the shared scratch folder, and read from there.

    For a frame that several passes read: they scan the table's columns instead of each working the
    frame out again, and a lost executor costs no more than its own scan. `unstage` removes the copy.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    staged = df.sparkSession.read.schema(df.schema).parquet(path)
    staged._staged_at = path
    return staged


def delete_path(spark: SparkSession, path: str) -> None:
    """Deletes a file or folder in whatever store it lies; a missing one is no error."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def unstage(*frames: DataFrame) -> None:
    """Removes the copies behind frames that `stage` gave, once nothing will read them again."""
    for df in frames:
        delete_path(df.sparkSession, df._staged_at)


def release(spark: SparkSession) -> None:
    """Lets Spark remove the shuffle files of finished steps.

    They go when the driver collects the garbage that refers to them, which a driver with little to do
    may put off for half an hour, while the files fill the executors' disks.
    """
    gc.collect()
    spark._jvm.System.gc()
