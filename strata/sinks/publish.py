"""Write, audit, publish: new partitions are written once, checked, and moved into place or put aside.

The partitions are first written beside the table, in ``_audit`` of its parent folder, which readers do not
list. A suite judges this copy. If it passes, a manifest names its partitions and each takes the place of
the one in the table by a rename; nothing is written a second time. A run that breaks off after the
manifest is finished by the next one, so that a table never stays between two states; one that
breaks off before it leaves the table as it was. A table has one writer at a time. While a partition
changes places a reader may miss it for a moment, and in stores without renames of folders a move copies.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession

from strata.operators.checks import QualityGateError, Suite, SuiteReport
from strata.params import RetentionRule
from strata.session import delete_path
from strata.sinks.tables import write_partitioned

MANIFEST = "manifest.json"


@dataclass(frozen=True)
class Outcome:
    """What became of a write: ``published`` or ``quarantined``, where it lies, and its partition folders."""

    status: str
    path: str
    partitions: list[str]
    report: SuiteReport


def write_audit_publish(
    df: DataFrame,
    path: str,
    by: list[str],
    suite: Suite,
    on_failure: str = "raise",
    quarantine: str | None = None,
    seen: Observation | None = None,
    before: Callable[[list[str]], None] | None = None,
) -> Outcome:
    """Replace the partitions of the table at ``path`` that ``df`` has rows for, if ``suite`` passes them.

    ``on_failure="raise"`` leaves nothing of a failing write behind and raises `QualityGateError`;
    ``"quarantine"`` keeps its partitions, with the failed checks in ``report.json``, in a folder of its own
    under ``quarantine``, or under ``_quarantine`` beside the table. Without ``by`` the whole table is
    replaced. ``seen`` gets the row and null counts of the one write. ``before`` is called with the
    partitions once they have passed, before the first of them changes.
    """
    if on_failure not in ("raise", "quarantine"):
        raise ValueError(f"on_failure is 'raise' or 'quarantine', not {on_failure!r}")
    spark = df.sparkSession
    recover(spark, path)
    audit, name = f"{_audits(path)}/{uuid.uuid4().hex}", path.rstrip("/").rsplit("/", 1)[1]
    data = f"{audit}/data"
    write_partitioned(df, data, by, seen)
    try:
        report = suite.run(_read(df, data))
    except Exception:
        delete_path(spark, audit)
        raise
    found = _partitions(spark, data, by)
    if not report.failed:
        if before:
            before(found)
        put_text(spark, f"{audit}/{MANIFEST}", json.dumps(found))
        publish(spark, audit, path)
        return Outcome("published", path, found, report)
    if on_failure == "raise":
        delete_path(spark, audit)
        raise QualityGateError(report)
    aside = f"{quarantine or path.rstrip('/').rsplit('/', 1)[0] + '/_quarantine'}/{name}/{audit.rsplit('/', 1)[1]}"
    checks = [{"check": r.check, "passed": r.passed, "detail": r.detail} for r in report.results]
    put_text(spark, f"{audit}/report.json", json.dumps({"suite": report.suite, "checks": checks}))
    _move(spark, audit, aside)
    return Outcome("quarantined", aside, found, report)


def expire_partitions(spark: SparkSession, path: str, rule: RetentionRule, as_of: dt.date) -> list[str]:
    """Delete the day partitions of a table that are older than ``rule`` keeps them; gives their folders.

    The folders may be ``date=``, ``year=/month=/day=`` or ``yyyy/mm/dd``; others are left alone, and so is
    everything under a rule that keeps all.
    """
    if rule.expire_days is None:
        return []
    oldest, gone = as_of - dt.timedelta(rule.expire_days), []
    for by, pattern in ((["date"], r"date=(\d+)-(\d+)-(\d+)"), (["year", "month", "day"], r"year=(\d+)/month=(\d+)/day=(\d+)"), (3, r"(\d{4})/(\d\d)/(\d\d)")):
        for partition in _partitions(spark, path, by):
            found = re.fullmatch(pattern, partition)
            if found and dt.date(*map(int, found.groups())) < oldest:
                delete_path(spark, f"{path}/{partition}")
                gone.append(partition)
    return gone


def publish(spark: SparkSession, audit: str, path: str) -> None:
    """Moves the partitions that the manifest of ``audit`` names to the table; goes on where it stopped."""
    for partition in json.loads(get_text(spark, f"{audit}/{MANIFEST}")):
        new = f"{audit}/data/{partition}".rstrip("/")
        if exists(spark, new):  # else it was moved before
            _move(spark, new, f"{path}/{partition}".rstrip("/"))
    delete_path(spark, audit)


def recover(spark: SparkSession, path: str) -> None:
    """Finishes a publication of the table that broke off, and removes copies that never were judged."""
    for audit in children(spark, _audits(path)):
        if exists(spark, f"{audit}/{MANIFEST}"):
            publish(spark, audit, path)
        else:
            delete_path(spark, audit)


def _audits(path: str) -> str:
    parent, name = path.rstrip("/").rsplit("/", 1)
    return f"{parent}/_audit/{name}"


def _read(df: DataFrame, path: str) -> DataFrame:
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _partitions(spark: SparkSession, path: str, by: list[str] | int) -> list[str]:
    """Folders of the partitions below ``path``, relative to it; the table itself without ``by``. A number
    asks for folders of any names at that depth."""
    if not by:
        return [""]
    names = ["*"] * by if isinstance(by, int) else [f"{c}=*" for c in by]
    fs, at = _at(spark, path)
    root = fs.makeQualified(at).toString()
    pattern = spark._jvm.org.apache.hadoop.fs.Path(at, "/".join(names))
    return sorted(s.getPath().toString()[len(root) + 1 :] for s in fs.globStatus(pattern))


def _move(spark: SparkSession, source: str, target: str) -> None:
    fs, at = _at(spark, target)
    fs.delete(at, True)
    fs.mkdirs(at.getParent())
    if not fs.rename(_at(spark, source)[1], at):
        raise OSError(f"could not move {source} to {target}")


def _at(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _at(spark, path)
    return fs.exists(at)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if it is missing."""
    fs, at = _at(spark, path)
    return sorted(f"{path}/{s.getPath().getName()}" for s in fs.listStatus(at)) if fs.exists(at) else []


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes a small file whole or not at all: beside its place first, then by a rename."""
    fs, at = _at(spark, path)
    draft = _at(spark, f"{path}.{uuid.uuid4().hex}.tmp")[1]
    out = fs.create(draft, True)
    out.write(bytearray(text, "utf-8"))
    out.close()
    fs.delete(at, False)
    if not fs.rename(draft, at):
        raise OSError(f"could not write {path}")


def get_text(spark: SparkSession, path: str) -> str:
    fs, at = _at(spark, path)
    stream = fs.open(at)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()
