"""Every registered query against its SQL, and rules all of them keep."""

from __future__ import annotations

import os
import re
from pathlib import Path

import pytest

import __spark_entry__ as registered
from tests.oracle import connect, differences

SF_DIR = os.environ.get("STRATA_TEST_SF", "/root/testdata/sf0.001")
PACKAGE = Path(__file__).resolve().parent.parent / "strata"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(registered.oracle_sql()))
def test_agrees_with_sql(spark, con, name):
    found = differences(registered.queries()[name](spark, SF_DIR), registered.oracle_sql()[name], con)
    assert not found, found[:5]


@pytest.mark.parametrize("name", sorted(set(registered.queries()) - set(registered.oracle_sql())))
def test_runs_without_sql(spark, name):
    assert registered.queries()[name](spark, SF_DIR).count() > 0


def test_flagship(spark):
    df = registered.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "date"


@pytest.mark.parametrize("word", [r"localCheckpoint", r"crossJoin", r"\.rdd\b", r"pandas_udf", r"\budf\(", r"\.toPandas\("])
def test_stays_declarative(word):
    users = [p.name for p in PACKAGE.rglob("*.py") if "llm" not in p.parts and re.search(word, p.read_text())]
    assert users == []
