from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from strata.functions.jsondoc import extract_json, extract_typed, record_count, unwrap_rows, wrap_envelope


def documents(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "id int, doc string")


# Shapes of documents, each with its number of records.
SHAPES = [
    ([], 0),
    ([1, 2, 3], 3),
    ({"data": [1, 2]}, 2),
    ({"data": {}}, 0),
    ({"data": []}, 0),
    ({"data": {"a": [1, 2], "b": 3, "c": [4]}}, 3),
    ({"data": "[1,2]", "records": [1]}, 1),
    ({"data": None, "items": {"x": "[1]"}}, 0),
    ({"hourly": {"time": [1, 2, 3], "t": [1, 2]}, "other": [1]}, 5),
    ({"results": 0, "hourly": [1]}, 1),
    ({"k": [1, 2]}, 1),
    ({"data": "{\"a\":[1]}", "records": ["x]", "\"[", "\\"]}, 3),
    ({"data": {"a": ["s\""], "b": "[1,2]", "c\"": [[1, 2], {}]}}, 3),
    ({}, 1),
    (3, 1),
    ("text", 1),
    (None, 1),
    (True, 1),
]


def test_record_count(spark):
    df = documents(spark, *[json.dumps(shape) for shape, _ in SHAPES])
    got = [r.n for r in df.select("id", record_count("doc").alias("n")).orderBy("id").collect()]
    assert got == [n for _, n in SHAPES]


REPEATED = [
    ('{"data":[1],"data":[1,2]}', 2),
    ('{"data":[1],"data":{"a":[1,2,3]}}', 3),
    ('{"data":[1],"data":"[1]"}', 1),
    ('{"data":[1,2],"data":null,"items":[1,2,3]}', 3),
    ('{"data":{"a":[1],"b":[1],"a":[1,2,3]}}', 4),
    ('{"data":{"a":[1],"a":7}}', 0),
    ('{"k":1,"k":2}', 1),
    ('{"d\\u0061ta":[1,2]}', 2),
    ('{"\\u0064ata":[1,2],"data":[1]}', 1),
    ('{"data":"\\u005b1,2]","items":[1,2,3]}', 3),
    ('{"data":{"a":"\\u005b1]","b":"\\"[","c":[1]}}', 1),
]


def test_of_a_repeated_key_the_last_counts(spark):
    df = documents(spark, *[text for text, _ in REPEATED])
    wrapped = wrap_envelope(df, "doc", F.lit("s"), F.lit("2024-01-05"), F.lit("now")).orderBy("id").collect()
    assert [(r.record_count, r.status) for r in wrapped] == [(n, "success") for _, n in REPEATED]
    rows = documents(spark, '{"data":[{"v":1}],"data":[{"v":2},{"v":3,"v":4.5}]}')
    assert [r.v for r in unwrap_rows(rows, "doc", "v double").select("row.v").collect()] == [2.0, 4.5]


def test_document_beyond_the_limits_of_parsers(spark):
    """140 MB of records, and one text of 25 MB."""
    item = F.concat(F.lit('{"v":"'), F.repeat(F.lit("x"), 1000), F.lit('"}'))
    many = F.concat(F.lit('{"data":['), F.array_join(F.array_repeat(item, 140_000), ","), F.lit("]}"))
    long = F.concat(F.lit('{"data":["'), F.repeat(F.lit("x"), 25_000_000), F.lit('"]}'))
    df = spark.range(2, numPartitions=1).select(F.when(F.col("id") == 0, many).otherwise(long).alias("doc"))
    assert [r.n for r in df.select(record_count("doc").alias("n")).collect()] == [140_000, 1]
    rows = unwrap_rows(df.limit(1), "doc", "v string").select(F.length("row.v").alias("n"))
    assert rows.groupBy("n").count().collect() == [(1000, 140_000)]


@pytest.mark.parametrize("text", ["bad", "{'a':1}", '{"a":"x\ny"}', '[1,]', '"a" "b"', "1],[2", "", '{"a":1', '{"a":1} x', '{"v":1},{"v":2}', None])
def test_text_that_is_not_json(spark, text):
    df = spark.createDataFrame([(text,)], "doc string")
    assert df.select(record_count("doc").alias("n")).head().n is None
    assert unwrap_rows(df, "doc", "v double").count() == 0
    wrapped = wrap_envelope(df, "doc", F.lit("s"), F.lit("2024-01-05"), F.lit("now")).head()
    assert wrapped.status == "failed" and wrapped.envelope is None


@pytest.mark.parametrize(
    "doc, rows",
    [
        ([{"v": 1}, {"v": 2}], [1.0, 2.0]),
        ({"data": [{"v": 1}]}, [1.0]),
        ({"data": [], "records": [{"v": 1}, {"v": 3}]}, [1.0, 3.0]),
        ({"data": {}, "items": {"v": 5}}, [5.0]),
        ({"data": 0, "records": False, "items": "", "v": 4}, [4.0]),
        ({"data": 0.0, "records": None, "v": 4}, [4.0]),
        ({"v": "abc"}, [None]),
        ({"data": "0", "v": 4}, [None]),
        ({"data": "null", "v": 4}, [None]),
        ([{"v": "[1]", "w": "\"{"}, None, "x", [1]], [None] * 4),
        ({"w": 1}, [None]),
        ([], []),
        (7, []),
    ],
)
def test_unwrap_rows(spark, doc, rows):
    got = unwrap_rows(documents(spark, json.dumps(doc)), "doc", "v double").select("row.v").collect()
    assert [r.v for r in got] == rows


def test_envelope_holds_the_payload(spark):
    payload = '{"name": "a \\"b\\"",\n "list": [1,\r\n2]}'
    df = documents(spark, payload)
    row = wrap_envelope(df, "doc", F.lit('quo"te'), F.lit("2024-01-05"), F.lit("2024-01-05T02:00:00Z")).head()
    assert "\n" not in row.envelope
    assert json.loads(row.envelope) == {
        "source": 'quo"te',
        "ingested_at": "2024-01-05T02:00:00Z",
        "execution_date": "2024-01-05",
        "record_count": 1,
        "data": json.loads(payload),
    }


def test_payload_that_would_break_out_of_its_envelope(spark):
    row = wrap_envelope(documents(spark, '{"v":1}],[2'), "doc", F.lit("s"), F.lit("d"), F.lit("t")).head()
    assert row.status == "failed"


def test_extract(spark):
    df = documents(spark, '{"a":{"b":"1.5"},"n":"x"}', "bad")
    got = extract_json(df, "doc", {"b": ("$.a.b", "double"), "n": ("$.n", "int")}).orderBy("id").collect()
    assert [(r.b, r.n) for r in got] == [(1.5, None), (None, None)]
    nested = spark.sql("SELECT struct(struct('2.5' AS x, 'no' AS y) AS s) AS d")
    row = extract_typed(nested, {"x": ("d.s.x", "double"), "y": ("d.s.y", "double")}).head()
    assert (row.x, row.y) == (2.5, None)


def test_fields_of_documents_that_a_variant_cannot_hold(spark):
    large = '{"a": {"b": 7, "pad": "' + "x" * (17 << 20) + '"}, "l": [1, {"z": "q"}]}'
    docs = [
        '{"a": {"b": 1}, "a": {"b": 2.5}, "l": [4, {"z": "w"}]}',
        '{"a": {"b": "x", "b": "3"}}',
        '{"a": 5, "a": null, "l": [8], "l": [9]}',
        '{"a": {"b": 1}} trailing',
        large,
        None,
    ]
    df = spark.createDataFrame(list(enumerate(docs)), "id int, doc string")
    fields = {"b": ("$.a.b", "double"), "z": ("$.l[1].z", "string"), "q": ("$['a']['b']", "int"), "t": ("$.l[0]", "int")}
    got = [tuple(r) for r in extract_json(df, "doc", fields).drop("doc").orderBy("id").collect()]
    assert got == [(0, 2.5, "w", None, 4), (1, 3.0, None, 3, None), (2, None, None, None, 8), (3, None, None, None, None), (4, 7.0, "q", 7, 1), (5, None, None, None, None)]
    with pytest.raises(ValueError, match="not a path"):
        extract_json(df, "doc", {"b": ("$.a..b", "int")})
