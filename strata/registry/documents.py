"""JSON documents: envelopes, record counts, unwrapping, typed look-ups."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions.jsondoc import extract_json, extract_typed, record_count, unwrap_rows, wrap_envelope
from strata.plans.landing import land_documents, landing_metrics
from strata.registry import query
from strata.registry.views import PROCESSED_AT, landed_prices, prop_k, table
from strata.session import scratch_dir


@query(
    "json_envelope",
    """WITH d AS (SELECT *, event_id % 31 <> 0 AS ok FROM events)
    SELECT event_id, CASE WHEN ok THEN 'success' ELSE 'failed' END AS status,
      CASE WHEN ok THEN 1 END::bigint AS record_count,
      CASE WHEN ok THEN '{"source":"' || event_type || '","ingested_at":"' || strftime(ts, '%Y-%m-%d %H:%M:%S')
        || '","execution_date":"' || strftime(ts, '%Y-%m-%d') || '","record_count":1,"data":' || props || '}' END
        AS envelope
    FROM d""",
)
def json_envelope(spark, sf_dir):
    cut_short = F.when(F.col("event_id") % 31 == 0, F.substring("props", 1, 5)).otherwise(F.col("props"))
    landed = table(spark, sf_dir, "events").withColumn("payload", cut_short)
    at = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    wrapped = wrap_envelope(landed, "payload", F.col("event_type"), F.to_date("ts"), at)
    return wrapped.select("event_id", "status", "record_count", "envelope")


@query(
    "land_documents",
    """WITH d AS (SELECT event_type AS source, event_id % 31 <> 0 AS ok, (props->>'k')::bigint AS k FROM events),
    t AS (SELECT source, CASE WHEN ok THEN 'success' ELSE 'failed' END AS status, count(*) AS documents,
        coalesce(sum(k % 4) FILTER (WHERE ok), 0)::bigint AS records FROM d GROUP BY 1, 2)
    SELECT t.*, CASE status WHEN 'success' THEN 'RecordsIngested' ELSE 'IngestionErrors' END AS metric,
      CASE status WHEN 'success' THEN records ELSE documents END::double AS value,
      (SELECT count(*) FROM d WHERE ok) AS landed FROM t""",
)
def land(spark, sf_dir):
    """Documents of a run, some cut short: their statuses, metric points, and the files landed."""
    events = table(spark, sf_dir, "events")
    text = F.concat(F.lit('{"data":'), listed(prop_k().cast("int") % 4), F.lit("}"))
    cut_short = F.when(F.col("event_id") % 31 == 0, F.substring(text, 1, 8)).otherwise(text)
    base, date = scratch_dir(spark, "lake"), "2024-02-01"
    statuses = land_documents(
        events.withColumn("payload", cut_short), "payload", F.col("event_type"), base, "events", date, F.lit("now")
    )
    found = landing_metrics(statuses, date, F.lit(PROCESSED_AT)).select(
        F.col("dimensions")["Source"].alias("source"),
        F.when(F.col("name") == "RecordsIngested", "success").otherwise("failed").alias("status"),
        F.col("name").alias("metric"),
        "value",
    )
    landed = spark.read.text(f"{base}/raw/events/2024/02/01").agg(F.count(F.lit(1))).scalar()
    return statuses.join(found, ["source", "status"]).withColumn("landed", landed)


def listed(n, item=None):
    """JSON text of a list of ``n`` items."""
    item = F.lit("1") if item is None else item
    return F.concat(F.lit("["), F.array_join(F.array_repeat(item, n.cast("int")), ","), F.lit("]"))


def by_type(**texts):
    cases = F.lit(None).cast("string")
    for event_type, text in texts.items():
        cases = F.when(F.col("event_type") == event_type, text).otherwise(cases)
    return cases


@query(
    "json_record_count",
    """WITH d AS (SELECT event_id, event_type, (props->>'k')::bigint AS k FROM events)
    SELECT event_id, CASE event_type WHEN 'click' THEN k % 4 WHEN 'error' THEN k % 3
      WHEN 'purchase' THEN k % 3 + k % 2 WHEN 'signup' THEN k % 5 ELSE 1 END::bigint AS records FROM d""",
)
def json_record_count(spark, sf_dir):
    """Lists, lists under a key, objects of lists, text under a preferred key, and plain objects."""
    k = prop_k().cast("int")
    text = by_type(
        click=listed(k % 4),
        error=F.concat(F.lit('{"data":'), listed(k % 3), F.lit(',"records":[1,2,3,4,5]}')),
        purchase=F.concat(F.lit('{"records":{"a":'), listed(k % 3), F.lit(',"b":'), listed(k % 2), F.lit(',"c":7}}')),
        signup=F.concat(F.lit('{"results":"[1,2]","hourly":{"time":'), listed(k % 5), F.lit("}}")),
        view=F.to_json(F.struct("value")),
    )
    return table(spark, sf_dir, "events").select("event_id", record_count(text).alias("records"))


@query(
    "json_unwrap_rows",
    """WITH d AS (SELECT event_id, event_type, value, (props->>'k')::bigint AS k FROM events)
    SELECT event_id, k::double AS v FROM d, range(0, 4) AS r(i) WHERE event_type = 'click' AND i < k % 4
    UNION ALL SELECT event_id, k::double FROM d WHERE event_type IN ('error', 'purchase')
    UNION ALL SELECT event_id, i::double FROM d, unnest([1, 2]) AS r(i) WHERE event_type = 'signup'
    UNION ALL SELECT event_id, value FROM d WHERE event_type = 'view'""",
)
def json_unwrap_rows(spark, sf_dir):
    """Rows in a list, under the second key as the first is empty, as one object, under a later key, bare."""
    row = F.concat(F.lit('{"v":'), prop_k(), F.lit("}"))
    text = by_type(
        click=listed(prop_k().cast("int") % 4, row),
        error=F.concat(F.lit('{"data":[],"records":['), row, F.lit("]}")),
        purchase=F.concat(F.lit('{"data":'), row, F.lit("}")),
        signup=F.lit('{"data":0,"items":[{"v":1},{"v":2}]}'),
        view=F.to_json(F.struct(F.col("value").alias("v"))),
    )
    documents = table(spark, sf_dir, "events").select("event_id", text.alias("doc"))
    return unwrap_rows(documents, "doc", "v double").select("event_id", "row.v")


@query(
    "json_extract_typed",
    """SELECT event_id, (props->>'k')::int AS k, (props->>'k')::double AS k_double, NULL::varchar AS absent
    FROM events""",
)
def json_extract(spark, sf_dir):
    fields = {"k": ("$.k", "int"), "k_double": ("$.k", "double"), "absent": ("$.nothing", "string")}
    return extract_json(table(spark, sf_dir, "events"), "props", fields).select("event_id", *fields)


@query(
    "struct_extract_typed",
    """SELECT strftime(o_orderdate, '%Y-%m-%d') AS execution_date, CASE WHEN o_orderkey % 29 = 0 THEN -o_totalprice ELSE o_totalprice END AS usd,
      o_orderpriority AS description FROM orders""",
)
def struct_extract(spark, sf_dir):
    fields = {"usd": ("data.bpi.USD.rate_float", "double"), "description": ("data.bpi.USD.description", "string")}
    return extract_typed(landed_prices(spark, sf_dir), fields).select("execution_date", *fields)
