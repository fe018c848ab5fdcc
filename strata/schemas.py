"""Declared schemas of the three layers."""

from __future__ import annotations

from pyspark.sql import types as T

DATE, INT, LONG, DOUBLE, TEXT, TIME = (
    T.DateType(),
    T.IntegerType(),
    T.LongType(),
    T.DoubleType(),
    T.StringType(),
    T.TimestampType(),
)


def struct(required: tuple[str, ...] = (), **fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, type_, name not in required) for name, type_ in fields.items()])


# The layouts of the landed documents and the cleaned tables.
HOURLY_PAYLOAD = struct(
    hourly=struct(
        time=T.ArrayType(TEXT),
        temperature_2m=T.ArrayType(DOUBLE),
        precipitation=T.ArrayType(DOUBLE),
        windspeed_10m=T.ArrayType(DOUBLE),
    )
)
PRICE_PAYLOAD = struct(
    bpi=struct(
        USD=struct(rate_float=DOUBLE, description=TEXT), GBP=struct(rate_float=DOUBLE), EUR=struct(rate_float=DOUBLE)
    )
)
HOURLY_CLEANED = struct(
    ("date", "hour"),
    date=DATE,
    hour=INT,
    temperature_c=DOUBLE,
    precipitation_mm=DOUBLE,
    windspeed_kmh=DOUBLE,
    source=TEXT,
    ingested_at=TIME,
    execution_date=DATE,
)
PRICE_CLEANED = struct(
    ("date", "currency"),
    date=DATE,
    currency=TEXT,
    rate_usd=DOUBLE,
    rate_gbp=DOUBLE,
    rate_eur=DOUBLE,
    description=TEXT,
    ingested_at=TIME,
    execution_date=DATE,
)

# The columns each dataset must have, per layer.
EXPECTED_FIELDS = {
    "raw": {
        "weather": ["source", "ingested_at", "execution_date", "data"],
        "crypto": ["source", "ingested_at", "execution_date", "data"],
    },
    "cleaned": {
        "weather": ["date", "hour", "temperature_c", "precipitation_mm", "windspeed_kmh", "ingested_at"],
        "crypto": ["date", "currency", "rate_usd", "rate_gbp", "rate_eur", "ingested_at"],
    },
    "curated": {
        "daily_summary": ["date", "avg_temp_c", "max_temp_c", "min_temp_c", "total_precip_mm",
                          "btc_usd_avg", "processed_at"],
    },
}

METRIC = struct(name=TEXT, value=DOUBLE, unit=TEXT, dimensions=T.MapType(TEXT, TEXT), ts=TIME)


def envelope(payload: T.DataType) -> T.StructType:
    """Schema of one landed document around ``payload``, with a column for unreadable text."""
    return struct(
        source=TEXT, ingested_at=TEXT, execution_date=TEXT, record_count=LONG, data=payload, _corrupt_record=TEXT
    )
