"""Explicit schemas: raw file, wire message, consumer view, lake, serving tables, extras registry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

SCHEMA_VERSION = "1.0.0"

INT, LONG, DOUBLE, TEXT = IntegerType(), LongType(), DoubleType(), StringType()
INSTANT, DAY, FLAG = TimestampType(), DateType(), BooleanType()

MONEY = DecimalType(12, 2)  # one amount
WIDE = DecimalType(20, 8)  # exact intermediate; narrowed last
REVENUE = DecimalType(14, 2)  # a sum of amounts
AVERAGE = DecimalType(10, 2)  # a mean amount, also one quote
ERROR = DecimalType(10, 4)  # mae / rmse / mape


def struct_of(columns: dict[str, DataType]) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in columns.items()])


# --- raw trip file: fixed column names of the published monthly files --------------------------------
RAW_TYPES: dict[str, DataType] = {
    "VendorID": INT,
    "tpep_pickup_datetime": INSTANT,
    "tpep_dropoff_datetime": INSTANT,
    "passenger_count": INT,
    "trip_distance": DOUBLE,
    "RatecodeID": INT,
    "store_and_fwd_flag": TEXT,
    "PULocationID": INT,
    "DOLocationID": INT,
    "payment_type": INT,
    "fare_amount": DOUBLE,
    "extra": DOUBLE,
    "mta_tax": DOUBLE,
    "tip_amount": DOUBLE,
    "tolls_amount": DOUBLE,
    "improvement_surcharge": DOUBLE,
    "total_amount": DOUBLE,
    "congestion_surcharge": DOUBLE,
    "airport_fee": DOUBLE,
}
# A file without one of these means "nothing charged"; a NULL inside one is an invalid record.
ZERO_WHEN_ABSENT = ("extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge")
NULLABLE_RAW = (
    "passenger_count",
    "RatecodeID",
    "store_and_fwd_flag",
    "payment_type",
    "congestion_surcharge",
    "airport_fee",
)
REQUIRED_RAW = tuple(name for name in RAW_TYPES if name not in NULLABLE_RAW)

# --- source-specific extras --------------------------------------------------------------------------
_EXTRAS: dict[str, StructType] = {
    "tlc_yellow": struct_of(
        {
            "ratecode_id": INT,
            "store_and_fwd_flag": TEXT,
            "extra": DOUBLE,
            "mta_tax": DOUBLE,
            "improvement_surcharge": DOUBLE,
            "congestion_surcharge": DOUBLE,
            "airport_fee": DOUBLE,
        }
    )
}


def extras_schema(source: str) -> StructType:
    """Shape of the extras a source carries; unknown sources are an error, never a guess."""
    if source not in _EXTRAS:
        raise ValueError(f"no extras schema for source {source!r}; known: {sorted(_EXTRAS)}")
    return _EXTRAS[source]


# --- canonical event ---------------------------------------------------------------------------------
LOCATION = struct_of({"zone_id": INT, "lat": DOUBLE, "lon": DOUBLE})
AMOUNTS = ("fare_amount", "surcharges_amount", "tip_amount", "tolls_amount", "total_amount")
PARTITIONS = ("year", "month", "day")

CANONICAL_TYPES: dict[str, DataType] = {
    "event_id": TEXT,
    "source": TEXT,
    "ingested_at": INSTANT,
    "schema_version": TEXT,
    "pickup_datetime": INSTANT,
    "dropoff_datetime": INSTANT,
    "pickup_location": LOCATION,
    "dropoff_location": LOCATION,
    "passenger_count": INT,
    "trip_distance_km": DOUBLE,
    "provider_id": TEXT,
    "payment_type": TEXT,
    **dict.fromkeys(AMOUNTS, MONEY),
}
REQUIRED_CANONICAL = tuple(
    name
    for name in CANONICAL_TYPES
    if name not in ("passenger_count", "trip_distance_km", "provider_id")
)


def lake_schema(source: str) -> StructType:
    return struct_of(
        {
            **CANONICAL_TYPES,
            "source_extras": extras_schema(source),
            **dict.fromkeys(PARTITIONS, INT),
        }
    )


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Names, order and types of `schema`; nullability is left as it is. Extra columns are an error."""
    surplus = sorted(set(df.columns) - set(schema.names))
    missing = sorted(set(schema.names) - set(df.columns))
    if surplus or missing:
        raise ValueError(f"schema mismatch: surplus {surplus}, missing {missing}")
    for field in schema.fields:
        have = df.schema[field.name].dataType
        if have.simpleString() != field.dataType.simpleString():
            raise ValueError(
                f"{field.name}: {have.simpleString()} is not {field.dataType.simpleString()}"
            )
    return df.select(*schema.names)


# --- wire message: everything is read as text and cast afterwards -------------------------------------
_TEXT_LOCATION = struct_of({"zone_id": TEXT, "lat": TEXT, "lon": TEXT})
WIRE_TEXT = struct_of(
    {
        name: _TEXT_LOCATION if isinstance(kind, StructType) else TEXT
        for name, kind in CANONICAL_TYPES.items()
    }
)
VIEW_TEXT = struct_of(
    {
        "pickup_datetime": TEXT,
        "pickup_location": struct_of({"zone_id": TEXT}),
        "fare_amount": TEXT,
        "tip_amount": TEXT,
        "total_amount": TEXT,
        "trip_distance_km": TEXT,
    }
)
# What the natural key of a trip needs besides.
KEY_TEXT = struct_of(
    {"dropoff_datetime": TEXT, "dropoff_location": struct_of({"zone_id": TEXT}), "provider_id": TEXT}
)
TOPIC = struct_of({"key": TEXT, "value": TEXT})

# --- serving tables ----------------------------------------------------------------------------------
_MEASURES: dict[str, DataType] = {
    "trip_count": LONG,
    "total_revenue": REVENUE,
    "avg_fare": AVERAGE,
    "avg_tip": AVERAGE,
    "avg_distance_km": DOUBLE,
}
MEASURES = tuple(_MEASURES)
# `grain` ('zone' or 'city') marks the rollup level, so a trip without a zone is a zone row of its own.
DAILY = struct_of(
    {"metric_date": DAY, "grain": TEXT, "zone_id": INT, **_MEASURES, "updated_at": INSTANT}
)
WINDOWS = struct_of(
    {
        "window_start": INSTANT,
        "window_end": INSTANT,
        "grain": TEXT,
        "zone_id": INT,
        **_MEASURES,
        "is_final": FLAG,
    }
)
PREDICTIONS = struct_of(
    {
        "event_id": TEXT,
        "pickup_datetime": INSTANT,
        "dropoff_datetime": INSTANT,
        "pickup_zone_id": INT,
        "dropoff_zone_id": INT,
        "predicted_amount": AVERAGE,
        "actual_amount": AVERAGE,
        "model_version": TEXT,
        "predicted_at": INSTANT,
    }
)
EVAL_VALUES = ("predictions", "mae", "rmse", "mape", "r2", "mean_actual", "mean_predicted")
EVALUATION = struct_of(
    {
        "eval_date": DAY,
        "model_version": TEXT,
        "predictions": LONG,
        "mae": ERROR,
        "rmse": ERROR,
        "mape": ERROR,
        "r2": DOUBLE,
        "mean_actual": AVERAGE,
        "mean_predicted": AVERAGE,
        "computed_at": INSTANT,
    }
)
