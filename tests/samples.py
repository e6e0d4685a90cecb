"""Hand-written raw rows; every test changes one thing about a good one."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql.types import DoubleType, StringType, StructField, StructType, TimestampType

from tripflow.schemas import RAW_TYPES, TEXT, INSTANT

GOOD = {
    "VendorID": 2.0,
    "tpep_pickup_datetime": datetime(2025, 1, 15, 8, 0, 0),
    "tpep_dropoff_datetime": datetime(2025, 1, 15, 8, 20, 0),
    "passenger_count": 1.0,
    "trip_distance": 3.5,
    "RatecodeID": 1.0,
    "store_and_fwd_flag": "N",
    "PULocationID": 132.0,
    "DOLocationID": 48.0,
    "payment_type": 1.0,
    "fare_amount": 20.0,
    "extra": 1.0,
    "mta_tax": 0.5,
    "tip_amount": 4.0,
    "tolls_amount": 0.0,
    "improvement_surcharge": 1.0,
    "total_amount": 29.0,
    "congestion_surcharge": 2.5,
    "airport_fee": None,
}


def raw_schema(names=tuple(GOOD)) -> StructType:
    kinds = {TEXT: StringType(), INSTANT: TimestampType()}
    return StructType([StructField(n, kinds.get(RAW_TYPES.get(n), DoubleType())) for n in names])


def raw_frame(spark, *changes: dict, without: tuple = ()):
    names = tuple(n for n in GOOD if n not in without)
    rows = [tuple({**GOOD, **change}[n] for n in names) for change in changes]
    return spark.createDataFrame(rows, raw_schema(names))
