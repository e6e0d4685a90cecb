from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from samples import GOOD, raw_frame
from tripflow import Settings
from tripflow.functions.time import month_list
from tripflow.operators.ingest import REASON, adapt, judge
from tripflow.operators.ownership import check_history_month, is_history, is_live
from tripflow.operators.validate import canonical_violations
from tripflow.schemas import conform, extras_schema, lake_schema

AT = datetime(2026, 6, 1)
NAN = float("nan")


def reasons(spark, *changes, month=None, without=()):
    return [r[REASON] for r in judge(raw_frame(spark, *changes, without=without), month).collect()]


def test_reject_rules(spark):
    pickup = GOOD["tpep_pickup_datetime"]
    cases = [
        ({}, None),
        ({"extra": None}, "missing_required"),
        ({"fare_amount": NAN}, "missing_required"),
        ({"PULocationID": NAN}, "missing_required"),
        ({"passenger_count": NAN}, None),
        ({"congestion_surcharge": None}, None),
        ({"trip_distance": -0.1}, "negative_distance"),
        ({"tpep_dropoff_datetime": pickup}, "dropoff_not_after_pickup"),
        ({"tpep_dropoff_datetime": pickup + timedelta(seconds=1)}, None),
        ({"tip_amount": -0.01}, "negative_money"),
        ({"extra": -1.0, "mta_tax": 1.5}, None),
        ({"extra": -9.0}, "negative_money"),
        ({"passenger_count": -1.0}, "negative_passenger_count"),
    ]
    assert reasons(spark, *(c for c, _ in cases)) == [want for _, want in cases]


def test_absent_column_is_zero_but_null_is_not(spark):
    assert reasons(spark, {}, without=("extra",)) == [None]
    assert reasons(spark, {"extra": None}) == ["missing_required"]


def test_month_rule_is_half_open(spark):
    def at(t):
        return {"tpep_pickup_datetime": t, "tpep_dropoff_datetime": t + timedelta(minutes=5)}

    got = reasons(spark, at(datetime(2025, 1, 1)), at(datetime(2025, 2, 1)), month="2025-01")
    assert got == [None, "outside_source_month"]


def test_payment_codes(spark):
    codes = [0.0, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, None]
    events, _ = adapt(raw_frame(spark, *({"payment_type": c} for c in codes)), AT)
    assert [r.payment_type for r in events.collect()] == [
        "OTHER", "CARD", "CASH", "OTHER", "OTHER", "UNKNOWN", "OTHER", "UNKNOWN",
    ]


def test_values_and_schema(spark):
    events, _ = adapt(raw_frame(spark, {}), AT)
    row = conform(events, lake_schema("tlc_yellow")).first()
    assert row.surcharges_amount == Decimal("5.00")
    assert row.trip_distance_km == pytest.approx(5.632704, rel=1e-12)
    assert row.provider_id == "2"
    assert (row.year, row.month, row.day) == (2025, 1, 15)
    assert [len(part) for part in row.event_id.split("-")] == [8, 4, 4, 4, 12]
    with pytest.raises(ValueError):
        conform(events.drop("source"), lake_schema("tlc_yellow"))


def test_event_id_ignores_everything_outside_the_key(spark):
    events, _ = adapt(raw_frame(spark, {}, {"tip_amount": 1.0}, {"total_amount": 29.01}), AT)
    ids = [r.event_id for r in events.collect()]
    assert ids[0] == ids[1] != ids[2]


def test_counts_come_with_the_job(spark):
    seen = Observation("t")
    events, rejected = adapt(raw_frame(spark, {}, {"extra": None}), AT, observation=seen)
    assert events.count() == 1 and rejected.count() == 1
    assert seen.get["total"] == 2 and seen.get["accepted"] == 1 and seen.get["missing_required"] == 1


def test_canonical_violations(spark):
    events, _ = adapt(raw_frame(spark, {}), AT)
    place = lambda z, lat, lon: F.struct(
        F.lit(z).cast("int").alias("zone_id"), F.lit(lat).cast("double").alias("lat"), F.lit(lon).cast("double").alias("lon")
    )
    check = lambda df: df.select(canonical_violations().alias("v")).first().v
    assert check(events) == []
    assert check(events.withColumn("pickup_location", place(None, 40.0, None))) == ["location_missing"]
    assert check(events.withColumn("pickup_location", place(None, 40.0, -73.0))) == []
    assert check(events.withColumn("pickup_location", place(1, 40.0, 181.0))) == ["coordinates_out_of_range"]


def test_ownership_and_months(spark):
    settings = Settings()
    cut = settings.cutoff
    df = spark.createDataFrame([(cut,), (cut + timedelta(seconds=1),)], "pickup_datetime timestamp")
    got = df.select(is_history(cut).alias("h"), is_live(cut).alias("l")).collect()
    assert [tuple(r) for r in got] == [(True, False), (False, True)]
    check_history_month("2025-12", cut)
    with pytest.raises(ValueError):
        check_history_month("2026-01", cut)
    assert month_list("2023-11", "2024-02") == ["2023-11", "2023-12", "2024-01", "2024-02"]
    with pytest.raises(ValueError):
        month_list("2024-02", "2024-01")
    with pytest.raises(ValueError):
        extras_schema("unknown")
