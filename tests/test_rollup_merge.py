from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tripflow import Settings
from tripflow.functions.time import floor_to_window
from tripflow.operators.dedupe import first_per_key
from tripflow.operators.evaluation import evaluate_daily
from tripflow.operators.merge import merge_changed, replace_by_key
from tripflow.operators.rollup import both_grains
from tripflow.operators.rules import evaluate_rules, model_error

T0, T1 = datetime(2026, 1, 1), datetime(2026, 1, 2)


def trips(spark, rows):
    return spark.createDataFrame(
        [(date(2025, 1, d), z, Decimal(f), Decimal("0.00"), Decimal(f), km) for d, z, f, km in rows],
        "metric_date date, zone_id int, fare_amount decimal(12,2), tip_amount decimal(12,2), "
        "total_amount decimal(12,2), trip_distance_km double",
    )


def test_grains_nulls_and_rounding(spark):
    rows = [(1, 1, "0.01", None), (1, 1, "0.00", None), (1, None, "1.00", 2.0), (2, 1, "0.005", 1.0)]
    rows[3] = (2, 1, "0.02", 1.0)
    got = {(r.metric_date.day, r.grain, r.zone_id): r for r in both_grains(trips(spark, rows), "metric_date").collect()}
    assert set(got) == {(1, "zone", 1), (1, "zone", None), (1, "city", None), (2, "zone", 1), (2, "city", None)}
    assert got[(1, "zone", 1)].avg_fare == Decimal("0.01")  # 0.005 rounds up once
    assert got[(1, "zone", 1)].avg_distance_km is None
    assert got[(1, "city", None)].trip_count == 3
    assert got[(1, "city", None)].avg_distance_km == 2.0


def test_window_floor(spark):
    df = spark.createDataFrame(
        [(datetime(2025, 1, 1, 9, 59, 59, 999999),), (datetime(2025, 1, 1, 10),)], "t timestamp"
    )
    got = [r.w for r in df.withColumn("w", floor_to_window(F.col("t"), 5)).select("w").collect()]
    assert got == [datetime(2025, 1, 1, 9, 55), datetime(2025, 1, 1, 10)]
    with pytest.raises(ValueError):
        floor_to_window(F.col("t"), 7)


def test_merge_stamps_only_changes(spark):
    schema = "k int, g string, v int, at timestamp"
    old = spark.createDataFrame([(1, "a", 10, T0), (None, "a", 5, T0), (3, "a", 7, T0), (4, "a", 8, T0)], schema)
    new = spark.createDataFrame([(1, "a", 10), (None, "a", 6), (5, "a", None)], "k int, g string, v int")
    out = merge_changed(old, new, ["k", "g"], ["v"], T1, "at", action="took")
    got = {r.k: (r.v, r.at, r.took) for r in out.collect()}
    assert got == {
        1: (10, T0, "unchanged"),
        None: (6, T1, "updated"),
        3: (7, T0, "kept"),
        4: (8, T0, "kept"),
        5: (None, T1, "inserted"),
    }
    gone = merge_changed(old, new, ["k", "g"], ["v"], T1, "at", covered=lambda c: c("k") >= 4)
    assert {r.k for r in gone.collect()} == {1, None, 3, 5}


def test_replace_by_key(spark):
    old = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int")
    new = spark.createDataFrame([("b", 2), ("c", 3)], "k string, v int")
    assert sorted(map(tuple, replace_by_key(old, new, ["k"]).collect())) == [("a", 1), ("b", 2), ("c", 3)]


def test_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = first_per_key(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    partial, exchange = plan.index("Partial"), plan.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan and partial > exchange  # below the exchange


def predictions(spark, rows):
    return spark.createDataFrame(
        [(datetime(2026, 1, d, 5), v, Decimal(p), Decimal(a)) for d, v, p, a in rows],
        "pickup_datetime timestamp, model_version string, predicted_amount decimal(10,2), actual_amount decimal(10,2)",
    )


def test_evaluation_edges(spark):
    rows = [(1, "m", "10.00", "12.00"), (2, "m", "5.00", "6.00"), (2, "m", "7.00", "6.00"), (3, "m", "1.00", "0.00"), (3, "m", "4.00", "2.00")]
    got = {r.eval_date.day: r for r in evaluate_daily(predictions(spark, rows)).collect()}
    assert got[1].r2 is None  # one quote
    assert got[2].r2 is None  # constant outcome
    assert got[2].mae == Decimal("1.0000")
    assert got[3].mape == Decimal("100.0000")  # the free trip is skipped
    assert got[3].r2 == pytest.approx(1 - 5 / 2)


def evaluation(spark, maes):
    return spark.createDataFrame(
        [(date(2026, 1, d), "m", 10, Decimal(m), 0.9) for d, m in maes],
        "eval_date date, model_version string, predictions bigint, mae decimal(10,4), r2 double",
    )


def test_rules(spark):
    settings = Settings()
    found = {r.subject: r.severity for r in model_error(evaluation(spark, [(1, "2"), (2, "2"), (3, "3.1"), (4, "5")]), settings).collect()}
    assert found == {"2026-01-03 m": "serious", "2026-01-04 m": "critical"}
    assert model_error(evaluation(spark, [(1, "5")]), settings).count() == 0
    assert model_error(evaluation(spark, [(1, "5"), (2, "0")]), settings).where("subject like '2026-01-01%'").count() == 0
    calm = evaluation(spark, [(1, "2"), (2, "2")])
    recon = spark.createDataFrame([], "metric_date date, cold_trips bigint, hot_trips bigint")
    fresh = spark.createDataFrame([(datetime(2026, 1, 2, 11, 59),)], "last_written timestamp")
    now = datetime(2026, 1, 2, 12)
    clear = evaluate_rules(calm, recon, fresh, now, settings).collect()
    assert [(r.rule, r.severity) for r in clear] == [("all", "good")]
    never = spark.createDataFrame([(None,)], "last_written timestamp")
    worst_first = evaluate_rules(evaluation(spark, [(1, "2"), (2, "9")]), recon, never, now, settings).collect()
    assert [r.severity for r in worst_first] == ["critical", "warning"]
