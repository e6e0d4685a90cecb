"""Window and daily metrics at both grains, zone and city."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.functions.money import mean_of
from tripflow.functions.time import check_window_minutes
from tripflow.schemas import MEASURES, REVENUE, WIDE

ZONE, CITY = "zone", "city"


def _sums() -> list[Column]:
    """Mergeable totals. Distance is added up as a decimal, so no order of addition changes it."""
    km = F.col("trip_distance_km")
    return [
        F.count(F.lit(1)).alias("n"),
        F.sum("total_amount").alias("revenue"),
        F.sum("fare_amount").alias("fare"),
        F.sum("tip_amount").alias("tip"),
        F.sum(km.try_cast(WIDE)).alias("km"),
        F.count(km).alias("km_n"),
    ]


def _measures() -> list[Column]:
    n = F.col("n")
    return [
        n.alias("trip_count"),
        F.col("revenue").try_cast(REVENUE).alias("total_revenue"),
        mean_of(F.col("fare"), n).alias("avg_fare"),
        mean_of(F.col("tip"), n).alias("avg_tip"),
        mean_of(F.col("km"), F.col("km_n"), "decimal(18,3)").cast("double").alias("avg_distance_km"),
    ]


def _grain() -> Column:
    return F.when(F.col("_is_city") == 1, CITY).otherwise(ZONE).alias("grain")


def both_grains(trips: DataFrame, time: str) -> DataFrame:
    """Zone rows and city rows of one time column from one pass over the trips.

    The trips are shuffled once, after a partial sum per zone. The city rows add up the exact zone totals
    (not their averages), so they equal a sum over the trips and cost a second pass over totals only.
    """
    totals = trips.groupBy(time, "zone_id").agg(*_sums())
    again = [F.sum(name).alias(name) for name in ("n", "revenue", "fare", "tip", "km", "km_n")]
    return (
        totals.groupingSets([[time, "zone_id"], [time]], time, "zone_id")
        .agg(F.grouping("zone_id").alias("_is_city"), *again)
        .select(time, _grain(), "zone_id", *_measures())
    )


def daily_metrics(events: DataFrame) -> DataFrame:
    """Canonical events to daily x zone and daily x city metrics."""
    trips = events.select(
        F.to_date("pickup_datetime").alias("metric_date"),
        F.col("pickup_location.zone_id").alias("zone_id"),
        "fare_amount",
        "tip_amount",
        "total_amount",
        "trip_distance_km",
    )
    return both_grains(trips, "metric_date")


def window_metrics(views: DataFrame, minutes: int) -> DataFrame:
    """Consumer-view events to tumbling-window metrics (batch form)."""
    check_window_minutes(minutes)
    windowed = views.withColumn("window_start", F.window("pickup_datetime", f"{minutes} minutes")["start"])
    return both_grains(windowed, "window_start").select(
        "window_start",
        (F.col("window_start") + F.make_dt_interval(mins=F.lit(minutes))).alias("window_end"),
        "grain",
        "zone_id",
        *MEASURES,
    )


def window_metrics_stream(views: DataFrame, minutes: int) -> DataFrame:
    """The same metrics as one stateful aggregation, which both output modes of a stream accept."""
    check_window_minutes(minutes)
    windowed = views.select("*", F.window("pickup_datetime", f"{minutes} minutes").alias("window"))
    return (
        windowed.groupingSets([["window", "zone_id"], ["window"]], "window", "zone_id")
        .agg(F.grouping("zone_id").alias("_is_city"), *_sums())
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            _grain(),
            "zone_id",
            *_measures(),
        )
    )


def mark_final(windows: DataFrame, newest: Column | datetime, grace_minutes: int) -> DataFrame:
    """`is_final`: the newest event time lies at least the grace period behind the window's end."""
    newest = newest if isinstance(newest, Column) else F.lit(newest)
    closes = F.col("window_end") + F.make_dt_interval(mins=F.lit(grace_minutes))
    return windows.withColumn("is_final", closes <= newest)


def city_rows(metrics: DataFrame) -> DataFrame:
    return metrics.where(F.col("grain") == CITY)


def zone_rows(metrics: DataFrame) -> DataFrame:
    return metrics.where(F.col("grain") == ZONE)


def rollup_violations(metrics: DataFrame, time: str) -> DataFrame:
    """Periods whose zone rows do not add up to their city row."""
    is_city = F.col("grain") == CITY
    zero = F.lit(0).cast(REVENUE)
    return (
        metrics.groupBy(time)
        .agg(
            F.sum(F.when(is_city, F.col("trip_count")).otherwise(0)).alias("city_trips"),
            F.sum(F.when(~is_city, F.col("trip_count")).otherwise(0)).alias("zone_trips"),
            F.sum(F.when(is_city, F.col("total_revenue")).otherwise(zero)).alias("city_revenue"),
            F.sum(F.when(~is_city, F.col("total_revenue")).otherwise(zero)).alias("zone_revenue"),
        )
        .where("city_trips <> zone_trips or city_revenue <> zone_revenue")
    )


def staged_stats(metrics: DataFrame, time: str = "metric_date") -> DataFrame:
    """Rows and distinct days about to be published."""
    return (
        metrics.groupBy(time)
        .agg(F.count(F.lit(1)).alias("_n"))
        .agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"), F.count(F.lit(1)).alias("day_count")
        )
    )
