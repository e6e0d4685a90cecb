"""Data-quality reports over raw, canonical and rolled-up data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.functions.money import mean_of, money
from tripflow.functions.order_stats import exact_median
from tripflow.operators.ingest import REASON
from tripflow.operators.rollup import city_rows


def reject_summary(judged: DataFrame) -> DataFrame:
    """Rows and share per verdict."""
    counts = judged.groupBy(F.coalesce(F.col(REASON), F.lit("accepted")).alias("verdict")).agg(
        F.count(F.lit(1)).alias("row_count")
    )
    total = counts.agg(F.sum("row_count")).scalar()
    return counts.withColumn("share_pct", F.round(100 * F.col("row_count") / total, 4))


def rejection_by_month(judged: DataFrame) -> DataFrame:
    """Rows read, accepted and rejected per source month."""
    rejected = F.count_if(F.col(REASON).isNotNull())
    return judged.groupBy("source_month").agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(F.col(REASON).isNull()).alias("rows_accepted"),
        F.round(100 * rejected / F.count(F.lit(1)), 4).alias("rejected_pct"),
    )


def pair_raw_with_canonical(raw: DataFrame, events: DataFrame) -> DataFrame:
    """Per natural key: 'paired' when one raw row and one event share it, 'rejected' when no event does,
    'unsent' when no raw row does, 'ambiguous' when either side has several.

    Both sides are counted per key before they meet, so copies never multiply in the join.
    """
    key = ("pickup", "dropoff", "pu", "do", "total", "provider")
    raw_keys = raw.select(
        F.col("tpep_pickup_datetime").alias("pickup"),
        F.col("tpep_dropoff_datetime").alias("dropoff"),
        F.col("PULocationID").alias("pu"),
        F.col("DOLocationID").alias("do"),
        money("total_amount").alias("total"),
        F.col("VendorID").cast("string").alias("provider"),
    )
    event_keys = events.select(
        F.col("pickup_datetime").alias("pickup"),
        F.col("dropoff_datetime").alias("dropoff"),
        F.col("pickup_location.zone_id").alias("pu"),
        F.col("dropoff_location.zone_id").alias("do"),
        F.col("total_amount").alias("total"),
        F.col("provider_id").alias("provider"),
    )
    tagged = raw_keys.withColumn("_raw", F.lit(1)).unionByName(event_keys.withColumn("_raw", F.lit(0)))
    raw_n, event_n = F.col("raw_rows"), F.col("events")
    outcome = (
        F.when((raw_n > 1) | (event_n > 1), "ambiguous")
        .when(event_n == 0, "rejected")
        .when(raw_n == 0, "unsent")
        .otherwise("paired")
    )
    return (
        tagged.groupBy(*key)
        .agg(F.sum("_raw").alias("raw_rows"), F.sum(1 - F.col("_raw")).alias("events"))
        .withColumn("outcome", outcome)
    )


def coverage(source_daily: DataFrame, lake_daily: DataFrame) -> DataFrame:
    """Per day: rows in the source, rows in the lake, and the share that arrived."""
    joined = source_daily.join(lake_daily, "metric_date", "left")
    held = F.coalesce(F.col("lake_rows"), F.lit(0))
    return joined.select(
        "metric_date",
        "source_rows",
        held.alias("lake_rows"),
        F.round(100 * held / F.col("source_rows"), 4).alias("coverage_pct"),
    )


def rows_per_day(rows: DataFrame, time: str, out: str) -> DataFrame:
    return rows.groupBy(F.to_date(time).alias("metric_date")).agg(F.count(F.lit(1)).alias(out))


def days_of(daily: DataFrame) -> DataFrame:
    return daily.select("metric_date").distinct()


def history_span(daily: DataFrame) -> DataFrame:
    """Distinct days, first day, last day and the number of days missing in between."""
    days = days_of(daily)
    return days.agg(
        F.count(F.lit(1)).alias("day_count"),
        F.min("metric_date").alias("first_day"),
        F.max("metric_date").alias("last_day"),
    ).withColumn(
        "missing_days", F.datediff("last_day", "first_day") + 1 - F.col("day_count")
    )


def history_gaps(daily: DataFrame) -> DataFrame:
    """The missing days themselves."""
    days = days_of(daily)
    every = days.agg(
        F.explode(F.sequence(F.min("metric_date"), F.max("metric_date"))).alias("metric_date")
    )
    return every.join(days, "metric_date", "left_anti")


def day_outliers(daily: DataFrame) -> DataFrame:
    """Each day's average price and volume against the median day."""
    city = city_rows(daily).select(
        "metric_date",
        "trip_count",
        mean_of(F.col("total_revenue"), F.col("trip_count")).alias("avg_price"),
    )
    priced = city.withColumn("_cents", (F.col("avg_price") * 100).cast("bigint"))
    price = exact_median(priced, "_cents", out="m").select(F.col("m") / 100).scalar()
    volume = exact_median(city, "trip_count", out="m").scalar()
    return city.select(
        "*",
        F.round(F.try_divide(F.col("avg_price").cast("double"), price), 4).alias("price_ratio"),
        F.round(F.try_divide(F.col("trip_count"), volume), 4).alias("volume_ratio"),
    )


def tip_share(events: DataFrame) -> DataFrame:
    """Tips as a share of fares per payment type; cash tips are not recorded by the meter."""
    n, fare, tip = F.col("trips"), F.col("_fare"), F.col("_tip")
    return (
        events.groupBy("payment_type")
        .agg(F.count(F.lit(1)).alias("trips"), F.sum("fare_amount").alias("_fare"), F.sum("tip_amount").alias("_tip"))
        .select(
            "payment_type",
            "trips",
            mean_of(fare, n).alias("avg_fare"),
            mean_of(tip, n).alias("avg_tip"),
            F.when(fare != 0, (tip / fare).cast("decimal(12,6)")).alias("tip_share"),
        )
    )


def rows_changed(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows of either version that the other does not have, with the side they are on."""
    gone = before.exceptAll(after).withColumn("side", F.lit("before"))
    new = after.exceptAll(before).withColumn("side", F.lit("after"))
    return gone.unionByName(new)
