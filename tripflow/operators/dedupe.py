"""Duplicates of one trip on its natural key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The six fields that identify a trip.
NATURAL_KEY = (
    "pickup_datetime",
    "dropoff_datetime",
    "pickup_location.zone_id",
    "dropoff_location.zone_id",
    "total_amount",
    "provider_id",
)


def first_per_key(df: DataFrame, keys, order) -> DataFrame:
    """One row per key, the first by `order`.

    Spark limits each group to one row before the shuffle as well (WindowGroupLimit), so a key whose
    copies make up a third of the input arrives as one row per input partition.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_nth", F.row_number().over(window)).where("_nth = 1").drop("_nth")


def drop_duplicate_trips(events: DataFrame) -> DataFrame:
    """The copy that came in first survives; ties fall to the smallest id, so reruns agree."""
    return first_per_key(events, [F.col(k) for k in NATURAL_KEY], ["ingested_at", "event_id"])


def duplicate_stats(events: DataFrame) -> DataFrame:
    """Rows before, rows after and rows collapsed."""
    keys = [F.col(k).alias(f"k{i}") for i, k in enumerate(NATURAL_KEY)]
    return (
        events.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("rows_before"),
            F.count(F.lit(1)).alias("rows_after"),
            F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("collapsed"),
        )
    )
