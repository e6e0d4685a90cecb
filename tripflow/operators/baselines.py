"""Two price tables a model has to beat, and scoring with them."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.functions.order_stats import exact_median
from tripflow.operators.features import quoted_amount
from tripflow.schemas import AVERAGE, PREDICTIONS

PAIR = ("pickup_zone_id", "dropoff_zone_id")


def _whole_cents(table: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Medians are taken over whole cents and rounded to a cent, never over doubles."""
    return table.select(*keys, F.round("_m").cast("bigint").alias("median_cents"))


def global_median(rows: DataFrame) -> DataFrame:
    return _whole_cents(exact_median(rows, "quoted_cents", out="_m"), ())


def pair_medians(rows: DataFrame) -> DataFrame:
    return _whole_cents(exact_median(rows, "quoted_cents", PAIR, "_m"), PAIR)


def as_amount(cents: Column) -> Column:
    return (cents / F.lit(100).cast("decimal(3,0)")).cast(AVERAGE)


def quote_by_global(trips: DataFrame, everywhere: DataFrame) -> DataFrame:
    return trips.withColumn("predicted_amount", as_amount(everywhere.scalar().cast("decimal(12,0)")))


def quote_by_pair(trips: DataFrame, pairs: DataFrame, everywhere: DataFrame) -> DataFrame:
    """The median of the trip's zone pair, or the overall median for a pair never seen.

    The table has one row per pair; adaptive execution broadcasts it when it is measured to be small and
    otherwise joins by shuffle, splitting the partition of a pair that holds most trips.
    """
    p = pairs.withColumnRenamed("median_cents", "_pair_cents").alias("p")
    t = trips.alias("t")
    same = [F.col(f"t.{c}").eqNullSafe(F.col(f"p.{c}")) for c in PAIR]
    quoted = t.join(p, same[0] & same[1], "left").select("t.*", "p._pair_cents")
    cents = F.coalesce(F.col("_pair_cents"), everywhere.scalar()).cast("decimal(12,0)")
    return quoted.withColumn("predicted_amount", as_amount(cents)).drop("_pair_cents")


def as_predictions(quoted: DataFrame, version: str, predicted_at: datetime | Column) -> DataFrame:
    """Quoted trips in the shape of the prediction table: quote and outcome side by side."""
    at = predicted_at if isinstance(predicted_at, Column) else F.lit(predicted_at)
    return quoted.select(
        "event_id",
        "pickup_datetime",
        "dropoff_datetime",
        "pickup_zone_id",
        "dropoff_zone_id",
        F.col("predicted_amount").cast(AVERAGE).alias("predicted_amount"),
        quoted_amount().cast(AVERAGE).alias("actual_amount"),
        F.lit(version).alias("model_version"),
        at.cast("timestamp").alias("predicted_at"),
    ).select(*PREDICTIONS.names)
