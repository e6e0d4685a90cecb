"""Model inputs: one definition of a feature row and of the target, shared by training and scoring."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.functions.money import cents
from tripflow.functions.order_stats import smallest_per_group
from tripflow.operators.ownership import is_history
from tripflow.settings import Settings

# The feature columns in model order, and the stand-in for an unknown zone.
FEATURES = (
    "pickup_zone_id",
    "dropoff_zone_id",
    "zone_pair",
    "hour",
    "day_of_week",
    "month",
    "passenger_count",
)
ENCODED = ("pickup_zone_id", "dropoff_zone_id", "zone_pair")
UNKNOWN_ZONE = -1


def zone_or_unknown(zone: str | Column) -> Column:
    zone = F.col(zone) if isinstance(zone, str) else zone
    return F.coalesce(zone, F.lit(UNKNOWN_ZONE))


def zone_pair(pu: Column, do: Column) -> Column:
    return pu.cast("bigint") * 1000 + do


def features(trips: DataFrame, keep: Iterable[str] = ("event_id",)) -> DataFrame:
    """The feature columns as doubles, with `keep` in front.

    Only what is known before the ride starts: two zones, the clock and the party size. Expects flattened
    zones; missing party sizes stay NULL.
    """
    pu, do = zone_or_unknown("pickup_zone_id"), zone_or_unknown("dropoff_zone_id")
    pickup = F.col("pickup_datetime")
    columns = {
        "pickup_zone_id": pu,
        "dropoff_zone_id": do,
        "zone_pair": zone_pair(pu, do),
        "hour": F.hour(pickup),
        "day_of_week": F.weekday(pickup),
        "month": F.month(pickup),
        "passenger_count": F.col("passenger_count"),
    }
    return trips.select(*keep, *(columns[name].cast("double").alias(name) for name in FEATURES))


def quoted_amount() -> Column:
    """What is charged before the rider picks a tip."""
    return F.col("total_amount") - F.col("tip_amount")


def with_target(trips: DataFrame) -> DataFrame:
    return trips.withColumn("quoted_amount", quoted_amount()).withColumn(
        "quoted_cents", cents(F.col("quoted_amount"))
    )


def usable_target(settings: Settings) -> Column:
    return F.col("quoted_amount").between(F.lit(settings.min_price), F.lit(settings.max_price))


def usable_stats(trips: DataFrame, settings: Settings) -> DataFrame:
    usable = usable_target(settings)
    return trips.agg(
        F.count(F.lit(1)).alias("rows_seen"),
        F.count_if(usable).alias("rows_kept"),
        F.count_if(~usable).alias("rows_dropped"),
    )


SAMPLE_COLUMNS = (
    "event_id",
    "pickup_datetime",
    "pickup_zone_id",
    "dropoff_zone_id",
    "passenger_count",
    "quoted_amount",
    "quoted_cents",
)


def stable_hash(seed: int, *columns: str) -> Column:
    return F.xxhash64(*columns, F.lit(seed))


def monthly_sample(
    trips: DataFrame, per_month: int | Callable[[int], int], rank_hash: Column, month: str = "source_month"
) -> DataFrame:
    """Up to `per_month` rows of every month without replacement, repeatable on any partitioning."""
    return smallest_per_group(trips, [month], rank_hash, per_month)


def training_rows(trips: DataFrame, settings: Settings, rank_hash: Column | None = None) -> DataFrame:
    """Trips up to the cutoff -> the same number of rows per month -> usable prices only."""
    history = with_target(trips.where(is_history(settings.cutoff))).select(
        F.trunc("pickup_datetime", "month").alias("source_month"), *SAMPLE_COLUMNS
    )
    hashed = stable_hash(settings.seed, "event_id") if rank_hash is None else rank_hash
    # The quota of a month follows from the number of months present, which the sample's own sketch tells.
    sample = monthly_sample(history, lambda months: max(1, settings.train_sample_rows // max(1, months)), hashed)
    return sample.where(usable_target(settings)).drop("source_month")


def bucket_of_100(seed: int, key: str = "event_id") -> Column:
    """A bucket 0..99 fixed by the id: 32 bits of an MD5, which any engine can recompute."""
    text = F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % 100


def holdout_split(rows: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """(training rows, holdout rows)."""
    held = bucket_of_100(settings.seed) < settings.holdout_percent
    return rows.where(~held), rows.where(held)
