"""What makes a record unacceptable, as columns: for raw files, and for canonical events of any source."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.functions.money import BOUNDS, SURCHARGE_PARTS, negative_surcharges, rough_surcharges, unrepresentable
from tripflow.functions.time import month_span
from tripflow.schemas import AMOUNTS, MONEY, REQUIRED_RAW, WIDE

# Reject reasons in the order in which they are reported.
REJECT_REASONS = (
    "missing_required",
    "out_of_range",
    "negative_distance",
    "dropoff_not_after_pickup",
    "negative_money",
    "negative_passenger_count",
    "outside_source_month",
)


def in_month(time: Column, month: str | Column) -> Column:
    """Whether an event time lies in a month, given as 'YYYY-MM' or as a column of first days."""
    if isinstance(month, str):
        first, following = month_span(month)
        return (time >= F.lit(first)) & (time < F.lit(following))
    return (time >= month.cast("timestamp")) & (time < F.add_months(month, 1).cast("timestamp"))


def reject_reason(month: str | Column | None = None) -> Column:
    """First broken rule of a resolved raw record, NULL when it is acceptable.

    Surcharges are judged by their sum: a negative part made up for by the others is fine. The month rule
    applies only where the packaging of the record claims a month.
    """
    pickup, dropoff = F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime")
    charged = ("fare_amount", "tip_amount", "tolls_amount", "total_amount")
    broken = {
        "missing_required": reduce(or_, (F.col(c).isNull() for c in REQUIRED_RAW)),
        "out_of_range": reduce(or_, (unrepresentable(c) for c in (*charged, *SURCHARGE_PARTS)))
        | unrepresentable("trip_distance", WIDE)
        | (F.abs(rough_surcharges()) >= BOUNDS[MONEY]),
        "negative_distance": F.col("trip_distance") < 0,
        "dropoff_not_after_pickup": dropoff <= pickup,
        "negative_money": reduce(or_, (F.col(c) < 0 for c in charged)) | negative_surcharges(),
        "negative_passenger_count": F.col("passenger_count") < 0,
        "outside_source_month": F.lit(False) if month is None else ~F.coalesce(in_month(pickup, month), F.lit(False)),
    }
    verdict = F.lit(None).cast("string")
    for reason in reversed(REJECT_REASONS):
        verdict = F.when(broken[reason], F.lit(reason)).otherwise(verdict)
    return verdict


def _canonical_checks() -> dict[str, Column]:
    """Per canonical constraint: whether an event breaks it."""

    def unplaced(point: str) -> Column:
        both = F.col(f"{point}.lat").isNotNull() & F.col(f"{point}.lon").isNotNull()
        return F.col(f"{point}.zone_id").isNull() & ~both

    def off_globe(point: str) -> Column:
        lat, lon = F.col(f"{point}.lat"), F.col(f"{point}.lon")
        known = lambda test: F.coalesce(test, F.lit(False))
        return known(~lat.between(-90, 90)) | known(~lon.between(-180, 180))

    points = ("pickup_location", "dropoff_location")
    return {
        "location_missing": reduce(or_, map(unplaced, points)),
        "coordinates_out_of_range": reduce(or_, map(off_globe, points)),
        "amount_missing": reduce(or_, (F.col(c).isNull() for c in AMOUNTS)),
        "distance_out_of_range": unrepresentable("trip_distance_km", WIDE),
        "negative_amount": reduce(or_, (F.col(c) < 0 for c in AMOUNTS)),
        "negative_passenger_count": F.col("passenger_count") < 0,
        "negative_distance": F.col("trip_distance_km") < 0,
        "dropoff_not_after_pickup": F.col("dropoff_datetime") <= F.col("pickup_datetime"),
    }


def canonical_violations() -> Column:
    """Names of all canonical constraints an event breaks, whatever source it came from."""
    checks = _canonical_checks().items()
    return F.array_compact(F.array(*(F.when(F.coalesce(bad, F.lit(False)), F.lit(name)) for name, bad in checks)))


def first_violation() -> Column:
    """The first of them, NULL where there is none; unlike the list it is compiled."""
    return F.coalesce(*(F.when(bad, F.lit(name)) for name, bad in _canonical_checks().items()))


def split(judged: DataFrame, reason: str) -> tuple[DataFrame, DataFrame]:
    """Accepted rows without the reason column, and rejected rows with it."""
    return judged.where(F.col(reason).isNull()).drop(reason), judged.where(F.col(reason).isNotNull())

