"""Exact money and distance arithmetic."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripflow.schemas import AVERAGE, MONEY, WIDE

# Kilometres per mile, and the five parts of the surcharge total.
KM_PER_MILE = "1.609344"
SURCHARGE_PARTS = (
    "extra",
    "mta_tax",
    "improvement_surcharge",
    "congestion_surcharge",
    "airport_fee",
)


def exact(name: str) -> Column:
    """A raw double as a wide decimal; NULL where it is not finite or too large for one."""
    return F.col(name).try_cast(WIDE)


def money(name: str) -> Column:
    return exact(name).try_cast(MONEY)


# The smallest doubles that the exact types cannot hold once they are rounded to their last place.
BOUNDS = {MONEY: 9_999_999_999.995, WIDE: 1e12}
# Sums of doubles within these bounds are exact to less than this.
BLUR = 0.01


def unrepresentable(name: str, kind=MONEY) -> Column:
    """Whether a double is there that the exact type cannot hold (not a number, infinite, or out of range)."""
    return F.coalesce(F.abs(F.col(name)) >= BOUNDS[kind], F.lit(False))


def surcharges() -> Column:
    """Sum of all surcharge parts; a missing part counts as nothing."""
    zero = F.lit(0).cast(WIDE)
    return reduce(add, (F.coalesce(exact(part), zero) for part in SURCHARGE_PARTS))


def rough_surcharges() -> Column:
    """The same sum in doubles, for comparisons that need no last place."""
    return reduce(add, (F.coalesce(F.col(part), F.lit(0.0)) for part in SURCHARGE_PARTS))


def negative_surcharges() -> Column:
    """Whether the parts add up to less than nothing; the exact sum is only formed where the rough one is too close."""
    rough = rough_surcharges()
    return F.when(F.abs(rough) > BLUR, rough < 0).otherwise(surcharges() < 0)


def kilometres(miles: str) -> Column:
    return (exact(miles) * F.lit(KM_PER_MILE).cast("decimal(7,6)")).cast("double")


def cents(amount: Column) -> Column:
    """Money as whole cents."""
    return (amount * 100).cast("bigint")


def mean_of(total: Column, n: Column, kind=AVERAGE) -> Column:
    """Exact quotient, rounded half-up once when it is narrowed to `kind`; NULL where that cannot hold it."""
    return (total / F.when(n != 0, n).cast("decimal(20,0)")).try_cast(kind)
