"""How far a quote was off."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper ends of the good and the warning band, in percent.
GOOD_BELOW, WARNING_BELOW = 10, 25


def quote_error(predicted: Column, actual: Column) -> Column:
    return predicted - actual


def error_pct(predicted: Column, actual: Column) -> Column:
    """Signed percentage of the actual amount; NULL for a free trip."""
    return F.when(actual != 0, (100 * (predicted - actual) / F.abs(actual)).cast("double"))


def error_band(pct: Column) -> Column:
    size = F.abs(pct)
    return (
        F.when(pct.isNull() | (size < GOOD_BELOW), "good")
        .when(size < WARNING_BELOW, "warning")
        .otherwise("critical")
    )
