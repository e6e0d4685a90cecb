"""Which writer owns which part of the timeline."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripflow.functions.time import month_span


def is_history(cutoff: datetime, time: str = "pickup_datetime") -> Column:
    return F.col(time) <= F.lit(cutoff)


def is_live(cutoff: datetime, time: str = "pickup_datetime") -> Column:
    return F.col(time) > F.lit(cutoff)


def check_history_month(month: str, cutoff: datetime) -> None:
    """A month that begins after the cutoff belongs to the live log and must not be loaded from a file."""
    first, _ = month_span(month)
    if first > cutoff:
        raise ValueError(f"{month} starts after the cutoff {cutoff.isoformat()}; the live log owns it")
