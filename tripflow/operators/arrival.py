"""Late events, judged event by event in arrival order (the audit form of the stream's watermark)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.functions.order_stats import running_max_before
from tripflow.functions.time import floor_to_window


def mark_late(
    events: DataFrame, minutes: int, grace_minutes: int, arrival: str = "arrival", tie: str = "event_id"
) -> DataFrame:
    """Adds `watermark` (newest event time that arrived before) and `is_late`.

    An event is late when its window had already closed, grace included, before it arrived.
    """
    marked = running_max_before(events, "pickup_datetime", arrival, tie, "watermark")
    closes = floor_to_window(F.col("pickup_datetime"), minutes) + F.make_dt_interval(
        mins=F.lit(minutes + grace_minutes)
    )
    return marked.withColumn("is_late", F.coalesce(closes <= F.col("watermark"), F.lit(False)))
