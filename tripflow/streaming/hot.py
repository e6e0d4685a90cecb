"""The hot path: the event log as window metrics within seconds.

Windows that are still open and windows that are closed need two output modes, so two queries follow the
same log: `append` publishes each window once, when the watermark has passed it, and `update` republishes
open windows as they grow. Readers see both through `serving_windows`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tripflow.operators.merge import WINDOW_KEYS
from tripflow.operators.rollup import window_metrics_stream
from tripflow.operators.serving import serving_windows
from tripflow.operators.validate import split
from tripflow.schemas import MEASURES, WINDOWS
from tripflow.settings import Settings
from tripflow.sources.serving_tables import COMPACT_AFTER, compact, due, read_batches, write_batch
from tripflow.sources.wire import decode_view

# Fields two copies of one trip share on the narrow view, where its natural key is not carried along.
VIEW_KEY = ("pickup_datetime", "zone_id", "fare_amount", "tip_amount", "total_amount", "trip_distance_km")
WINDOW_ROWS = StructType([f for f in WINDOWS.fields if f.name != "is_final"])


def read_views(messages: DataFrame, keyed: bool = False) -> tuple[DataFrame, DataFrame]:
    """(usable events, dead letters) of a batch or a stream of messages; `keyed` adds `trip_key`, the natural key's digest."""
    good, dead = split(decode_view(messages, keyed), "view_error")
    return good.drop("value"), dead.select("value", "view_error")


def window_stream(views: DataFrame, settings: Settings, unique: bool = False) -> DataFrame:
    """Watermarked window metrics.

    With `unique`, copies of a trip inside the watermark are counted once, told by their natural key where the views carry
    it; off by default, so that a double replay stays visible as a difference between the hot and the cold counts.
    """
    marked = views.withWatermark("pickup_datetime", settings.grace)
    if unique:
        marked = marked.dropDuplicatesWithinWatermark(["trip_key"] if "trip_key" in views.columns else list(VIEW_KEY))
    return window_metrics_stream(marked, settings.window_minutes).select(
        "window_start", "window_end", "grain", "zone_id", *MEASURES
    )


def _trigger(writer, settings: Settings, once: bool):
    if once:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=f"{settings.liveness_seconds} seconds")


def publish_windows(
    views: DataFrame,
    mode: str,
    path: str,
    checkpoint: str,
    settings: Settings,
    *,
    once: bool = False,
    unique: bool = False,
    final_path: str | None = None,
    compact_after: int = COMPACT_AFTER,
) -> StreamingQuery:
    """One of the two queries: mode 'append' for final rows, 'update' for open windows.

    `once` works off what the log holds and stops; otherwise the query runs until it is stopped. Batches are compacted as
    they add up; provisional rows of windows that are final in `final_path` are dropped then.
    """

    def publish(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        write_batch(rows, batch_id, path, "window_start")
        if due(spark, path, compact_after):
            compact_windows(spark, path, final_path)

    writer = (
        window_stream(views, settings, unique)
        .writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
    )
    return _trigger(writer, settings, once).foreachBatch(publish).start()


def compact_windows(spark: SparkSession, path: str, final_path: str | None = None) -> int | None:
    """One row per window; of open windows, those that `final_path` holds as final are dropped."""

    def open_ones(rows: DataFrame) -> DataFrame:
        final = read_batches(spark, final_path, WINDOW_ROWS).select(*(F.col(k).alias(f"_{k}") for k in WINDOW_KEYS))
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in WINDOW_KEYS]
        return rows.join(final, same[0] & same[1] & same[2], "left_anti")

    keep = open_ones if final_path else None
    return compact(spark, path, WINDOW_ROWS, WINDOW_KEYS, [F.desc("batch_id")], "window_start", keep)


def publish_dead_letters(
    dead: DataFrame, path: str, checkpoint: str, settings: Settings, *, once: bool = False
) -> StreamingQuery:
    writer = (
        dead.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    )
    return _trigger(writer, settings, once).start()


def read_windows(spark: SparkSession, final_path: str, open_path: str) -> DataFrame:
    """The serving view over what both queries have published."""
    return serving_windows(
        read_batches(spark, final_path, WINDOW_ROWS), read_batches(spark, open_path, WINDOW_ROWS)
    )


def missing_from_windows(events_read: int, windows: DataFrame) -> DataFrame:
    """Events the stream did not aggregate: what came in minus what the city rows count."""
    counted = F.coalesce(F.sum(F.when(F.col("grain") == "city", F.col("trip_count"))), F.lit(0))
    return windows.agg((F.lit(events_read) - counted).alias("not_aggregated"))
