"""Quotes for live events, micro-batch by micro-batch."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripflow.operators.baselines import as_predictions
from tripflow.operators.dedupe import first_per_key
from tripflow.operators.features import quoted_amount
from tripflow.operators.ingest import flatten_zones
from tripflow.schemas import AVERAGE, PREDICTIONS
from tripflow.session import scratch
from tripflow.settings import Settings
from tripflow.sources.files import remove_folder
from tripflow.sources.serving_tables import COMPACT_AFTER, compact, due, read_batches, write_batch
from tripflow.sources.wire import decode_wire, decoded_once

Quote = Callable[[DataFrame], DataFrame]


def newest_quote() -> list:
    return [F.desc("batch_id"), F.desc("predicted_at")]


def readable(messages: DataFrame, settings: Settings) -> DataFrame:
    """Messages decoded, each with its `wire_error`; a price that a quote cannot hold is one too."""
    judged = decode_wire(messages, settings.source)
    wide = F.col("wire_error").isNull() & quoted_amount().isNotNull() & quoted_amount().try_cast(AVERAGE).isNull()
    return judged.withColumn("wire_error", F.when(wide, "price_out_of_range").otherwise(F.col("wire_error")))


def score(events: DataFrame, quote: Quote, version: str) -> DataFrame:
    return as_predictions(quote(events), version, F.current_timestamp())


def publish_quotes(
    messages: DataFrame,
    quote: Quote,
    version: str,
    path: str,
    checkpoint: str,
    settings: Settings,
    *,
    dead_path: str,
    once: bool = False,
    compact_after: int = COMPACT_AFTER,
) -> StreamingQuery:
    """Score every micro-batch: quotes and dead letters are published under its batch id, and a repeated batch replaces both.

    A message is decoded once; live events and dead letters lie in the shared folder until both tables are written.
    """

    def publish(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        held = scratch(spark, "scored-batch")
        live, dead = decoded_once(readable(batch, settings), settings, held)
        write_batch(score(flatten_zones(live), quote, version), batch_id, path, "pickup_datetime")
        dead.write.mode("overwrite").parquet(f"{dead_path.rstrip('/')}/batch_id={batch_id}")
        remove_folder(spark, held)
        if due(spark, path, compact_after):
            compact(spark, path, PREDICTIONS, ["event_id"], newest_quote(), "pickup_datetime")

    writer = messages.writeStream.option("checkpointLocation", checkpoint)
    writer = (
        writer.trigger(availableNow=True)
        if once
        else writer.trigger(processingTime=f"{settings.liveness_seconds} seconds")
    )
    return writer.foreachBatch(publish).start()


def read_quotes(
    spark: SparkSession,
    path: str,
    since: datetime | date | None = None,
    until: datetime | date | None = None,
    days: list[str] | None = None,
) -> DataFrame:
    """One row per event: the quote written last. Event times or days bound the folders that are read."""
    rows = read_batches(spark, path, PREDICTIONS, since, until, days)
    return first_per_key(rows, ["event_id"], newest_quote()).drop("batch_id")
