"""The shapes as Spark frames, each derived lazily from the tables in one folder."""

from __future__ import annotations

from dataclasses import replace
from datetime import date, datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.shapes import (
    CUTOFF,
    GLOBAL_VERSION,
    HISTORY_STAMP,
    NOW_STAMP,
    PAIR_VERSION,
    RAW_TRIPS,
    TRIP_LOG,
)
from tripflow import Settings, adopt
from tripflow.operators.baselines import (
    as_predictions,
    global_median,
    pair_medians,
    quote_by_global,
    quote_by_pair,
)
from tripflow.operators.dedupe import drop_duplicate_trips
from tripflow.operators.evaluation import evaluate_daily
from tripflow.operators.features import with_target
from tripflow.operators.ingest import REASON, flatten_zones, judge, to_canonical
from tripflow.operators.ownership import is_history, is_live
from tripflow.operators.rollup import daily_metrics, mark_final, window_metrics
from tripflow.operators.validate import split
from tripflow.schemas import MONEY, SCHEMA_VERSION, extras_schema
from tripflow.sources.lake import partition_columns


def _time(text: str) -> datetime:
    return datetime.fromisoformat(text)


SETTINGS = replace(
    Settings(),
    cutoff=_time(CUTOFF),
    live_era_start=date(2000, 1, 1),
    window_minutes=60,
)
INGESTED = _time(HISTORY_STAMP)
NOW = _time(NOW_STAMP)


class Inputs:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self.settings = adopt(spark), folder.rstrip("/"), SETTINGS

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # --- raw files and the lake ---
    @cached_property
    def raw(self) -> DataFrame:
        return self.spark.sql(RAW_TRIPS, lineitem=self.table("lineitem"))

    @cached_property
    def judged(self) -> DataFrame:
        return judge(self.raw)

    @cached_property
    def judged_by_month(self) -> DataFrame:
        return judge(self.raw, F.col("source_month"))

    @cached_property
    def events(self) -> DataFrame:
        return to_canonical(split(self.judged, REASON)[0], INGESTED)

    @cached_property
    def repeated_events(self) -> DataFrame:
        """All events plus a later second copy of everything the first provider sent."""
        again = self.events.where("provider_id = '1'").withColumn("ingested_at", F.lit(NOW))
        return self.events.unionByName(again)

    @cached_property
    def trips(self) -> DataFrame:
        return flatten_zones(self.events)

    @cached_property
    def daily(self) -> DataFrame:
        return daily_metrics(self.events)

    # --- the log ---
    @cached_property
    def log(self) -> DataFrame:
        rows = self.spark.sql(TRIP_LOG, events=self.table("events"))
        return rows.withColumn("pickup_datetime", F.col("pickup_datetime").cast("timestamp"))

    @staticmethod
    def as_views(log: DataFrame, *also: str) -> DataFrame:
        amount = lambda c: (F.col(c).cast("decimal(14,0)") / 100).cast(MONEY)
        return log.select(
            *also,
            "event_id",
            "arrival",
            "pickup_datetime",
            "zone_id",
            amount("fare_c").alias("fare_amount"),
            amount("tip_c").alias("tip_amount"),
            amount("total_c").alias("total_amount"),
            (F.col("km_tenths") / 10).alias("trip_distance_km"),
        )

    @cached_property
    def views(self) -> DataFrame:
        return self.as_views(self.log)

    @cached_property
    def windows(self) -> DataFrame:
        """Hourly windows of the log, closed ones marked final."""
        return self._windows(self.views, 60)

    @cached_property
    def short_windows(self) -> DataFrame:
        return self._windows(self.views, 5)

    def _windows(self, views: DataFrame, minutes: int) -> DataFrame:
        newest = views.agg(F.max("pickup_datetime")).scalar()
        return mark_final(window_metrics(views, minutes), newest, self.settings.grace_minutes)

    @cached_property
    def log_events(self) -> DataFrame:
        """The log as canonical events; trips without a zone get coordinates instead."""
        views = self.as_views(self.log, "user_id")
        nowhere = F.col("zone_id").isNull()
        place = F.struct(
            F.col("zone_id"),
            F.when(nowhere, F.lit(40.5)).alias("lat"),
            F.when(nowhere, F.lit(-73.5)).alias("lon"),
        )
        zero = F.lit(0).cast(MONEY)
        return views.select(
            F.col("event_id").cast("string").alias("event_id"),
            F.lit("tlc_yellow").alias("source"),
            F.lit(INGESTED).cast("timestamp").alias("ingested_at"),
            F.lit(SCHEMA_VERSION).alias("schema_version"),
            "pickup_datetime",
            (F.col("pickup_datetime") + F.expr("interval 10 minutes")).alias("dropoff_datetime"),
            place.alias("pickup_location"),
            place.alias("dropoff_location"),
            F.lit(1).alias("passenger_count"),
            "trip_distance_km",
            F.col("user_id").cast("string").alias("provider_id"),
            F.lit("CARD").alias("payment_type"),
            "fare_amount",
            zero.alias("surcharges_amount"),
            "tip_amount",
            zero.alias("tolls_amount"),
            "total_amount",
            F.lit(None).cast(extras_schema("tlc_yellow")).alias("source_extras"),
            *partition_columns(),
        )

    @cached_property
    def replayed_events(self) -> DataFrame:
        """The log with every Sunday replayed once more."""
        again = self.log_events.where(F.weekday("pickup_datetime") == 6).withColumn("ingested_at", F.lit(NOW))
        return self.log_events.unionByName(again)

    @cached_property
    def replayed_windows(self) -> DataFrame:
        views = flatten_zones(self.replayed_events).withColumnRenamed("pickup_zone_id", "zone_id")
        return self._windows(views, 60)

    @cached_property
    def log_daily(self) -> DataFrame:
        return daily_metrics(drop_duplicate_trips(self.replayed_events))

    # --- quotes ---
    @cached_property
    def priced(self) -> DataFrame:
        return with_target(self.trips)

    @cached_property
    def fitted(self) -> DataFrame:
        return self.priced.where(is_history(self.settings.cutoff))

    def predictions_of(self, version: str) -> DataFrame:
        live = self.trips.where(is_live(self.settings.cutoff))
        everywhere = global_median(self.fitted)
        if version == PAIR_VERSION:
            quoted = quote_by_pair(live, pair_medians(self.fitted), everywhere)
        else:
            quoted = quote_by_global(live, everywhere)
        return as_predictions(quoted, version, F.col("dropoff_datetime"))

    @cached_property
    def predictions(self) -> DataFrame:
        return self.predictions_of(PAIR_VERSION).unionByName(self.predictions_of(GLOBAL_VERSION))

    @cached_property
    def evaluation(self) -> DataFrame:
        return evaluate_daily(self.predictions)

