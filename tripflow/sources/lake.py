"""The date-partitioned Parquet lake."""

from __future__ import annotations

import re
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.functions.time import at_or_after
from tripflow.schemas import PARTITIONS, conform, lake_schema
from tripflow.sources.files import list_files

_MONTH_FOLDER = re.compile(r"/year=(\d+)/month=(\d+)$")


def partition_columns(time: str = "pickup_datetime") -> list[Column]:
    parts = (F.year(time), F.month(time), F.dayofmonth(time))
    return [part.alias(name) for part, name in zip(parts, PARTITIONS)]


def by_day(rows: DataFrame, time: str) -> DataFrame:
    """The rows dealt to tasks by day of `time`.

    A rebalance keeps a small day in one task and lets adaptive execution cut a day that holds a large share of all rows
    into several.
    """
    return rows.select("*", *partition_columns(time)).hint("rebalance", *PARTITIONS)


def write_lake(
    events: DataFrame, path: str, source: str, rows_per_file: int = 20_000_000, placed: bool = False
) -> None:
    """Replace exactly the days present in `events`; every other day stays as it is.

    Events go to the task of their day first, where each task writes files of its own, unless they are `placed` already.
    """
    days = [c for c in events.columns if c not in PARTITIONS]
    if placed:
        dated = events.select(*days, *partition_columns())
    else:
        dated = by_day(events.select(*days), "pickup_datetime")
    (
        conform(dated, lake_schema(source))
        .sortWithinPartitions(*PARTITIONS, "pickup_datetime")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy(*PARTITIONS)
        .parquet(path)
    )


def on_partitions(since: datetime | date | None, until: datetime | date | None) -> Column:
    """Bound on year, month and day implied by an event-time range, so whole days are never listed."""
    year, month, day = (F.col(name) for name in PARTITIONS)

    def from_day(d) -> Column:
        return (year > d.year) | (
            (year == d.year) & ((month > d.month) | ((month == d.month) & (day >= d.day)))
        )

    def to_day(d) -> Column:
        return (year < d.year) | (
            (year == d.year) & ((month < d.month) | ((month == d.month) & (day <= d.day)))
        )

    bound = F.lit(True)
    if since is not None:
        bound = bound & from_day(since)
    if until is not None:
        bound = bound & to_day(until)
    return bound


def read_lake(
    spark: SparkSession, path: str, source: str, since: datetime | None = None, until: datetime | None = None
) -> DataFrame:
    """Events with since <= pickup < until; the same bounds prune partition folders and row groups."""
    lake = spark.read.schema(lake_schema(source)).parquet(path)
    if since is None and until is None:
        return lake
    lake = lake.where(on_partitions(since, until))
    time = F.col("pickup_datetime")
    if since is None:
        return lake.where(time < F.lit(until))
    return lake.where(at_or_after(time, since, until))


def lake_months(spark: SparkSession, path: str) -> DataFrame:
    """Months present, from the names of the folders: no task looks at a data file."""
    found = (_MONTH_FOLDER.search(folder) for folder in list_files(spark, path, "year=*/month=*"))
    return spark.createDataFrame(sorted((int(m[1]), int(m[2])) for m in found if m), "year int, month int")


def layout_report(lake: DataFrame) -> DataFrame:
    """Per day: files, rows, and rows whose event time does not belong to the folder they lie in."""
    stray = ~F.col("pickup_datetime").cast("date").eqNullSafe(F.make_date(*PARTITIONS))
    return (
        lake.select(*PARTITIONS, F.col("_metadata.file_path").alias("_file"), stray.alias("_stray"))
        .groupBy(*PARTITIONS, "_file")
        .agg(F.count(F.lit(1)).alias("_rows"), F.count_if("_stray").alias("_strays"))
        .groupBy(*PARTITIONS)
        .agg(
            F.count(F.lit(1)).alias("files"),
            F.sum("_rows").alias("row_count"),
            F.sum("_strays").alias("stray_rows"),
        )
    )
