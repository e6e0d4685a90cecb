"""Calendar and clock helpers over event time."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def parse_month(month: str) -> date:
    """'2023-01' -> 2023-01-01."""
    return datetime.strptime(month, "%Y-%m").date()


def month_span(month: str) -> tuple[datetime, datetime]:
    """Half-open span of a month."""
    first = parse_month(month)
    following = date(first.year + first.month // 12, first.month % 12 + 1, 1)
    return datetime(first.year, first.month, 1), datetime(following.year, following.month, 1)


def month_list(start: str, end: str) -> list[str]:
    """Every month from `start` to `end`, both included."""
    first, last = parse_month(start), parse_month(end)
    if first > last:
        raise ValueError(f"start month {start} is after end month {end}")
    count = (last.year - first.year) * 12 + last.month - first.month + 1
    serial = first.year * 12 + first.month - 1
    return [f"{(serial + i) // 12:04d}-{(serial + i) % 12 + 1:02d}" for i in range(count)]


def month_range(spark: SparkSession, start: str, end: str) -> DataFrame:
    """The same list as a one-column table."""
    months = month_list(start, end)
    return spark.range(len(months)).select(
        F.add_months(F.lit(parse_month(start)), F.col("id").cast("int")).alias("month_start")
    ).select(F.date_format("month_start", "yyyy-MM").alias("month"))


def check_window_minutes(minutes: int) -> None:
    if minutes < 1 or 60 % minutes:
        raise ValueError(f"window of {minutes} minutes does not divide the hour")


def floor_to_window(ts: Column, minutes: int) -> Column:
    """Start of the tumbling window on the wall-clock grid."""
    check_window_minutes(minutes)
    return F.window(ts, f"{minutes} minutes")["start"]


def minutes_between(start: Column, end: Column) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(60_000_000)


def iso_text(ts: Column) -> Column:
    """ISO 8601 text, with a fraction only where there is one."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.unix_micros(ts) % 1_000_000
    return F.when(fraction == 0, whole).otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


def age_text(seconds: Column) -> Column:
    """Humanised age: seconds below 90 s, minutes below 90 min, then hours with one decimal."""
    as_text = lambda value, places: F.format_number(value, places)
    return (
        F.when(seconds < 90, F.concat(as_text(seconds, 0), F.lit("s")))
        .when(seconds < 5400, F.concat(as_text(seconds / 60, 0), F.lit(" min")))
        .otherwise(F.concat(F.regexp_replace(as_text(seconds / 3600, 1), ",", ""), F.lit(" h")))
    )


def at_or_after(ts: Column, since, until=None) -> Column:
    """Lower bound included, upper bound excluded or open."""
    bound = ts >= F.lit(since)
    return bound if until is None else bound & (ts < F.lit(until))
