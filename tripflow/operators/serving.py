"""The read queries behind a dashboard. Each takes a serving table and returns a small result."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.functions.errors import error_band, error_pct, quote_error
from tripflow.functions.money import mean_of
from tripflow.functions.time import at_or_after, floor_to_window, minutes_between
from tripflow.operators.dedupe import first_per_key
from tripflow.operators.evaluation import accuracy_shares
from tripflow.operators.merge import WINDOW_KEYS
from tripflow.operators.rollup import city_rows, zone_rows
from tripflow.schemas import MEASURES


def serving_windows(final: DataFrame, provisional: DataFrame) -> DataFrame:
    """One row per window key out of both streams' outputs.

    A final row beats a provisional one; among rows of one kind the later micro-batch wins.
    """
    rows = final.withColumn("is_final", F.lit(True)).unionByName(
        provisional.withColumn("is_final", F.lit(False))
    )
    return first_per_key(rows, WINDOW_KEYS, [F.desc("is_final"), F.desc("batch_id")]).drop("batch_id")


def hot_windows(windows: DataFrame, start, end=None, limit: int = 96) -> DataFrame:
    """The newest city windows of a range, oldest first."""
    newest = (
        city_rows(windows)
        .where(at_or_after(F.col("window_start"), start, end))
        .select("window_start", "trip_count", "total_revenue", "avg_fare", "avg_tip", "is_final")
        .orderBy(F.desc("window_start"))
        .limit(limit)
    )
    return newest.orderBy("window_start")


def newest_window_rows(windows: DataFrame, start, end=None) -> DataFrame:
    """All rows of the newest window inside the range."""
    ranged = windows.where(at_or_after(F.col("window_start"), start, end))
    newest = ranged.agg(F.max("window_start")).scalar()
    return ranged.where(F.col("window_start") == newest)


def hot_top_zones(windows: DataFrame, start, end=None, limit: int = 10) -> DataFrame:
    """Busiest zones of the newest window inside the range; ties go to the smaller zone."""
    return (
        zone_rows(newest_window_rows(windows, start, end))
        .where(F.col("zone_id").isNotNull())
        .select("zone_id", "trip_count", "avg_fare")
        .orderBy(F.desc("trip_count"), "zone_id")
        .limit(limit)
    )


def cold_daily(daily: DataFrame) -> DataFrame:
    return city_rows(daily).select("metric_date", *MEASURES).orderBy("metric_date")


def reconciliation(daily: DataFrame, windows: DataFrame, live_from: date) -> DataFrame:
    """Days of the live era both paths have counted, with both counts."""
    hot = (
        city_rows(windows)
        .where(F.col("window_start") >= F.lit(live_from).cast("timestamp"))
        .groupBy(F.to_date("window_start").alias("metric_date"))
        .agg(F.sum("trip_count").alias("hot_trips"))
    )
    cold = (
        city_rows(daily)
        .where(F.col("metric_date") >= F.lit(live_from))
        .select("metric_date", F.col("trip_count").alias("cold_trips"))
    )
    return cold.join(hot, "metric_date").orderBy("metric_date")


def daily_evaluation(evaluation: DataFrame) -> DataFrame:
    kept = [c for c in evaluation.columns if c != "computed_at"]
    return evaluation.select(*kept).orderBy("eval_date", "model_version")


def _with_errors(predictions: DataFrame) -> DataFrame:
    predicted, actual = F.col("predicted_amount"), F.col("actual_amount")
    return predictions.select(
        "*",
        quote_error(predicted, actual).cast("decimal(11,2)").alias("error"),
        F.round(error_pct(predicted, actual), 4).alias("error_pct"),
    )


def live_predictions(predictions: DataFrame, start, end=None, limit: int = 300) -> DataFrame:
    """The newest quotes of a range with their errors, newest first; ties go to the smaller event id."""
    columns = (
        "event_id",
        "pickup_datetime",
        "dropoff_datetime",
        "pickup_zone_id",
        "dropoff_zone_id",
        "predicted_amount",
        "actual_amount",
    )
    newest = (
        predictions.where(at_or_after(F.col("pickup_datetime"), start, end))
        .select(*columns, "model_version")
        .orderBy(F.desc("pickup_datetime"), "event_id", "model_version")
        .limit(limit)
    )
    return _with_errors(newest)


def prediction_windows(predictions: DataFrame, start, end=None, minutes: int = 5) -> DataFrame:
    """Quoted and charged, averaged per window."""
    n = F.count(F.lit(1))
    return (
        predictions.where(at_or_after(F.col("pickup_datetime"), start, end))
        .groupBy(floor_to_window(F.col("pickup_datetime"), minutes).alias("window_start"))
        .agg(
            n.alias("trips"),
            mean_of(F.sum("predicted_amount"), n).alias("predicted"),
            mean_of(F.sum("actual_amount"), n).alias("actual"),
        )
        .orderBy("window_start")
    )


def prediction_range(predictions: DataFrame) -> DataFrame:
    return predictions.agg(
        F.to_date(F.min("pickup_datetime")).alias("first_day"),
        F.to_date(F.max("pickup_datetime")).alias("last_day"),
    )


def prediction_freshness(predictions: DataFrame) -> DataFrame:
    return predictions.agg(
        F.max("predicted_at").alias("last_written"),
        F.count(F.lit(1)).alias("total"),
        F.max("model_version").alias("model_version"),
    )


def feed_rows(feed: DataFrame) -> DataFrame:
    """Feed rows with ride duration and error band."""
    return feed.select(
        "*",
        F.round(minutes_between(F.col("pickup_datetime"), F.col("dropoff_datetime")), 4).alias("duration_min"),
        error_band(F.col("error_pct")).alias("band"),
    )


def feed_summary(feed: DataFrame) -> DataFrame:
    return accuracy_shares(feed)


def latest(rows: DataFrame, by: Column, columns: list[str]) -> DataFrame:
    """The row with the largest ordering value, as a single aggregate (no sort)."""
    row = F.struct(*columns)
    return rows.agg(F.max_by(row, by).alias("r")).where("r is not null").select("r.*")


def latest_window(windows: DataFrame, start, end=None) -> DataFrame:
    """Headline numbers of the newest city window in the range."""
    ranged = city_rows(windows).where(at_or_after(F.col("window_start"), start, end))
    return latest(ranged, F.col("window_start"), ["window_start", "trip_count", "total_revenue", "avg_fare"])


def latest_evaluation(evaluation: DataFrame) -> DataFrame:
    """Headline numbers of the newest evaluated day, and the number of quotes scored overall."""
    row = F.struct("eval_date", "model_version", "mae", "mape", "r2")
    return evaluation.agg(
        F.max_by(row, F.struct("eval_date", "model_version")).alias("r"),
        F.sum("predictions").alias("quotes_scored"),
    ).select("r.*", "quotes_scored")


def long_series(
    wide: DataFrame, ids: list[str], labels: dict[str, str], name: str, value: str
) -> DataFrame:
    """Measures under one another with their display labels."""
    shown = F.create_map(*(F.lit(x) for pair in labels.items() for x in pair))
    return wide.unpivot(ids, list(labels), "_measure", value).select(
        *ids, shown[F.col("_measure")].alias(name), value
    )


# Display labels of the three long-form charts.
LAYER_LABELS = {"cold_trips": "Cold path", "hot_trips": "Hot path"}
MEAN_LABELS = {"mean_actual": "Actual", "mean_predicted": "Predicted"}
PRICE_LABELS = {"actual": "Charged", "predicted": "Quoted"}


def zone_history(metrics: DataFrame, zone_id: int, time: str, limit: int) -> DataFrame:
    """One zone's metrics, newest first."""
    return (
        zone_rows(metrics)
        .where(F.col("zone_id") == zone_id)
        .orderBy(F.desc(time))
        .limit(limit)
    )


def quotes_per_version(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("model_version").agg(F.count(F.lit(1)).alias("quotes"))


def open_end_of(day: date) -> datetime:
    """Exclusive end of an inclusive last day."""
    following = date.fromordinal(day.toordinal() + 1)
    return datetime(following.year, following.month, following.day)
