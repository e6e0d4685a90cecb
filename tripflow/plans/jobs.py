"""The jobs of the platform. Times that end up in audit columns are arguments, never read from a clock."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripflow.functions.time import month_list
from tripflow.operators.boosting import (
    MODEL_VERSION,
    compare_on_holdout,
    fit_fare_model,
    load_model,
)
from tripflow.operators.dedupe import drop_duplicate_trips
from tripflow.operators.evaluation import evaluate_daily, improvement_pct
from tripflow.operators.features import FEATURES, holdout_split, training_rows
from tripflow.operators.ingest import REASON, SOUND, flatten_zones, judged_once, judged_rows, to_canonical
from tripflow.operators.merge import merge_daily, merge_evaluation
from tripflow.operators.ownership import check_history_month, is_history, is_live
from tripflow.operators.rollup import daily_metrics
from tripflow.operators.validate import split
from tripflow.schemas import DAILY, EVALUATION, RAW_TYPES, TEXT, struct_of
from tripflow.session import scratch, settled
from tripflow.settings import Settings
from tripflow.sources.files import exists, remove_folder
from tripflow.sources.lake import by_day, read_lake, write_lake
from tripflow.sources.log import (
    FileLog,
    KafkaLog,
    diagnose,
    follow_log,
    read_log,
    write_log,
)
from tripflow.sources.raw_files import read_raw, read_raw_range
from tripflow.sources.serving_tables import (
    days_since,
    high_water_mark,
    mark_snapshot,
    newest_batch,
    publish_snapshot,
    read_snapshot,
)
from tripflow.sources.wire import decode_wire, decoded_once, encode_wire
from tripflow.streaming.hot import publish_dead_letters, publish_windows, read_views
from tripflow.streaming.scoring import Quote, publish_quotes, read_quotes, score

Log = FileLog | KafkaLog


@dataclass(frozen=True)
class Paths:
    """Where the tables of one deployment live."""

    root: str

    def at(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def lake(self) -> str:
        return self.at("lake")

    @property
    def daily(self) -> str:
        return self.at("daily")

    @property
    def evaluation(self) -> str:
        return self.at("evaluation")

    @property
    def predictions(self) -> str:
        return self.at("predictions")

    @property
    def model(self) -> str:
        return self.at("model")

    @property
    def rejects(self) -> str:
        return self.at("rejects")

    @property
    def dead_letters(self) -> str:
        return self.at("dead_letters")


def load_history(
    raw: DataFrame,
    paths: Paths,
    ingested_at: datetime,
    settings: Settings,
    month=None,
    load: str | None = None,
    loads: Sequence[str] = (),
) -> dict[str, int]:
    """Raw rows -> accepted canonical events up to the cutoff -> lake days, counts taken on the way.

    The raw rows are read and judged once. Rejected rows go to their own table with the reason, under the id of the load:
    the month they were loaded for, or `load`. `loads` names all ids that this load covers: what an earlier run of them
    has left goes, also where this one rejects nothing.
    """
    seen = Observation("history_load")
    load = load or (month if isinstance(month, str) else _load_id("load", ingested_at))
    held = scratch(raw.sparkSession, "judged")
    sound, rejected = judged_rows(raw, ingested_at, month, settings.source, seen, held)
    # Raw rows travel to the task of their day: they are half as wide as the events made of them there.
    time = "tpep_pickup_datetime"
    placed = by_day(sound.where(is_history(settings.cutoff, time)), time)
    write_lake(to_canonical(placed, ingested_at, settings.source), paths.lake, settings.source, placed=True)
    write_rejects(rejected, paths, load, loads, by_month=isinstance(month, Column))
    remove_folder(raw.sparkSession, held)
    return dict(seen.get)


def _load_id(kind: str, at: datetime) -> str:
    return f"{kind}-{at:%Y%m%dT%H%M%S}"


_LOAD_ID = re.compile(r"[A-Za-z0-9._-]+")
REJECTS = struct_of({**RAW_TYPES, REASON: TEXT, "load_id": TEXT})


def write_rejects(
    rejected: DataFrame, paths: Paths, load: str, loads: Sequence[str] = (), by_month: bool = False
) -> None:
    """Publish the rejected rows of a load: a repeated load replaces its own rows, a new one adds to those of others.

    With `by_month`, rows with a source month belong to the load of that month, all others to `load`.
    """
    spark, covered = rejected.sparkSession, {load, *loads}
    for name in covered:
        if not _LOAD_ID.fullmatch(name):
            raise ValueError(f"load id {name!r}: letters, digits, '.', '_' and '-' only")
    named = F.lit(load)
    if by_month and "source_month" in rejected.columns:
        named = F.coalesce(F.date_format("source_month", "yyyy-MM"), named)
    rows = rejected.withColumn("load_id", named).select(*REJECTS.names)
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("load_id").parquet(paths.rejects)
    # One id per month at most.
    kept = {r["load_id"] for r in rows.select("load_id").distinct().collect()}
    for name in covered - kept:
        remove_folder(spark, f"{paths.rejects}/load_id={name}")


def read_rejects(spark: SparkSession, paths: Paths) -> DataFrame:
    """All rejected rows with their reason and load; empty before the first load."""
    if not exists(spark, paths.rejects):
        return spark.createDataFrame([], REJECTS)
    return spark.read.schema(REJECTS).parquet(paths.rejects)


def bulk_load(
    spark: SparkSession, folder: str, month: str, paths: Paths, ingested_at: datetime, settings: Settings
) -> dict[str, int]:
    """One monthly file into the lake; a rerun replaces the same days."""
    check_history_month(month, settings.cutoff)
    return load_history(read_raw(spark, folder, month), paths, ingested_at, settings, month)


def stream_to_lake(
    spark: SparkSession, log: Log, paths: Paths, settings: Settings
) -> dict[str, int]:
    """Recompute the live part of the lake from the whole log, duplicates collapsed.

    Unreadable messages land in the dead-letter table. A log without a topic yet leaves the lake as it is.
    """
    read = Observation("log_read")
    kept = Observation("log_kept")
    # Decoded once: live events and dead letters are read from what that pass has written.
    held = scratch(spark, "decoded-log")
    live, dead = decoded_once(decode_wire(read_log(spark, log), settings.source), settings, held)
    counted = live.observe(read, F.count(F.lit(1)).alias("rows_before"))
    unique = drop_duplicate_trips(counted).observe(kept, F.count(F.lit(1)).alias("rows_after"))
    write_lake(unique, paths.lake, settings.source)
    dead.write.mode("overwrite").parquet(paths.dead_letters)
    remove_folder(spark, held)
    before, after = read.get["rows_before"], kept.get["rows_after"]
    return {"rows_before": before, "rows_after": after, "collapsed": before - after}


def aggregate_daily(
    spark: SparkSession,
    paths: Paths,
    now: datetime,
    settings: Settings,
    since: datetime | None = None,
    until: datetime | None = None,
    drop_vanished: bool = False,
) -> dict[str, int]:
    """Recompute daily metrics of a date range and merge them into the published table.

    Without `since` the live era is recomputed, from its first day. Bounds are widened to whole days,
    because half a day's metrics would replace a full day's. `drop_vanished` removes published keys of
    the recomputed range that no longer have any trips.
    """
    if since is None:
        live = settings.live_era_start
        since = datetime(live.year, live.month, live.day)
    since = since.replace(hour=0, minute=0, second=0, microsecond=0)
    if until is not None and until != until.replace(hour=0, minute=0, second=0, microsecond=0):
        raise ValueError("until must be midnight: it is the exclusive end of the last day")
    staged = daily_metrics(read_lake(spark, paths.lake, settings.source, since, until))
    covered = None
    if drop_vanished:

        def covered(stored):
            day = stored("metric_date")
            inside = day >= F.lit(since.date())
            return inside if until is None else inside & (day < F.lit(until.date()))

    current = read_snapshot(spark, paths.daily, DAILY)
    return _publish(merge_daily(current, staged, now, covered=covered, action="_took"), paths.daily, drop_vanished)


def _publish(merged: DataFrame, path: str, removes: bool = False) -> dict[str, int]:
    """Publish a merge result unless it changes nothing; returns how many rows each action took."""
    spark = merged.sparkSession
    staged = scratch(spark, "merge")
    actions = ("inserted", "updated", "unchanged", "kept")
    took = Observation("merge")
    merged.observe(
        took, *(F.count_if(F.col("_took") == a).alias(a) for a in actions)
    ).write.parquet(staged)
    counts = {a: took.get[a] for a in actions}
    if removes or counts["inserted"] or counts["updated"]:
        publish_snapshot(spark.read.parquet(staged).drop("_took"), path)
    return counts


def backfill(
    spark: SparkSession,
    folder: str,
    start: str,
    end: str,
    paths: Paths,
    ingested_at: datetime,
    settings: Settings,
) -> dict[str, int]:
    """All months of a range in one plan, then one daily recompute from the first of them."""
    months = month_list(start, end)
    for month in months:
        check_history_month(month, settings.cutoff)
    raw = read_raw_range(spark, folder, start, end)
    counts = load_history(raw, paths, ingested_at, settings, F.col("source_month"), "undated", months)
    first = datetime.strptime(start, "%Y-%m")
    aggregate_daily(spark, paths, ingested_at, settings, since=first)
    return counts


def run_hot_path(
    spark: SparkSession, log: Log, paths: Paths, settings: Settings, once: bool = False, unique: bool = False
) -> list[StreamingQuery]:
    """Start the window queries and the dead-letter query, each with its own checkpoint."""
    good, dead = read_views(follow_log(spark, log), keyed=unique)
    good = good.drop("key")
    at = paths.at
    return [
        publish_windows(
            good, "append", at("windows_final"), at("_checkpoints/windows_final"), settings, once=once, unique=unique
        ),
        publish_windows(
            good, "update", at("windows_open"), at("_checkpoints/windows_open"), settings, once=once, unique=unique,
            final_path=at("windows_final"),
        ),
        publish_dead_letters(
            dead, at("hot_dead_letters"), at("_checkpoints/hot_dead_letters"), settings, once=once
        ),
    ]


def train(spark: SparkSession, paths: Paths, trained_at: datetime, settings: Settings) -> dict:
    """Sample the lake, fit, compare with both price tables on one holdout, save model and metadata."""
    trips = flatten_zones(read_lake(spark, paths.lake, settings.source, until=settings.cutoff + timedelta(seconds=1)))
    sampled = scratch(spark, "training-rows")
    training_rows(trips, settings).write.parquet(sampled)
    rows = spark.read.parquet(sampled)
    fit_part, _ = holdout_split(rows, settings)
    model = fit_fare_model(fit_part, settings)
    # One line per candidate; metrics and gain both read it, the holdout is quoted once.
    report = settled(compare_on_holdout(rows, settings, model), "comparison")
    metrics = {r["model"]: {k: float(r[k]) for k in ("mae", "rmse", "r2") if r[k] is not None} for r in report.collect()}
    gain = improvement_pct(report, "model", "zone_pair_median", "gradient_boosting").first()
    metadata = {
        "model_version": model.version,
        "trained_at": trained_at.isoformat(),
        "cutoff": settings.cutoff.isoformat(),
        "rows_trained": fit_part.count(),
        "features": list(FEATURES),
        "metrics": metrics,
        "improvement_over_lookup_pct": None if gain[2] is None else float(gain[2]),
        **model.card(),
    }
    model.save(paths.model, metadata)
    return metadata


def score_stream(
    spark: SparkSession,
    log: Log,
    paths: Paths,
    settings: Settings,
    quote: Quote | None = None,
    version: str = MODEL_VERSION,
    once: bool = False,
) -> StreamingQuery:
    """Score the live log as it grows, with the saved model or any other quoting function."""
    if quote is None:
        model, card = load_model(spark, paths.model)
        quote, version = model.quote, card["model_version"]
    return publish_quotes(
        follow_log(spark, log),
        quote,
        version,
        paths.predictions,
        paths.at("_checkpoints/predictions"),
        settings,
        dead_path=paths.at("scoring_dead_letters"),
        once=once,
    )


def score_batch(events: DataFrame, quote: Quote, version: str, settings: Settings) -> DataFrame:
    """Predictions for the live part of canonical events."""
    return score(flatten_zones(events.where(is_live(settings.cutoff))), quote, version)


def evaluate(spark: SparkSession, paths: Paths, now: datetime) -> dict[str, int]:
    """Bring the evaluation up to date with the predictions and publish what changed.

    The newest snapshot notes the batch it was computed up to. Only days that later batches touched are computed again,
    each from all of its predictions; without later batches no prediction is read.
    """
    newest, mark = newest_batch(spark, paths.predictions), high_water_mark(spark, paths.evaluation)
    if newest is None or (mark is not None and newest <= mark):
        return {"inserted": 0, "updated": 0, "unchanged": 0, "kept": 0}
    days = None if mark is None else days_since(spark, paths.predictions, mark)
    staged = evaluate_daily(read_quotes(spark, paths.predictions, days=days))
    current = read_snapshot(spark, paths.evaluation, EVALUATION)
    counts = _publish(merge_evaluation(current, staged, now, action="_took"), paths.evaluation)
    mark_snapshot(spark, paths.evaluation, newest)
    return counts


def ingest_validate(
    raw: DataFrame, log: Log, paths: Paths, ingested_at: datetime, settings: Settings, load: str | None = None
) -> DataFrame:
    """Raw rows to wire messages on the log; returns the rejected rows, which are stored as well.

    Rejects are kept under the id of the load (the ingest time, unless `load` names one).
    """
    held = scratch(raw.sparkSession, "judged")
    events, rejected = judged_once(raw, ingested_at, None, settings.source, path=held)
    write_log(encode_wire(events), log)
    # The log has the sound rows now; the rejected ones are still read by the caller.
    remove_folder(raw.sparkSession, f"{held}/{SOUND}")
    write_rejects(rejected, paths, load or _load_id("ingest", ingested_at))
    return rejected
