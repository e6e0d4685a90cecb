"""Raw records to canonical events."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tripflow.functions.identity import event_key, uuid_of
from tripflow.functions.once import with_once
from tripflow.functions.money import kilometres, money, surcharges
from tripflow.operators.validate import REJECT_REASONS, first_violation, reject_reason, split
from tripflow.schemas import DOUBLE, MONEY, SCHEMA_VERSION, extras_schema
from tripflow.session import scratch
from tripflow.sources.lake import partition_columns
from tripflow.sources.raw_files import resolve_columns

# Payment codes with a meaning of their own; every other code is OTHER, none is UNKNOWN.
PAYMENT_CODES = {1: "CARD", 2: "CASH", 5: "UNKNOWN"}
REASON = "reject_reason"
# Where a judged pass keeps the sound rows, below its path.
SOUND = "rejected=false"


def payment_type(code: Column) -> Column:
    named = F.lit("OTHER")
    for number, name in PAYMENT_CODES.items():
        named = F.when(code == number, name).otherwise(named)
    return F.when(code.isNull(), "UNKNOWN").otherwise(named)


def zone_location(zone: str) -> Column:
    """A place known by its zone only."""
    nowhere = F.lit(None).cast(DOUBLE)
    return F.struct(F.col(zone).alias("zone_id"), nowhere.alias("lat"), nowhere.alias("lon"))


def extras(source: str) -> Column:
    """The itemised raw fields kept for audit, in the shape registered for the source."""
    renamed = {"ratecode_id": "RatecodeID"}
    return F.struct(*(F.col(renamed.get(n, n)).alias(n) for n in extras_schema(source).names))


def judge(raw: DataFrame, month: str | Column | None = None) -> DataFrame:
    """A raw frame in the fixed shape, each row with its reject reason."""
    return with_once(resolve_columns(raw), REASON, reject_reason(month))


def to_canonical(valid: DataFrame, ingested_at: datetime, source: str = "tlc_yellow", *keep: Column) -> DataFrame:
    """Resolved, accepted raw rows as canonical events, with the columns `keep` in front."""
    total = money("total_amount")
    key = event_key(
        F.col("tpep_pickup_datetime"),
        F.col("tpep_dropoff_datetime"),
        F.col("PULocationID"),
        F.col("DOLocationID"),
        total,
        F.col("VendorID"),
    )
    canonical = {
        "event_id": uuid_of(key),
        "source": F.lit(source),
        "ingested_at": F.lit(ingested_at).cast("timestamp"),
        "schema_version": F.lit(SCHEMA_VERSION),
        "pickup_datetime": F.col("tpep_pickup_datetime"),
        "dropoff_datetime": F.col("tpep_dropoff_datetime"),
        "pickup_location": zone_location("PULocationID"),
        "dropoff_location": zone_location("DOLocationID"),
        "passenger_count": F.col("passenger_count"),
        "trip_distance_km": kilometres("trip_distance"),
        "provider_id": F.col("VendorID").cast("string"),
        "payment_type": payment_type(F.col("payment_type")),
        "fare_amount": money("fare_amount"),
        "surcharges_amount": surcharges().try_cast(MONEY),
        "tip_amount": money("tip_amount"),
        "tolls_amount": money("tolls_amount"),
        "total_amount": total,
        "source_extras": extras(source),
    }
    named = valid.select(*keep, *(column.alias(name) for name, column in canonical.items()))
    return named.select("*", *partition_columns())


def adapt(
    raw: DataFrame,
    ingested_at: datetime,
    month: str | Column | None = None,
    source: str = "tlc_yellow",
    observation: Observation | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(canonical events, rejected raw rows with their reason).

    With an `Observation`, the counts per reason are taken along with whatever job consumes the events,
    in the same pass over the data.
    """
    judged = judge(raw, month)
    watched = judged if observation is None else judged.observe(observation, *reject_counts())
    accepted, _ = split(watched, REASON)
    _, rejected = split(judged, REASON)
    return to_canonical(accepted, ingested_at, source), rejected


def reject_counts() -> list[Column]:
    reason = F.col(REASON)
    return [
        F.count(F.lit(1)).alias("total"),
        F.count_if(reason.isNull()).alias("accepted"),
        *(F.count_if(reason == name).alias(name) for name in REJECT_REASONS),
    ]


def judged_rows(
    raw: DataFrame,
    ingested_at: datetime,
    month: str | Column | None = None,
    source: str = "tlc_yellow",
    observation: Observation | None = None,
    path: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(sound raw rows, rejected raw rows with their reason), from one pass over the raw rows.

    The pass writes every row with its verdict to `path`, in the shared folder unless one is given; whatever reads the two
    afterwards starts from there. Who gives a path removes it (`SOUND` below it) when that is done.
    Rows whose event breaks a canonical constraint are rejects too, with the constraint as their reason. The raw form is
    kept, a third of the size of the events: these are derived where they are written, their ids there only.
    """
    judged = judge(raw, month)
    columns = [c for c in judged.columns if c != REASON]
    record = F.struct(*columns).alias("_record")
    events = to_canonical(judged, ingested_at, source, record, F.col(REASON).alias("_raw_reason"))
    verdict = F.coalesce("_raw_reason", first_violation())
    ruled = with_once(events, REASON, verdict)
    if observation is not None:
        ruled = ruled.observe(observation, *reject_counts())
    rows = ruled.select(F.col(REASON).isNotNull().alias("rejected"), REASON, "_record.*")
    path = path or scratch(raw.sparkSession, "judged")
    rows.write.option("compression", "zstd").partitionBy("rejected").parquet(path)
    held = raw.sparkSession.read.schema(rows.schema).parquet(path)
    return held.where("not rejected").select(*columns), held.where("rejected").select(*columns, REASON)


def judged_once(
    raw: DataFrame,
    ingested_at: datetime,
    month: str | Column | None = None,
    source: str = "tlc_yellow",
    observation: Observation | None = None,
    path: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(sound canonical events, rejected raw rows with their reason), from one pass over the raw rows."""
    sound, rejected = judged_rows(raw, ingested_at, month, source, observation, path)
    return to_canonical(sound, ingested_at, source), rejected


def flatten_zones(events: DataFrame) -> DataFrame:
    """Both zones as plain columns in place of the location structs."""
    kept = [c for c in events.columns if c not in ("pickup_location", "dropoff_location")]
    return events.select(
        *kept,
        F.col("pickup_location.zone_id").alias("pickup_zone_id"),
        F.col("dropoff_location.zone_id").alias("dropoff_zone_id"),
    )
