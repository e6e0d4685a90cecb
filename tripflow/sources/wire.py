"""Wire messages: canonical events as JSON text, and the two ways of reading them back.

Every scalar is read as text and cast with `try_cast`. A NULL that had text behind it is an error of the
message, reported in a column; it is never passed on as a missing value.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType, TimestampType

from tripflow.functions.identity import event_key, uuid_of
from tripflow.functions.once import with_once
from tripflow.functions.time import iso_text
from tripflow.operators.ownership import is_live
from tripflow.operators.validate import first_violation
from tripflow.schemas import (
    CANONICAL_TYPES,
    DOUBLE,
    INSTANT,
    INT,
    KEY_TEXT,
    MONEY,
    REQUIRED_CANONICAL,
    VIEW_TEXT,
    WIDE,
    WIRE_TEXT,
    extras_schema,
)
from tripflow.settings import Settings


def encode_wire(events: DataFrame) -> DataFrame:
    """Canonical events as (key, value): the pickup zone as text, the event as JSON.

    Amounts and times travel as JSON strings, so no reader has to trust a float.
    """
    fields = []
    for name, kind in CANONICAL_TYPES.items():
        column = F.col(name)
        if kind == MONEY:
            column = column.cast("string")
        elif isinstance(kind, TimestampType):
            column = iso_text(column)
        fields.append(column.alias(name))
    fields.append(F.col("source_extras"))
    return events.select(
        F.col("pickup_location.zone_id").cast("string").alias("key"),
        F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value"),
    )


def _typed(text: Column, kind: DataType) -> tuple[Column, Column]:
    """The cast value, and whether text was there that the cast could not read."""
    value = text.try_cast(kind)
    if kind == DOUBLE:
        # "NaN", "Infinity" and 1e300 are doubles, but nothing downstream can add them up exactly.
        value = F.when(value.try_cast(WIDE).isNotNull(), value)
    return value, text.isNotNull() & value.isNull()


def decode_wire(messages: DataFrame, source: str) -> DataFrame:
    """Messages as canonical columns plus `wire_error` (NULL when good) and the untouched `value`."""
    # The extras keep their own types; an unreadable extra is audit data lost, not a broken event.
    shape = StructType([*WIRE_TEXT.fields, StructField("source_extras", extras_schema(source))])
    texts = messages.select(F.col("value").cast("string").alias("value"))
    parsed = with_once(texts, "m", F.from_json("value", shape))
    columns, unreadable = [], []
    for name, kind in CANONICAL_TYPES.items():
        if isinstance(kind, StructType):
            parts = []
            for field in kind.fields:
                value, bad = _typed(F.col(f"m.{name}.{field.name}"), field.dataType)
                parts.append(value.alias(field.name))
                unreadable.append(bad)
            column = F.when(F.col(f"m.{name}").isNotNull(), F.struct(*parts))
        else:
            column, bad = _typed(F.col(f"m.{name}"), kind)
            unreadable.append(bad)
        columns.append(column.alias(name))
    flagged = parsed.select(
        *columns, "m.source_extras", reduce(or_, unreadable).alias("_unreadable"), "value"
    )
    missing = reduce(or_, (F.col(name).isNull() for name in REQUIRED_CANONICAL))
    error = (
        F.when(F.col("_unreadable"), "unreadable_field")
        .when(missing, "missing_field")
        .otherwise(first_violation())
    )
    return with_once(flagged, "wire_error", error).drop("_unreadable")


def decoded_once(judged: DataFrame, settings: Settings, path: str) -> tuple[DataFrame, DataFrame]:
    """(live events, dead letters) of decoded messages, read back from `path`, where one pass over them has written both.

    The pass leaves out what neither side reads: events that belong to the history, and the text of readable messages.
    """
    dead = F.col("wire_error").isNotNull()
    fields = [c for c in judged.columns if c not in ("value", "wire_error")]
    rows = judged.where(dead | is_live(settings.cutoff)).select(
        dead.alias("dead"),
        "wire_error",
        F.when(dead, F.col("value")).alias("value"),
        *(F.when(~dead, F.col(c)).alias(c) for c in fields),
    )
    rows.write.option("compression", "zstd").partitionBy("dead").parquet(path)
    held = judged.sparkSession.read.schema(rows.schema).parquet(path)
    return held.where("not dead").select(*fields), held.where("dead").select("value", "wire_error")


def decode_view(messages: DataFrame, keyed: bool = False) -> DataFrame:
    """The few fields window metrics need; unknown fields are ignored.

    Carries every column of `messages` along (arrival numbers, for one) and adds `view_error`. With `keyed` also
    `trip_key`, the digest of the natural key that tells copies of a trip from other trips.
    """
    text = F.col("value").cast("string")
    m = lambda path: F.col(f"_m.{path}")
    parsed = with_once(messages, "_m", F.from_json(text, StructType([*VIEW_TEXT.fields, *(KEY_TEXT.fields if keyed else ())])))
    pickup, bad_pickup = _typed(m("pickup_datetime"), INSTANT)
    zone, bad_zone = _typed(m("pickup_location.zone_id"), INT)
    fare, bad_fare = _typed(m("fare_amount"), MONEY)
    total, bad_total = _typed(m("total_amount"), MONEY)
    km, bad_km = _typed(m("trip_distance_km"), DOUBLE)
    tip_read, bad_tip = _typed(m("tip_amount"), MONEY)
    # An absent tip is no tip; an explicit null is an invalid message.
    tip_named = F.coalesce(F.array_contains(F.json_object_keys(text), "tip_amount"), F.lit(False))
    tip = F.when(m("tip_amount").isNotNull(), tip_read).when(~tip_named, F.lit(0).cast(MONEY))
    unreadable = bad_pickup | bad_zone | bad_fare | bad_total | bad_km | bad_tip
    carried = [c for c in messages.columns if c != "value"]
    digest = []
    if keyed:
        dropoff, to = m("dropoff_datetime").try_cast(INSTANT), m("dropoff_location.zone_id").try_cast(INT)
        digest = [uuid_of(event_key(pickup, dropoff, zone, to, total, m("provider_id"))).alias("trip_key")]
    decoded = parsed.select(
        *carried,
        pickup.alias("pickup_datetime"),
        zone.alias("zone_id"),
        fare.alias("fare_amount"),
        tip.alias("tip_amount"),
        total.alias("total_amount"),
        km.alias("trip_distance_km"),
        *digest,
        unreadable.alias("_unreadable"),
        m("pickup_location").isNull().alias("_no_place"),
        text.alias("value"),
    )
    needed = ("pickup_datetime", "fare_amount", "tip_amount", "total_amount")
    missing = reduce(or_, (F.col(c).isNull() for c in needed)) | F.col("_no_place")
    below_zero = ("fare_amount", "tip_amount", "total_amount", "trip_distance_km")
    negative = reduce(or_, (F.coalesce(F.col(c) < 0, F.lit(False)) for c in below_zero))
    error = (
        F.when(F.col("_unreadable"), "unreadable_field")
        .when(missing, "missing_field")
        .when(negative, "negative_value")
    )
    return with_once(decoded, "view_error", error).drop("_unreadable", "_no_place")
