"""Deterministic event identity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Length of the five groups of a UUID in hex digits, and the key's time format.
UUID_GROUPS = (8, 4, 4, 4, 12)
KEY_TIME = "yyyy-MM-dd HH:mm:ss"


def event_key(pickup: Column, dropoff: Column, pu: Column, do: Column, total: Column, provider: Column):
    """Six-field natural key as text; the amount as decimal text, so every engine agrees on it."""
    return F.concat_ws(
        "|",
        F.date_format(pickup, KEY_TIME),
        F.date_format(dropoff, KEY_TIME),
        pu.cast("string"),
        do.cast("string"),
        total.cast("string"),
        provider.cast("string"),
    )


def uuid_of(text: Column) -> Column:
    """First 32 hex digits of the SHA-256 in UUID shape."""
    digest = F.sha2(text, 256)
    groups, at = [], 1
    for width in UUID_GROUPS:
        groups.append(F.substring(digest, at, width))
        at += width
    return F.concat_ws("-", *groups)
