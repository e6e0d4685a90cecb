"""Keyed upserts as joins: absolute values replace stored ones, unchanged rows keep their time stamp."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.operators.dedupe import first_per_key
from tripflow.schemas import EVAL_VALUES, MEASURES

DAILY_KEYS = ("metric_date", "grain", "zone_id")
WINDOW_KEYS = ("window_start", "grain", "zone_id")
EVAL_KEYS = ("eval_date", "model_version")


def merge_changed(
    target: DataFrame,
    staged: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    now: datetime,
    stamp: str,
    covered: Callable[[Callable[[str], Column]], Column] | None = None,
    action: str | None = None,
) -> DataFrame:
    """The next version of `target`.

    Keys match null-safely. A staged row replaces the stored one only if some value differs, and only
    then takes `now` as its stamp. Stored keys absent from `staged` stay, unless `covered` (a condition
    built from the stored columns) says that the recompute should have produced them. `action` names an optional column telling
    what happened to each row: inserted, updated, unchanged or kept.
    """
    t = target.select(*keys, *values, stamp).withColumn("_there", F.lit(True)).alias("t")
    s = staged.select(*keys, *values).withColumn("_here", F.lit(True)).alias("s")
    same_key = reduce(and_, (F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys))
    here, there = F.col("s._here").isNotNull(), F.col("t._there").isNotNull()
    changed = reduce(or_, (~F.col(f"t.{v}").eqNullSafe(F.col(f"s.{v}")) for v in values))
    took = (
        F.when(here & ~there, "inserted")
        .when(here & changed, "updated")
        .when(here, "unchanged")
        .otherwise("kept")
    )
    written = here & (~there | changed)
    pick = lambda c: F.when(here, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c)
    joined = t.join(s, same_key, "full_outer")
    if covered is not None:
        gone = ~here & F.coalesce(covered(lambda c: F.col(f"t.{c}")), F.lit(False))
        joined = joined.where(~gone)
    return joined.select(
        *(pick(c) for c in (*keys, *values)),
        F.when(written, F.lit(now).cast("timestamp")).otherwise(F.col(f"t.{stamp}")).alias(stamp),
        *([took.alias(action)] if action else []),
    )


def merge_daily(target, staged, now, **kw) -> DataFrame:
    return merge_changed(target, staged, DAILY_KEYS, MEASURES, now, "updated_at", **kw)


def merge_evaluation(target, staged, now, **kw) -> DataFrame:
    return merge_changed(target, staged, EVAL_KEYS, EVAL_VALUES, now, "computed_at", **kw)


def replace_by_key(
    target: DataFrame, staged: DataFrame, keys: Sequence[str], newest_first: Sequence[Column] = ()
) -> DataFrame:
    """Last write wins: staged rows replace stored rows of the same key, the newest of them if several."""
    both = target.withColumn("_staged", F.lit(0)).unionByName(staged.withColumn("_staged", F.lit(1)))
    return first_per_key(both, keys, [F.desc("_staged"), *newest_first]).drop("_staged")
