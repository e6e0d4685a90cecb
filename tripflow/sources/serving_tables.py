"""Where results are published for readers.

Two forms. A *snapshot* table (rollups, evaluations: small by construction) is written whole into a new
folder and becomes visible when it is complete, so a merge never reads and overwrites one path. A *batch*
table (window rows, predictions) gets one folder per micro-batch, cut by day; a batch that is delivered twice replaces
its own folder, and readers keep the newest row per key.

Batches are compacted: the newest row per key of the days that new batches touched is written once more as the base of
these days, and what it replaces is removed by the compaction after that, so that a reader who planned before a
compaction still finds its files. The number of folders stays bounded however many batches there were.

    <table>/batch_id=<k>/day=<day>/...        rows of one micro-batch
    <table>/base/upto=<k>/day=<day>/...       rows of a day, of all batches up to k; a newer base of the day replaces it
    <table>/base/upto=<k>/_complete           the base counts once this is there
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tripflow.operators.dedupe import first_per_key
from tripflow.schemas import DAY, LONG
from tripflow.sources.files import list_files, make_folder, remove_folder

# Folders of the older half of the batches stay until the next compaction: there are at most twice as many.
COMPACT_AFTER = 64
_DAY = re.compile(r"/day=([^/]+)$")
_UPTO = re.compile(r"/upto=(\d+)")
_BATCH = re.compile(r"/batch_id=(\d+)")


# --- snapshots ---------------------------------------------------------------------------------------


def _snapshots(spark: SparkSession, path: str) -> list[str]:
    done = list_files(spark, path, "snapshot=*/_SUCCESS")
    return [marker.rsplit("/", 1)[0] for marker in done]


def read_snapshot(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The newest complete snapshot; empty when none was published yet."""
    known = _snapshots(spark, path)
    if not known:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(known[-1])


def publish_snapshot(table: DataFrame, path: str, keep: int = 2) -> str:
    """Publish the next snapshot; of the older ones the last `keep` - 1 stay for readers that have begun."""
    spark = table.sparkSession
    known = _snapshots(spark, path)
    number = int(known[-1].rsplit("=", 1)[1]) + 1 if known else 1
    target = f"{path.rstrip('/')}/snapshot={number:08d}"
    table.write.mode("overwrite").parquet(target)
    for old in known[: len(known) + 1 - keep]:
        remove_folder(spark, old)
    return target


def high_water_mark(spark: SparkSession, path: str) -> int | None:
    """The batch up to which the newest snapshot was computed, as `mark_snapshot` noted it; None if it did not."""
    known = _snapshots(spark, path)
    marks = [int(m.rsplit("=", 1)[1]) for m in (list_files(spark, known[-1], "_upto=*") if known else [])]
    return max(marks, default=None)


def mark_snapshot(spark: SparkSession, path: str, upto: int) -> None:
    """Note on the newest snapshot the batch up to which it was computed. It is written after the snapshot: where a job
    fails in between, the snapshot has no mark, and the next run computes all of it."""
    known = _snapshots(spark, path)
    if known:
        make_folder(spark, f"{known[-1]}/_upto={upto}")


# --- batches -----------------------------------------------------------------------------------------


def _bases(spark: SparkSession, path: str) -> list[int]:
    """The batches that complete bases go up to, ascending."""
    done = list_files(spark, path, "base/upto=*/_complete")
    return sorted(int(_UPTO.search(p)[1]) for p in done)


def _batch_ids(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(_BATCH.search(p)[1]) for p in list_files(spark, path, "batch_id=*"))


def _day_folders(spark: SparkSession, path: str) -> dict[str, str]:
    """The folder that holds the base of each day: the newest complete one."""
    complete, newest = set(_bases(spark, path)), {}
    for folder in list_files(spark, path, "base/upto=*/day=*"):
        upto, day = int(_UPTO.search(folder)[1]), _DAY.search(folder)[1]
        if upto in complete and (day not in newest or upto > newest[day][0]):
            newest[day] = (upto, folder)
    return {day: folder for day, (_, folder) in newest.items()}


def write_batch(rows: DataFrame, batch_id: int, path: str, time: str) -> None:
    """Publish a micro-batch; one that a compaction has taken in already is not published again."""
    merged = _bases(rows.sparkSession, path)
    if merged and batch_id <= merged[-1]:
        return
    # Each day in one task: otherwise every task writes a file for every day.
    dated = rows.withColumn("day", F.to_date(time)).hint("rebalance", "day")
    dated.write.mode("overwrite").partitionBy("day").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")


def newest_batch(spark: SparkSession, path: str) -> int | None:
    """The highest batch id of a table; None while it has none."""
    return max([*_batch_ids(spark, path), *_bases(spark, path)], default=None)


def days_since(spark: SparkSession, path: str, mark: int) -> list[str]:
    """The days that batches after `mark` have touched, from folder names alone (a compaction may name a few more)."""
    batches = [p for p in list_files(spark, path, "batch_id=*/day=*") if int(_BATCH.search(p)[1]) > mark]
    bases = [p for p in list_files(spark, path, "base/upto=*/day=*") if int(_UPTO.search(p)[1]) > mark]
    return sorted({_DAY.search(p)[1] for p in (*batches, *bases)})


def read_batches(
    spark: SparkSession,
    path: str,
    schema: StructType,
    since: datetime | date | None = None,
    until: datetime | date | None = None,
    days: Sequence[str] | None = None,
) -> DataFrame:
    """All rows still held, with their batch id. A range of event times, or a list of days, reads those day folders only."""
    merged = _bases(spark, path)
    upto = merged[-1] if merged else -1
    whole = StructType([*schema.fields, StructField("batch_id", LONG), StructField("day", DAY)])
    root, found = path.rstrip("/"), []
    live = [f"{root}/batch_id={k}" for k in _batch_ids(spark, path) if k > upto]
    if live:
        found.append(spark.read.schema(whole).option("basePath", root).parquet(*live))
    base = sorted(_day_folders(spark, path).values())
    if base:
        # `upto` comes from the folder names and is of no use to readers.
        inner = StructType([*whole.fields, StructField("upto", LONG)])
        found.append(spark.read.schema(inner).option("basePath", f"{root}/base").parquet(*base).drop("upto"))
    if not found:
        return spark.createDataFrame([], whole).drop("day")
    rows = found[0] if len(found) == 1 else found[0].unionByName(found[1])
    day = F.col("day")
    if since is not None:
        rows = rows.where(day >= F.lit(since).cast("date"))
    if until is not None:
        rows = rows.where(day <= F.lit(until).cast("date"))
    if days is not None:
        rows = rows.where(day.isin(*[date.fromisoformat(d) for d in days]))
    return rows.drop("day")


def compact(
    spark: SparkSession,
    path: str,
    schema: StructType,
    keys: Sequence[str],
    newest_first: Sequence[Column],
    time: str,
    keep: Callable[[DataFrame], DataFrame] | None = None,
) -> int | None:
    """Take all batches in: one row per key for each day they touched. Returns the batch taken in last.

    `keep` may drop rows that nobody needs any more. Only touched days are written again.
    """
    ids, merged = _batch_ids(spark, path), _bases(spark, path)
    before = merged[-1] if merged else -1
    if not ids or ids[-1] <= before:
        return None
    upto, root = ids[-1], path.rstrip("/")
    days = days_since(spark, path, before)
    rows = first_per_key(read_batches(spark, path, schema, days=days), keys, newest_first)
    rows = (keep(rows) if keep else rows).withColumn("day", F.to_date(time))
    target = f"{root}/base/upto={upto:012d}"
    rows.hint("rebalance", "day").write.mode("overwrite").partitionBy("day").parquet(target)
    for day in days:
        # A day without rows is replaced by an empty folder.
        make_folder(spark, f"{target}/day={day}")
    make_folder(spark, f"{target}/_complete")
    # What the base before this one has replaced goes now; what this one replaces goes next time.
    for old in (k for k in ids if k <= before):
        remove_folder(spark, f"{root}/batch_id={old}")
    current = _day_folders(spark, path)
    for folder in list_files(spark, path, "base/upto=*/day=*"):
        if int(_UPTO.search(folder)[1]) < before and current.get(_DAY.search(folder)[1]) != folder:
            remove_folder(spark, folder)
    return upto


def due(spark: SparkSession, path: str, after: int = COMPACT_AFTER) -> bool:
    """Whether as many batches wait for a compaction."""
    merged = _bases(spark, path)
    return sum(k > (merged[-1] if merged else -1) for k in _batch_ids(spark, path)) >= after


def stage_jdbc(table: DataFrame, url: str, name: str, connections: int = 4, **options: str) -> None:
    """Replace a disposable staging table in a database; the open connections are the scarce resource.

    The rows are written once to the shared folder first, so that few connections do not narrow the work behind them.
    """
    from tripflow.session import settled

    writer = settled(table, "jdbc-stage").coalesce(connections).write.format("jdbc")
    writer.options(url=url, dbtable=name, **options).mode("overwrite").save()
