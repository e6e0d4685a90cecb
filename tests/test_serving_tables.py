"""Batch tables: repeated batches, compaction, ranges of days; and what is computed from them step by step."""

from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from tripflow.operators.evaluation import evaluate_daily
from tripflow.plans import jobs
from tripflow.plans.jobs import Paths
from tripflow.schemas import EVALUATION, PREDICTIONS
from tripflow.sources.files import list_files
from tripflow.sources.serving_tables import (
    compact,
    days_since,
    due,
    high_water_mark,
    newest_batch,
    publish_snapshot,
    read_batches,
    read_snapshot,
    write_batch,
)
from tripflow.streaming.hot import WINDOW_ROWS, compact_windows
from tripflow.streaming.scoring import newest_quote, read_quotes

START = datetime(2026, 1, 1, 8)


def quotes(spark, *rows):
    """Rows of (event id, day, predicted, actual)."""
    data = [
        (i, START + timedelta(days=d), START + timedelta(days=d, minutes=9), 1, 2, p, a, "v", START) for i, d, p, a in rows
    ]
    frame = spark.createDataFrame(
        data, "event_id string, p timestamp, q timestamp, x int, y int, f double, a double, v string, t timestamp"
    ).toDF(*PREDICTIONS.names)
    return frame.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in PREDICTIONS.fields))


def shrink(spark, path):
    return compact(spark, path, PREDICTIONS, ["event_id"], newest_quote(), "pickup_datetime")


def content(spark, path, **span):
    return sorted((r.event_id, float(r.predicted_amount)) for r in read_quotes(spark, path, **span).collect())


def test_folders_stay_bounded_over_many_batches(spark, tmp_path):
    path, want, most = str(tmp_path / "quotes"), {}, 0
    for k in range(90):
        # Every batch repeats an event of an earlier one with another quote.
        rows = [(f"e{k}", k // 10, 10.0 + k, 11.0), (f"e{k // 2}", k // 2 // 10, 500.0 + k, 11.0)]
        want.update({i: p for i, _, p, _ in rows[: 1 if k // 2 == k else 2]})
        write_batch(quotes(spark, *rows[: 1 if k // 2 == k else 2]), k, path, "pickup_datetime")
        if due(spark, path, 10):
            shrink(spark, path)
        most = max(most, len(list_files(spark, path, "batch_id=*")) + len(list_files(spark, path, "base/upto=*/day=*/part-*")))
    assert content(spark, path) == sorted(want.items())
    assert most <= 2 * 10 + 2 * 10  # batches of two compactions, and a file per day of two bases
    assert newest_batch(spark, path) == 89


def test_readers_and_repeats_across_a_compaction(spark, tmp_path):
    path = str(tmp_path / "quotes")
    write_batch(quotes(spark, ("a", 0, 1.0, 1.0)), 0, path, "pickup_datetime")
    write_batch(quotes(spark, ("a", 0, 2.0, 1.0), ("b", 1, 3.0, 1.0)), 1, path, "pickup_datetime")
    planned = read_quotes(spark, path)  # its files are listed now
    assert shrink(spark, path) == 1 and shrink(spark, path) is None
    want = [("a", 2.0), ("b", 3.0)]
    assert sorted((r.event_id, float(r.predicted_amount)) for r in planned.collect()) == want == content(spark, path)
    # A batch that was taken in is delivered again, and a later one twice.
    write_batch(quotes(spark, ("a", 0, 9.0, 1.0)), 1, path, "pickup_datetime")
    for value in (7.0, 8.0):
        write_batch(quotes(spark, ("b", 1, value, 1.0)), 2, path, "pickup_datetime")
    assert content(spark, path) == [("a", 2.0), ("b", 8.0)]
    planned = read_quotes(spark, path)
    shrink(spark, path)
    assert sorted((r.event_id, float(r.predicted_amount)) for r in planned.collect()) == content(spark, path) == [("a", 2.0), ("b", 8.0)]
    # An unfinished base does not count.
    quotes(spark, ("z", 0, 1.0, 1.0)).withColumn("day", F.lit(date(2026, 1, 1))).write.partitionBy("day").parquet(f"{path}/base/upto=000000000099")
    assert content(spark, path) == [("a", 2.0), ("b", 8.0)]


def test_a_range_reads_its_days_only(spark, tmp_path):
    path = str(tmp_path / "quotes")
    write_batch(quotes(spark, *((f"e{d}", d, 1.0, 1.0) for d in range(8))), 0, path, "pickup_datetime")
    shrink(spark, path)
    write_batch(quotes(spark, ("late", 3, 1.0, 1.0), ("far", 7, 1.0, 1.0)), 1, path, "pickup_datetime")
    span = {"since": START + timedelta(days=2), "until": START + timedelta(days=3, hours=1)}
    assert [i for i, _ in content(spark, path, **span)] == ["e2", "e3", "late"]
    plan = read_batches(spark, path, PREDICTIONS, **span)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(day") == 2 and "PartitionFilters: []" not in plan
    assert days_since(spark, path, 0) == ["2026-01-04", "2026-01-08"]


def test_provisional_rows_of_final_windows_are_dropped(spark, tmp_path):
    final, open_ = str(tmp_path / "final"), str(tmp_path / "open")

    def rows(*hours):
        data = [(START + timedelta(hours=h), START + timedelta(hours=h + 1), "city", None, n, 1.0, 1.0, 1.0, 1.0) for h, n in hours]
        frame = spark.createDataFrame(data, "a timestamp, b timestamp, g string, z int, n long, r double, f double, t double, k double")
        frame = frame.toDF(*WINDOW_ROWS.names)
        return frame.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in WINDOW_ROWS.fields))

    write_batch(rows((0, 5), (1, 5)), 0, open_, "window_start")
    write_batch(rows((1, 6), (2, 1)), 1, open_, "window_start")
    write_batch(rows((0, 5), (1, 6)), 0, final, "window_start")
    compact_windows(spark, open_, final)
    assert [(r.window_start.hour, r.trip_count) for r in read_batches(spark, open_, WINDOW_ROWS).collect()] == [(10, 1)]
    # A day whose rows are all dropped stays empty.
    write_batch(rows((2, 1)), 1, final, "window_start")
    write_batch(rows((2, 1)), 2, open_, "window_start")
    compact_windows(spark, open_, final)
    assert read_batches(spark, open_, WINDOW_ROWS).isEmpty()


def test_evaluation_goes_on_from_its_mark(spark, tmp_path, monkeypatch):
    paths = Paths(str(tmp_path))
    at, later = datetime(2026, 2, 1), datetime(2026, 2, 2)
    assert jobs.evaluate(spark, paths, at) == {"inserted": 0, "updated": 0, "unchanged": 0, "kept": 0}
    write_batch(quotes(spark, ("a", 0, 10.0, 12.0), ("b", 1, 10.0, 10.0), ("c", 1, 5.0, 9.0)), 0, paths.predictions, "pickup_datetime")
    assert jobs.evaluate(spark, paths, at)["inserted"] == 2 and high_water_mark(spark, paths.evaluation) == 0
    read = []
    real = jobs.read_quotes
    monkeypatch.setattr(jobs, "read_quotes", lambda *a, **k: read.append(k["days"]) or real(*a, **k))
    assert jobs.evaluate(spark, paths, later)["inserted"] == 0 and read == []
    write_batch(quotes(spark, ("d", 1, 7.0, 7.0), ("e", 2, 1.0, 2.0)), 1, paths.predictions, "pickup_datetime")
    compact(spark, paths.predictions, PREDICTIONS, ["event_id"], newest_quote(), "pickup_datetime")
    counts = jobs.evaluate(spark, paths, later)
    assert counts["inserted"] == 1 and counts["updated"] == 1
    whole = evaluate_daily(read_quotes(spark, paths.predictions))
    columns = whole.columns
    stored = read_snapshot(spark, paths.evaluation, EVALUATION)
    assert sorted(map(tuple, stored.select(*columns).collect())) == sorted(map(tuple, whole.collect()))
    assert {r.eval_date.day: r.computed_at for r in stored.collect()} == {1: at, 2: later, 3: later}
    read.clear()
    jobs.evaluate(spark, paths, later)
    assert read == []


def test_old_snapshots_go(spark, tmp_path):
    path = str(tmp_path / "table")
    for n in range(5):
        publish_snapshot(spark.range(n + 1), path)
    assert len(list_files(spark, path, "snapshot=*")) == 2
    assert read_snapshot(spark, path, spark.range(1).schema).count() == 5
