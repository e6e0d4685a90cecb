import json
from dataclasses import replace
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tripflow import Settings
from tripflow.operators.arrival import mark_late
from tripflow.operators.rollup import window_metrics
from tripflow.plans import jobs
from tripflow.plans.jobs import Paths
from tripflow.sources.log import FileLog
from tripflow.sources.serving_tables import read_batches
from tripflow.sources.wire import decode_view
from tripflow.streaming.hot import WINDOW_ROWS, missing_from_windows, read_windows

SETTINGS = Settings()
START = datetime(2026, 1, 1)


def message(minute: float, zone=1, fare="10.00"):
    return json.dumps(
        {
            "pickup_datetime": (START + timedelta(minutes=minute)).isoformat(),
            "pickup_location": {"zone_id": zone},
            "fare_amount": fare,
            "tip_amount": "1.00",
            "total_amount": "11.00",
            "trip_distance_km": 2.0,
        }
    )


def put(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.json").write_text("\n".join(lines) + "\n")


def run(spark, tmp_path, **kw):
    log = FileLog(str(tmp_path / "log"), files_per_batch=1)
    paths = Paths(str(tmp_path / "out"))
    for stream in jobs.run_hot_path(spark, log, paths, SETTINGS, once=True, **kw):
        stream.awaitTermination()
    return paths


def rows_of(df):
    return {
        (r.window_start, r.grain, r.zone_id): (r.trip_count, float(r.total_revenue))
        for r in df.collect()
    }


def test_stream_equals_batch_restarts_and_sets_damage_aside(spark, tmp_path):
    folder = tmp_path / "log"
    lines = [message(m, zone=m % 3 or None) for m in range(0, 60, 2)]
    put(folder, "a", *lines[:12], "not json", '{"pickup_datetime": "x"}')
    paths = run(spark, tmp_path)
    put(folder, "b", *lines[12:], message(59, fare="-1.00"))
    run(spark, tmp_path)  # goes on from the checkpoints
    views = decode_view(spark.createDataFrame([(x,) for x in lines], "value string"))
    batch = window_metrics(views, SETTINGS.window_minutes)
    served = read_windows(spark, paths.at("windows_final"), paths.at("windows_open"))
    assert rows_of(served) == rows_of(batch)
    closes = F.col("window_end") + F.expr("interval 10 minutes")
    final = read_batches(spark, paths.at("windows_final"), WINDOW_ROWS)
    want = batch.where(closes <= F.lit(START + timedelta(minutes=58)))
    assert rows_of(final) == rows_of(want) and final.count() == want.count()  # each emitted once
    assert spark.read.parquet(paths.at("hot_dead_letters")).count() == 3


def test_late_events_are_left_out_and_counted(spark, tmp_path):
    folder = tmp_path / "log"
    first = [message(m) for m in range(0, 40)]
    put(folder, "a", *first)
    put(folder, "b", message(60))
    put(folder, "c", message(1), message(61))
    paths = run(spark, tmp_path)
    served = read_windows(spark, paths.at("windows_final"), paths.at("windows_open"))
    events = [*range(0, 40), 60, 1, 61]
    assert missing_from_windows(len(events), served).first()[0] == 1
    order = spark.createDataFrame(
        [(i, i, START + timedelta(minutes=m)) for i, m in enumerate(events)],
        "arrival bigint, event_id bigint, pickup_datetime timestamp",
    )
    late = mark_late(order, 5, 10).where("is_late").collect()
    assert [r.arrival for r in late] == [41]


def test_double_replay_shows_in_the_hot_path_unless_unique(spark, tmp_path):
    lines = [message(m) for m in range(0, 30)]
    put(tmp_path / "log", "a", *lines, *lines)
    paths = run(spark, tmp_path)
    twice = read_windows(spark, paths.at("windows_final"), paths.at("windows_open"))
    assert twice.where("grain = 'city'").agg(F.sum("trip_count")).first()[0] == 60
    other = Paths(str(tmp_path / "unique"))
    from tripflow.sources.log import follow_log
    from tripflow.streaming.hot import publish_windows, read_views

    good, _ = read_views(follow_log(spark, FileLog(str(tmp_path / "log"))))
    publish_windows(
        good, "append", other.at("rows"), other.at("cp"), replace(SETTINGS), once=True, unique=True
    ).awaitTermination()
    once = read_batches(spark, other.at("rows"), WINDOW_ROWS).where("grain = 'city'")
    assert {r.trip_count for r in once.collect()} == {5}
