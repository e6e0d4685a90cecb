from dataclasses import replace
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from samples import GOOD, raw_frame
from tripflow import Settings
from tripflow.operators.ingest import adapt
from tripflow.plans import jobs
from tripflow.plans.jobs import Paths
from tripflow.schemas import DAILY
from tripflow.sources.lake import layout_report, lake_months, read_lake, write_lake
from tripflow.sources.log import (
    ConnectorMissing,
    FileLog,
    KafkaLog,
    diagnose,
    follow_log,
    read_log,
    write_log,
)
from tripflow.sources.raw_files import FILE_PREFIX, ordered_prefix, read_raw_range
from tripflow.sources.serving_tables import read_snapshot
from tripflow.sources.wire import decode_view, decode_wire, encode_wire

AT, SETTINGS = datetime(2026, 6, 1), Settings()


def ride(day: datetime, minutes=10, **more):
    return {"tpep_pickup_datetime": day, "tpep_dropoff_datetime": day + timedelta(minutes=minutes), **more}


def events(spark, *rides):
    return adapt(raw_frame(spark, *rides), AT)[0]


def test_lake_rewrites_only_its_days_and_prunes(spark, tmp_path):
    path = str(tmp_path / "lake")
    d = lambda n, h=8: datetime(2025, 3, n, h)
    write_lake(events(spark, ride(d(1)), ride(d(2)), ride(d(2, 9))), path, "tlc_yellow")
    write_lake(events(spark, ride(d(2), fare_amount=21.0)), path, "tlc_yellow")
    lake = read_lake(spark, path, "tlc_yellow")
    assert sorted((r.day, float(r.fare_amount)) for r in lake.collect()) == [(1, 20.0), (2, 21.0)]
    ranged = read_lake(spark, path, "tlc_yellow", d(2), datetime(2025, 3, 3))
    plan = ranged._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    assert "GreaterThanOrEqual(pickup_datetime" in plan
    assert [r.day for r in ranged.collect()] == [2]
    assert [tuple(r) for r in lake_months(spark, path).collect()] == [(2025, 3)]
    assert all(r.files == 1 and r.stray_rows == 0 for r in layout_report(lake).collect())


def write_month(spark, folder, month, *rides, **kw):
    raw_frame(spark, *rides, **kw).coalesce(1).write.parquet(f"{folder}/_{month}")
    part = next((folder / f"_{month}").glob("part-*.parquet"))
    (folder / f"{FILE_PREFIX}{month}.parquet").write_bytes(part.read_bytes())


def test_backfill_reads_drifting_months_in_one_plan(spark, tmp_path):
    first, second = datetime(2024, 11, 5, 7), datetime(2024, 12, 6, 7)
    write_month(spark, tmp_path, "2024-11", ride(first), ride(second))  # one stray
    write_month(spark, tmp_path, "2024-12", ride(second), ride(second, extra=None), without=("airport_fee",))
    paths = Paths(str(tmp_path / "out"))
    counts = jobs.backfill(spark, str(tmp_path), "2024-11", "2024-12", paths, AT, SETTINGS)
    assert counts["total"] == 4 and counts["accepted"] == 2
    assert counts["outside_source_month"] == 1 and counts["missing_required"] == 1
    daily = read_snapshot(spark, paths.daily, DAILY).where("grain = 'city'")
    assert {r.metric_date: r.trip_count for r in daily.collect()} == {date(2024, 11, 5): 1, date(2024, 12, 6): 1}
    assert spark.read.parquet(paths.rejects).count() == 2
    again = jobs.aggregate_daily(spark, paths, AT + timedelta(days=1), SETTINGS, datetime(2024, 11, 1))
    assert again == {"inserted": 0, "updated": 0, "unchanged": 4, "kept": 0}
    with pytest.raises(FileNotFoundError):
        read_raw_range(spark, str(tmp_path), "2020-01", "2020-02")
    with pytest.raises(ValueError):
        jobs.bulk_load(spark, str(tmp_path), "2026-01", paths, AT, SETTINGS)


def test_wire_round_trip_and_dead_letters(spark, tmp_path):
    live = events(spark, ride(datetime(2026, 1, 2, 3)), ride(datetime(2026, 1, 3, 3)), ride(datetime(2025, 12, 31, 3)))
    log = FileLog(str(tmp_path / "log"))
    write_log(encode_wire(live), log)
    write_log(encode_wire(live.withColumn("ingested_at", F.lit(AT + timedelta(hours=1)))), log)
    bad = ["not json", '{"pickup_datetime": "x"}', '{"fare_amount": "-1"}']
    write_log(spark.createDataFrame([(None, b) for b in bad], "key string, value string"), log)
    decoded = decode_wire(read_log(spark, log), "tlc_yellow")
    assert decoded.where("wire_error is not null").count() == 3
    paths = Paths(str(tmp_path / "out"))
    for _ in range(2):
        got = jobs.stream_to_lake(spark, log, paths, SETTINGS)
        assert got == {"rows_before": 4, "rows_after": 2, "collapsed": 2}
        lake = read_lake(spark, paths.lake, "tlc_yellow")
        assert [(r.day, r.ingested_at) for r in lake.orderBy("day").collect()] == [(2, AT), (3, AT)]
        assert spark.read.parquet(paths.dead_letters).count() == 3


def test_view_tells_absent_from_null(spark):
    head = '{"pickup_datetime":"2026-01-01T00:00:00","pickup_location":{"zone_id":1},"fare_amount":"1.00","total_amount":"1.00"'
    rows = [(head + "}",), (head + ',"tip_amount":null}',), (head + ',"tip_amount":"2.00","new_field":[1]}',)]
    got = decode_view(spark.createDataFrame(rows, "value string")).collect()
    assert [r.view_error for r in got] == [None, "missing_field", None]
    assert float(got[0].tip_amount) == 0.0 and float(got[2].tip_amount) == 2.0


def test_log_that_does_not_exist_yet(spark, tmp_path):
    log = FileLog(str(tmp_path / "nowhere"))
    assert read_log(spark, log).count() == 0
    paths = Paths(str(tmp_path / "out"))
    assert jobs.stream_to_lake(spark, log, paths, SETTINGS)["rows_after"] == 0
    assert diagnose(Exception("UNKNOWN_TOPIC_OR_PARTITION")) == "topic"
    assert diagnose(Exception("disk full")) is None
    kafka = KafkaLog("broker:9092", "trips")
    with pytest.raises(ConnectorMissing):
        read_log(spark, kafka)
    with pytest.raises(ConnectorMissing):
        follow_log(spark, kafka)


def test_ordered_prefix_cuts_inside_a_day(spark):
    rides = [ride(datetime(2025, 5, 1 + i // 4, i % 4)) for i in range(12)]
    got = ordered_prefix(events(spark, *rides), datetime(2025, 5, 1, 1), 5, "pickup_datetime", ["event_id"]).collect()
    assert [r.pickup_datetime for r in got] == [x["tpep_pickup_datetime"] for x in rides[1:6]]


def test_validation_job_keeps_every_record(spark, tmp_path):
    log, paths = FileLog(str(tmp_path / "log")), Paths(str(tmp_path / "out"))
    raw = raw_frame(spark, {}, {"fare_amount": -1.0}, {"trip_distance": None})
    jobs.ingest_validate(raw, log, paths, AT, SETTINGS)
    assert read_log(spark, log).count() == 1
    assert spark.read.parquet(paths.rejects).count() == 2


def test_train_save_load_quote(spark, tmp_path):
    paths = Paths(str(tmp_path / "out"))
    start = datetime(2025, 2, 1)
    rides = [
        ride(
            start + timedelta(hours=i),
            PULocationID=float(1 + i % 4),
            DOLocationID=float(1 + i % 3),
            passenger_count=None if i % 9 == 0 else 1.0,
            total_amount=20.0 + 5 * (i % 4) + (i % 3),
        )
        for i in range(400)
    ]
    jobs.load_history(raw_frame(spark, *rides), paths, AT, SETTINGS)
    card = jobs.train(spark, paths, AT, replace(SETTINGS, boosting_rounds=3, train_sample_rows=400))
    assert set(card["metrics"]) == {"global_median", "zone_pair_median", "gradient_boosting"}
    from tripflow.operators.boosting import load_model
    from tripflow.operators.ingest import flatten_zones

    model, saved = load_model(spark, paths.model)
    assert saved["model_version"] == card["model_version"]
    quoted = model.quote(flatten_zones(events(spark, ride(datetime(2026, 1, 1, 5), PULocationID=250.0), {})))
    assert quoted.where("predicted_amount is null").count() == 0
    assert GOOD["fare_amount"] == 20.0


def test_month_folders_keep_the_month_rule_and_repeat_nothing(spark, tmp_path):
    inside, stray = datetime(2024, 11, 5, 7), datetime(2008, 12, 31, 23)
    raw_frame(spark, ride(inside), ride(stray)).repartition(2).write.parquet(f"{tmp_path}/{FILE_PREFIX}2024-11.parquet")
    paths = Paths(str(tmp_path / "out"))
    for _ in range(2):
        counts = jobs.backfill(spark, str(tmp_path), "2024-11", "2024-11", paths, AT, SETTINGS)
        assert counts["accepted"] == 1 and counts["outside_source_month"] == 1
        assert spark.read.parquet(paths.rejects).count() == 1


def test_numbers_no_type_holds_are_rejected_not_fatal(spark, tmp_path):
    log, paths = FileLog(str(tmp_path / "log")), Paths(str(tmp_path / "out"))
    wild = [{"fare_amount": 1e11}, {"extra": 1e13}, {"extra": float("inf")}, {"trip_distance": 1e300}, {"tip_amount": float("inf")}]
    jobs.ingest_validate(raw_frame(spark, {}, *wild), log, paths, AT, SETTINGS)
    rejected = spark.read.parquet(paths.rejects)
    assert rejected.where("reject_reason = 'out_of_range'").count() == len(wild) == rejected.count()
    (good,) = read_log(spark, log).collect()
    views = spark.createDataFrame(
        [(good.value.replace('"trip_distance_km":', f'"trip_distance_km":{n},"was":'),) for n in ("1e300", '"Infinity"', '"NaN"', "1.5")],
        "value string",
    )
    from tripflow.operators.rollup import window_metrics
    from tripflow.sources.wire import decode_view

    judged = decode_view(views)
    assert judged.where("view_error is null").count() == 1
    wide = judged.where("view_error is null").withColumn("fare_amount", F.lit(500_000_000).cast("decimal(12,2)"))
    assert window_metrics(wide, 60).where("avg_fare is null").count() == 2


def test_lake_failures_are_not_taken_for_an_absent_topic(spark, tmp_path):
    log = FileLog(str(tmp_path / "log"))
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "part.txt").write_text("not json\n")
    blocked = tmp_path / "out"
    blocked.write_text("a file where the lake should be")
    with pytest.raises(Exception):  # noqa: B017
        jobs.stream_to_lake(spark, log, Paths(str(blocked)), SETTINGS)
    assert diagnose(Exception("Path does not exist: file:/x")) is None
