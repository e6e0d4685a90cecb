"""Loads judged in one pass, with rejects that last as long as their load is not repeated."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from samples import raw_frame
from tripflow import Settings
from tripflow.operators.ingest import adapt, judged_once
from tripflow.plans import jobs
from tripflow.plans.jobs import Paths, read_rejects
from tripflow.sources.log import FileLog, read_log, write_log
from tripflow.sources.wire import encode_wire
from tripflow.streaming.scoring import read_quotes

AT, SETTINGS = datetime(2026, 6, 1), Settings()
BAD = {"fare_amount": -1.0}


def kept(spark, paths):
    return sorted((r.load_id, r.reject_reason) for r in read_rejects(spark, paths).collect())


def test_rejects_of_several_loads_and_reruns(spark, tmp_path):
    paths, log = Paths(str(tmp_path / "out")), FileLog(str(tmp_path / "log"))
    assert kept(spark, paths) == []
    run = lambda load, *rows: jobs.ingest_validate(raw_frame(spark, *rows), log, paths, AT, SETTINGS, load)
    run("a", {}, BAD, {"trip_distance": None})
    run("b", BAD)
    assert kept(spark, paths) == [("a", "missing_required"), ("a", "negative_money"), ("b", "negative_money")]
    run("a", {}, BAD)
    assert kept(spark, paths) == [("a", "negative_money"), ("b", "negative_money")]
    run("a", {})
    assert kept(spark, paths) == [("b", "negative_money")]
    with pytest.raises(ValueError, match="load id"):
        run("../a", {})


def test_a_clean_rerun_of_a_month_leaves_no_rejects(spark, tmp_path):
    paths = Paths(str(tmp_path / "out"))
    other = raw_frame(spark, BAD).withColumn("source_month", F.lit("2024-12-01").cast("date"))
    jobs.load_history(other, paths, AT, SETTINGS, F.col("source_month"), "undated", ["2024-12"])
    for rows, want in ((({}, BAD), 1), (({},), 0)):
        counts = jobs.load_history(raw_frame(spark, *rows), paths, AT, SETTINGS, "2025-01")
        assert counts["accepted"] == 1 and counts["total"] == len(rows)
        assert [x for x, _ in kept(spark, paths)] == ["2024-12"] + ["2025-01"] * want


def test_one_pass_gives_what_two_gave_and_reads_the_source_once(spark, tmp_path):
    rows = [{}, BAD, {"trip_distance": None}, {"fare_amount": 1e11}, {"extra": float("inf")}, {"tpep_dropoff_datetime": datetime(2025, 1, 1)}]
    raw_frame(spark, *rows).repartition(2).write.parquet(str(tmp_path / "raw"))
    source = spark.read.parquet(str(tmp_path / "raw"))
    events, rejected = judged_once(source, AT)
    want_events, want_rejected = adapt(source, AT)
    same = lambda a, b: sorted(map(repr, a.collect())) == sorted(map(repr, b.select(*a.columns).collect()))
    assert same(events, want_events) and same(rejected, want_rejected)
    for frame in (events, rejected):
        assert str(tmp_path / "raw") not in " ".join(frame.inputFiles())


def test_events_that_break_a_canonical_rule_are_rejects(spark, tmp_path, monkeypatch):
    from tripflow.operators import ingest

    # The raw rules let everything through: only the canonical ones are left.
    monkeypatch.setattr(ingest, "reject_reason", lambda month: F.lit(None).cast("string"))
    events, rejected = judged_once(raw_frame(spark, {}, BAD, {"PULocationID": None}), AT)
    assert events.count() == 1
    assert sorted(r.reject_reason for r in rejected.collect()) == ["location_missing", "negative_amount"]


def test_readable_and_dead_messages_add_up(spark, tmp_path):
    paths, log = Paths(str(tmp_path / "out")), FileLog(str(tmp_path / "log"), files_per_batch=1)
    live = [{"tpep_pickup_datetime": datetime(2026, 1, d), "tpep_dropoff_datetime": datetime(2026, 1, d, 1)} for d in range(1, 6)]
    events, _ = judged_once(raw_frame(spark, *live, {"total_amount": 9e8, **live[0]}), AT)
    write_log(encode_wire(events), log)
    write_log(spark.createDataFrame([(None, "not json")], "key string, value string"), log)
    quote = lambda t: t.withColumn("predicted_amount", F.lit("1.00").cast("decimal(10,2)"))
    for _ in range(2):
        jobs.score_stream(spark, log, paths, SETTINGS, quote=quote, version="v", once=True).awaitTermination()
        dead = spark.read.parquet(paths.at("scoring_dead_letters"))
        assert sorted(r.wire_error for r in dead.collect())[0] in ("missing_field", "price_out_of_range", "unreadable_field")
        assert read_quotes(spark, paths.predictions).count() == 5 and dead.count() == 2
        assert read_log(spark, log).count() == 7
