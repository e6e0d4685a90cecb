"""What grows with the trips: messages are packed well, judged rows do not outlast their load, and each message is read once."""

import zlib
from datetime import datetime

from pyspark.sql import functions as F

from samples import raw_frame
from tripflow import Settings
from tripflow.operators.ingest import judged_once
from tripflow.operators.validate import canonical_violations, first_violation
from tripflow.plans import jobs
from tripflow.plans.jobs import Paths
from tripflow.session import shared_folder
from tripflow.sources.files import list_files
from tripflow.sources.log import FileLog, read_log, write_log
from tripflow.sources.wire import decode_wire, encode_wire

AT, SETTINGS = datetime(2026, 6, 1), Settings()
BAD = {"fare_amount": -1.0}


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_a_log_is_packed_closer_than_at_best_speed(spark, tmp_path):
    rows = raw_frame(spark, {}).crossJoin(spark.range(2000)).withColumn("fare_amount", F.hash("id") % 5000 / 100 + 60).drop("id")
    sent = encode_wire(judged_once(rows.coalesce(1), AT)[0]).coalesce(1)
    log = FileLog(str(tmp_path / "log"))
    write_log(sent, log)
    lines = [r.value for r in read_log(spark, log).collect()]
    assert len(lines) == 2000
    size = sum(p.stat().st_size for p in (tmp_path / "log").glob("part-*.gz"))
    assert size < 0.95 * len(zlib.compress("\n".join(lines).encode(), 1))


def test_judged_rows_do_not_outlast_their_load(spark, tmp_path):
    paths, log = Paths(str(tmp_path / "out")), FileLog(str(tmp_path / "log"))
    held = lambda what: set(list_files(spark, shared_folder(spark), f"judged-*/{what}"))
    before, sound = held("*"), held("rejected=false")
    rejected = jobs.ingest_validate(raw_frame(spark, {}, BAD), log, paths, AT, SETTINGS, "a")
    assert held("rejected=false") == sound
    assert rejected.count() == 1 and read_log(spark, log).count() == 1
    between = held("*")
    jobs.load_history(raw_frame(spark, {}, BAD), paths, AT, SETTINGS, "2025-01")
    assert held("*") == between and between - before
    assert jobs.read_rejects(spark, paths).count() == 2


def test_the_first_violation_is_compiled_and_the_first_of_the_list(spark):
    good = judged_once(raw_frame(spark, {}), AT)[0]
    sick = good.unionByName(good.withColumn("fare_amount", F.lit("-1.00").cast("decimal(12,2)")).withColumn("trip_distance_km", F.lit(-1.0)))
    sick = sick.unionByName(good.withColumn("tip_amount", F.lit(None).cast("decimal(12,2)")).withColumn("passenger_count", F.lit(-1)))
    found = sick.select(first_violation().alias("one"), F.get(canonical_violations(), F.lit(0)).alias("listed")).collect()
    assert [r.one for r in found] == [r.listed for r in found] == [None, "negative_amount", "amount_missing"]
    assert "lambda" not in plan(decode_wire(encode_wire(good), SETTINGS.source))


def test_encoded_fields_are_read_once(spark):
    from catalog import QUERIES

    assert plan(QUERIES["s8_encode_wire"](spark, "/root/testdata/sf0.001")).count("get_json_object(") == 1
