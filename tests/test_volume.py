"""What jobs write for themselves stays in proportion to what they read: packed logs, narrow tables in between, few files."""

from datetime import datetime

from pyspark.sql import functions as F

from samples import raw_frame
from tripflow import Settings
from tripflow.operators.ingest import judged_once, judged_rows
from tripflow.sources.files import list_files
from tripflow.sources.log import FileLog, follow_log, read_log, write_log
from tripflow.sources.serving_tables import write_batch
from tripflow.sources.wire import decode_wire, decoded_once, encode_wire

AT, SETTINGS = datetime(2026, 6, 1), Settings()
LIVE = {"tpep_pickup_datetime": datetime(2026, 1, 2), "tpep_dropoff_datetime": datetime(2026, 1, 2, 1)}


def messages(spark, *rows):
    return encode_wire(judged_once(raw_frame(spark, *rows), AT)[0])


def test_a_log_is_packed_and_reads_back_whole(spark, tmp_path):
    sent = messages(spark, *({"fare_amount": 1.0 + k} for k in range(500))).coalesce(1)
    want = sorted(r.value for r in sent.collect())
    log = FileLog(str(tmp_path / "log"))
    write_log(sent, log)
    size = sum(p.stat().st_size for p in (tmp_path / "log").glob("part-*"))
    assert 4 * size < sum(map(len, want))
    assert sorted(r.value for r in read_log(spark, log).collect()) == want
    (
        follow_log(spark, log).select("value").writeStream.format("parquet").option("path", str(tmp_path / "rows"))
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    )
    assert sorted(r.value for r in spark.read.parquet(str(tmp_path / "rows")).collect()) == want


def test_files_that_are_batches_stay_in_pieces_tasks_can_share(spark, tmp_path):
    log = FileLog(str(tmp_path / "log"), files_per_batch=1, packed=False)
    write_log(messages(spark, {}), log)
    assert all(p.endswith(".txt") for p in list_files(spark, log.folder, "part-*"))


def test_decoding_holds_live_events_and_dead_text_only(spark, tmp_path):
    sent = messages(spark, {}, LIVE).select("value").unionByName(spark.createDataFrame([("not json",)], "value string"))
    path = str(tmp_path / "held")
    live, dead = decoded_once(decode_wire(sent, SETTINGS.source), SETTINGS, path)
    assert [r.pickup_datetime for r in live.collect()] == [LIVE["tpep_pickup_datetime"]]
    assert [r.value for r in dead.collect()] == ["not json"]
    held = spark.read.parquet(path)
    assert held.count() == 2 and held.where("not dead and value is not null").isEmpty()


def test_judging_holds_raw_rows_not_events(spark):
    sound, rejected = judged_rows(raw_frame(spark, {}, {"fare_amount": -1.0}), AT)
    assert sound.count() == 1 and rejected.count() == 1
    for file in sound.inputFiles():
        held = spark.read.parquet(file)
        assert "event" not in held.columns and "event_id" not in held.columns


def test_a_batch_has_one_small_file_per_day_whatever_its_tasks(spark, tmp_path):
    days = spark.range(0, 400, 1, 8).select("id", F.expr("timestamp'2026-01-01' + make_interval(0, 0, 0, cast(id % 5 as int))").alias("at"))
    write_batch(days, 0, str(tmp_path / "t"), "at")
    assert len(list_files(spark, str(tmp_path / "t"), "batch_id=0/day=*/part-*")) == 5


def test_codes_of_folds_start_from_kept_sums(spark, tmp_path):
    from tripflow.operators.encoding import cross_fitted_codes

    source = str(tmp_path / "rows")
    rows = spark.range(50).selectExpr(
        "cast(id as string) AS event_id", "id * 100 AS quoted_cents", "id % 3 AS pickup_zone_id", "id % 2 AS dropoff_zone_id", "id % 6 AS zone_pair"
    )
    rows.write.parquet(source)
    codes = cross_fitted_codes(spark.read.parquet(source), SETTINGS)
    assert source not in " ".join(codes.inputFiles()) and codes.count() > 0
