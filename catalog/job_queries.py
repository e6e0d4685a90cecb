"""Streams and whole jobs (R*, K*). They publish into a fresh folder and return what they published."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.analysis_queries import LATE
from catalog.inputs import INGESTED, NOW, Inputs
from catalog.ingest_queries import damaged_messages
from catalog.reference_sql import amount, rollup
from catalog.registry import query
from catalog.serving_queries import FOLLOWED, SHORT_TRAINING, followed, ruled_cents
from catalog.shapes import HISTORY_STAMP, PAIR_VERSION
from tripflow.operators.arrival import mark_late
from tripflow.operators.baselines import global_median, pair_medians, quote_by_global, quote_by_pair
from tripflow.operators.dedupe import first_per_key
from tripflow.operators.merge import WINDOW_KEYS
from tripflow.operators.ownership import is_live
from tripflow.operators.rollup import city_rows, mark_final, window_metrics
from tripflow.operators.serving import serving_windows
from tripflow.plans.jobs import (
    backfill,
    Paths,
    aggregate_daily,
    evaluate,
    ingest_validate,
    load_history,
    read_rejects,
    run_hot_path,
    score_stream,
    stream_to_lake,
    train,
)
from tripflow.schemas import DAILY, EVALUATION
from tripflow.session import scratch, settled
from tripflow.sources.lake import read_lake, write_lake
from tripflow.sources.files import exists, list_files, make_folder, rename
from tripflow.sources.log import FileLog, follow_log, read_log, write_log
from tripflow.sources.raw_files import FILE_PREFIX, read_raw_range
from tripflow.sources.serving_tables import read_batches, read_snapshot
from tripflow.sources.wire import decode_view, encode_wire
from tripflow.streaming.hot import WINDOW_ROWS, publish_dead_letters, publish_windows, read_views, read_windows
from tripflow.streaming.scoring import publish_quotes, read_quotes

_MEASURES = "trip_count, total_revenue, avg_fare, avg_tip, avg_distance_km"


def place(i: Inputs, name: str) -> Paths:
    return Paths(scratch(i.spark, name))


def written_log(i: Inputs, events: DataFrame, paths: Paths) -> FileLog:
    log = FileLog(paths.at("log"))
    write_log(encode_wire(events), log)
    return log


def table_stream(i: Inputs) -> DataFrame:
    """The events table itself followed as a stream, in the consumer's view."""
    # A pattern, because the table may be one file or a folder of files.
    rows = i.spark.readStream.schema(i.table("events").schema).parquet(f"{i.folder}/event[s].parquet")
    amount_of = lambda c: (c.cast("decimal(14,0)") / 100).cast("decimal(12,2)")
    fare = (F.col("value").cast("decimal(12,2)") * 100).cast("bigint")
    tip = F.when(F.col("event_type") == "purchase", F.expr("_fare div 10")).otherwise(0)
    zone = F.when(F.col("user_id") % 29 != 0, (1 + F.col("user_id") % 25).cast("int"))
    km = F.when(F.col("event_type") != "error", (F.col("event_id") % 200) / 10)
    return (
        rows.withColumn("_fare", fare)
        .withColumn("_tip", tip)
        .select(
            F.col("ts").cast("timestamp").alias("pickup_datetime"),
            zone.alias("zone_id"),
            amount_of(F.col("_fare")).alias("fare_amount"),
            amount_of(F.col("_tip")).alias("tip_amount"),
            amount_of(F.col("_fare") + F.col("_tip")).alias("total_amount"),
            km.alias("trip_distance_km"),
        )
    )


def run_windows(i: Inputs, mode: str, minutes: int, unique: bool = False) -> DataFrame:
    paths = place(i, f"stream-{mode}")
    settings = replace(i.settings, window_minutes=minutes)
    publish_windows(
        table_stream(i), mode, paths.at("rows"), paths.at("checkpoint"), settings, once=True, unique=unique
    ).awaitTermination()
    return read_batches(i.spark, paths.at("rows"), WINDOW_ROWS)


@query("r1_watermark_closes", "SELECT window_start, trip_count FROM hot WHERE grain = 'city' AND is_final")
def r1(i):
    return city_rows(run_windows(i, "append", 60)).select("window_start", "trip_count")


@query("r2_stream_windows", f"SELECT window_start, window_end, grain, zone_id, {_MEASURES} FROM hot5 WHERE is_final")
def r2(i):
    return run_windows(i, "append", 5).drop("batch_id")


@query("r3_final_windows", f"SELECT window_start, window_end, grain, zone_id, {_MEASURES} FROM hot WHERE is_final")
def r3(i):
    return run_windows(i, "append", 60).drop("batch_id")


@query("r4_open_windows", f"SELECT window_start, window_end, grain, zone_id, {_MEASURES} FROM hot")
def r4(i):
    return first_per_key(run_windows(i, "update", 60), WINDOW_KEYS, [F.desc("batch_id")]).drop("batch_id")


@query(
    "r5_late_audit",
    f"""SELECT CAST(e.pickup_datetime AS DATE) AS d, count(*) AS events, count(*) FILTER (l.is_late) AS late
        FROM ({LATE}) l JOIN log e USING (event_id) GROUP BY 1""",
)
def r5(i):
    marked = mark_late(i.views, i.settings.window_minutes, i.settings.grace_minutes)
    return marked.groupBy(F.to_date("pickup_datetime").alias("d")).agg(
        F.count(F.lit(1)).alias("events"), F.count_if("is_late").alias("late")
    )


@query(
    "r6_dead_letters",
    """SELECT CASE WHEN event_id % 101 = 0 THEN 'missing_field' WHEN event_id % 103 = 0 THEN 'unreadable_field'
         ELSE 'negative_value' END AS view_error, count(*) AS messages
       FROM log WHERE event_id % 101 = 0 OR event_id % 103 = 0 OR event_id % 107 = 0 GROUP BY 1""",
)
def r6(i):
    """A log with damaged messages followed as a stream; the dead letters it set aside."""
    paths = place(i, "dead-letters")
    log = FileLog(paths.at("log"))
    write_log(damaged_messages(i), log)
    lines = i.spark.readStream.format("text").load(log.folder)
    _, dead = read_views(lines)
    publish_dead_letters(dead, paths.at("dead"), paths.at("checkpoint"), i.settings, once=True).awaitTermination()
    return i.spark.read.parquet(paths.at("dead")).groupBy("view_error").agg(F.count(F.lit(1)).alias("messages"))


@query("r8_serving_view", f"SELECT window_start, window_end, grain, zone_id, {_MEASURES}, is_final FROM hot")
def r8(i):
    """Two provisional batches, the first half-filled, under the final rows."""
    half = window_metrics(i.views.where("hour(pickup_datetime) < 12"), 60).withColumn("batch_id", F.lit(0).cast("bigint"))
    whole = i.windows.drop("is_final").withColumn("batch_id", F.lit(1).cast("bigint"))
    final = i.windows.where("is_final").drop("is_final").withColumn("batch_id", F.lit(0).cast("bigint"))
    return serving_windows(final, half.unionByName(whole))


@query(
    "r9_scored_stream",
    f"""SELECT event_id, {amount('predicted_c', 10)} AS predicted_amount, {amount('quoted_c', 10)} AS actual_amount, model_version
        FROM scored WHERE model_version = '{PAIR_VERSION}'""",
)
def r9(i):
    return scored_by_stream(i, i.events, place(i, "scoring")).select(
        "event_id", "predicted_amount", "actual_amount", "model_version"
    )


def scored_by_stream(i: Inputs, events: DataFrame, paths: Paths) -> DataFrame:
    """The price tables are written first: every micro-batch reads them again."""
    if not exists(i.spark, paths.at("everywhere")):
        pair_medians(i.fitted).write.parquet(paths.at("pairs"))
        global_median(i.fitted).write.parquet(paths.at("everywhere"))
    pairs, everywhere = i.spark.read.parquet(paths.at("pairs")), i.spark.read.parquet(paths.at("everywhere"))
    log = written_log(i, events, paths)
    score_stream(
        i.spark,
        log,
        paths,
        i.settings,
        quote=lambda trips: quote_by_pair(trips, pairs, everywhere),
        version=PAIR_VERSION,
        once=True,
    ).awaitTermination()
    return read_quotes(i.spark, paths.predictions)


@query(
    "r10_redelivery",
    f"""SELECT event_id, {amount('predicted_c', 10)} AS predicted_amount FROM scored WHERE model_version = '{PAIR_VERSION}'""",
)
def r10(i):
    """Half of the events are delivered twice; the published quotes are the same."""
    rows = scored_by_stream(i, i.repeated_events, place(i, "redelivery"))
    return rows.select("event_id", "predicted_amount")


@query(
    "r12_batch_recompute",
    f"""SELECT CAST(year(pickup_datetime) AS INT) AS year, CAST(month(pickup_datetime) AS INT) AS month, count(*) AS trips,
        {amount('sum(total_c)', 14)} AS revenue, max(TIMESTAMP '{HISTORY_STAMP}') AS last_ingested FROM trips
        WHERE NOT is_history GROUP BY 1, 2""",
)
def r12(i):
    return by_month(recomputed_lake(i, place(i, "recompute")))


def recomputed_lake(i: Inputs, paths: Paths) -> DataFrame:
    stream_to_lake(i.spark, written_log(i, i.repeated_events, paths), paths, i.settings)
    return read_lake(i.spark, paths.lake, i.settings.source)


def by_month(lake: DataFrame) -> DataFrame:
    return lake.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("trips"),
        F.sum("total_amount").cast("decimal(14,2)").alias("revenue"),
        F.max("ingested_at").alias("last_ingested"),
    )


@query(
    "r13_file_replay",
    "SELECT CAST(pickup_datetime AS DATE) AS d, count(*) AS events, CAST(sum(total_c) AS BIGINT) AS cents FROM log GROUP BY 1",
)
def r13(i):
    """Arrival-ordered chunks of the log, replayed one file per micro-batch."""
    paths = place(i, "replay")
    chunks = i.log_events.withColumn("_id", F.col("event_id").cast("bigint"))
    ordered = chunks.repartitionByRange(6, "_id").sortWithinPartitions("_id").drop("_id")
    log = FileLog(paths.at("log"), files_per_batch=1, packed=False)
    write_log(encode_wire(ordered), log)
    good, _ = read_views(follow_log(i.spark, log))
    (
        good.drop("key")
        .writeStream.format("parquet")
        .option("path", paths.at("rows"))
        .option("checkpointLocation", paths.at("checkpoint"))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return i.spark.read.parquet(paths.at("rows")).groupBy(F.to_date("pickup_datetime").alias("d")).agg(
        F.count(F.lit(1)).alias("events"), F.sum((F.col("total_amount") * 100).cast("bigint")).alias("cents")
    )


# --- jobs --------------------------------------------------------------------------------------------


@query(
    "k1_bulk_load",
    f"""SELECT CAST(year(pickup_datetime) AS INT) AS year, CAST(month(pickup_datetime) AS INT) AS month, count(*) AS trips,
        {amount('sum(total_c)', 14)} AS revenue, max(TIMESTAMP '{HISTORY_STAMP}') AS last_ingested FROM trips
        WHERE is_history GROUP BY 1, 2""",
)
def k1(i):
    paths = place(i, "bulk-load")
    load_history(i.raw, paths, INGESTED, i.settings)
    return by_month(read_lake(i.spark, paths.lake, i.settings.source))


@query(
    "k2_stream_to_lake",
    f"""SELECT event_id, pickup_datetime, {amount('total_c')} AS total_amount FROM trips WHERE NOT is_history""",
)
def k2(i):
    return recomputed_lake(i, place(i, "stream-to-lake")).select("event_id", "pickup_datetime", "total_amount")


@query("k3_flagship_daily", f"SELECT metric_date, grain, zone_id, {_MEASURES} FROM daily")
def flagship(i):
    """Raw files -> validation -> canonical events -> daily metrics at both grains, in one plan."""
    return i.daily


@query(
    "k3_aggregate_daily",
    f"SELECT metric_date, grain, zone_id, {_MEASURES}, TIMESTAMP '2002-01-01 06:00:00' AS updated_at FROM daily",
)
def k3(i):
    """Lake -> daily table, in two overlapping runs; the second one changes nothing in the overlap."""
    paths = place(i, "aggregate-daily")
    write_lake(i.events, paths.lake, i.settings.source)
    aggregate_daily(i.spark, paths, NOW, i.settings, datetime(1990, 1, 1), datetime(2000, 1, 1))
    aggregate_daily(i.spark, paths, NOW, i.settings, datetime(1999, 6, 1))
    return read_snapshot(i.spark, paths.daily, DAILY)


@query("k4_hot_path", f"SELECT window_start, window_end, grain, zone_id, {_MEASURES}, is_final FROM hot")
def k4(i):
    paths = place(i, "hot-path")
    log = written_log(i, i.log_events, paths)
    for stream in run_hot_path(i.spark, log, paths, i.settings, once=True):
        stream.awaitTermination()
    return read_windows(i.spark, paths.at("windows_final"), paths.at("windows_open"))


@query("k5_train", FOLLOWED)
def k5(i):
    """Lake -> sample -> fit -> comparison with both price tables -> saved model, whose card is read back.

    Prices follow from zones and clock here, so that a model that has learned nothing shows.
    """
    paths = place(i, "train")
    raw = i.raw.withColumn("total_amount", F.col("tip_amount") + ruled_cents(
        "tpep_pickup_datetime", "PULocationID", "DOLocationID") / 100)
    load_history(raw, paths, INGESTED, i.settings)
    train(i.spark, paths, NOW, replace(i.settings, **SHORT_TRAINING))
    card = i.spark.read.text(f"{paths.model}/card")
    shape = "metrics map<string, struct<mae:double>>, rounds_kept int"
    read = card.select(F.from_json("value", shape).alias("c"))
    metrics = read.select(F.explode("c.metrics").alias("model", "m"), "c.rounds_kept")
    return followed(metrics.select("model", F.col("m.mae").alias("mae"), "rounds_kept"))


@query(
    "k1_rejects_by_month",
    """SELECT strftime(source_month, '%Y-%m') AS load_id, reject_reason, count(*) AS records FROM (
         SELECT source_month, coalesce(reject_reason, CASE WHEN tpep_pickup_datetime < source_month
           OR tpep_pickup_datetime >= source_month + INTERVAL 1 MONTH THEN 'outside_source_month' END) AS reject_reason
         FROM judged) WHERE reject_reason IS NOT NULL GROUP BY 1, 2""",
)
def k1_rejects(i):
    """A load and its rerun: every month keeps its rejects once."""
    paths = place(i, "rejects-by-month")
    for _ in range(2):
        load_history(i.raw, paths, INGESTED, i.settings, F.col("source_month"), "undated")
    return read_rejects(i.spark, paths).groupBy("load_id", "reject_reason").agg(F.count(F.lit(1)).alias("records"))


# The months asked for; the folder has some before and some after them.
MONTHS = ("1992-04", "1998-08")
_IN_MONTHS = f"source_month BETWEEN DATE '{MONTHS[0]}-01' AND DATE '{MONTHS[-1]}-01'"


def month_folders(i: Inputs, paths: Paths) -> str:
    """All months as Spark writes them: one folder of part files each, every other one with other column names."""
    folder = paths.at("raw")
    make_folder(i.spark, folder)
    for k in (0, 1):
        rows = i.raw.where(F.month("source_month") % 2 == k).withColumn("m", F.date_format("source_month", "yyyy-MM"))
        rows = rows.drop("source_month")
        rows = rows.toDF(*(c.upper() if k and c != "m" else c for c in rows.columns))
        staged = paths.at(f"months-{k}")
        rows.write.partitionBy("m").parquet(staged)
        for part in list_files(i.spark, staged, "m=*"):
            rename(i.spark, part, f"{folder}/{FILE_PREFIX}{part.rpartition('m=')[2]}.parquet")
    return folder


@query(
    "s2_read_months",
    f"""SELECT source_month, count(*) AS records, CAST(round(sum(total_amount) * 100) AS BIGINT) AS cents FROM raw_trips
        WHERE {_IN_MONTHS} GROUP BY 1""",
)
def s2(i):
    """A range of monthly folders with drifting columns, each row tagged with the month of its path."""
    raw = read_raw_range(i.spark, month_folders(i, place(i, "months")), *MONTHS)
    return raw.groupBy("source_month").agg(
        F.count(F.lit(1)).alias("records"), F.round(F.sum("total_amount") * 100).cast("bigint").alias("cents")
    )


_BACKFILLED = f"""(SELECT *, CAST(round(trip_distance * 100) AS BIGINT) * 1609344 AS km8 FROM judged
    WHERE reject_reason IS NULL AND {_IN_MONTHS} AND date_trunc('month', tpep_pickup_datetime) = source_month)"""


@query(
    "k8_backfill",
    f"""SELECT period AS metric_date, grain, zone_id, {_MEASURES}
        FROM ({rollup(_BACKFILLED, 'CAST(tpep_pickup_datetime AS DATE)', 'CAST(PULocationID AS INT)')})""",
)
def k8(i):
    """Monthly folders -> lake -> daily table, twice: the second run replaces and repeats nothing."""
    paths = place(i, "backfill")
    folder = month_folders(i, paths)
    for _ in range(2):
        backfill(i.spark, folder, *MONTHS, paths, INGESTED, i.settings)
    columns = ["metric_date", "grain", "zone_id", *(c.strip() for c in _MEASURES.split(","))]
    return read_snapshot(i.spark, paths.daily, DAILY).select(*columns)


@query(
    "k6_score_stream",
    f"SELECT CAST(pickup_datetime AS DATE) AS d, count(*) AS quotes, CAST(sum(predicted_c) AS BIGINT) AS cents FROM scored "
    f"WHERE model_version = '{PAIR_VERSION}' GROUP BY 1",
)
def k6(i):
    rows = scored_by_stream(i, i.events, place(i, "score-stream"))
    return rows.groupBy(F.to_date("pickup_datetime").alias("d")).agg(
        F.count(F.lit(1)).alias("quotes"),
        F.sum((F.col("predicted_amount") * 100).cast("bigint")).alias("cents"),
    )


@query(
    "k7_evaluate",
    f"SELECT *, TIMESTAMP '2002-01-01 06:00:00' AS computed_at FROM evaluation WHERE model_version = '{PAIR_VERSION}'",
)
def k7(i):
    """Two portions of the log, evaluated after each: the second run computes only the days the second portion touched,
    and a third one finds nothing to do."""
    paths = place(i, "evaluate")
    late = F.to_date("pickup_datetime") >= F.lit("2000-09-01").cast("date")
    for portion in (i.events.where(~late), i.events.where(late)):
        scored_by_stream(i, portion, paths)
        evaluate(i.spark, paths, NOW)
    evaluate(i.spark, paths, datetime(2030, 1, 1))
    return read_snapshot(i.spark, paths.evaluation, EVALUATION)


@query(
    "k9_ingest_validate",
    """SELECT coalesce(reject_reason, 'sent') AS outcome, count(*) AS records, CAST(sum(total_c) AS BIGINT) AS cents
       FROM judged GROUP BY 1""",
)
def k9(i):
    paths = place(i, "ingest")
    log = FileLog(paths.at("log"))
    rejected = ingest_validate(i.raw, log, paths, INGESTED, i.settings)
    sent = decode_view(read_log(i.spark, log)).select(F.lit("sent").alias("outcome"), "total_amount")
    refused = rejected.select(F.col("reject_reason").alias("outcome"), F.col("total_amount").cast("decimal(12,2)"))
    return sent.unionByName(refused).groupBy("outcome").agg(
        F.count(F.lit(1)).alias("records"), F.sum((F.col("total_amount") * 100).cast("bigint")).alias("cents")
    )


@query(
    "k9_lasting_rejects",
    """SELECT CASE WHEN VendorID = 1 THEN 'first' ELSE 'second' END AS load_id, reject_reason, count(*) AS records
       FROM judged WHERE reject_reason IS NOT NULL GROUP BY 1, 2""",
)
def k9_rejects(i):
    """Two loads, the first of them repeated, and a third whose clean rerun leaves nothing behind."""
    paths = place(i, "lasting-rejects")
    log = FileLog(paths.at("log"))
    loads = (("first", F.col("VendorID") == 1), ("second", F.col("VendorID") != 1), ("first", F.col("VendorID") == 1),
             ("third", F.col("fare_amount") < 0), ("third", F.lit(False)))
    for name, part in loads:
        ingest_validate(i.raw.where(part), log, paths, INGESTED, i.settings, name)
    return read_rejects(i.spark, paths).groupBy("load_id", "reject_reason").agg(F.count(F.lit(1)).alias("records"))


@query(
    "k6_dead_letters",
    """SELECT 'unreadable' AS outcome, count(*) AS messages FROM trips WHERE NOT is_history AND pu % 5 = 0
       UNION ALL SELECT 'price_out_of_range', count(*) FROM trips WHERE NOT is_history AND pu % 5 = 1
       UNION ALL SELECT 'scored', count(*) FROM trips WHERE NOT is_history AND (pu IS NULL OR pu % 5 > 1)""",
)
def k6_dead(i):
    """Damaged messages and prices no quote can hold go to the scorer's dead letters; everything else is scored."""
    paths = place(i, "score-dead-letters")
    log = FileLog(paths.at("log"))
    events = i.events.where(is_live(i.settings.cutoff))
    wide = events.withColumn("total_amount", F.when(F.expr("pickup_location.zone_id % 5 = 1"), F.lit("900000000.00").cast("decimal(12,2)")).otherwise(F.col("total_amount")))
    messages = encode_wire(wide)
    damaged = F.when(F.col("key").cast("int") % 5 == 0, F.expr("substring(value, 1, length(value) - 10)")).otherwise(F.col("value"))
    write_log(messages.withColumn("value", damaged), log)
    everywhere = settled(global_median(i.fitted), "everywhere")
    score_stream(
        i.spark, log, paths, i.settings, quote=lambda t: quote_by_global(t, everywhere), version="global", once=True
    ).awaitTermination()
    dead = i.spark.read.parquet(paths.at("scoring_dead_letters")).select(
        F.when(F.col("wire_error") == "price_out_of_range", "price_out_of_range").otherwise("unreadable").alias("outcome")
    )
    rows = read_quotes(i.spark, paths.predictions).select(F.lit("scored").alias("outcome")).unionByName(dead)
    return rows.groupBy("outcome").agg(F.count(F.lit(1)).alias("messages"))


@query(
    "s12_compacted_batches",
    f"""SELECT event_id, {amount('predicted_c', 10)} AS predicted_amount FROM scored
        WHERE model_version = '{PAIR_VERSION}' AND pickup_datetime >= TIMESTAMP '2000-03-01' AND pickup_datetime < TIMESTAMP '2000-06-01'""",
)
def s12(i):
    """Quotes published in many micro-batches, compacted as they add up, read back for a range of days."""
    paths = place(i, "compacted")
    pairs, everywhere = settled(pair_medians(i.fitted), "pairs"), settled(global_median(i.fitted), "everywhere")
    log = FileLog(paths.at("log"), files_per_batch=1, packed=False)
    live = i.events.where(is_live(i.settings.cutoff))
    write_log(encode_wire(live).repartition(5), log)
    publish_quotes(
        follow_log(i.spark, log), lambda t: quote_by_pair(t, pairs, everywhere), PAIR_VERSION, paths.predictions,
        paths.at("checkpoint"), i.settings, dead_path=paths.at("dead"), once=True, compact_after=2,
    ).awaitTermination()
    if len(list_files(i.spark, paths.predictions, "batch_id=*")) > 4:
        raise RuntimeError("batches were not compacted")
    since, until = datetime(2000, 3, 1), datetime(2000, 6, 1)
    rows = read_quotes(i.spark, paths.predictions, since, until)
    inside = (F.col("pickup_datetime") >= F.lit(since)) & (F.col("pickup_datetime") < F.lit(until))
    return rows.where(inside).select("event_id", "predicted_amount")


@query(
    "s5_independent_consumers",
    """SELECT consumer, count(*) AS events, CAST(sum(total_c) AS BIGINT) AS cents FROM log
       CROSS JOIN (SELECT unnest(['one_file', 'three_files']) AS consumer) GROUP BY 1""",
)
def s5(i):
    """Two consumers of one log, each with its own cursor and batch size, read the same events; their progress is a table."""
    paths = place(i, "consumers")
    log = FileLog(paths.at("log"), packed=False)
    write_log(encode_wire(i.log_events).repartition(7), log)
    totals = None
    for name, files in (("one_file", 1), ("three_files", 3)):
        progress = paths.at(f"progress/{name}")

        def count(rows, batch_id, progress=progress):
            cents = F.coalesce(F.sum((F.col("total_amount") * 100).cast("bigint")), F.lit(0))
            done = rows.agg(F.count(F.lit(1)).alias("events"), cents.alias("cents"))
            done.coalesce(1).write.mode("overwrite").parquet(f"{progress}/batch_id={batch_id}")

        good, _ = read_views(follow_log(i.spark, FileLog(log.folder, files)))
        writer = good.drop("key").writeStream.option("checkpointLocation", paths.at(f"cursor/{name}"))
        writer.trigger(availableNow=True).foreachBatch(count).start().awaitTermination()
        mine = i.spark.read.parquet(progress).select(F.lit(name).alias("consumer"), "batch_id", "events", "cents")
        totals = mine if totals is None else totals.unionByName(mine)
    return totals.groupBy("consumer").agg(F.sum("events").alias("events"), F.sum("cents").alias("cents"))


@query("r7_recovered_windows", f"SELECT window_start, window_end, grain, zone_id, {_MEASURES}, is_final FROM hot")
def r7(i):
    """The hot path stopped after some batches and started again: open windows go on from the checkpoint."""
    paths = place(i, "recovery")
    log, early = FileLog(paths.at("log"), files_per_batch=2, packed=False), F.col("event_id").cast("bigint") % 2 == 0
    # Each stop falls into open windows: the days of the second portion continue those of the first.
    days = F.to_date("pickup_datetime")
    middle = i.log_events.agg(F.max(days)).scalar() - F.expr("interval 10 days")
    for portion in (days < middle, (days >= middle) & early, (days >= middle) & ~early):
        ordered = i.log_events.where(portion).repartitionByRange(4, "pickup_datetime")
        write_log(encode_wire(ordered), log)
        for stream in run_hot_path(i.spark, log, paths, replace(i.settings, grace_minutes=20 * 24 * 60), once=True):
            stream.awaitTermination()
    rows = read_windows(i.spark, paths.at("windows_final"), paths.at("windows_open")).drop("is_final")
    newest = i.views.agg(F.max("pickup_datetime")).scalar()
    return mark_final(rows, newest, i.settings.grace_minutes)


@query(
    "r11_replayed_once",
    """SELECT CAST(pickup_datetime AS DATE) AS d, count(*) AS trips, CAST(sum(total_c) AS BIGINT) AS cents
       FROM (SELECT * FROM log UNION ALL SELECT * FROM log WHERE event_id % 50 = 0) GROUP BY 1""",
)
def r11(i):
    """A log delivered twice is counted once; two trips that are alike on the narrow view both count.

    Every fiftieth trip has a twin of another provider: only the natural key tells them apart.
    """
    paths = place(i, "replayed-once")
    log = FileLog(paths.at("log"))
    # The key must be unique per trip: the event's number stands for its provider.
    own = i.log_events.withColumn("provider_id", F.col("event_id"))
    twins = own.where(F.col("event_id").cast("bigint") % 50 == 0).withColumn("provider_id", F.concat(F.lit("x"), "event_id"))
    messages = encode_wire(own.unionByName(twins))
    write_log(messages.unionByName(messages), log)
    settings = replace(i.settings, window_minutes=60)
    for stream in run_hot_path(i.spark, log, paths, settings, once=True, unique=True):
        stream.awaitTermination()
    rows = city_rows(read_windows(i.spark, paths.at("windows_final"), paths.at("windows_open")))
    return rows.groupBy(F.to_date("window_start").alias("d")).agg(
        F.sum("trip_count").alias("trips"), F.sum((F.col("total_revenue") * 100).cast("bigint")).alias("cents")
    )
