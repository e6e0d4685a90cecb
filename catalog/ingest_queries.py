"""Sources, sinks, projections, filters (S*, P*, F*)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from catalog.inputs import INGESTED, NOW
from catalog.reference_sql import amount, measures
from catalog.registry import query
from catalog.shapes import HISTORY_STAMP, NOW_STAMP
from tripflow.functions.errors import error_band, error_pct, quote_error
from tripflow.functions.identity import event_key
from tripflow.functions.money import kilometres, money, surcharges
from tripflow.functions.time import (
    age_text,
    at_or_after,
    floor_to_window,
    iso_text,
    minutes_between,
    month_range,
)
from tripflow.operators.features import usable_stats, zone_or_unknown, zone_pair
from tripflow.operators.ingest import REASON, flatten_zones, judge, payment_type
from tripflow.operators.merge import merge_daily, merge_evaluation, replace_by_key
from tripflow.operators.evaluation import evaluate_daily
from tripflow.operators.ownership import is_history, is_live
from tripflow.operators.rollup import daily_metrics
from tripflow.operators.validate import canonical_violations, in_month, split
from tripflow.schemas import PARTITIONS, conform, lake_schema
from tripflow.session import scratch
from tripflow.sources.lake import lake_months, layout_report, read_lake, write_lake
from tripflow.sources.log import FileLog, read_log, write_log
from tripflow.sources.raw_files import ordered_prefix, resolve_columns
from tripflow.sources.wire import decode_view, decode_wire, encode_wire

_RAW = """SELECT CAST(VendorID AS INT) AS vendor, tpep_pickup_datetime AS pickup, CAST(passenger_count AS INT) AS passengers,
  CAST(RatecodeID AS INT) AS rate, CAST(payment_type AS INT) AS pay, CAST(PULocationID AS INT) AS pu,
  CAST(DOLocationID AS INT) AS do_zone, trip_distance AS miles"""


@query("s1_read_raw", f"{_RAW}, total_amount FROM raw_trips")
def s1(i):
    return resolve_columns(i.raw).select(
        F.col("VendorID").alias("vendor"),
        F.col("tpep_pickup_datetime").alias("pickup"),
        F.col("passenger_count").alias("passengers"),
        F.col("RatecodeID").alias("rate"),
        F.col("payment_type").alias("pay"),
        F.col("PULocationID").alias("pu"),
        F.col("DOLocationID").alias("do_zone"),
        F.col("trip_distance").alias("miles"),
        "total_amount",
    )


_CANONICAL = f"""event_id, pickup_datetime, dropoff_datetime, pu AS pickup_zone_id, do_ AS dropoff_zone_id, passenger_count,
  CAST(km8 / 100000000.0 AS DOUBLE) AS trip_distance_km, provider_id, payment_type, {amount('fare_c')} AS fare_amount,
  {amount('sur_c')} AS surcharges_amount, {amount('tip_c')} AS tip_amount, {amount('toll_c')} AS tolls_amount,
  {amount('total_c')} AS total_amount"""
_CANONICAL_COLUMNS = (
    "event_id",
    "pickup_datetime",
    "dropoff_datetime",
    "pickup_zone_id",
    "dropoff_zone_id",
    "passenger_count",
    "trip_distance_km",
    "provider_id",
    "payment_type",
    "fare_amount",
    "surcharges_amount",
    "tip_amount",
    "tolls_amount",
    "total_amount",
)


@query(
    "s3_log_round_trip",
    "SELECT count(*) AS messages, count(pu) AS with_zone, CAST(sum(total_c) AS BIGINT) AS cents FROM trips",
)
def s3(i):
    log = FileLog(scratch(i.spark, "log"))
    write_log(encode_wire(i.events), log)
    back = decode_wire(read_log(i.spark, log), i.settings.source)
    return back.agg(
        F.count(F.lit(1)).alias("messages"),
        F.count("pickup_location.zone_id").alias("with_zone"),
        F.sum((F.col("total_amount") * 100).cast("bigint")).alias("cents"),
    )


@query("s6_decode_wire", f"SELECT {_CANONICAL}, CAST(NULL AS VARCHAR) AS wire_error FROM trips")
def s6(i):
    decoded = decode_wire(encode_wire(i.events), i.settings.source)
    return flatten_zones(decoded).select(*_CANONICAL_COLUMNS, "wire_error")


def damaged_messages(i):
    """The log as messages; some are no JSON, some have an unreadable time, some a negative amount."""
    text = F.col("value")
    sick = (
        F.when(F.col("event_id") % 101 == 0, F.lit("not json"))
        .when(F.col("event_id") % 103 == 0, F.lit('{"pickup_datetime": "x"}'))
        .when(
            F.col("event_id") % 107 == 0,
            F.regexp_replace(text, '"fare_amount":"', '"fare_amount":"-'),
        )
        .otherwise(text)
    )
    wire = encode_wire_keeping_id(i)
    return wire.select("event_id", sick.alias("value"))


def encode_wire_keeping_id(i):
    return encode_wire(i.log_events).select(
        F.get_json_object("value", "$.event_id").cast("bigint").alias("event_id"), "value"
    )


@query(
    "s7_decode_view",
    """SELECT CASE WHEN event_id % 101 = 0 THEN 'missing_field' WHEN event_id % 103 = 0 THEN 'unreadable_field'
         WHEN event_id % 107 = 0 THEN 'negative_value' END AS view_error, count(*) AS messages,
         CAST(sum(CASE WHEN event_id % 101 <> 0 AND event_id % 103 <> 0 AND event_id % 107 <> 0 THEN total_c END)
           AS BIGINT) AS good_cents
       FROM log GROUP BY 1""",
)
def s7(i):
    views = decode_view(damaged_messages(i))
    good = F.when(F.col("view_error").isNull(), (F.col("total_amount") * 100).cast("bigint"))
    return views.groupBy("view_error").agg(
        F.count(F.lit(1)).alias("messages"), F.sum(good).alias("good_cents")
    )


@query(
    "s8_encode_wire",
    f"""SELECT CAST(pu AS VARCHAR) AS key, event_id, strftime(pickup_datetime, '%Y-%m-%dT%H:%M:%S') AS pickup,
      CAST({amount('total_c')} AS VARCHAR) AS total, payment_type AS pay, CAST(do_ AS VARCHAR) AS do_zone FROM trips""",
)
def s8(i):
    # One reading of a message gives all fields; a path each would read it five times.
    fields = F.json_tuple("value", "event_id", "pickup_datetime", "total_amount", "payment_type", "dropoff_location")
    told = encode_wire(i.events).select("key", fields.alias("event_id", "pickup", "total", "pay", "_to"))
    return told.select("key", "event_id", "pickup", "total", "pay", F.get_json_object("_to", "$.zone_id").alias("do_zone"))


def stored_lake(i):
    path = scratch(i.spark, "lake")
    write_lake(i.events, path, i.settings.source)
    return path


@query(
    "s9_write_lake",
    """SELECT CAST(year(pickup_datetime) AS INT) AS year, CAST(month(pickup_datetime) AS INT) AS month,
         count(*) AS row_count, count(DISTINCT CAST(pickup_datetime AS DATE)) AS days, CAST(0 AS BIGINT) AS stray_rows
       FROM trips GROUP BY 1, 2""",
)
def s9(i):
    report = layout_report(read_lake(i.spark, stored_lake(i), i.settings.source))
    return report.groupBy("year", "month").agg(
        F.sum("row_count").alias("row_count"),
        F.count(F.lit(1)).alias("days"),
        F.sum("stray_rows").alias("stray_rows"),
    )


@query(
    "s10_read_lake",
    f"""SELECT event_id, pickup_datetime, {amount('total_c')} AS total_amount FROM trips
        WHERE pickup_datetime >= TIMESTAMP '1998-03-15 12:00:00' AND pickup_datetime < TIMESTAMP '1999-02-01 00:00:00'""",
)
def s10(i):
    lake = read_lake(
        i.spark, stored_lake(i), i.settings.source, datetime(1998, 3, 15, 12), datetime(1999, 2, 1)
    )
    return lake.select("event_id", "pickup_datetime", "total_amount")


_OLD_DAILY = f"""SELECT CAST(pickup_datetime AS DATE) AS metric_date, CASE WHEN grouping(pu) = 1 THEN 'city' ELSE 'zone' END AS grain,
  pu AS zone_id, {measures()} FROM trips WHERE is_history AND provider_id = '1'
  GROUP BY GROUPING SETS ((CAST(pickup_datetime AS DATE), pu), (CAST(pickup_datetime AS DATE)))"""
_SAME = " AND ".join(
    f"o.{c} IS NOT DISTINCT FROM n.{c}"
    for c in ("trip_count", "total_revenue", "avg_fare", "avg_tip", "avg_distance_km")
)


@query(
    "s13_merge_changed",
    f"""SELECT coalesce(n.metric_date, o.metric_date) AS metric_date, coalesce(n.grain, o.grain) AS grain,
      coalesce(n.zone_id, o.zone_id) AS zone_id,
      CASE WHEN n.grain IS NULL THEN o.trip_count ELSE n.trip_count END AS trip_count,
      CASE WHEN n.grain IS NULL THEN o.total_revenue ELSE n.total_revenue END AS total_revenue,
      CASE WHEN n.grain IS NULL THEN o.avg_fare ELSE n.avg_fare END AS avg_fare,
      CASE WHEN n.grain IS NULL THEN o.avg_tip ELSE n.avg_tip END AS avg_tip,
      CASE WHEN n.grain IS NULL THEN o.avg_distance_km ELSE n.avg_distance_km END AS avg_distance_km,
      CASE WHEN n.grain IS NULL OR (o.grain IS NOT NULL AND {_SAME}) THEN TIMESTAMP '{HISTORY_STAMP}'
        ELSE TIMESTAMP '{NOW_STAMP}' END AS updated_at,
      CASE WHEN n.grain IS NULL THEN 'kept' WHEN o.grain IS NULL THEN 'inserted' WHEN {_SAME} THEN 'unchanged'
        ELSE 'updated' END AS took
    FROM ({_OLD_DAILY}) o FULL JOIN (SELECT * FROM daily WHERE metric_date >= DATE '1996-01-01') n
      ON o.metric_date = n.metric_date AND o.grain = n.grain AND o.zone_id IS NOT DISTINCT FROM n.zone_id""",
)
def s13(i):
    old = daily_metrics(i.events.where(is_history(i.settings.cutoff) & (F.col("provider_id") == "1")))
    stored = old.withColumn("updated_at", F.lit(INGESTED).cast("timestamp"))
    staged = i.daily.where("metric_date >= date '1996-01-01'")
    return merge_daily(stored, staged, NOW, action="took")


@query(
    "s14_upsert_predictions",
    f"""SELECT event_id, {amount('predicted_c', 10)} AS predicted_amount, model_version FROM scored
        WHERE (model_version = 'pair-median-1') = (pickup_datetime < TIMESTAMP '2000-09-01 00:00:00')""",
)
def s14(i):
    stored = i.predictions_of("pair-median-1")
    staged = i.predictions_of("global-median-1").where("pickup_datetime >= timestamp '2000-09-01'")
    merged = replace_by_key(stored, staged, ["event_id"], [F.desc("predicted_at")])
    return merged.select("event_id", "predicted_amount", "model_version")


@query(
    "s15_merge_evaluation",
    f"""SELECT eval_date, model_version, predictions, mae, rmse, mape, r2, mean_actual, mean_predicted,
      CASE WHEN eval_date < DATE '2000-06-01' THEN TIMESTAMP '{HISTORY_STAMP}' ELSE TIMESTAMP '{NOW_STAMP}' END
        AS computed_at FROM evaluation""",
)
def s15(i):
    # The stored day 2000-06-01 had seen the morning only, so it is updated; later days are inserted.
    early = evaluate_daily(i.predictions.where("pickup_datetime < timestamp '2000-06-01 12:00:00'"))
    stored = early.withColumn("computed_at", F.lit(INGESTED).cast("timestamp"))
    return merge_evaluation(stored, i.evaluation, NOW)


@query(
    "s16_lake_months",
    "SELECT DISTINCT CAST(year(pickup_datetime) AS INT) AS year, CAST(month(pickup_datetime) AS INT) AS month FROM trips",
)
def s16(i):
    return lake_months(i.spark, stored_lake(i))


@query(
    "s17_lake_layout",
    """SELECT CAST(year(pickup_datetime) AS INT) AS year, CAST(month(pickup_datetime) AS INT) AS month,
         CAST(day(pickup_datetime) AS INT) AS day, CAST(1 AS BIGINT) AS files, count(*) AS row_count,
         CAST(0 AS BIGINT) AS stray_rows FROM trips GROUP BY 1, 2, 3""",
)
def s17(i):
    return layout_report(read_lake(i.spark, stored_lake(i), i.settings.source))


@query(
    "s18_month_range",
    """SELECT strftime(m, '%Y-%m') AS month, count(pickup_datetime) AS trips
       FROM (SELECT unnest(generate_series(TIMESTAMP '1994-11-01', TIMESTAMP '2002-02-01', INTERVAL 1 MONTH)) AS m)
         LEFT JOIN trips ON date_trunc('month', pickup_datetime) = m GROUP BY 1""",
)
def s18(i):
    """Every month of a range with its trips, months without trips included."""
    per_month = i.events.groupBy(F.date_format("pickup_datetime", "yyyy-MM").alias("month")).agg(
        F.count(F.lit(1)).alias("n")
    )
    months = month_range(i.spark, "1994-11", "2002-02")
    return months.join(per_month, "month", "left").select(
        "month", F.coalesce("n", F.lit(0)).alias("trips")
    )


# --- projections, filters, predicates ---------------------------------------------------------------


@query(
    "p1_resolve_columns",
    """SELECT tpep_pickup_datetime AS pickup, 0.0::DOUBLE AS extra, mta_tax, CAST(NULL AS DOUBLE) AS congestion_surcharge,
         Airport_fee AS airport_fee FROM raw_trips""",
)
def p1(i):
    """Two columns are taken away and one is respelled, as in older files."""
    drifted = i.raw.drop("extra", "congestion_surcharge").withColumnRenamed("mta_tax", "MTA_Tax")
    return resolve_columns(drifted).select(
        F.col("tpep_pickup_datetime").alias("pickup"), "extra", "mta_tax", "congestion_surcharge", "airport_fee"
    )


@query(
    "p2_narrow_codes",
    """SELECT CAST(VendorID AS INT) AS vendor, CAST(passenger_count AS INT) AS passengers,
         CAST(payment_type AS INT) AS pay, count(*) AS n FROM raw_trips GROUP BY 1, 2, 3""",
)
def p2(i):
    return resolve_columns(i.raw).groupBy(
        F.col("VendorID").alias("vendor"),
        F.col("passenger_count").alias("passengers"),
        F.col("payment_type").alias("pay"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query(
    "p3_nan_is_missing",
    """SELECT CASE WHEN tip_amount = 0 THEN 'missing_required' ELSE reject_reason END AS verdict, count(*) AS n
       FROM (SELECT *, CASE WHEN PULocationID IS NULL THEN 1 ELSE 0 END AS z FROM judged) GROUP BY 1""",
)
def p3(i):
    """Free rides of tip are given a NaN tip: they must be rejected as incomplete."""
    nan = F.when(F.col("tip_amount") == 0, F.lit(float("nan"))).otherwise(F.col("tip_amount"))
    return judge(i.raw.withColumn("tip_amount", nan)).groupBy(F.col(REASON).alias("verdict")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query("p4_adapt", f"SELECT {_CANONICAL} FROM trips")
def p4(i):
    return i.trips.select(*_CANONICAL_COLUMNS)


@query(
    "p5_exact_money",
    f"""SELECT {amount('fare_c')} AS fare_amount, {amount('tip_c')} AS tip_amount, {amount('toll_c')} AS tolls_amount,
        {amount('total_c')} AS total_amount FROM judged""",
)
def p5(i):
    return resolve_columns(i.raw).select(
        *(money(c).alias(c) for c in ("fare_amount", "tip_amount", "tolls_amount", "total_amount"))
    )


@query("p6_surcharges", f"SELECT {amount('sur_c')} AS surcharges, count(*) AS n FROM judged GROUP BY 1")
def p6(i):
    return resolve_columns(i.raw).groupBy(surcharges().cast("decimal(12,2)").alias("surcharges")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "p7_payment_type",
    """SELECT CAST(payment_type AS INT) AS code, CASE WHEN payment_type IS NULL OR payment_type = 5 THEN 'UNKNOWN'
         WHEN payment_type = 1 THEN 'CARD' WHEN payment_type = 2 THEN 'CASH' ELSE 'OTHER' END AS payment_type,
         count(*) AS n FROM raw_trips GROUP BY 1, 2""",
)
def p7(i):
    code = F.col("payment_type")
    return resolve_columns(i.raw).groupBy(code.alias("code"), payment_type(code).alias("payment_type")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "p8_kilometres",
    """SELECT trip_distance AS miles, CAST(CAST(round(trip_distance * 100) AS BIGINT) * 1609344 / 100000000.0 AS DOUBLE)
         AS km, count(*) AS n FROM raw_trips GROUP BY 1, 2""",
)
def p8(i):
    return (
        resolve_columns(i.raw)
        .groupBy(F.col("trip_distance").alias("miles"), kilometres("trip_distance").alias("km"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "p9_locations",
    """SELECT pu AS pu_zone, CAST(NULL AS DOUBLE) AS pu_lat, do_ AS do_zone, CAST(NULL AS DOUBLE) AS do_lon,
         count(*) AS n FROM trips GROUP BY 1, 3""",
)
def p9(i):
    return i.events.groupBy(
        F.col("pickup_location.zone_id").alias("pu_zone"),
        F.col("pickup_location.lat").alias("pu_lat"),
        F.col("dropoff_location.zone_id").alias("do_zone"),
        F.col("dropoff_location.lon").alias("do_lon"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query(
    "p10_extras",
    """SELECT event_id, CAST(RatecodeID AS INT) AS ratecode_id, store_and_fwd_flag, extra, mta_tax,
         improvement_surcharge, congestion_surcharge, Airport_fee AS airport_fee FROM trips""",
)
def p10(i):
    return i.events.select("event_id", "source_extras.*")


@query(
    "p11_partition_columns",
    """SELECT CAST(year(pickup_datetime) AS INT) AS year, CAST(month(pickup_datetime) AS INT) AS month,
         CAST(day(pickup_datetime) AS INT) AS day, count(*) AS n FROM trips GROUP BY 1, 2, 3""",
)
def p11(i):
    return i.events.groupBy(*PARTITIONS).agg(F.count(F.lit(1)).alias("n"))


@query("p12_event_id", "SELECT event_id, pickup_datetime, pu AS pickup_zone_id FROM trips")
def p12(i):
    return i.trips.select("event_id", "pickup_datetime", "pickup_zone_id")


@query(
    "p13_reject_reason",
    """SELECT tpep_pickup_datetime AS pickup, CAST(PULocationID AS INT) AS pu, total_amount,
         coalesce(reject_reason, CASE WHEN tpep_pickup_datetime < source_month
           OR tpep_pickup_datetime >= source_month + INTERVAL 1 MONTH THEN 'outside_source_month' END) AS reject_reason
       FROM judged""",
)
def p13(i):
    return i.judged_by_month.select(
        F.col("tpep_pickup_datetime").alias("pickup"),
        F.col("PULocationID").alias("pu"),
        "total_amount",
        REASON,
    )


@query(
    "p14_canonical_violations",
    """SELECT concat_ws(',', CASE WHEN pu IS NULL OR pu % 10 = 3 THEN 'location_missing' END,
         CASE WHEN do_ % 7 = 2 THEN 'coordinates_out_of_range' END,
         CASE WHEN tip_c > 300 THEN 'negative_amount' END,
         CASE WHEN passenger_count = 6 THEN 'negative_passenger_count' END) AS violations, count(*) AS n
       FROM trips GROUP BY 1""",
)
def p14(i):
    """Canonical events with some zones, coordinates, tips and party sizes made invalid."""
    pu, do = F.col("pickup_location.zone_id"), F.col("dropoff_location.zone_id")
    nothing = F.lit(None).cast("double")
    place = F.struct(
        F.when(pu % 10 != 3, pu).alias("zone_id"), nothing.alias("lat"), nothing.alias("lon")
    )
    off = F.struct(do.alias("zone_id"), F.when(do % 7 == 2, 91.0).alias("lat"), F.lit(10.0).alias("lon"))
    sick = (
        i.events.withColumn("pickup_location", place)
        .withColumn("dropoff_location", off)
        .withColumn("tip_amount", F.when(F.col("tip_amount") > 3, -F.col("tip_amount")).otherwise(F.col("tip_amount")))
        .withColumn("passenger_count", F.when(F.col("passenger_count") == 6, -1).otherwise(F.col("passenger_count")))
    )
    return sick.groupBy(F.array_join(canonical_violations(), ",").alias("violations")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "p15_split",
    f"""SELECT CASE WHEN reject_reason IS NULL THEN 'accepted' ELSE 'rejected' END AS side, reject_reason,
        count(*) AS n, {amount('sum(total_c)', 14)} AS total FROM judged GROUP BY 1, 2""",
)
def p15(i):
    good, bad = split(i.judged, REASON)
    both = good.select(F.lit("accepted").alias("side"), F.lit(None).cast("string").alias(REASON), "total_amount")
    rest = bad.select(F.lit("rejected").alias("side"), REASON, "total_amount")
    return both.unionByName(rest).groupBy("side", REASON).agg(
        F.count(F.lit(1)).alias("n"), F.sum(money("total_amount")).cast("decimal(14,2)").alias("total")
    )


@query(
    "p16_month_bounds",
    """SELECT event_id, pickup_datetime FROM trips WHERE pickup_datetime >= TIMESTAMP '1998-12-01'
         AND pickup_datetime < TIMESTAMP '1999-01-01'""",
)
def p16(i):
    return i.events.where(in_month(F.col("pickup_datetime"), "1998-12")).select("event_id", "pickup_datetime")


@query(
    "p17_cutoff_ownership",
    """SELECT CASE WHEN is_history THEN 'history' ELSE 'live' END AS owner, count(*) AS n,
         max(pickup_datetime) AS newest FROM trips GROUP BY 1""",
)
def p17(i):
    history = i.events.where(is_history(i.settings.cutoff)).withColumn("owner", F.lit("history"))
    live = i.events.where(is_live(i.settings.cutoff)).withColumn("owner", F.lit("live"))
    return history.unionByName(live).groupBy("owner").agg(
        F.count(F.lit(1)).alias("n"), F.max("pickup_datetime").alias("newest")
    )


@query(
    "p19_time_range",
    f"""SELECT event_id, pickup_datetime, {amount('total_c')} AS total_amount FROM trips
        WHERE pickup_datetime >= TIMESTAMP '2000-02-29 06:00:00' AND pickup_datetime < TIMESTAMP '2000-03-31 18:30:00'""",
)
def p19(i):
    bound = at_or_after(
        F.col("pickup_datetime"),
        F.lit("2000-02-29 06:00:00").cast("timestamp"),
        F.lit("2000-03-31 18:30:00").cast("timestamp"),
    )
    return i.events.where(bound).select("event_id", "pickup_datetime", "total_amount")


@query(
    "p20_usable_target",
    """SELECT count(*) AS rows_seen, count(*) FILTER (quoted_c BETWEEN 250 AND 25000) AS rows_kept,
         count(*) FILTER (NOT quoted_c BETWEEN 250 AND 25000) AS rows_dropped FROM trips""",
)
def p20(i):
    return usable_stats(i.priced, i.settings)


@query(
    "p22_lake_schema",
    f"SELECT event_id, 'tlc_yellow' AS source, '1.0.0' AS schema_version, {amount('total_c')} AS total_amount FROM trips",
)
def p22(i):
    shuffled = i.events.select(*sorted(i.events.columns))
    return conform(shuffled, lake_schema("tlc_yellow")).select(
        "event_id", "source", "schema_version", "total_amount"
    )


@query("p23_flatten_zones", "SELECT event_id, pu AS pickup_zone_id, do_ AS dropoff_zone_id FROM trips")
def p23(i):
    return flatten_zones(i.events).select("event_id", "pickup_zone_id", "dropoff_zone_id")


# --- scalar functions --------------------------------------------------------------------------------


@query(
    "f1_date_parts",
    """SELECT event_id, CAST(year(ts) AS INT) AS y, CAST(month(ts) AS INT) AS m, CAST(day(ts) AS INT) AS d,
         CAST(hour(ts) AS INT) AS h, CAST(isodow(ts) - 1 AS INT) AS weekday FROM events""",
)
def f1(i):
    ts = F.col("pickup_datetime")
    return i.log.select(
        "event_id",
        F.year(ts).alias("y"),
        F.month(ts).alias("m"),
        F.dayofmonth(ts).alias("d"),
        F.hour(ts).alias("h"),
        F.weekday(ts).alias("weekday"),
    )


@query(
    "f2_window_floor",
    """SELECT event_id, date_trunc('hour', ts) + (minute(ts) // 5) * INTERVAL 5 MINUTE AS w5,
         date_trunc('hour', ts) + (minute(ts) // 15) * INTERVAL 15 MINUTE AS w15, date_trunc('hour', ts) AS w60 FROM events""",
)
def f2(i):
    ts = F.col("pickup_datetime")
    return (
        i.log.withColumn("w5", floor_to_window(ts, 5))
        .withColumn("w15", floor_to_window(ts, 15))
        .withColumn("w60", floor_to_window(ts, 60))
        .select("event_id", "w5", "w15", "w60")
    )


@query(
    "f3_time_text",
    """SELECT event_id, CASE WHEN microsecond(ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
         ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS iso, CAST(ts AS DATE) AS d FROM events""",
)
def f3(i):
    ts = F.col("pickup_datetime")
    iso = iso_text(ts)
    back = F.to_date(F.try_to_timestamp(iso))
    return i.log.select("event_id", iso.alias("iso"), back.alias("d"))


@query(
    "f4_duration_minutes",
    """SELECT event_id, CAST(round(epoch(dropoff_datetime - pickup_datetime) / 60, 4) AS DOUBLE) AS minutes FROM trips""",
)
def f4(i):
    span = minutes_between(F.col("pickup_datetime"), F.col("dropoff_datetime"))
    return i.events.select("event_id", F.round(span, 4).alias("minutes"))


@query(
    "f5_natural_key_digest",
    "SELECT event_id, digest, substr(digest, 1, 8) AS head FROM trips",
)
def f5(i):
    key = event_key(
        F.col("pickup_datetime"),
        F.col("dropoff_datetime"),
        F.col("pickup_zone_id"),
        F.col("dropoff_zone_id"),
        F.col("total_amount"),
        F.col("provider_id"),
    )
    digest = F.sha2(key, 256)
    return i.trips.select("event_id", digest.alias("digest"), F.substring(digest, 1, 8).alias("head"))


@query(
    "f6_rounding",
    """SELECT event_id, CAST((2 * fare_c * 15 + 100) // 200 / 100.0 AS DECIMAL(10,2)) AS share,
         CAST(round(sqrt(CAST(fare_c AS DOUBLE)), 6) AS DOUBLE) AS root, abs(fare_c - total_c) AS gap FROM log""",
)
def f6(i):
    """15 % of a fare, half-up at the cent; square root and absolute difference."""
    fare = F.col("fare_c").cast("decimal(14,0)")
    return i.log.select(
        "event_id",
        (fare * F.lit("0.0015").cast("decimal(5,4)")).cast("decimal(10,2)").alias("share"),
        F.round(F.sqrt("fare_c"), 6).alias("root"),
        F.abs(F.col("fare_c") - F.col("total_c")).alias("gap"),
    )


@query(
    "f7_null_logic",
    """SELECT event_id, coalesce(zone_id, -1) AS zone, km_tenths IS DISTINCT FROM event_id AS km_differs FROM log""",
)
def f7(i):
    return i.log.select(
        "event_id",
        F.coalesce("zone_id", F.lit(-1)).alias("zone"),
        (~F.col("km_tenths").eqNullSafe(F.col("event_id"))).alias("km_differs"),
    )


@query(
    "f8_zone_pair",
    "SELECT event_id, CAST(coalesce(zone_id, -1) AS BIGINT) * 1000 + user_id AS pair FROM log",
)
def f8(i):
    return i.log.select("event_id", zone_pair(zone_or_unknown("zone_id"), F.col("user_id")).alias("pair"))


@query(
    "f9_json",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         '{"id":' || event_id || ',"zone":' || coalesce(CAST(zone_id AS VARCHAR), 'null') || '}' AS text
       FROM events JOIN log USING (event_id)""",
)
def f9(i):
    table = i.table("events").select("event_id", F.get_json_object("props", "$.k").try_cast("bigint").alias("k"))
    text = F.to_json(
        F.struct(F.col("event_id").alias("id"), F.col("zone_id").alias("zone")), {"ignoreNullFields": "false"}
    )
    return i.log.select("event_id", text.alias("text")).join(table, "event_id")


_ERRORS = f"""SELECT event_id, model_version, CAST((predicted_c - quoted_c) / 100.0 AS DECIMAL(11,2)) AS error,
  CASE WHEN quoted_c <> 0 THEN CAST(round(100 * CAST(predicted_c - quoted_c AS DOUBLE) / abs(quoted_c), 4) AS DOUBLE) END
    AS error_pct,
  CASE WHEN quoted_c = 0 OR 100 * abs(predicted_c - quoted_c) < 10 * abs(quoted_c) THEN 'good'
    WHEN 100 * abs(predicted_c - quoted_c) < 25 * abs(quoted_c) THEN 'warning' ELSE 'critical' END AS band FROM scored"""


@query("f10_error_band", f"SELECT model_version, band, count(*) AS n FROM ({_ERRORS}) GROUP BY 1, 2")
def f10(i):
    band = error_band(error_pct(F.col("predicted_amount"), F.col("actual_amount")))
    return i.predictions.groupBy("model_version", band.alias("band")).agg(F.count(F.lit(1)).alias("n"))


@query("f11_quote_errors", f"SELECT event_id, model_version, error, error_pct FROM ({_ERRORS})")
def f11(i):
    predicted, actual = F.col("predicted_amount"), F.col("actual_amount")
    return i.predictions.select(
        "event_id",
        "model_version",
        quote_error(predicted, actual).cast("decimal(11,2)").alias("error"),
        F.round(error_pct(predicted, actual), 4).alias("error_pct"),
    )


@query(
    "f12_age_text",
    """SELECT event_id, CASE WHEN km_tenths IS NULL THEN NULL WHEN km_tenths * 60 + user_id < 90 THEN (km_tenths * 60 + user_id) || 's'
         WHEN km_tenths * 60 + user_id < 5400 THEN CAST(round((km_tenths * 60 + user_id) / 60.0) AS BIGINT) || ' min'
         ELSE printf('%.1f', (km_tenths * 60 + user_id) / 3600.0) || ' h' END AS age
       FROM (SELECT event_id, km_tenths, user_id - user_id % 60 AS user_id FROM log)""",
)
def f12(i):
    """Ages in whole minutes made from two columns, so no half has to be rounded."""
    whole_minutes = F.col("user_id") - F.col("user_id") % 60
    seconds = (F.col("km_tenths") * 60 + whole_minutes).cast("double")
    return i.log.select("event_id", F.when(seconds.isNotNull(), age_text(seconds)).alias("age"))


@query(
    "t4_ordered_prefix",
    """SELECT event_id, pickup_datetime FROM trips WHERE pickup_datetime >= TIMESTAMP '1997-05-05 08:00:00'
       ORDER BY pickup_datetime, event_id LIMIT 5000""",
)
def t4(i):
    prefix = ordered_prefix(i.events, datetime(1997, 5, 5, 8), 5000, "pickup_datetime", ["event_id"])
    return prefix.select("event_id", "pickup_datetime")

