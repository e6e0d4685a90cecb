"""Joins, aggregations, analytic functions, order and limits, set operations (J*, A*, W*, T*, U*)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Window
from pyspark.sql import functions as F

from catalog.inputs import NOW
from catalog.reference_sql import amount, mean_amount, measures
from catalog.registry import query
from catalog.shapes import GLOBAL_VERSION, PAIR_VERSION
from tripflow.functions.order_stats import leave_group_out_median
from tripflow.operators.arrival import mark_late
from tripflow.operators.baselines import as_amount, global_median, pair_medians, quote_by_pair
from tripflow.operators.dedupe import drop_duplicate_trips, duplicate_stats
from tripflow.operators.encoding import category_statistics
from tripflow.operators.evaluation import (
    accuracy_shares,
    compare_models,
    improvement_pct,
    regression_report,
)
from tripflow.operators.features import bucket_of_100, holdout_split, monthly_sample
from tripflow.operators.merge import WINDOW_KEYS, merge_changed
from tripflow.operators.ownership import is_history, is_live
from tripflow.operators.quality import (
    coverage,
    day_outliers,
    history_gaps,
    history_span,
    pair_raw_with_canonical,
    reject_summary,
    rejection_by_month,
    rows_changed,
    rows_per_day,
    tip_share,
)
from tripflow.operators.rollup import (
    city_rows,
    daily_metrics,
    rollup_violations,
    staged_stats,
    zone_rows,
)
from tripflow.operators.rules import by_severity, with_all_clear, _finding
from tripflow.operators.serving import (
    cold_daily,
    hot_top_zones,
    hot_windows,
    latest_window,
    live_predictions,
    long_series,
    LAYER_LABELS,
    newest_window_rows,
    prediction_freshness,
    prediction_range,
    prediction_windows,
    quotes_per_version,
    reconciliation,
)
from tripflow.sources.raw_files import union_months, union_permissive

_MEASURES = "trip_count, total_revenue, avg_fare, avg_tip, avg_distance_km"

# --- joins -------------------------------------------------------------------------------------------

RECON = """SELECT c.metric_date, c.trip_count AS cold_trips, h.hot_trips FROM log_daily c JOIN (
    SELECT CAST(window_start AS DATE) AS d, CAST(sum(trip_count) AS BIGINT) AS hot_trips FROM replayed_hot
    WHERE grain = 'city' AND window_start >= TIMESTAMP '2024-01-05' GROUP BY 1) h ON h.d = c.metric_date
  WHERE c.grain = 'city' AND c.metric_date >= DATE '2024-01-05'"""


def recon(i):
    return reconciliation(i.log_daily, i.replayed_windows, datetime(2024, 1, 5).date())


query("j1_reconcile", RECON)(recon)


@query(
    "j2_pair_lookup",
    f"""SELECT event_id, {amount('predicted_c', 10)} AS predicted_amount FROM scored
        WHERE model_version = '{PAIR_VERSION}'""",
)
def j2(i):
    live = i.trips.where(is_live(i.settings.cutoff))
    return quote_by_pair(live, pair_medians(i.fitted), global_median(i.fitted)).select(
        "event_id", "predicted_amount"
    )


@query(
    "j3_newest_window_rows",
    f"""SELECT window_start, grain, zone_id, {_MEASURES}, is_final FROM hot WHERE window_start = (
        SELECT max(window_start) FROM hot WHERE window_start >= TIMESTAMP '2024-01-10'
          AND window_start < TIMESTAMP '2024-01-20 12:00:00')""",
)
def j3(i):
    rows = newest_window_rows(i.windows, datetime(2024, 1, 10), datetime(2024, 1, 20, 12))
    return rows.drop("window_end")


_OTHERS = """SELECT a.eval_date, a.model_version, median(CAST(b.mae AS DOUBLE)) AS others_median FROM evaluation a
  JOIN evaluation b ON b.model_version = a.model_version AND b.eval_date <> a.eval_date GROUP BY 1, 2"""


@query("j4_other_days_median", f"SELECT eval_date, model_version, round(others_median, 6) AS others_median FROM ({_OTHERS})")
def j4(i):
    others = leave_group_out_median(i.evaluation, "mae", "eval_date", ["model_version"])
    return others.select("eval_date", "model_version", F.round("others_median", 6).alias("others_median"))


@query(
    "j4_other_days_median_pooled",
    """SELECT a.eval_date, round(median(CAST(b.mae AS DOUBLE)), 6) AS others_median
       FROM (SELECT DISTINCT eval_date FROM evaluation) a JOIN evaluation b ON b.eval_date <> a.eval_date GROUP BY 1""",
)
def j4_pooled(i):
    others = leave_group_out_median(i.evaluation, "mae", "eval_date")
    return others.select("eval_date", F.round("others_median", 6).alias("others_median"))


@query(
    "j5_pair_raw_with_canonical",
    """SELECT outcome, count(*) AS keys, CAST(sum(raw_rows) AS BIGINT) AS raw_rows, CAST(sum(events) AS BIGINT) AS events FROM (
        SELECT CASE WHEN raw_rows > 1 OR events > 1 THEN 'ambiguous' WHEN events = 0 THEN 'rejected'
          WHEN raw_rows = 0 THEN 'unsent' ELSE 'paired' END AS outcome, raw_rows, events
        FROM (SELECT sum(r) AS raw_rows, sum(1 - r) AS events FROM (
            SELECT tpep_pickup_datetime a, tpep_dropoff_datetime b, PULocationID c, DOLocationID d, total_c e,
              CAST(CAST(VendorID AS INT) AS VARCHAR) f, 1 AS r FROM judged
            UNION ALL SELECT pickup_datetime, dropoff_datetime, pu, do_, total_c, provider_id, 0 FROM repeated)
          GROUP BY a, b, c, d, e, f)) GROUP BY 1""",
)
def j5(i):
    pairs = pair_raw_with_canonical(i.judged, i.repeated_events)
    return pairs.groupBy("outcome").agg(
        F.count(F.lit(1)).alias("keys"), F.sum("raw_rows").alias("raw_rows"), F.sum("events").alias("events")
    )


@query(
    "j6_null_safe_upsert",
    f"""SELECT coalesce(n.window_start, o.window_start) AS window_start, coalesce(n.grain, o.grain) AS grain,
      coalesce(n.zone_id, o.zone_id) AS zone_id, coalesce(n.trip_count, o.trip_count) AS trip_count
    FROM (SELECT * FROM hot WHERE is_final AND window_start < TIMESTAMP '2024-01-15') o
      FULL JOIN (SELECT * FROM replayed_hot WHERE window_start >= TIMESTAMP '2024-01-10') n
      ON o.window_start = n.window_start AND o.grain = n.grain AND o.zone_id IS NOT DISTINCT FROM n.zone_id""",
)
def j6(i):
    stored = i.windows.where("is_final and window_start < timestamp '2024-01-15'").withColumn(
        "updated_at", F.lit(NOW).cast("timestamp")
    )
    staged = i.replayed_windows.where("window_start >= timestamp '2024-01-10'")
    return merge_changed(stored, staged, WINDOW_KEYS, ["trip_count"], NOW, "updated_at").drop("updated_at")


@query(
    "j7_coverage",
    """SELECT s.metric_date, s.source_rows, coalesce(l.lake_rows, 0) AS lake_rows,
         CAST(round(100.0 * coalesce(l.lake_rows, 0) / s.source_rows, 4) AS DOUBLE) AS coverage_pct
       FROM (SELECT CAST(pickup_datetime AS DATE) AS metric_date, count(*) AS source_rows FROM trips GROUP BY 1) s
       LEFT JOIN (SELECT CAST(pickup_datetime AS DATE) AS metric_date, count(*) AS lake_rows FROM trips
         WHERE provider_id = '1' AND is_history GROUP BY 1) l USING (metric_date)""",
)
def j7(i):
    lake = i.events.where(is_history(i.settings.cutoff) & (F.col("provider_id") == "1"))
    return coverage(
        rows_per_day(i.events, "pickup_datetime", "source_rows"), rows_per_day(lake, "pickup_datetime", "lake_rows")
    )


@query(
    "j8_compare_models",
    f"""SELECT o.eval_date, o.mae AS old_mae, n.mae AS new_mae,
      CASE WHEN o.mae <> 0 THEN CAST(round(CAST(1000000 * (n.mae - o.mae) AS DOUBLE) / CAST(o.mae * 10000 AS DOUBLE), 2)
        AS DECIMAL(12,2)) END AS change_pct, n.mae < o.mae AS new_wins
    FROM evaluation o JOIN evaluation n ON n.eval_date = o.eval_date AND n.model_version = '{PAIR_VERSION}'
    WHERE o.model_version = '{GLOBAL_VERSION}'""",
)
def j8(i):
    return compare_models(i.evaluation, GLOBAL_VERSION, PAIR_VERSION)


# --- aggregations ------------------------------------------------------------------------------------


@query("a1_window_zone", f"SELECT window_start, window_end, zone_id, {_MEASURES}, is_final FROM hot WHERE grain = 'zone'")
def a1(i):
    return zone_rows(i.windows).drop("grain")


@query("a1_window_zone_5min", f"SELECT window_start, window_end, zone_id, {_MEASURES}, is_final FROM hot5 WHERE grain = 'zone'")
def a1_short(i):
    return zone_rows(i.short_windows).drop("grain")


@query("a2_window_city", f"SELECT window_start, window_end, {_MEASURES}, is_final FROM hot WHERE grain = 'city'")
def a2(i):
    return city_rows(i.windows).drop("grain", "zone_id")


@query("a3_daily_zone", f"SELECT metric_date, zone_id, {_MEASURES} FROM daily WHERE grain = 'zone'")
def a3(i):
    return zone_rows(i.daily).drop("grain")


@query("a4_daily_city", f"SELECT metric_date, {_MEASURES} FROM daily WHERE grain = 'city'")
def a4(i):
    return city_rows(i.daily).drop("grain", "zone_id")


@query("a5_evaluate_daily", "SELECT * FROM evaluation")
def a5(i):
    return i.evaluation


PREDICTION_WINDOWS = f"""SELECT date_trunc('hour', pickup_datetime) + (minute(pickup_datetime) // 5) * INTERVAL 5 MINUTE
    AS window_start, count(*) AS trips, {mean_amount('sum(predicted_c)', 'count(*)')} AS predicted,
    {mean_amount('sum(quoted_c)', 'count(*)')} AS actual FROM scored
  WHERE pickup_datetime >= TIMESTAMP '2000-02-01' AND pickup_datetime < TIMESTAMP '2001-02-01' GROUP BY 1"""


def windows_of_quotes(i):
    return prediction_windows(i.predictions, datetime(2000, 2, 1), datetime(2001, 2, 1))


query("a6_quote_windows", PREDICTION_WINDOWS)(windows_of_quotes)
RANGE = "SELECT CAST(min(pickup_datetime) AS DATE) AS first_day, CAST(max(pickup_datetime) AS DATE) AS last_day FROM scored"
FRESHNESS = "SELECT max(dropoff_datetime) AS last_written, count(*) AS total, max(model_version) AS model_version FROM scored"
query("a7_scored_range", RANGE)(lambda i: prediction_range(i.predictions))
query("a8_freshness", FRESHNESS)(lambda i: prediction_freshness(i.predictions))


@query(
    "a9_reject_summary",
    """SELECT coalesce(reject_reason, 'accepted') AS verdict, count(*) AS row_count,
         CAST(round(100.0 * count(*) / (SELECT count(*) FROM judged), 4) AS DOUBLE) AS share_pct FROM judged GROUP BY 1""",
)
def a9(i):
    return reject_summary(i.judged)


@query(
    "a10_rejection_by_month",
    """SELECT source_month, count(*) AS rows_read, count(*) FILTER (ok) AS rows_accepted,
         CAST(round(100.0 * count(*) FILTER (NOT ok) / count(*), 4) AS DOUBLE) AS rejected_pct
       FROM (SELECT *, reject_reason IS NULL AND tpep_pickup_datetime >= source_month
           AND tpep_pickup_datetime < source_month + INTERVAL 1 MONTH AS ok FROM judged) GROUP BY 1""",
)
def a10(i):
    return rejection_by_month(i.judged_by_month)


@query("a11_global_median", f"SELECT {amount('median_c', 10)} AS median_amount FROM global_median")
def a11(i):
    return global_median(i.fitted).select(as_amount(F.col("median_cents").cast("decimal(12,0)")).alias("median_amount"))


@query("a12_pair_median", "SELECT pu AS pickup_zone_id, do_ AS dropoff_zone_id, median_c AS median_cents FROM pair_median")
def a12(i):
    return pair_medians(i.fitted)


REPORT = """SELECT model_version, count(*) AS row_count,
  CAST(CAST((200 * sum(abs(predicted_c - quoted_c)) + count(*)) // (2 * count(*)) AS BIGINT) / 10000.0 AS DECIMAL(10,4)) AS mae,
  CAST(sqrt(CAST(sum((predicted_c - quoted_c) * (predicted_c - quoted_c)) AS DOUBLE) / count(*)) / 100 AS DECIMAL(10,4)) AS rmse,
  round(1 - CAST(sum((predicted_c - quoted_c) * (predicted_c - quoted_c)) AS DOUBLE) * count(*)
    / CAST(count(*) * sum(quoted_c * quoted_c) - sum(quoted_c) * sum(quoted_c) AS DOUBLE), 6) AS r2
  FROM scored GROUP BY 1"""


@query("a13_regression_report", REPORT)
def a13(i):
    return regression_report(i.predictions, ["model_version"])


@query(
    "a14_improvement",
    f"""SELECT b.mae AS baseline_mae, m.mae AS model_mae,
      CAST(round(CAST(1000000 * (b.mae - m.mae) AS DOUBLE) / CAST(b.mae * 10000 AS DOUBLE), 2) AS DECIMAL(10,2)) AS improvement_pct
    FROM ({REPORT}) b, ({REPORT}) m WHERE b.model_version = '{GLOBAL_VERSION}' AND m.model_version = '{PAIR_VERSION}'""",
)
def a14(i):
    return improvement_pct(
        regression_report(i.predictions, ["model_version"]), "model_version", GLOBAL_VERSION, PAIR_VERSION
    )


@query(
    "a15_accuracy_shares",
    """SELECT model_version, count(*) AS quotes,
      CAST(round(100.0 * count(*) FILTER (quoted_c <> 0 AND 100 * abs(predicted_c - quoted_c) < 10 * abs(quoted_c)) / count(*), 4)
        AS DOUBLE) AS within_10_pct,
      CAST(round(100.0 * count(*) FILTER (quoted_c <> 0 AND 100 * abs(predicted_c - quoted_c) < 25 * abs(quoted_c)) / count(*), 4)
        AS DOUBLE) AS within_25_pct, median(abs(predicted_c - quoted_c)) / 100 AS median_abs_error FROM scored GROUP BY 1""",
)
def a15(i):
    return accuracy_shares(i.predictions, ["model_version"])


@query("a16_staged_stats", "SELECT count(*) AS row_count, count(DISTINCT metric_date) AS day_count FROM daily")
def a16(i):
    return staged_stats(i.daily)


@query(
    "a17_duplicate_stats",
    """SELECT CAST(sum(n) AS BIGINT) AS rows_before, count(*) AS rows_after, CAST(sum(n) - count(*) AS BIGINT) AS collapsed
       FROM (SELECT count(*) AS n FROM repeated GROUP BY pickup_datetime, dropoff_datetime, pu, do_, total_c, provider_id)""",
)
def a17(i):
    return duplicate_stats(i.repeated_events)


@query(
    "a18_rollup_violations",
    """SELECT metric_date, CAST(sum(trip_count) FILTER (grain = 'city') AS BIGINT) AS city_trips,
         CAST(sum(trip_count) FILTER (grain = 'zone') AS BIGINT) AS zone_trips,
         CAST(sum(total_revenue) FILTER (grain = 'city') AS DECIMAL(24,2)) AS city_revenue,
         CAST(sum(total_revenue) FILTER (grain = 'zone') AS DECIMAL(24,2)) AS zone_revenue
       FROM (SELECT CAST(window_start AS DATE) AS metric_date, grain, trip_count, total_revenue FROM replayed_hot WHERE grain = 'city'
         UNION ALL SELECT metric_date, grain, trip_count, total_revenue FROM log_daily WHERE grain = 'zone')
       GROUP BY 1 HAVING city_trips <> zone_trips OR city_revenue <> zone_revenue""",
)
def a18(i):
    """City rows of a log with replays against zone rows without: exactly the replayed days disagree."""
    city = city_rows(i.replayed_windows).select(
        F.to_date("window_start").alias("metric_date"), "grain", "trip_count", "total_revenue"
    )
    zones = zone_rows(i.log_daily).select("metric_date", "grain", "trip_count", "total_revenue")
    return rollup_violations(city.unionByName(zones), "metric_date")


@query(
    "a19_category_statistics",
    """SELECT pu AS pickup_zone_id, count(*) AS row_count, round(avg(CAST(quoted_c AS DOUBLE)), 4) AS mean_value,
         round(var_pop(CAST(quoted_c AS DOUBLE)), 2) AS variance_value FROM trips WHERE is_history GROUP BY 1""",
)
def a19(i):
    stats = category_statistics(i.fitted, ["pickup_zone_id"])
    return stats.select(
        "pickup_zone_id",
        "row_count",
        F.round("mean_value", 4).alias("mean_value"),
        F.round("variance_value", 2).alias("variance_value"),
    )


@query("a20_quotes_per_version", "SELECT model_version, count(*) AS quotes FROM scored GROUP BY 1")
def a20(i):
    return quotes_per_version(i.predictions)


_ZONE_7 = "SELECT DISTINCT metric_date FROM daily WHERE grain = 'zone' AND zone_id = 7"


@query(
    "a21_history_span",
    f"""SELECT count(*) AS day_count, min(metric_date) AS first_day, max(metric_date) AS last_day,
         max(metric_date) - min(metric_date) + 1 - count(*) AS missing_days FROM (SELECT DISTINCT metric_date FROM daily)""",
)
def a21(i):
    return history_span(i.daily)


@query(
    "a21_history_gaps",
    f"""SELECT CAST(d AS DATE) AS metric_date FROM (SELECT unnest(generate_series(min(metric_date)::TIMESTAMP,
          max(metric_date)::TIMESTAMP, INTERVAL 1 DAY)) AS d FROM ({_ZONE_7}))
        WHERE CAST(d AS DATE) NOT IN (SELECT metric_date FROM ({_ZONE_7}))""",
)
def a21_gaps(i):
    """Days on which one zone had no trip."""
    return history_gaps(zone_rows(i.daily).where("zone_id = 7"))


_CITY_DAYS = f"""(SELECT CAST(pickup_datetime AS DATE) AS metric_date, count(*) AS trip_count,
  {mean_amount('sum(total_c)', 'count(*)')} AS avg_price FROM trips GROUP BY 1)"""


@query(
    "a22_day_outliers",
    f"""SELECT metric_date, trip_count, avg_price,
      CAST(round(CAST(avg_price AS DOUBLE) / (SELECT median(CAST(round(avg_price * 100) AS BIGINT)) / 100 FROM {_CITY_DAYS}), 4)
        AS DOUBLE) AS price_ratio,
      CAST(round(trip_count / (SELECT median(trip_count) FROM {_CITY_DAYS}), 4) AS DOUBLE) AS volume_ratio FROM {_CITY_DAYS}""",
)
def a22(i):
    return day_outliers(i.daily)


@query(
    "a23_tip_share",
    f"""SELECT payment_type, count(*) AS trips, {mean_amount('sum(fare_c)', 'count(*)')} AS avg_fare,
      {mean_amount('sum(tip_c)', 'count(*)')} AS avg_tip,
      CAST(round(sum(tip_c) / sum(fare_c), 6) AS DECIMAL(12,6)) AS tip_share FROM trips GROUP BY 1""",
)
def a23(i):
    return tip_share(i.events)


# --- analytic functions ------------------------------------------------------------------------------

LATE = """SELECT event_id, watermark, coalesce(date_trunc('hour', pickup_datetime) + INTERVAL 70 MINUTE <= watermark, false)
    AS is_late FROM (SELECT event_id, pickup_datetime, max(pickup_datetime) OVER (ORDER BY arrival, event_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS watermark FROM log)"""


@query("w1_late_events", LATE)
def w1(i):
    marked = mark_late(i.views, i.settings.window_minutes, i.settings.grace_minutes)
    return marked.select("event_id", "watermark", "is_late")


@query(
    "w2_first_copy",
    """SELECT event_id, TIMESTAMP '2001-12-01 06:00:00' AS ingested_at, provider_id FROM repeated
       QUALIFY row_number() OVER (PARTITION BY pickup_datetime, dropoff_datetime, pu, do_, total_c, provider_id ORDER BY copy) = 1""",
)
def w2(i):
    return drop_duplicate_trips(i.repeated_events).select("event_id", "ingested_at", "provider_id")


LATEST_WINDOW = """SELECT window_start, trip_count, total_revenue, avg_fare FROM hot WHERE grain = 'city'
  AND window_start >= TIMESTAMP '2024-01-03' AND window_start < TIMESTAMP '2024-01-25 07:00:00' ORDER BY window_start DESC LIMIT 1"""


def newest_window(i):
    return latest_window(i.windows, datetime(2024, 1, 3), datetime(2024, 1, 25, 7))


query("w3_latest_row", LATEST_WINDOW)(newest_window)

# --- order, limits, samples --------------------------------------------------------------------------

TOP_ZONES = """SELECT zone_id, trip_count, avg_fare FROM hot WHERE grain = 'zone' AND zone_id IS NOT NULL AND window_start = (
    SELECT max(window_start) FROM hot WHERE window_start >= TIMESTAMP '2024-01-10' AND window_start < TIMESTAMP '2024-01-20 12:00:00')
  ORDER BY trip_count DESC, zone_id LIMIT 10"""
HOT_WINDOWS = """SELECT window_start, trip_count, total_revenue, avg_fare, avg_tip, is_final FROM hot WHERE grain = 'city'
  AND window_start >= TIMESTAMP '2024-01-10' ORDER BY window_start DESC LIMIT 96"""
NEWEST_QUOTES = f"""SELECT event_id, pickup_datetime, dropoff_datetime, pu AS pickup_zone_id, do_ AS dropoff_zone_id,
    {amount('predicted_c', 10)} AS predicted_amount, {amount('quoted_c', 10)} AS actual_amount, model_version,
    CAST((predicted_c - quoted_c) / 100.0 AS DECIMAL(11,2)) AS error,
    CASE WHEN quoted_c <> 0 THEN CAST(round(100 * CAST(predicted_c - quoted_c AS DOUBLE) / abs(quoted_c), 4) AS DOUBLE) END AS error_pct
  FROM scored WHERE pickup_datetime >= TIMESTAMP '2000-01-01' AND pickup_datetime < TIMESTAMP '2001-07-01'
  ORDER BY pickup_datetime DESC, event_id, model_version LIMIT 300"""


def top_zones(i):
    return hot_top_zones(i.windows, datetime(2024, 1, 10), datetime(2024, 1, 20, 12), i.settings.top_zones)


def newest_windows(i):
    return hot_windows(i.windows, datetime(2024, 1, 10), None, i.settings.newest_windows)


def newest_quotes(i):
    return live_predictions(i.predictions, datetime(2000, 1, 1), datetime(2001, 7, 1), i.settings.newest_quotes)


query("t1_top_zones", TOP_ZONES)(top_zones)
query("t2_newest_windows", HOT_WINDOWS)(newest_windows)
query("t3_newest_quotes", NEWEST_QUOTES)(newest_quotes)


def findings(i):
    band = F.element_at(F.array(*map(F.lit, ("warning", "good", "critical", "serious"))), F.month("metric_date") % 4 + 1)
    city = city_rows(i.daily)
    return city.select(
        *_finding("day", band, F.col("metric_date"), F.col("trip_count"), F.lit(1.0))
    )


@query(
    "t5_severity_order",
    """SELECT CAST(row_number() OVER (ORDER BY CASE severity WHEN 'critical' THEN 0 WHEN 'serious' THEN 1 WHEN 'warning' THEN 2
         ELSE 3 END, subject) - 1 AS BIGINT) AS position, severity, subject FROM (
         SELECT ['warning', 'good', 'critical', 'serious'][month(metric_date) % 4 + 1] AS severity,
           CAST(metric_date AS VARCHAR) AS subject FROM daily WHERE grain = 'city')""",
)
def t5(i):
    ordered = by_severity(findings(i)).select("severity", "subject")
    rank = F.array_position(F.array(*map(F.lit, ("critical", "serious", "warning", "good"))), F.col("severity"))
    # The report of one row per day is numbered to make its order visible to an order-blind comparison.
    return ordered.withColumn(
        "position", (F.row_number().over(Window.orderBy(rank, "subject")) - 1).cast("bigint")
    )


@query(
    "t6_monthly_sample",
    """SELECT event_id, CAST(date_trunc('month', pickup_datetime) AS DATE) AS source_month FROM trips WHERE is_history
       QUALIFY row_number() OVER (PARTITION BY date_trunc('month', pickup_datetime)
         ORDER BY CAST('0x' || substr(md5(event_id), 1, 15) AS BIGINT), event_id) <= 100""",
)
def t6(i):
    rows = i.trips.where(is_history(i.settings.cutoff)).select(
        "event_id", F.trunc("pickup_datetime", "month").alias("source_month")
    )
    rank = F.conv(F.substring(F.md5("event_id"), 1, 15), 16, 10).cast("bigint")
    return monthly_sample(rows, 100, rank)


@query(
    "t7_holdout_split",
    """SELECT event_id, CAST('0x' || substr(md5(event_id || ':42'), 1, 8) AS BIGINT) % 100 AS bucket,
         CASE WHEN CAST('0x' || substr(md5(event_id || ':42'), 1, 8) AS BIGINT) % 100 < 20 THEN 'holdout' ELSE 'train' END AS part
       FROM trips""",
)
def t7(i):
    train, held = holdout_split(i.trips, i.settings)
    bucket = bucket_of_100(i.settings.seed).alias("bucket")
    return train.select("event_id", bucket, F.lit("train").alias("part")).unionByName(
        held.select("event_id", bucket, F.lit("holdout").alias("part"))
    )


@query("t8_daily_series", f"SELECT metric_date, {_MEASURES} FROM daily WHERE grain = 'city'")
def t8(i):
    return cold_daily(i.daily)


# --- set operations ----------------------------------------------------------------------------------


@query("u1_both_grains", f"SELECT metric_date, grain, zone_id, {_MEASURES} FROM daily")
def u1(i):
    return zone_rows(i.daily).unionByName(city_rows(i.daily))


@query(
    "u2_permissive_union",
    """SELECT tpep_pickup_datetime AS pickup, CASE WHEN l = 'F' THEN congestion_surcharge END AS congestion_surcharge,
         CASE WHEN l = 'F' THEN extra ELSE 0.0::DOUBLE END AS extra FROM (
         SELECT *, CASE WHEN store_and_fwd_flag = 'Y' THEN 'F' ELSE 'O' END AS l FROM raw_trips)""",
)
def u2(i):
    """Half of the files lack two columns."""
    full = i.raw.where("store_and_fwd_flag = 'Y'")
    older = i.raw.where("store_and_fwd_flag <> 'Y'").drop("congestion_surcharge", "extra")
    return union_months(full, older).select(
        F.col("tpep_pickup_datetime").alias("pickup"), "congestion_surcharge", "extra"
    )


@query(
    "u2_permissive_union_plain",
    """SELECT CAST(VendorID AS INT) AS vendor, CASE WHEN VendorID = 1 THEN congestion_surcharge END AS congestion_surcharge,
         total_amount FROM raw_trips""",
)
def u2_plain(i):
    raw = i.raw.select(F.col("VendorID").cast("int").alias("vendor"), "congestion_surcharge", "total_amount")
    return union_permissive(raw.where("vendor = 1"), raw.where("vendor <> 1").drop("congestion_surcharge"))


@query(
    "u3_rule_union",
    "SELECT 'good' AS severity, 'all' AS subject UNION ALL SELECT 'critical', CAST(metric_date AS VARCHAR) FROM daily "
    "WHERE grain = 'city' AND month(metric_date) % 4 = 2",
)
def u3(i):
    """An empty set of findings gets the all-clear row; a filled one stays as it is."""
    rows = findings(i)
    nothing = with_all_clear(rows.where("severity = 'nothing'"))
    some = with_all_clear(rows.where("severity = 'critical'"))
    return nothing.unionByName(some).select("severity", "subject")


RECON_SERIES = f"""SELECT metric_date, 'Cold path' AS layer, cold_trips AS trips FROM ({RECON})
  UNION ALL SELECT metric_date, 'Hot path', hot_trips FROM ({RECON})"""


def recon_series(i):
    return long_series(recon(i), ["metric_date"], LAYER_LABELS, "layer", "trips")


query("u4_unpivot", RECON_SERIES)(recon_series)


_HISTORY_DAILY = f"""SELECT CAST(pickup_datetime AS DATE) AS metric_date, CASE WHEN grouping(pu) = 1 THEN 'city' ELSE 'zone' END AS grain,
  pu AS zone_id, {measures()} FROM trips WHERE pickup_datetime < TIMESTAMP '2000-06-01 12:00:00'
  GROUP BY GROUPING SETS ((CAST(pickup_datetime AS DATE), pu), (CAST(pickup_datetime AS DATE)))"""


@query(
    "u5_rows_changed",
    f"""SELECT *, 'before' AS side FROM ({_HISTORY_DAILY} EXCEPT ALL SELECT * FROM daily)
        UNION ALL SELECT *, 'after' FROM (SELECT * FROM daily EXCEPT ALL {_HISTORY_DAILY})""",
)
def u5(i):
    before = daily_metrics(i.events.where("pickup_datetime < timestamp '2000-06-01 12:00:00'"))
    return rows_changed(before, i.daily)

