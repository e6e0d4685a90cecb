"""Common table expressions of the checking statements, written independently of the Spark operators.

They work on whole cents (and on 10^-8 km) with integer arithmetic, so a half is always rounded up exactly.
"""

from __future__ import annotations

import re

from catalog.shapes import CUTOFF, GLOBAL_VERSION, PAIR_VERSION, RAW_TRIPS, TRIP_LOG


def amount(cents: str, digits: int = 12) -> str:
    return f"CAST(({cents}) / 100.0 AS DECIMAL({digits},2))"


def mean_amount(total: str, n: str) -> str:
    return f"CAST(CAST((2 * ({total}) + {n}) // (2 * {n}) AS BIGINT) / 100.0 AS DECIMAL(10,2))"


def mean_km(total8: str, n: str) -> str:
    half_up = f"CAST((2 * ({total8}) + {n} * 100000) // (2 * {n} * 100000) AS BIGINT)"
    return f"CASE WHEN {n} > 0 THEN CAST({half_up} / 1000.0 AS DOUBLE) END"


def measures(fare="fare_c", tip="tip_c", total="total_c", km="km8") -> str:
    return f"""count(*) AS trip_count, {amount(f'sum({total})', 14)} AS total_revenue,
      {mean_amount(f'sum({fare})', 'count(*)')} AS avg_fare, {mean_amount(f'sum({tip})', 'count(*)')} AS avg_tip,
      {mean_km(f'sum({km})', f'count({km})')} AS avg_distance_km"""


_JUDGED = """
SELECT *, CAST(round(fare_amount * 100) AS BIGINT) AS fare_c, CAST(round(tip_amount * 100) AS BIGINT) AS tip_c,
  CAST(round(tolls_amount * 100) AS BIGINT) AS toll_c, CAST(round(total_amount * 100) AS BIGINT) AS total_c,
  CAST(round((extra + mta_tax + improvement_surcharge + coalesce(congestion_surcharge, 0)
    + coalesce(Airport_fee, 0)) * 100) AS BIGINT) AS sur_c,
  CASE WHEN VendorID IS NULL OR PULocationID IS NULL OR DOLocationID IS NULL OR tpep_pickup_datetime IS NULL
      OR tpep_dropoff_datetime IS NULL OR trip_distance IS NULL OR fare_amount IS NULL OR total_amount IS NULL
      OR extra IS NULL OR mta_tax IS NULL OR tip_amount IS NULL OR tolls_amount IS NULL
      OR improvement_surcharge IS NULL THEN 'missing_required'
    WHEN trip_distance < 0 THEN 'negative_distance'
    WHEN tpep_dropoff_datetime <= tpep_pickup_datetime THEN 'dropoff_not_after_pickup'
    WHEN fare_amount < 0 OR tip_amount < 0 OR tolls_amount < 0 OR total_amount < 0 OR extra + mta_tax
      + improvement_surcharge + coalesce(congestion_surcharge, 0) + coalesce(Airport_fee, 0) < 0
      THEN 'negative_money'
    WHEN passenger_count < 0 THEN 'negative_passenger_count' END AS reject_reason
FROM raw_trips"""

_TRIPS = f"""
SELECT tpep_pickup_datetime AS pickup_datetime, tpep_dropoff_datetime AS dropoff_datetime,
  CAST(PULocationID AS INT) AS pu, CAST(DOLocationID AS INT) AS do_, CAST(passenger_count AS INT) AS passenger_count,
  CAST(round(trip_distance * 100) AS BIGINT) * 1609344 AS km8, CAST(CAST(VendorID AS INT) AS VARCHAR) AS provider_id,
  CASE WHEN payment_type IS NULL THEN 'UNKNOWN' WHEN payment_type = 1 THEN 'CARD' WHEN payment_type = 2 THEN 'CASH'
    WHEN payment_type = 5 THEN 'UNKNOWN' ELSE 'OTHER' END AS payment_type,
  fare_c, sur_c, tip_c, toll_c, total_c, total_c - tip_c AS quoted_c,
  sha256(concat_ws('|', strftime(tpep_pickup_datetime, '%Y-%m-%d %H:%M:%S'),
    strftime(tpep_dropoff_datetime, '%Y-%m-%d %H:%M:%S'), CAST(CAST(PULocationID AS INT) AS VARCHAR),
    CAST(CAST(DOLocationID AS INT) AS VARCHAR), CAST({amount('total_c')} AS VARCHAR),
    CAST(CAST(VendorID AS INT) AS VARCHAR))) AS digest,
  concat_ws('-', substr(digest, 1, 8), substr(digest, 9, 4), substr(digest, 13, 4), substr(digest, 17, 4),
    substr(digest, 21, 12)) AS event_id,
  pickup_datetime <= TIMESTAMP '{CUTOFF}' AS is_history,
  RatecodeID, store_and_fwd_flag, extra, mta_tax, improvement_surcharge, congestion_surcharge, Airport_fee
FROM judged WHERE reject_reason IS NULL"""

def rollup(source: str, time: str, zone: str, **columns: str) -> str:
    return f"""
SELECT _t AS period, CASE WHEN grouping(_z) = 1 THEN 'city' ELSE 'zone' END AS grain, _z AS zone_id, {measures(**columns)}
FROM (SELECT *, {time} AS _t, {zone} AS _z FROM {source}) GROUP BY GROUPING SETS ((_t, _z), (_t))"""


def windows(source: str, minutes: int) -> str:
    return f"""
SELECT period AS window_start, period + INTERVAL '{minutes}' MINUTE AS window_end, grain, zone_id, trip_count,
  total_revenue, avg_fare, avg_tip, avg_distance_km,
  period + INTERVAL '{minutes + 10}' MINUTE <= (SELECT max(pickup_datetime) FROM {source}) AS is_final
FROM ({rollup(source, f"time_bucket(INTERVAL '{minutes}' MINUTE, pickup_datetime)", 'zone_id')})"""


_SCORED = f"""
SELECT t.*, '{PAIR_VERSION}' AS model_version,
  coalesce(p.median_c, (SELECT median_c FROM global_median)) AS predicted_c
FROM trips t LEFT JOIN pair_median p ON p.pu = t.pu AND p.do_ = t.do_ WHERE NOT t.is_history
UNION ALL
SELECT t.*, '{GLOBAL_VERSION}', (SELECT median_c FROM global_median) FROM trips t WHERE NOT t.is_history"""

_EVALUATION = """
SELECT eval_date, model_version, n AS predictions,
  CAST(CAST((200 * abs_e + n) // (2 * n) AS BIGINT) / 10000.0 AS DECIMAL(10,4)) AS mae,
  CAST(sqrt(CAST(sq_e AS DOUBLE) / n) / 100 AS DECIMAL(10,4)) AS rmse,
  CAST(rel * 100 AS DECIMAL(10,4)) AS mape,
  CASE WHEN n > 1 AND n * sq_a - a * a > 0
    THEN round(1 - CAST(sq_e AS DOUBLE) * n / CAST(n * sq_a - a * a AS DOUBLE), 6) END AS r2,
  CAST(CAST((2 * a + n) // (2 * n) AS BIGINT) / 100.0 AS DECIMAL(10,2)) AS mean_actual,
  CAST(CAST((2 * p + n) // (2 * n) AS BIGINT) / 100.0 AS DECIMAL(10,2)) AS mean_predicted
FROM (SELECT CAST(pickup_datetime AS DATE) AS eval_date, model_version, count(*) AS n,
    CAST(sum(abs(predicted_c - quoted_c)) AS HUGEINT) AS abs_e,
    CAST(sum((predicted_c - quoted_c) * (predicted_c - quoted_c)) AS HUGEINT) AS sq_e,
    avg(CASE WHEN quoted_c <> 0 THEN CAST(abs(predicted_c - quoted_c) AS DOUBLE) / abs(quoted_c) END) AS rel,
    CAST(sum(quoted_c) AS HUGEINT) AS a, CAST(sum(quoted_c * quoted_c) AS HUGEINT) AS sq_a,
    CAST(sum(predicted_c) AS HUGEINT) AS p
  FROM scored GROUP BY ALL)"""

CTES: dict[str, str] = {
    "raw_trips": RAW_TRIPS.format(lineitem="lineitem"),
    "judged": _JUDGED,
    "trips": _TRIPS,
    "repeated": "SELECT *, 1 AS copy FROM trips UNION ALL SELECT *, 2 FROM trips WHERE provider_id = '1'",
    "daily": f"SELECT period AS metric_date, * EXCLUDE (period) FROM ({rollup('trips', 'CAST(pickup_datetime AS DATE)', 'pu')})",
    "log": "SELECT *, km_tenths * 10000000 AS km8 FROM (" + TRIP_LOG.format(events="events") + ")",
    "hot": windows("log", 60),
    "hot5": windows("log", 5),
    "replayed": "SELECT * FROM log UNION ALL SELECT * FROM log WHERE isodow(pickup_datetime) = 7",
    "replayed_hot": windows("replayed", 60),
    "log_unique": "SELECT DISTINCT ON (pickup_datetime, zone_id, total_c, user_id) * FROM log "
    "ORDER BY pickup_datetime, zone_id, total_c, user_id, CAST(event_id AS VARCHAR)",
    "log_daily": "SELECT period AS metric_date, * EXCLUDE (period) FROM ("
    + rollup("log_unique", "CAST(pickup_datetime AS DATE)", "zone_id")
    + ")",
    "global_median": "SELECT CAST(round(median(quoted_c)) AS BIGINT) AS median_c FROM trips WHERE is_history",
    "pair_median": "SELECT pu, do_, CAST(round(median(quoted_c)) AS BIGINT) AS median_c FROM trips "
    "WHERE is_history GROUP BY pu, do_",
    "scored": _SCORED,
    "evaluation": _EVALUATION,
}


def statement(body: str) -> str:
    """The body with every expression it needs in front, in order of definition."""
    needed: set[str] = set()
    pending = [body]
    while pending:
        text = pending.pop()
        for name, definition in CTES.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                pending.append(definition)
    parts = [f"{name} AS ({definition})" for name, definition in CTES.items() if name in needed]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body.strip()
