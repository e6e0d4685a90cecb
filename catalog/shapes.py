"""The test tables seen as trip data. The texts run unchanged in Spark SQL and in the checking engine."""

# lineitem as raw monthly trip files. Amounts are built from whole cents, so decimals are exact.
RAW_TRIPS = """
WITH c AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag, l_linestatus, l_shipdate,
    CAST(floor(l_extendedprice / 10) AS BIGINT) AS fare_c,
    CAST(floor(l_discount * 100 + 0.5) AS BIGINT) AS disc_pct,
    CAST(floor(l_tax * 100 + 0.5) AS BIGINT) AS tax_pct,
    CASE WHEN l_returnflag = 'R' AND l_orderkey % 53 = 0 THEN -1 ELSE 1 END AS sgn,
    (l_orderkey * 7919 + l_linenumber * 104729) % 86400 AS sec
  FROM {lineitem}),
m AS (
  SELECT c.*, sgn * fare_c AS f_c, disc_pct * 37 AS tip_c, CASE WHEN tax_pct = 8 THEN 694 ELSE 0 END AS toll_c,
    (l_linenumber % 2) * 100 AS extra_c, 50 AS mta_c, 100 AS imp_c,
    CASE WHEN l_linestatus = 'F' THEN 250 END AS cong_c,
    CASE WHEN l_suppkey % 20 = 0 THEN 175 END AS air_c
  FROM c)
SELECT
  CAST(1 + l_suppkey % 2 AS DOUBLE) AS VendorID,
  l_shipdate + sec * INTERVAL '1' SECOND AS tpep_pickup_datetime,
  l_shipdate + (sec + (CAST(l_quantity AS BIGINT) - 1) * 60) * INTERVAL '1' SECOND AS tpep_dropoff_datetime,
  CASE WHEN l_partkey % 11 <> 0 THEN CAST(l_linenumber % 7 AS DOUBLE) END AS passenger_count,
  CAST(1 + l_partkey % 6 AS DOUBLE) AS RatecodeID,
  CASE l_returnflag WHEN 'A' THEN 1.0 WHEN 'N' THEN 2.0
    ELSE CASE l_orderkey % 3 WHEN 0 THEN 3.0 WHEN 1 THEN 5.0 END END AS payment_type,
  CAST(l_quantity * 37 AS DOUBLE) / 100 AS trip_distance,
  CASE WHEN l_linestatus = 'F' THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
  CASE WHEN l_orderkey % 97 <> 0 THEN CAST(1 + l_suppkey % 265 AS DOUBLE) END AS PULocationID,
  CAST(1 + l_partkey % 265 AS DOUBLE) AS DOLocationID,
  CAST(f_c AS DOUBLE) / 100 AS fare_amount, CAST(extra_c AS DOUBLE) / 100 AS extra,
  CAST(mta_c AS DOUBLE) / 100 AS mta_tax, CAST(tip_c AS DOUBLE) / 100 AS tip_amount,
  CAST(toll_c AS DOUBLE) / 100 AS tolls_amount, CAST(imp_c AS DOUBLE) / 100 AS improvement_surcharge,
  CAST(f_c + tip_c + toll_c + extra_c + mta_c + imp_c + coalesce(cong_c, 0) + coalesce(air_c, 0) AS DOUBLE) / 100 AS total_amount,
  CAST(cong_c AS DOUBLE) / 100 AS congestion_surcharge, CAST(air_c AS DOUBLE) / 100 AS Airport_fee,
  CAST(date_trunc('month', l_shipdate) - CASE WHEN l_orderkey % 997 = 0
    THEN INTERVAL '1' MONTH ELSE INTERVAL '0' MONTH END AS DATE) AS source_month
FROM m
"""

# events as an arrival-ordered trip log. Some trips have no zone; a disturbed arrival number is included.
TRIP_LOG = """
WITH c AS (
  SELECT event_id, ts, user_id, event_type,
    CASE WHEN user_id % 29 <> 0 THEN CAST(1 + user_id % 25 AS INT) END AS zone_id,
    CAST(CAST(value AS DECIMAL(12,2)) * 100 AS BIGINT) AS fare_c
  FROM {events}),
m AS (
  SELECT c.*, CASE WHEN event_type = 'purchase'
    THEN CAST((fare_c - fare_c % 10) / 10 AS BIGINT) ELSE 0 END AS tip_c
  FROM c)
SELECT event_id, event_id + CASE WHEN event_id % 37 = 0 THEN 20 ELSE 0 END AS arrival,
  ts AS pickup_datetime, zone_id, user_id, event_type,
  fare_c, tip_c, fare_c + tip_c AS total_c,
  CASE WHEN event_type <> 'error' THEN event_id % 200 END AS km_tenths
FROM m
"""

CUTOFF = "1999-12-31 23:59:59"
HISTORY_STAMP = "2001-12-01 06:00:00"
NOW_STAMP = "2002-01-01 06:00:00"
PAIR_VERSION, GLOBAL_VERSION = "pair-median-1", "global-median-1"
