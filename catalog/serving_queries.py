"""Read queries and anomaly rules (Q*, L*), and the model pipeline around them (M*)."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Window
from pyspark.sql import functions as F

from catalog.analysis_queries import (
    FRESHNESS,
    HOT_WINDOWS,
    LATEST_WINDOW,
    NEWEST_QUOTES,
    PREDICTION_WINDOWS,
    RANGE,
    RECON,
    RECON_SERIES,
    TOP_ZONES,
    newest_quotes,
    newest_window,
    newest_windows,
    recon,
    recon_series,
    top_zones,
    windows_of_quotes,
)
from catalog.inputs import NOW
from catalog.reference_sql import amount
from catalog.registry import query
from catalog.shapes import NOW_STAMP, PAIR_VERSION
from tripflow.operators.baselines import global_median, pair_medians, quote_by_pair
from tripflow.operators.boosting import compare_on_holdout, fit_fare_model, load_model, score_holdout
from tripflow.operators.encoding import (
    cross_fitted_codes,
    encode,
    encode_training,
    fit_encodings,
    fold_of,
)
from tripflow.operators.features import (
    SAMPLE_COLUMNS,
    features,
    holdout_split,
    training_rows,
    usable_target,
)
from tripflow.operators.ownership import is_live
from tripflow.operators.rules import (
    evaluate_rules,
    explanatory_power,
    layer_divergence,
    model_error,
    scoring_idle,
)
from tripflow.operators.serving import (
    MEAN_LABELS,
    PRICE_LABELS,
    cold_daily,
    daily_evaluation,
    feed_rows,
    feed_summary,
    latest_evaluation,
    long_series,
    prediction_freshness,
    prediction_range,
    zone_history,
)
from tripflow.session import scratch, settled
from tripflow.plans.jobs import score_batch

_MEASURES = "trip_count, total_revenue, avg_fare, avg_tip, avg_distance_km"

# --- read queries ------------------------------------------------------------------------------------

query("q1_hot_windows", HOT_WINDOWS)(newest_windows)
query("q2_hot_top_zones", TOP_ZONES)(top_zones)
query("q3_cold_daily", f"SELECT metric_date, {_MEASURES} FROM daily WHERE grain = 'city'")(
    lambda i: cold_daily(i.daily)
)
query("q4_reconciliation", RECON)(recon)
query("q5_daily_eval", "SELECT * FROM evaluation")(lambda i: daily_evaluation(i.evaluation))
query("q6_live_predictions", NEWEST_QUOTES)(newest_quotes)
query("q7_prediction_windows", PREDICTION_WINDOWS)(windows_of_quotes)
query("q8_prediction_range", RANGE)(lambda i: prediction_range(i.predictions))
query("q9_prediction_freshness", FRESHNESS)(lambda i: prediction_freshness(i.predictions))

_FEED_TEST = """CAST(round(100.0 * count(*) FILTER (actual_amount <> 0 AND 100 * abs(error) < {limit} * abs(actual_amount))
  / count(*), 4) AS DOUBLE)"""


@query(
    "q10_feed_summary",
    f"""SELECT count(*) AS quotes, {_FEED_TEST.format(limit=10)} AS within_10_pct, {_FEED_TEST.format(limit=25)} AS within_25_pct,
        median(CAST(round(abs(error) * 100) AS BIGINT)) / 100 AS median_abs_error FROM ({NEWEST_QUOTES})""",
)
def q10(i):
    return feed_summary(newest_quotes(i))


@query(
    "q10_feed_rows",
    f"""SELECT event_id, model_version, CAST(round(epoch(dropoff_datetime - pickup_datetime) / 60, 4) AS DOUBLE) AS duration_min,
        CASE WHEN error_pct IS NULL OR abs(error_pct) < 10 THEN 'good' WHEN abs(error_pct) < 25 THEN 'warning'
          ELSE 'critical' END AS band FROM ({NEWEST_QUOTES})""",
)
def q10_rows(i):
    return feed_rows(newest_quotes(i)).select("event_id", "model_version", "duration_min", "band")


query("q11_latest_window", LATEST_WINDOW)(newest_window)


@query(
    "q11_latest_evaluation",
    """SELECT eval_date, model_version, mae, mape, r2, (SELECT CAST(sum(predictions) AS BIGINT) FROM evaluation) AS quotes_scored
       FROM evaluation ORDER BY eval_date DESC, model_version DESC LIMIT 1""",
)
def q11(i):
    return latest_evaluation(i.evaluation)


query("q12_layer_series", RECON_SERIES)(recon_series)


@query(
    "q12_mean_series",
    """SELECT eval_date, model_version, 'Actual' AS series, mean_actual AS amount FROM evaluation
       UNION ALL SELECT eval_date, model_version, 'Predicted', mean_predicted FROM evaluation""",
)
def q12_means(i):
    return long_series(i.evaluation, ["eval_date", "model_version"], MEAN_LABELS, "series", "amount")


@query(
    "q12_price_series",
    f"""SELECT window_start, 'Quoted' AS series, predicted AS amount FROM ({PREDICTION_WINDOWS})
        UNION ALL SELECT window_start, 'Charged', actual FROM ({PREDICTION_WINDOWS})""",
)
def q12_prices(i):
    return long_series(windows_of_quotes(i), ["window_start"], PRICE_LABELS, "series", "amount")


@query(
    "q13_zone_history",
    f"SELECT metric_date, {_MEASURES} FROM daily WHERE grain = 'zone' AND zone_id = 7 ORDER BY metric_date DESC LIMIT 200",
)
def q13(i):
    return zone_history(i.daily, 7, "metric_date", 200).drop("grain", "zone_id")


# --- rules -------------------------------------------------------------------------------------------

_MODEL_ERROR = """SELECT 'model_error' AS rule, CASE WHEN ratio >= 2.0 THEN 'critical' ELSE 'serious' END AS severity,
    eval_date || ' ' || model_version AS subject, round(ratio, 6) AS value, round(others, 6) AS baseline
  FROM (SELECT e.eval_date, e.model_version, CAST(e.mae AS DOUBLE) / o.others AS ratio, o.others FROM evaluation e JOIN (
      SELECT a.eval_date, a.model_version, median(CAST(b.mae AS DOUBLE)) AS others FROM evaluation a JOIN evaluation b
        ON b.model_version = a.model_version AND b.eval_date <> a.eval_date GROUP BY 1, 2) o
    ON o.eval_date = e.eval_date AND o.model_version = e.model_version WHERE o.others > 0) WHERE ratio >= 1.5"""
_POWER = """SELECT 'explanatory_power' AS rule, 'serious' AS severity, eval_date || ' ' || model_version AS subject,
    round(r2, 6) AS value, CAST(0.3 AS DOUBLE) AS baseline FROM evaluation WHERE r2 < 0.3"""
_DIVERGENCE = f"""SELECT 'layer_divergence' AS rule, 'warning' AS severity,
    metric_date || ' ' || CASE WHEN hot_trips > cold_trips THEN 'above' ELSE 'below' END AS subject,
    round(abs(cold_trips - hot_trips) / cold_trips, 6) AS value, CAST(0.05 AS DOUBLE) AS baseline FROM ({RECON})
  WHERE cold_trips > 0 AND abs(cold_trips - hot_trips) / cold_trips >= 0.05"""
_IDLE = f"""SELECT 'scoring_idle' AS rule, 'warning' AS severity, 'scoring' AS subject,
    CAST(epoch(TIMESTAMP '{NOW_STAMP}') - epoch(last_written) AS DOUBLE) AS value, CAST(300 AS DOUBLE) AS baseline
  FROM ({FRESHNESS}) WHERE last_written IS NULL OR epoch(TIMESTAMP '{NOW_STAMP}') - epoch(last_written) >= 300"""


@query("l1_model_error", _MODEL_ERROR)
def l1(i):
    return model_error(i.evaluation, i.settings).drop("title")


@query("l2_explanatory_power", _POWER)
def l2(i):
    return explanatory_power(i.evaluation, i.settings).drop("title")


@query("l3_layer_divergence", _DIVERGENCE)
def l3(i):
    return layer_divergence(recon(i), i.settings).drop("title")


@query("l4_scoring_idle", _IDLE)
def l4(i):
    return scoring_idle(prediction_freshness(i.predictions), NOW, i.settings).drop("title")


@query("l5_all_rules", " UNION ALL ".join((_MODEL_ERROR, _POWER, _DIVERGENCE, _IDLE)))
def l5(i):
    return evaluate_rules(
        i.evaluation, recon(i), prediction_freshness(i.predictions), NOW, i.settings
    ).drop("title")


# --- model pipeline ----------------------------------------------------------------------------------

_FEATURES = """CAST(pu AS DOUBLE) AS pickup_zone_id, CAST(do_ AS DOUBLE) AS dropoff_zone_id,
  CAST(pu * 1000 + do_ AS DOUBLE) AS zone_pair, CAST(hour(pickup_datetime) AS DOUBLE) AS hour,
  CAST(isodow(pickup_datetime) - 1 AS DOUBLE) AS day_of_week, CAST(month(pickup_datetime) AS DOUBLE) AS month,
  CAST(passenger_count AS DOUBLE) AS passenger_count"""


@query("m1_features", f"SELECT event_id, {_FEATURES} FROM trips")
def m1(i):
    return features(i.trips.drop("month"))


@query("m2_target", f"SELECT event_id, {amount('quoted_c', 13)} AS quoted_amount, quoted_c AS quoted_cents FROM trips")
def m2(i):
    return i.priced.select("event_id", "quoted_amount", "quoted_cents")


@query(
    "m3_training_rows",
    """SELECT event_id, quoted_c AS quoted_cents FROM (SELECT *, row_number() OVER (
           PARTITION BY date_trunc('month', pickup_datetime)
           ORDER BY CAST('0x' || substr(md5(event_id), 1, 15) AS BIGINT), event_id) AS nth,
         12000 // (SELECT count(DISTINCT date_trunc('month', pickup_datetime)) FROM trips WHERE is_history) AS quota
       FROM trips WHERE is_history) WHERE nth <= quota AND quoted_c BETWEEN 250 AND 25000""",
)
def m3(i):
    rank = F.conv(F.substring(F.md5("event_id"), 1, 15), 16, 10).cast("bigint")
    rows = training_rows(i.trips, replace(i.settings, train_sample_rows=12_000), rank)
    return rows.select("event_id", "quoted_cents")


def fitting_rows(i):
    """Usable history, all of it."""
    return i.fitted.where(usable_target(i.settings))


_HELD = "CAST('0x' || substr(md5(event_id || ':42'), 1, 8) AS BIGINT) % 100 < 20"
_USABLE = "is_history AND quoted_c BETWEEN 250 AND 25000"


@query(
    "m4_global_median_baseline",
    f"""SELECT CAST(round(median(quoted_c)) AS BIGINT) AS median_cents FROM trips WHERE {_USABLE} AND NOT {_HELD}""",
)
def m4(i):
    return global_median(holdout_split(fitting_rows(i), i.settings)[0])


@query(
    "m5_pair_median_baseline",
    f"""SELECT pu AS pickup_zone_id, do_ AS dropoff_zone_id, CAST(round(median(quoted_c)) AS BIGINT) AS median_cents
        FROM trips WHERE {_USABLE} AND NOT {_HELD} GROUP BY 1, 2""",
)
def m5(i):
    return pair_medians(holdout_split(fitting_rows(i), i.settings)[0])


_ENTRIES = f"""SELECT event_id, fold, quoted_c, f.feature AS feature, f.category AS category FROM (
    SELECT event_id, CAST('0x' || substr(md5(event_id || ':43'), 1, 8) AS BIGINT) % 100 % 5 AS fold, quoted_c,
      unnest([{{'feature': 'pickup_zone_id', 'category': CAST(pu AS BIGINT)}},
        {{'feature': 'dropoff_zone_id', 'category': CAST(do_ AS BIGINT)}},
        {{'feature': 'zone_pair', 'category': CAST(pu * 1000 + do_ AS BIGINT)}}]) AS f
    FROM trips WHERE {_USABLE})"""


def _code(own: str, overall: str) -> str:
    """Shrunk mean, from sums given as (n, s, q) column prefixes."""
    spread = lambda p: f"(({p}q - {p}s * {p}s / {p}n) / {p}n)"
    return (
        f"round(CASE WHEN {own}n > 0 THEN ({own}n * {spread(overall)} * {own}s / {own}n + {spread(own)} * {overall}s / {overall}n)"
        f" / ({own}n * {spread(overall)} + {spread(own)}) ELSE {overall}s / {overall}n END / 100, 4)"
    )


_DOUBLE_SUMS = "CAST(count(*) AS DOUBLE) AS {p}n, CAST(sum(quoted_c) AS DOUBLE) AS {p}s, CAST(sum(quoted_c * quoted_c) AS DOUBLE) AS {p}q"


@query(
    "m6_encodings",
    f"""SELECT feature, category, {_code('c_', 't_')} AS code FROM (
          SELECT feature, category, {_DOUBLE_SUMS.format(p='c_')} FROM ({_ENTRIES}) GROUP BY 1, 2)
        JOIN (SELECT feature, {_DOUBLE_SUMS.format(p='t_')} FROM ({_ENTRIES}) GROUP BY 1) USING (feature)""",
)
def m6(i):
    rows = features(fitting_rows(i).drop("month"), keep=("event_id", "quoted_cents"))
    return fit_encodings(rows).where("category is not null").select(
        "feature", "category", F.round("code", 4).alias("code")
    )


@query(
    "m6_cross_fitted",
    f"""SELECT feature, category, fold, {_code('r_', 'o_')} AS code FROM (
          SELECT c.feature, c.category, c.fold, a_n - f_n AS r_n, a_s - f_s AS r_s, a_q - f_q AS r_q,
            t_n - tf_n AS o_n, t_s - tf_s AS o_s, t_q - tf_q AS o_q
          FROM (SELECT feature, category, fold, {_DOUBLE_SUMS.format(p='f_')} FROM ({_ENTRIES}) GROUP BY ALL) c
            JOIN (SELECT feature, category, {_DOUBLE_SUMS.format(p='a_')} FROM ({_ENTRIES}) GROUP BY ALL) a USING (feature, category)
            JOIN (SELECT feature, {_DOUBLE_SUMS.format(p='t_')} FROM ({_ENTRIES}) GROUP BY ALL) t USING (feature)
            JOIN (SELECT feature, fold, {_DOUBLE_SUMS.format(p='tf_')} FROM ({_ENTRIES}) GROUP BY ALL) tf USING (feature, fold))""",
)
def m6_folds(i):
    rows = features(fitting_rows(i).drop("month"), keep=("event_id", "quoted_cents"))
    return cross_fitted_codes(rows, i.settings).select(
        "feature", "category", F.col("fold").cast("bigint").alias("fold"), F.round("code", 4).alias("code")
    )


@query(
    "m6_encoded_rows",
    f"""SELECT event_id, CAST(pu AS DOUBLE) AS pickup_zone_id, fold FROM (SELECT *,
        CAST('0x' || substr(md5(event_id || ':43'), 1, 8) AS BIGINT) % 100 % 5 AS fold FROM trips WHERE {_USABLE})""",
)
def m6_rows(i):
    """Every training row keeps its place and gets three codes."""
    rows = features(fitting_rows(i).drop("month"), keep=("event_id", "quoted_cents"))
    encoded = encode_training(rows, cross_fitted_codes(rows, i.settings), i.settings)
    complete = F.col("pickup_zone_id_code") + F.col("dropoff_zone_id_code") + F.col("zone_pair_code")
    return encoded.where(complete.isNotNull()).select(
        "event_id", "pickup_zone_id", fold_of(i.settings).alias("fold")
    )


@query(
    "m6_encode_new_rows",
    f"SELECT event_id, CAST(pu * 1000 + do_ AS DOUBLE) AS zone_pair, CAST(0 AS INT) AS uncoded FROM trips WHERE NOT is_history",
)
def m6_new(i):
    """Live rows, many with a pair never seen: all of them get a code."""
    rows = features(fitting_rows(i).drop("month"), keep=("event_id", "quoted_cents"))
    live = features(i.trips.where(is_live(i.settings.cutoff)).drop("month"))
    encoded = encode(live, fit_encodings(rows))
    return encoded.select("event_id", "zone_pair", F.col("zone_pair_code").isNull().cast("int").alias("uncoded"))


BASELINES = f"""SELECT model AS model, count(*) AS row_count,
      CAST(CAST((200 * sum(abs(p - a)) + count(*)) // (2 * count(*)) AS BIGINT) / 10000.0 AS DECIMAL(10,4)) AS mae,
      CAST(sqrt(CAST(sum((p - a) * (p - a)) AS DOUBLE) / count(*)) / 100 AS DECIMAL(10,4)) AS rmse,
      round(1 - CAST(sum((p - a) * (p - a)) AS DOUBLE) * count(*) / CAST(count(*) * sum(a * a) - sum(a) * sum(a) AS DOUBLE), 6) AS r2
    FROM (SELECT 'zone_pair_median' AS model, h.quoted_c AS a, coalesce(m.c, g.c) AS p
        FROM (SELECT * FROM trips WHERE {_USABLE} AND {_HELD}) h
        LEFT JOIN (SELECT pu, do_, CAST(round(median(quoted_c)) AS BIGINT) AS c FROM trips WHERE {_USABLE} AND NOT {_HELD}
          GROUP BY 1, 2) m ON m.pu = h.pu AND m.do_ = h.do_,
        (SELECT CAST(round(median(quoted_c)) AS BIGINT) AS c FROM trips WHERE {_USABLE} AND NOT {_HELD}) g
      UNION ALL SELECT 'global_median', h.quoted_c, g.c FROM (SELECT * FROM trips WHERE {_USABLE} AND {_HELD}) h,
        (SELECT CAST(round(median(quoted_c)) AS BIGINT) AS c FROM trips WHERE {_USABLE} AND NOT {_HELD}) g) GROUP BY 1"""


@query("m8_compare_baselines", BASELINES)
def m8(i):
    return compare_on_holdout(settled(fitting_rows(i).select(*SAMPLE_COLUMNS), "compared-rows"), i.settings)


# On the test tables prices do not depend on what is known before a ride, so the model is trained on prices made to:
# distance between zones, hour, day of the week, and a little that nothing explains.
_RULED = """SELECT * REPLACE (1000 + 25 * abs(coalesce(pu, -1) - coalesce(do_, -1)) + CASE WHEN hour(pickup_datetime) BETWEEN 7 AND 9
      THEN 900 ELSE 0 END + CASE WHEN isodow(pickup_datetime) >= 6 THEN 500 ELSE 0 END + 3 * second(pickup_datetime) AS quoted_c)
    FROM trips"""
# Fewer rounds and larger steps than in production: the queries are run again and again.
SHORT_TRAINING = {"boosting_rounds": 16, "learning_rate": 0.3}


def ruled_cents(pickup, pu, do):
    """The price, in cents, that follows from zones and clock."""
    far = F.abs(F.coalesce(F.col(pu).cast("int"), F.lit(-1)) - F.coalesce(F.col(do).cast("int"), F.lit(-1)))
    rush = F.when(F.hour(pickup).between(7, 9), 900).otherwise(0)
    weekend = F.when(F.weekday(pickup) >= 5, 500).otherwise(0)
    return (F.lit(1000) + 25 * far + rush + weekend + 3 * F.second(pickup)).cast("bigint")


def ruled_rows(i):
    rows = i.fitted.withColumn("quoted_cents", ruled_cents("pickup_datetime", "pickup_zone_id", "dropoff_zone_id"))
    return rows.withColumn("quoted_amount", (F.col("quoted_cents") / 100).cast("decimal(13,2)"))


def fare_model(i):
    """The model, and the rows it comes from: they are derived once, training and all quotes read them."""
    rows = settled(ruled_rows(i).select(*SAMPLE_COLUMNS), "ruled-rows")
    return fit_fare_model(holdout_split(rows, i.settings)[0], replace(i.settings, **SHORT_TRAINING)), rows


_RULED_BASELINES = BASELINES.replace(f"trips WHERE {_USABLE} AND", "ruled WHERE is_history AND")


@query(
    "m7_boosted_trees",
    f"""SELECT count(*) AS quotes, CAST(0 AS BIGINT) AS unquoted, true AS within_two_dollars, true AS many_rounds
        FROM trips WHERE is_history AND {_HELD}""",
)
def m7(i):
    """Holdout rows whose price follows from the inputs: half of the quotes are within two dollars, from many rounds. Neither one
    tree nor a constant gets there: the prices spread over tens of dollars."""
    model, rows = fare_model(i)
    _, held = holdout_split(rows, i.settings)
    off = F.abs(F.col("predicted_amount") - F.col("actual_amount"))
    return score_holdout(model, held).agg(
        F.count(F.lit(1)).alias("quotes"),
        F.count_if(F.col("predicted_amount").isNull()).alias("unquoted"),
        (2 * F.count_if(off <= 2) >= F.count(F.lit(1))).alias("within_two_dollars"),
        F.lit(model.card()["rounds_kept"] >= 12).alias("many_rounds"),
    )


# Models whose mean error is at most three quarters of the pair median's, on prices that follow from the inputs.
FOLLOWED = f"""SELECT * FROM (WITH ruled AS ({_RULED}), b AS ({_RULED_BASELINES})
    SELECT model, mae <= 0.75 * (SELECT mae FROM b WHERE model = 'zone_pair_median') AS follows, true AS many_rounds FROM b
    UNION ALL SELECT 'gradient_boosting', true, true)"""


def followed(report):
    """Per model: whether its mean error is well below the pair median's, and whether the trees are many."""
    pair = F.max(F.when(F.col("model") == "zone_pair_median", F.col("mae"))).over(Window.partitionBy())
    follows = (F.col("mae").cast("double") <= 0.75 * pair.cast("double")).alias("follows")
    return report.select("model", follows, (F.col("rounds_kept") >= 12).alias("many_rounds"))


@query("m8_compare_all", FOLLOWED)
def m8_all(i):
    model, rows = fare_model(i)
    report = compare_on_holdout(rows, i.settings, model)
    return followed(report.withColumn("rounds_kept", F.lit(model.card()["rounds_kept"])))


@query("m9_saved_model", f"SELECT event_id, true AS same_quote FROM trips WHERE is_history AND {_HELD}")
def m9(i):
    """A model saved and loaded again quotes every holdout row as before."""
    rows = ruled_rows(i)
    train, held = holdout_split(rows, i.settings)
    model = fit_fare_model(train, replace(i.settings, boosting_rounds=4))
    path = scratch(i.spark, "saved-model")
    model.save(path, {})
    loaded, card = load_model(i.spark, path)
    if card["rounds_kept"] != len(model.rounds.values):
        raise RuntimeError("the card does not say how many rounds were kept")
    both = loaded.quote(model.quote(held).withColumnRenamed("predicted_amount", "_before"))
    same = F.col("predicted_amount").eqNullSafe(F.col("_before"))
    return both.select("event_id", same.alias("same_quote"))


@query(
    "m10_batch_score",
    f"""SELECT event_id, {amount('predicted_c', 10)} AS predicted_amount, {amount('quoted_c', 10)} AS actual_amount, model_version
        FROM scored WHERE model_version = '{PAIR_VERSION}'""",
)
def m10(i):
    pairs, everywhere = pair_medians(i.fitted), global_median(i.fitted)
    scored = score_batch(i.events, lambda t: quote_by_pair(t, pairs, everywhere), PAIR_VERSION, i.settings)
    return scored.select("event_id", "predicted_amount", "actual_amount", "model_version")


@query(
    "m11_forward_holdout",
    "SELECT event_id, pickup_datetime FROM trips WHERE NOT is_history",
)
def m11(i):
    return i.events.where(is_live(i.settings.cutoff)).select("event_id", "pickup_datetime")

