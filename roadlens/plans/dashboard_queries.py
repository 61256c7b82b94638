"""Dashboard, alert and derived-measure queries over the device inventory."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadlens import fixed_values as fv
from roadlens.functions import derive as D
from roadlens.operators import report as R
from roadlens.plans.registry import register, with_views
from roadlens.sources import tables as T

KEY = ["record_id", "src_orderkey", "src_partkey", "src_suppkey", "priority_ranking"]
KEY_SQL = ", ".join(KEY)
TF = repr(D.time_factor())


def _mult_sql(col="road_type"):
    whens = " ".join(f"WHEN {col} = '{k}' THEN CAST({m!r} AS DOUBLE)" for k, m in fv.ROAD_MULTIPLIER.items())
    return f"(CASE {whens} ELSE CAST({fv.DEFAULT_MULTIPLIER!r} AS DOUBLE) END)"


def _scored(df):
    return df.withColumns(D.scoring_columns())


SCORE_SQL = ("CASE WHEN coalesce(average_speed > posted_speed_limit * CAST(1.2 AS DOUBLE), false) "
             "THEN CAST(0.1 AS DOUBLE) ELSE CAST(0.3 AS DOUBLE) END")


@register("road_profile", ("A4", "P6", "F20", "F23"), with_views(f"""
SELECT road_type,
  round(avg(volume_vpd), 2) AS volume_mean,
  round(stddev_samp(volume_vpd), 2) AS volume_std,
  min(volume_vpd) AS volume_min, max(volume_vpd) AS volume_max,
  round(avg(average_speed), 2) AS speed_mean,
  round(stddev_samp(average_speed), 2) AS speed_std,
  CAST(sum(CAST(coalesce(average_speed > posted_speed_limit * CAST(1.1 AS DOUBLE), false) AS INT)) AS BIGINT) AS speed_violations,
  CAST(sum(CAST(({SCORE_SQL}) < CAST(0.2 AS DOUBLE) AS INT)) AS BIGINT) AS anomalies
FROM devices WHERE road_type IS NOT NULL GROUP BY road_type
""", "devices"))
def q_road_profile(spark, sf):
    return R.road_profile(_scored(T.devices(spark, sf)))


@register("speed_violation_110", ("P6",), with_views(f"""
SELECT {KEY_SQL}, average_speed, posted_speed_limit,
  coalesce(average_speed > posted_speed_limit * CAST(1.1 AS DOUBLE), false) AS speed_violation
FROM devices
""", "devices"))
def q_speed_violation_110(spark, sf):
    d = T.devices(spark, sf)
    return R.speed_violations(d, fv.VIOLATION_FACTOR_DASHBOARD).select(
        *KEY, "average_speed", "posted_speed_limit", "speed_violation")


@register("speed_violation_120", ("P7",), with_views(f"""
SELECT {KEY_SQL}, average_speed, posted_speed_limit,
  coalesce(average_speed > posted_speed_limit * CAST(1.2 AS DOUBLE), false) AS speed_violation
FROM devices
""", "devices"))
def q_speed_violation_120(spark, sf):
    d = T.devices(spark, sf)
    return R.speed_violations(d, fv.VIOLATION_FACTOR_ALERT).select(
        *KEY, "average_speed", "posted_speed_limit", "speed_violation")


def _vol_anomaly_sql(k):
    return with_views(f"""
SELECT {KEY_SQL}, volume_vpd, m.mean_volume
FROM devices CROSS JOIN (SELECT avg(volume_vpd) AS mean_volume FROM devices) m
WHERE volume_vpd > m.mean_volume * CAST({k!r} AS DOUBLE)
""", "devices")


@register("volume_anomaly_mean_2x", ("P8", "J6"), _vol_anomaly_sql(fv.VOLUME_ANOMALY_K_SIMPLE))
def q_volume_anomaly_2x(spark, sf):
    return R.volume_anomalies(T.devices(spark, sf), fv.VOLUME_ANOMALY_K_SIMPLE).select(
        *KEY, "volume_vpd", "mean_volume")


@register("volume_anomaly_mean_150", ("P8", "J6"), _vol_anomaly_sql(fv.VOLUME_ANOMALY_K_DASHBOARD))
def q_volume_anomaly_150(spark, sf):
    return R.volume_anomalies(T.devices(spark, sf), fv.VOLUME_ANOMALY_K_DASHBOARD).select(
        *KEY, "volume_vpd", "mean_volume")


@register("alerts_union", ("U1", "F13", "F14", "P7", "P8"), with_views("""
WITH m AS (SELECT avg(volume_vpd) AS mean_volume FROM devices)
SELECT record_id, street_name || ' & ' || intersection1 AS location,
  'Speed Violation' AS alert_type, 'High' AS severity,
  'Speed ' || CAST(average_speed AS VARCHAR) || ' km/h exceeds limit ' || CAST(posted_speed_limit AS VARCHAR) || ' km/h' AS details
FROM devices WHERE average_speed > posted_speed_limit * CAST(1.2 AS DOUBLE)
UNION ALL
SELECT record_id, street_name || ' & ' || intersection1 AS location,
  'Volume Anomaly' AS alert_type, 'Medium' AS severity,
  'Volume ' || CAST(volume_vpd AS VARCHAR) || ' vpd is unusually high' AS details
FROM devices CROSS JOIN m WHERE volume_vpd > m.mean_volume * CAST(2.0 AS DOUBLE)
""", "devices"))
def q_alerts_union(spark, sf):
    return R.alerts(T.devices(spark, sf), fv.VOLUME_ANOMALY_K_SIMPLE)


@register("congestion_ratio", ("F20", "F21"), with_views(f"""
SELECT {KEY_SQL},
  CASE WHEN posted_speed_limit = 0 THEN NULL ELSE CAST(average_speed AS DOUBLE) / CAST(posted_speed_limit AS DOUBLE) END AS speed_compliance,
  CASE WHEN CAST(average_speed AS DOUBLE) / CAST(posted_speed_limit AS DOUBLE) < CAST(0.8 AS DOUBLE) THEN 'High'
       WHEN CAST(average_speed AS DOUBLE) / CAST(posted_speed_limit AS DOUBLE) < CAST(1.0 AS DOUBLE) THEN 'Medium'
       ELSE 'Low' END AS congestion_level
FROM devices
""", "devices"))
def q_congestion_ratio(spark, sf):
    return R.with_congestion_ratio(T.devices(spark, sf)).select(*KEY, "speed_compliance", "congestion_level")


@register("congestion_speed", ("F22",), with_views(f"""
SELECT {KEY_SQL},
  CASE WHEN average_speed < posted_speed_limit * CAST(0.7 AS DOUBLE) THEN 'High'
       WHEN average_speed < posted_speed_limit * CAST(0.9 AS DOUBLE) THEN 'Medium'
       ELSE 'Low' END AS congestion_level
FROM devices
""", "devices"))
def q_congestion_speed(spark, sf):
    d = T.devices(spark, sf)
    return d.select(*KEY, D.congestion_by_speed().alias("congestion_level"))


@register("volume_bucket", ("F23",), with_views(f"""
SELECT {KEY_SQL}, volume_vpd,
  CASE WHEN volume_vpd > 0 AND volume_vpd <= 1000 THEN 'Low'
       WHEN volume_vpd > 1000 AND volume_vpd <= 3000 THEN 'Medium'
       WHEN volume_vpd > 3000 AND volume_vpd <= 5000 THEN 'High'
       WHEN volume_vpd > 5000 THEN 'Very High' END AS volume_category
FROM devices
""", "devices"))
def q_volume_bucket(spark, sf):
    d = T.devices(spark, sf)
    return d.select(*KEY, "volume_vpd", D.volume_category().alias("volume_category"))


HEURISTIC_SQL = f"CAST(trunc(CAST(volume_vpd AS DOUBLE) * {_mult_sql()} * CAST({TF} AS DOUBLE)) AS BIGINT)"


@register("heuristic_prediction", ("F24", "J7", "F13"), with_views(f"""
SELECT {KEY_SQL}, street_name || ' & ' || intersection1 AS location,
  volume_vpd AS current_volume, {HEURISTIC_SQL} AS predicted_volume,
  CAST({fv.HEURISTIC_CONFIDENCE!r} AS DOUBLE) AS confidence
FROM devices
""", "devices"))
def q_heuristic_prediction(spark, sf):
    d = T.devices(spark, sf)
    return d.select(*KEY, F.concat_ws(" & ", "street_name", "intersection1").alias("location"),
                    F.col("volume_vpd").alias("current_volume"),
                    D.heuristic_volume().alias("predicted_volume"),
                    F.lit(fv.HEURISTIC_CONFIDENCE).alias("confidence"))


CHANGE_RAW_SQL = (f"(CAST({HEURISTIC_SQL} - volume_vpd AS DOUBLE) / "
                  f"CASE WHEN volume_vpd = 0 THEN NULL ELSE CAST(volume_vpd AS DOUBLE) END * CAST(100.0 AS DOUBLE))")


@register("change_percent", ("F25", "F24"), with_views(f"""
SELECT {KEY_SQL}, volume_vpd, {HEURISTIC_SQL} AS predicted_volume,
  round({CHANGE_RAW_SQL}, 1) AS change_percent
FROM devices
""", "devices"))
def q_change_percent(spark, sf):
    d = T.devices(spark, sf).withColumn("predicted_volume", D.heuristic_volume())
    return d.select(*KEY, "volume_vpd", "predicted_volume",
                    D.change_percent("predicted_volume", "volume_vpd").alias("change_percent"))


@register("request_scoring", ("F26",), with_views(f"""
SELECT {KEY_SQL},
  CAST(volume_vpd AS DOUBLE) * CAST(1.1 AS DOUBLE) AS predicted_volume,
  CAST(0.85 AS DOUBLE) AS confidence,
  {SCORE_SQL} AS anomaly_score,
  ({SCORE_SQL}) < CAST(0.2 AS DOUBLE) AS is_anomaly
FROM devices
""", "devices"))
def q_request_scoring(spark, sf):
    return _scored(T.devices(spark, sf)).select(*KEY, "predicted_volume", "confidence",
                                                 "anomaly_score", "is_anomaly")


@register("row_quality", ("F27",), with_views(f"""
SELECT {KEY_SQL},
  greatest(CAST(0.0 AS DOUBLE), least(CAST(1.0 AS DOUBLE),
    CAST(1.0 AS DOUBLE)
    - CAST(CAST(coalesce(record_id = '', true) AS INT) + CAST(coalesce(street_name = '', true) AS INT)
         + CAST(coalesce(volume_vpd = 0, true) AS INT) + CAST(coalesce(average_speed = 0, true) AS INT) AS DOUBLE) * CAST(0.2 AS DOUBLE)
    - CAST(CAST(coalesce(volume_vpd < 0, false) AS INT) + CAST(coalesce(average_speed < 0, false) AS INT)
         + CAST(coalesce(posted_speed_limit < 0, false) AS INT) AS DOUBLE) * CAST(0.1 AS DOUBLE))) AS data_quality_score
FROM devices
""", "devices"))
def q_row_quality(spark, sf):
    d = T.devices(spark, sf)
    return d.select(*KEY, D.row_quality_score().alias("data_quality_score"))


@register("overview", ("A1", "F21", "U1", "F14"), with_views("""
WITH m AS (SELECT avg(volume_vpd) AS mean_volume FROM devices),
a AS (
  SELECT count(*) AS total_locations, avg(volume_vpd) AS av, avg(average_speed) AS asp,
    sum(CASE WHEN CAST(average_speed AS DOUBLE) / CAST(posted_speed_limit AS DOUBLE) < CAST(0.8 AS DOUBLE) THEN 1 ELSE 0 END) AS n_high,
    sum(CAST(coalesce(average_speed > posted_speed_limit * CAST(1.2 AS DOUBLE), false) AS INT)
      + CAST(coalesce(volume_vpd > m.mean_volume * CAST(2.0 AS DOUBLE), false) AS INT)) AS n_alerts
  FROM devices CROSS JOIN m)
SELECT total_locations, CAST(trunc(av) AS BIGINT) AS average_volume, round(asp, 1) AS average_speed,
  CAST(round(n_high * CAST(100.0 AS DOUBLE) / total_locations, 1) AS VARCHAR) || '%' AS congestion_level,
  CAST(n_alerts AS BIGINT) AS anomalies_detected
FROM a
""", "devices"))
def q_overview(spark, sf):
    return R.overview(T.devices(spark, sf))


KPI_FILTER = dict(road_type="Arterial", status="All", volume_range=(500, 8000))


@register("kpi_cards", ("A2", "P5", "P6"), with_views("""
WITH f AS (SELECT *, ({score}) < CAST(0.2 AS DOUBLE) AS is_anomaly FROM devices
           WHERE road_type = 'Arterial' AND volume_vpd BETWEEN 500 AND 8000),
t AS (SELECT count(*) AS n_all FROM devices)
SELECT count(*) AS total_locations, count(*) - max(t.n_all) AS delta_from_original,
  round(avg(volume_vpd), 0) AS average_volume, round(stddev_samp(volume_vpd), 0) AS volume_std,
  CAST(coalesce(sum(CAST(coalesce(average_speed > posted_speed_limit * CAST(1.1 AS DOUBLE), false) AS INT)), 0) AS BIGINT) AS speed_violations,
  round(avg(CAST(CAST(coalesce(average_speed > posted_speed_limit * CAST(1.1 AS DOUBLE), false) AS INT) AS DOUBLE)) * 100, 1) AS violation_pct,
  CAST(coalesce(sum(CAST(is_anomaly AS INT)), 0) AS BIGINT) AS anomalies,
  round(avg(CAST(CAST(is_anomaly AS INT) AS DOUBLE)) * 100, 1) AS anomaly_pct
FROM f CROSS JOIN t
""".format(score=SCORE_SQL), "devices"))
def q_kpi_cards(spark, sf):
    return R.kpi_cards(_scored(T.devices(spark, sf)), **KPI_FILTER)


@register("kpi_cards_plain", ("A2", "P6", "P11"), with_views("""
SELECT count(*) AS total_locations, CAST(0 AS BIGINT) AS delta_from_original,
  round(avg(volume_vpd), 0) AS average_volume, round(stddev_samp(volume_vpd), 0) AS volume_std,
  CAST(coalesce(sum(CAST(coalesce(average_speed > posted_speed_limit * CAST(1.1 AS DOUBLE), false) AS INT)), 0) AS BIGINT) AS speed_violations,
  round(avg(CAST(CAST(coalesce(average_speed > posted_speed_limit * CAST(1.1 AS DOUBLE), false) AS INT) AS DOUBLE)) * 100, 1) AS violation_pct,
  CAST(0 AS BIGINT) AS anomalies, CAST(0 AS DOUBLE) AS anomaly_pct
FROM devices
""", "devices"))
def q_kpi_cards_plain(spark, sf):
    """Without a model no row has a flag: the column is added with its default."""
    return R.kpi_cards(T.devices(spark, sf))


@register("filter_range", ("P5",), with_views(f"""
SELECT {KEY_SQL}, road_type, status, volume_vpd FROM devices
WHERE road_type = 'Collector' AND status = 'Completed' AND volume_vpd BETWEEN 1000 AND 5000
""", "devices"))
def q_filter_range(spark, sf):
    d = T.devices(spark, sf)
    return R.apply_filters(d, road_type="Collector", status="Completed",
                           volume_range=(1000, 5000)).select(*KEY, "road_type", "status", "volume_vpd")


@register("anomaly_summary", ("A3", "F26"), with_views(f"""
WITH s AS (SELECT road_type, {SCORE_SQL} AS anomaly_score FROM devices WHERE road_type IS NOT NULL),
g AS (SELECT road_type, count(*) AS total_locations,
        CAST(sum(CAST(anomaly_score < CAST(0.2 AS DOUBLE) AS INT)) AS BIGINT) AS anomalies,
        avg(anomaly_score) AS sc FROM s GROUP BY road_type)
SELECT road_type, total_locations, anomalies, round(sc, 3) AS avg_anomaly_score,
  round(anomalies * CAST(100.0 AS DOUBLE) / total_locations, 1) AS anomaly_rate
FROM g
""", "devices"))
def q_anomaly_summary(spark, sf):
    return R.anomaly_summary(_scored(T.devices(spark, sf)))


@register("cost_by_class", ("A5", "P9"), with_views("""
WITH g AS (SELECT road_type, sum(CAST(estimated_cost AS DECIMAL(18,2))) AS s, count(*) AS cost_count
           FROM devices WHERE estimated_cost > 0 AND road_type IS NOT NULL GROUP BY road_type)
SELECT road_type, round(CAST(s AS DOUBLE), 0) AS cost_sum,
  round(CAST(s AS DOUBLE) / cost_count, 0) AS cost_mean, cost_count
FROM g
""", "devices"))
def q_cost_by_class(spark, sf):
    return R.cost_by_class(T.devices(spark, sf))


@register("cost_share", ("A6", "P9"), with_views("""
WITH g AS (SELECT road_type, CAST(sum(CAST(estimated_cost AS DECIMAL(18,2))) AS DOUBLE) AS cost_total
           FROM devices WHERE estimated_cost > 0 AND road_type IS NOT NULL GROUP BY road_type),
t AS (SELECT sum(cost_total) AS al FROM g)
SELECT road_type, cost_total, cost_total / t.al AS cost_share FROM g CROSS JOIN t
""", "devices"))
def q_cost_share(spark, sf):
    return R.cost_share(T.devices(spark, sf))


@register("volume_pivot", ("A7", "F13"), with_views("""
SELECT street_name || ' & ' || intersection1 AS location,
  coalesce(avg(CASE WHEN road_type = 'Residential' THEN volume_vpd END), 0.0) AS Residential,
  coalesce(avg(CASE WHEN road_type = 'Collector' THEN volume_vpd END), 0.0) AS Collector,
  coalesce(avg(CASE WHEN road_type = 'Arterial' THEN volume_vpd END), 0.0) AS Arterial,
  coalesce(avg(CASE WHEN road_type = 'Highway' THEN volume_vpd END), 0.0) AS Highway
FROM devices WHERE volume_vpd IS NOT NULL AND road_type IS NOT NULL
GROUP BY street_name || ' & ' || intersection1
""", "devices"))
def q_volume_pivot(spark, sf):
    return R.volume_pivot(T.devices(spark, sf))


@register("status_counts", ("A8",), with_views("""
SELECT status, count(*) AS count FROM devices WHERE status IS NOT NULL GROUP BY status
""", "devices"))
def q_status_counts(spark, sf):
    return R.value_counts(T.devices(spark, sf), "status")


@register("histogram", ("A9",), with_views("""
WITH r AS (SELECT CAST(min(volume_vpd) AS DOUBLE) AS lo, CAST(max(volume_vpd) AS DOUBLE) AS hi FROM devices),
b AS (SELECT road_type, lo, hi,
        CAST(CASE WHEN hi = lo THEN 1
             ELSE least(floor((CAST(volume_vpd AS DOUBLE) - lo) / ((hi - lo) / CAST(20.0 AS DOUBLE))) + 1, 20) END AS BIGINT) AS bin
      FROM devices CROSS JOIN r WHERE volume_vpd IS NOT NULL AND road_type IS NOT NULL)
SELECT road_type, bin, lo + (bin - 1) * (hi - lo) / CAST(20.0 AS DOUBLE) AS bin_start, count(*) AS n
FROM b GROUP BY road_type, bin, lo, hi
""", "devices"))
def q_histogram(spark, sf):
    return R.histogram(T.devices(spark, sf))


@register("box_summary", ("A10",), with_views("""
WITH base AS (SELECT road_type, average_speed AS v FROM devices WHERE average_speed IS NOT NULL AND road_type IS NOT NULL),
q AS (SELECT road_type, min(v) AS min,
        round(quantile_cont(v, 0.25), 6) AS q1, round(quantile_cont(v, 0.5), 6) AS median,
        round(quantile_cont(v, 0.75), 6) AS q3, max(v) AS max
      FROM base GROUP BY road_type),
f AS (SELECT *, q3 - q1 AS iqr, q1 - CAST(1.5 AS DOUBLE) * (q3 - q1) AS lower_fence,
        q3 + CAST(1.5 AS DOUBLE) * (q3 - q1) AS upper_fence FROM q),
w AS (SELECT base.road_type,
        min(CASE WHEN v >= lower_fence AND v <= upper_fence THEN v END) AS lower_whisker,
        max(CASE WHEN v >= lower_fence AND v <= upper_fence THEN v END) AS upper_whisker,
        count(*) FILTER (WHERE NOT (v >= lower_fence AND v <= upper_fence)) AS outliers
      FROM base JOIN f ON base.road_type = f.road_type GROUP BY base.road_type)
SELECT f.road_type, min, q1, median, q3, max, iqr, lower_fence, upper_fence,
  lower_whisker, upper_whisker, outliers
FROM f JOIN w ON f.road_type = w.road_type
""", "devices"))
def q_box_summary(spark, sf):
    return R.box_summary(T.devices(spark, sf))


@register("distinct_bounds", ("A11",), with_views("""
SELECT DISTINCT 'road_type' AS control, road_type AS value FROM devices WHERE road_type IS NOT NULL
UNION ALL
SELECT DISTINCT 'status' AS control, status AS value FROM devices WHERE status IS NOT NULL
UNION ALL
SELECT 'volume_min' AS control, CAST(min(volume_vpd) AS VARCHAR) AS value FROM devices
UNION ALL
SELECT 'volume_max' AS control, CAST(max(volume_vpd) AS VARCHAR) AS value FROM devices
""", "devices"))
def q_distinct_bounds(spark, sf):
    return R.distinct_bounds(T.devices(spark, sf))


@register("top10_change", ("W5", "F25"), with_views(f"""
WITH c AS (SELECT {KEY_SQL}, src_price, volume_vpd, {HEURISTIC_SQL} AS predicted_volume,
             {CHANGE_RAW_SQL} AS raw FROM devices)
SELECT {KEY_SQL}, volume_vpd, predicted_volume, round(raw, 1) AS change_percent
FROM c WHERE raw IS NOT NULL
ORDER BY raw DESC, src_orderkey, priority_ranking, src_partkey, src_suppkey, src_price LIMIT 10
""", "devices"))
def q_top10_change(spark, sf):
    d = (T.devices(spark, sf).withColumn("predicted_volume", D.heuristic_volume())
         .withColumn("raw", D.change_percent_raw("predicted_volume", "volume_vpd"))
         .filter(F.col("raw").isNotNull()))
    top = R.top_k(d, 10, [F.col("raw").desc(), "src_orderkey", "priority_ranking",
                          "src_partkey", "src_suppkey", "src_price"])
    return top.select(*KEY, "volume_vpd", "predicted_volume", F.round("raw", 1).alias("change_percent"))


@register("first_predictions", ("W6", "F24"), with_views(f"""
SELECT {KEY_SQL}, volume_vpd AS current_volume, {HEURISTIC_SQL} AS predicted_volume
FROM devices ORDER BY src_orderkey, priority_ranking, src_partkey, src_suppkey, src_price LIMIT 3
""", "devices"))
def q_first_predictions(spark, sf):
    d = T.devices(spark, sf).withColumn("predicted_volume", D.heuristic_volume())
    top = R.top_k(d, 3, ["src_orderkey", "priority_ranking", "src_partkey", "src_suppkey", "src_price"])
    return top.select(*KEY, F.col("volume_vpd").alias("current_volume"), "predicted_volume")


@register("anomaly_list", ("W4", "P10", "F26"), with_views(f"""
SELECT {KEY_SQL}, street_name, road_type, volume_vpd, average_speed, anomaly_score FROM (
  SELECT *, {SCORE_SQL} AS anomaly_score FROM devices) s
WHERE anomaly_score < CAST(0.2 AS DOUBLE)
""", "devices"))
def q_anomaly_list(spark, sf):
    d = _scored(T.devices(spark, sf)).filter("is_anomaly")
    return d.orderBy("anomaly_score", *KEY).select(
        *KEY, "street_name", "road_type", "volume_vpd", "average_speed", "anomaly_score")
