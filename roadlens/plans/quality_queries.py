"""Data-quality queries over the device inventory (and the event stream)."""

from __future__ import annotations

from roadlens import fixed_values as fv
from roadlens.operators import quality as Q
from roadlens.plans.registry import register, with_views
from roadlens.session import written
from roadlens.sources import tables as T

# Column types of the derived views (as Spark names them).
DEVICE_TYPES = [
    ("record_id", "string"), ("street_name", "string"), ("intersection1", "string"),
    ("intersection2", "string"), ("road_type", "string"), ("status", "string"),
    ("requested_analysis_date", "date"), ("received_analysis_date", "date"),
    ("street_operation", "string"), ("volume_vpd", "bigint"), ("posted_speed_limit", "bigint"),
    ("average_speed", "double"), ("percentile_speed_85", "double"), ("estimated_cost", "double"),
    ("comments", "string"), ("num_speed_humps", "int"), ("num_speed_bumps", "bigint"),
    ("priority_ranking", "int"), ("src_orderkey", "bigint"), ("src_partkey", "bigint"),
    ("src_suppkey", "bigint"), ("src_price", "double"),
]
DEVICE_COLS = [c for c, _ in DEVICE_TYPES]
DEVICE_NUMERIC = [c for c, t in DEVICE_TYPES if t in ("bigint", "int", "double")]
EVENT_NUMERIC = ["event_id", "volume", "average_speed", "speed_limit"]


def completeness_sql(view="devices", cols=DEVICE_COLS) -> str:
    parts = [f"SELECT '{c}' AS \"column\", {i} AS position, count(*) AS total_values, "
             f"count({c}) AS non_null_values FROM {view}" for i, c in enumerate(cols)]
    return f"""
SELECT "column", position, total_values, non_null_values, total_values - non_null_values AS null_count,
  non_null_values * CAST(100.0 AS DOUBLE) / total_values AS completeness_percentage,
  non_null_values * CAST(100.0 AS DOUBLE) / total_values >= CAST({fv.COMPLETE_PCT!r} AS DOUBLE) AS is_complete
FROM ({' UNION ALL '.join(parts)}) c"""


def duplicates_sql(view="devices", cols=DEVICE_COLS) -> str:
    return f"""
SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS "count",
  sum(c - 1) / sum(c) * 100 AS percentage,
  sum(c - 1) / sum(c) < CAST({fv.DUPLICATE_ACCEPTABLE_SHARE!r} AS DOUBLE) AS is_acceptable
FROM (SELECT count(*) AS c FROM {view} GROUP BY {', '.join(cols)}) g"""


def type_consistency_sql(view="devices", types=DEVICE_TYPES) -> str:
    parts = []
    for i, (c, t) in enumerate(types):
        if t == "string":
            kind = (f"CASE WHEN count({c}) = count(TRY_CAST({c} AS DOUBLE)) "
                    f"THEN 'numeric_string' ELSE 'text' END")
            parts.append(f"SELECT '{c}' AS \"column\", {i} AS position, {kind} AS kind FROM {view}")
        else:
            parts.append(f"SELECT '{c}' AS \"column\", {i} AS position, '{t}' AS kind")
    return " UNION ALL ".join(parts)


def column_rules_sql(view="devices", types=DEVICE_TYPES) -> str:
    tmap = dict(types)
    parts = []
    for pos, (rule_col, r) in enumerate(fv.QUALITY_RULES.items()):
        c = "volume_vpd" if rule_col == "volume" else rule_col
        if c not in tmap:
            continue
        text = tmap[c] == "string"
        req = f"count(*) FILTER (WHERE {c} IS NULL)" if r.get("required") else "CAST(NULL AS BIGINT)"
        lo = f"count(*) FILTER (WHERE {c} < {r['min_value']})" if "min_value" in r else "CAST(NULL AS BIGINT)"
        hi = f"count(*) FILTER (WHERE {c} > {r['max_value']})" if "max_value" in r else "CAST(NULL AS BIGINT)"
        short = (f"count(*) FILTER (WHERE length({c}) < {r['min_length']})"
                 if "min_length" in r and text else "CAST(NULL AS BIGINT)")
        pat = (f"count(*) FILTER (WHERE NOT coalesce(regexp_matches({c}, '{r['pattern']}'), false))"
               if "pattern" in r and text else "CAST(NULL AS BIGINT)")
        parts.append(f"SELECT '{c}' AS \"column\", {pos} AS position, {req} AS required_nulls, "
                     f"{lo} AS below_min, {hi} AS above_max, {short} AS short_strings, "
                     f"{pat} AS pattern_misses FROM {view}")
    inner = " UNION ALL ".join(parts)
    ic = " + ".join(f"coalesce(CAST({n} > 0 AS INT), 0)" for n in
                    ("required_nulls", "below_min", "above_max", "short_strings", "pattern_misses"))
    return f"SELECT *, CAST({ic} AS BIGINT) AS issue_count, ({ic}) = 0 AS is_valid FROM ({inner}) r"


def zscore_sql(view: str, cols: list[str], table: str = "") -> str:
    parts = []
    for i, c in enumerate(cols):
        parts.append(f"""
SELECT '{c}' AS "column", {i} AS position, n, s,
  (SELECT count(*) FROM {view} WHERE abs((CAST({c} AS DOUBLE) - m) / CASE WHEN s = 0 THEN NULL ELSE s END) > 3) AS outliers
FROM (SELECT avg(CAST({c} AS DOUBLE)) AS m, stddev_samp(CAST({c} AS DOUBLE)) AS s, count({c}) AS n FROM {view}) st""")
    base = " UNION ALL ".join(parts)
    tcol = f", '{table}' AS \"table\"" if table else ""
    return f"""
SELECT "column", position, 'statistical_outlier' AS type, outliers AS "count",
  outliers * CAST(100.0 AS DOUBLE) / n AS percentage,
  CASE WHEN outliers > n * CAST({fv.OUTLIER_HIGH_SHARE!r} AS DOUBLE) THEN 'high' ELSE 'medium' END AS severity{tcol}
FROM ({base}) z WHERE n > 0 AND outliers > 0
UNION ALL
SELECT "column", position, 'no_variation' AS type, n AS "count", CAST(100.0 AS DOUBLE) AS percentage, 'high' AS severity{tcol}
FROM ({base}) z WHERE n > 0 AND s = 0"""


def business_rules_sql(view="devices") -> str:
    parts = [f"""
SELECT 0 AS position, 'speed_limit_violation' AS rule, 'Average speed exceeds posted limit by >20%' AS description,
  count(*) FILTER (WHERE average_speed > posted_speed_limit * CAST(1.2 AS DOUBLE)) AS "count", 'medium' AS severity FROM {view}"""]
    for i, (k, (lo, hi)) in enumerate(fv.VOLUME_RANGES.items()):
        parts.append(f"""
SELECT {i + 1} AS position, 'volume_range_violation' AS rule, 'Volume outside expected range for {k}' AS description,
  count(*) FILTER (WHERE volume_vpd < {float(lo)!r} OR volume_vpd > {float(hi)!r}) AS "count", 'low' AS severity
FROM {view} WHERE road_type = '{k}'""")
    parts.append(f"""
SELECT {len(fv.VOLUME_RANGES) + 1} AS position, 'percentile_speed_violation' AS rule,
  '85th percentile speed lower than average speed' AS description,
  count(*) FILTER (WHERE percentile_speed_85 < average_speed) AS "count", 'high' AS severity FROM {view}""")
    return f"SELECT * FROM ({' UNION ALL '.join(parts)}) b WHERE \"count\" > 0"


def _sections_sql() -> str:
    return f"""WITH comp AS ({completeness_sql()}),
dup AS ({duplicates_sql()}),
rules AS ({column_rules_sql()}),
anom AS ({zscore_sql('devices', DEVICE_NUMERIC)}),
biz AS ({business_rules_sql()})"""


@register("completeness", ("A12",), with_views(completeness_sql(), "devices"))
def q_completeness(spark, sf):
    return Q.completeness(T.devices(spark, sf))


@register("duplicate_rows", ("A13",), with_views(duplicates_sql(), "devices"))
def q_duplicate_rows(spark, sf):
    return Q.duplicates(T.devices(spark, sf))


@register("type_consistency", ("A14",), with_views(type_consistency_sql(), "devices"))
def q_type_consistency(spark, sf):
    return Q.type_consistency(T.devices(spark, sf))


@register("column_rules", ("A15", "F17", "F18"), with_views(column_rules_sql(), "devices"))
def q_column_rules(spark, sf):
    return Q.column_rules(T.devices(spark, sf))


@register("zscore_outliers", ("A16",), with_views(
    zscore_sql("devices", DEVICE_NUMERIC, "devices") + "\nUNION ALL\n"
    + zscore_sql("traffic_events", EVENT_NUMERIC, "traffic_events"), "devices", "traffic_events"))
def q_zscore_outliers(spark, sf):
    d = Q.zscore_outliers(T.devices(spark, sf), DEVICE_NUMERIC, "devices")
    e = Q.zscore_outliers(T.traffic_events(spark, sf), EVENT_NUMERIC, "traffic_events")
    return d.unionByName(e)


@register("business_rules", ("A17", "J8"), with_views(business_rules_sql(), "devices"))
def q_business_rules(spark, sf):
    return Q.business_rules(T.devices(spark, sf))


@register("dataset_score", ("A18",), with_views(_sections_sql() + """,
parts AS (
  SELECT
    (SELECT coalesce(sum(CASE WHEN NOT is_complete THEN (CAST(100.0 AS DOUBLE) - completeness_percentage) / CAST(1000.0 AS DOUBLE) ELSE 0.0 END), 0.0) FROM comp) AS d_completeness,
    (SELECT max(total_values) FROM comp) AS total_records,
    (SELECT CASE WHEN NOT is_acceptable THEN percentage / CAST(100.0 AS DOUBLE) ELSE 0.0 END FROM dup) AS d_duplicates,
    (SELECT sum(issue_count) FROM rules) AS column_issues,
    (SELECT coalesce(sum(CASE WHEN severity = 'high' THEN CAST(0.1 AS DOUBLE) WHEN severity = 'medium' THEN CAST(0.05 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END), CAST(0.0 AS DOUBLE)) FROM anom) AS d_anomalies,
    (SELECT coalesce(sum(CASE WHEN severity = 'high' THEN CAST(0.1 AS DOUBLE) WHEN severity = 'medium' THEN CAST(0.05 AS DOUBLE) ELSE CAST(0.02 AS DOUBLE) END), CAST(0.0 AS DOUBLE)) FROM biz) AS d_business)
SELECT round(greatest(CAST(0.0 AS DOUBLE), least(CAST(1.0 AS DOUBLE),
    CAST(1.0 AS DOUBLE) - d_completeness - d_duplicates
    - coalesce(least(CAST(0.2 AS DOUBLE), CAST(column_issues AS DOUBLE) / CAST(total_records AS DOUBLE)), 0.0)
    - d_anomalies - d_business)), 6) AS quality_score,
  total_records, round(d_completeness, 6) AS d_completeness, round(d_duplicates, 6) AS d_duplicates,
  CAST(column_issues AS BIGINT) AS column_issues, round(d_anomalies, 6) AS d_anomalies, round(d_business, 6) AS d_business
FROM parts
""", "devices"))
def q_dataset_score(spark, sf):
    return Q.quality_score(written(T.devices(spark, sf), "score"), numeric=DEVICE_NUMERIC)


@register("recommendations", ("A19",), with_views(_sections_sql() + """
SELECT 1 AS seq, 'Improve data completeness for columns: ' || string_agg("column", ', ' ORDER BY position) AS recommendation
FROM comp WHERE NOT is_complete HAVING count(*) > 0
UNION ALL
SELECT 2 AS seq, 'Remove ' || CAST("count" AS VARCHAR) || ' duplicate records' AS recommendation FROM dup WHERE NOT is_acceptable
UNION ALL
SELECT 3 AS seq, 'Investigate ' || CAST(count(*) AS VARCHAR) || ' high-severity data anomalies' AS recommendation
FROM anom WHERE severity = 'high' HAVING count(*) > 0
UNION ALL
SELECT 4 AS seq, 'Address ' || CAST(count(*) AS VARCHAR) || ' high-severity business rule violations' AS recommendation
FROM biz WHERE severity = 'high' HAVING count(*) > 0
""", "devices"))
def q_recommendations(spark, sf):
    return Q.recommendations(written(T.devices(spark, sf), "recommendations"), numeric=DEVICE_NUMERIC)
