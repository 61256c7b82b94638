"""Source/sink round trips over data Spark derives from the driver's tables:
each query writes with a sink into the shared checkpoint folder and reads the
result back with the matching source, so the oracle checks both ends."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from roadlens import fixed_values as fv
from roadlens.functions import derive as D
from roadlens.operators import etl as E
from roadlens.operators import jobs as J
from roadlens.plans.dashboard_queries import HEURISTIC_SQL
from roadlens.plans.etl_queries import _canonical_sql
from roadlens.plans.registry import register, with_views
from roadlens.session import scratch_path, shuffles_freed, written
from roadlens.sinks import writers as W
from roadlens.sources import files as FS
from roadlens.sources import tables as T
from roadlens.streaming import stream as S

_CAMEL = {v: k for k, v in fv.CAMEL_TO_CANONICAL.items()}


def _run_dir(spark, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


@register("json_export_roundtrip", ("K1", "S2", "S3", "S4", "P1", "P2", "P3"),
          with_views(_canonical_sql(), "devices"))
def q_json_export_roundtrip(spark, sf):
    """Devices written as a camelCase JSON export (text values, one nested
    object; files with gzip, 281 MB without at sf0.1 and 27 MB with it), found
    by source precedence, flattened and canonicalised."""
    base = _run_dir(spark, "json-export")
    d = T.devices(spark, sf)
    flat_keys = [c for c in d.columns if c in _CAMEL and c not in ("status", "road_type")]
    export = d.select(*[F.col(c).cast("string").alias(_CAMEL[c]) for c in flat_keys],
                      F.struct(F.col("status").alias("status"), F.col("road_type").alias("roadType")).alias("meta"))
    with shuffles_freed(spark):
        W.write_json_records(export, f"{base}/export.json", compression="gzip")
    raw = FS.extract(spark, json_path=f"{base}/export.json", table_path=f"{base}/absent",
                     csv_path=f"{base}/absent.csv")
    flat = FS.flatten(raw).withColumnsRenamed({"meta.status": "status", "meta.roadType": "roadType"})
    return E.canonicalize(flat)


@register("csv_export_roundtrip", ("K8", "S1", "P14", "F24"), with_views(f"""
SELECT CAST(record_id AS VARCHAR) AS record_id, CAST(road_type AS VARCHAR) AS road_type,
  CAST(volume_vpd AS VARCHAR) AS volume_vpd, CAST({HEURISTIC_SQL} AS VARCHAR) AS predicted_volume
FROM devices
""", "devices"))
def q_csv_export_roundtrip(spark, sf):
    """Prediction table (column subset) exported as CSV and read back as text."""
    base = _run_dir(spark, "csv-export")
    d = T.devices(spark, sf).withColumn("predicted_volume", D.heuristic_volume())
    W.write_csv(d.select("record_id", "road_type", "volume_vpd", "predicted_volume"), base)
    return FS.read_inventory_csv(spark, base, ["record_id", "road_type", "volume_vpd", "predicted_volume"])


@register("attachment_files_roundtrip", ("K9", "S10", "K10", "F15"), with_views("""
SELECT record_id, count(*) AS n_files, CAST(sum(strlen(content)) AS BIGINT) AS n_bytes
FROM attachments GROUP BY record_id
""", "attachments"))
def q_attachment_files_roundtrip(spark, sf):
    """Attachments written one folder per record, listed back as binary files
    (record id from the path), counted per record."""
    base = _run_dir(spark, "attachments")
    att = T.attachments(spark, sf).select("record_id", "file_name", F.encode("content", "UTF-8").alias("content"))
    # Each file's bytes become one Parquet row under base/record_id=<id>/.
    W.write_files_per_record(att, base)
    files = spark.read.parquet(base)
    listed = FS.read_attachment_folder(spark, base, "*.parquet")
    ids = listed.select(F.regexp_extract("record_id", "record_id=(.*)", 1).alias("record_id")).distinct()
    W.write_id_list(ids, f"{base}-ids")
    with_files = spark.read.text(f"{base}-ids").withColumnRenamed("value", "record_id")
    return (files.join(with_files, "record_id", "left_semi").groupBy("record_id")
                 .agg(F.count(F.lit(1)).alias("n_files"), F.sum(F.octet_length("content")).alias("n_bytes")))


@register("event_time_features", ("F28", "M1"), with_views("""
SELECT event_id, CAST(hour(ts) AS INTEGER) AS time_of_day, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week FROM traffic_events
""", "traffic_events"))
def q_event_time_features(spark, sf):
    e = T.traffic_events(spark, sf)
    hour, weekday = D.hour_and_weekday(F.col("ts"))
    return e.select("event_id", hour.alias("time_of_day"), weekday.alias("day_of_week"))


@register("payload_parse", ("N7", "N8", "R4"), with_views("""
SELECT event_id, coalesce(location, 'unknown') AS location, CAST(volume AS DOUBLE) AS volume,
  average_speed, CAST(speed_limit AS DOUBLE) AS speed_limit
FROM traffic_events WHERE event_id % 50 <> 0
""", "traffic_events"))
def q_payload_parse(spark, sf):
    """Events serialised as JSON messages (every 50th one corrupted) and
    parsed back; corrupted messages are dropped."""
    e = T.traffic_events(spark, sf)
    msg = F.to_json(F.struct("event_id", "location", "volume", "average_speed", "speed_limit"))
    raw = e.select(F.when(F.col("event_id") % 50 == 0, F.concat(F.lit("{broken "), msg)).otherwise(msg).alias("value"))
    p = S.parse_messages(raw)
    return p.select(F.col("event_id").cast("bigint").alias("event_id"), F.coalesce("location", F.lit("unknown")).alias("location"), "volume",
                    "average_speed", "speed_limit")


@register("quality_report_sections", ("K7",))
def q_quality_report_sections(spark, sf):
    """The quality report written as one JSON dataset and read back: entries per section."""
    base = _run_dir(spark, "quality-report")
    J.run_quality_report(written(T.devices(spark, sf), "quality-input"), base)
    return spark.read.json(base).groupBy("section").agg(F.count(F.lit(1)).alias("entries"))


def _dashboard_input(spark, sf):
    """What the dashboard's sections read, each of them once or twice."""
    return written(T.devices(spark, sf).select("record_id", "street_name", "intersection1", "road_type", "volume_vpd", "average_speed",
                                               "posted_speed_limit"), "dashboard-input")


@register("dashboard_report", ("K7", "A1", "P7", "F24"), with_views("""
WITH a AS (SELECT count(*) FILTER (WHERE average_speed > posted_speed_limit * CAST(1.2 AS DOUBLE))
             + count(*) FILTER (WHERE volume_vpd > 2 * (SELECT avg(volume_vpd) FROM devices)) AS n FROM devices)
SELECT 'overview' AS section, CAST(1 AS BIGINT) AS entries
UNION ALL SELECT 'anomalies', n FROM a WHERE n > 0
UNION ALL SELECT 'predictions', count(*) FROM devices
""", "devices"))
def q_dashboard_report(spark, sf):
    """The dashboard's data written as one JSON dataset and read back: entries per section."""
    base = _run_dir(spark, "dashboard-report")
    W.write_report(J.dashboard_report(_dashboard_input(spark, sf)), base)
    return spark.read.json(base).groupBy("section").agg(F.count(F.lit(1)).alias("entries"))


@register("training_report", ("K7", "A20", "A21"), with_views("""
SELECT 'anomaly_detector' AS section, CAST(1 AS BIGINT) AS entries
UNION ALL SELECT 'model_info', 2 UNION ALL SELECT 'traffic_predictor', 1
""", "devices"))
def q_training_report(spark, sf):
    """The linear model on its test fold and the scoring flags, written as a report and read back."""
    from roadlens.operators import model as M
    from roadlens.plans import model_queries as Q
    base = _run_dir(spark, "training-report")
    data, model = Q._linear(spark, sf)
    test = M.linear_predict(model, data.filter(M.split_flag(*Q.SPLIT_KEYS)), "volume_vpd")
    flagged = T.devices(spark, sf).withColumns(D.scoring_columns())
    info = [("traffic_predictor", "LinearRegression", len(Q.X3)), ("anomaly_detector", "scoring rule", 2)]
    W.write_report(J.training_report(test, "volume_vpd", flagged, info), base)
    return spark.read.json(base).groupBy("section").agg(F.count(F.lit(1)).alias("entries"))


#: Every so many lines of the damaged export: one cut off, one that is null, one with text behind, two records in one.
_DAMAGE = "CAST(volume_vpd % 40 AS INTEGER)"


@register("export_json_rejects", ("S2", "N7"), with_views(f"""
WITH x AS (SELECT road_type, volume_vpd, {_DAMAGE} AS d FROM devices WHERE volume_vpd IS NOT NULL AND road_type IS NOT NULL)
SELECT 'record' AS kind, road_type AS value, CAST(count(*) AS BIGINT) AS n, CAST(sum(volume_vpd) AS BIGINT) AS volume
FROM (SELECT road_type, volume_vpd FROM x WHERE d NOT IN (1, 2) UNION ALL SELECT road_type, volume_vpd FROM x WHERE d = 4) GROUP BY road_type
UNION ALL SELECT 'reject', v, CAST(count(*) AS BIGINT), CAST(NULL AS BIGINT) FROM (
  SELECT CASE d WHEN 1 THEN '{{"volume":' WHEN 2 THEN 'null' ELSE '// seen' END AS v FROM x WHERE d IN (1, 2, 3)) GROUP BY v
""", "devices"))
def q_export_json_rejects(spark, sf):
    """Devices exported as JSON Lines of which some are cut off, null, followed by text, or hold two records: every
    good record by class, and one reject per bad span."""
    base = _run_dir(spark, "damaged-export")
    d = T.devices(spark, sf).filter(F.col("volume_vpd").isNotNull() & F.col("road_type").isNotNull())
    line = F.to_json(F.struct(F.col("volume_vpd").alias("volume"), F.col("road_type").alias("roadType"),
                              F.struct(F.lit('a "}" in a text').alias("note")).alias("meta")))
    kind = F.expr(_DAMAGE)
    d.select(F.when(kind == 1, F.lit('{"volume":')).when(kind == 2, F.lit("null")).when(kind == 3, F.concat(line, F.lit(" // seen")))
             .when(kind == 4, F.concat(line, line)).otherwise(line)).write.text(base)
    records, rejects = FS.read_export_with_rejects(spark, base)
    good = records.groupBy(F.lit("record").alias("kind"), F.col("roadType").alias("value")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("volume").cast("bigint")).alias("volume"))
    bad = rejects.groupBy(F.lit("reject").alias("kind"), F.col("text").alias("value")).agg(
        F.count(F.lit(1)).alias("n"), F.lit(None).cast("bigint").alias("volume"))
    return good.unionByName(bad)


def _oracle(name: str) -> str:
    from roadlens.plans.registry import REGISTRY
    return f"({REGISTRY[name].oracle})"


def _values_sql() -> str:
    import roadlens.plans.dashboard_queries  # noqa: F401  (registers the queries whose SQL is used)
    over = ["total_locations", "average_volume", "average_speed", "congestion_level", "anomalies_detected"]
    parts = [f"SELECT 'overview' AS section, '{c}' AS metric, CAST({c} AS VARCHAR) AS value FROM {_oracle('overview')} o" for c in over]
    parts.append(f"SELECT 'anomalies', alert_type || ' ' || severity, CAST(count(*) AS VARCHAR) FROM {_oracle('alerts_union')} a GROUP BY alert_type, severity")
    parts.append(f"SELECT 'predictions', 'sum of predicted volumes', CAST(sum(predicted_volume) AS VARCHAR) FROM {_oracle('heuristic_prediction')} p")
    return "\nUNION ALL ".join(parts)


@register("dashboard_report_values", ("K7", "A1", "U1", "F24"), _values_sql())
def q_dashboard_report_values(spark, sf):
    """The dashboard's data written as one JSON dataset and read back: its values, not only its size."""
    base = _run_dir(spark, "dashboard-values")
    W.write_report(J.dashboard_report(_dashboard_input(spark, sf)), base)
    back = spark.read.schema("section string, entry string").json(base)

    def of(section, key):
        return F.when(F.col("section") == section, F.get_json_object("entry", f"$.{key}"))

    names = ["total_locations", "average_volume", "average_speed", "congestion_level", "anomalies_detected"]
    overview = back.filter("section = 'overview'").select(F.inline(F.array(*[
        F.struct("section", F.lit(c).alias("metric"), of("overview", c).alias("value")) for c in names])))
    kind = F.concat_ws(" ", of("anomalies", "alert_type"), of("anomalies", "severity"))
    alerts = back.filter("section = 'anomalies'").groupBy("section", kind.alias("metric")).agg(F.count(F.lit(1)).cast("string").alias("value"))
    predicted = back.filter("section = 'predictions'").groupBy("section", F.lit("sum of predicted volumes").alias("metric")).agg(
        F.sum(of("predictions", "predicted_volume").cast("bigint")).cast("string").alias("value"))
    return overview.unionByName(alerts).unionByName(predicted)


def _training_sql() -> str:
    import roadlens.plans.model_queries  # noqa: F401
    parts = [f"SELECT 'traffic_predictor' AS section, '{c}' AS metric, CAST({c} AS DOUBLE) AS value FROM {_oracle('linear_metrics')} l"
             for c in ("n", "mse", "mae", "r2")]
    parts += [f"SELECT 'anomaly_detector', '{c}', CAST({c} AS DOUBLE) FROM {_oracle('anomaly_metrics')} a"
              for c in ("total_samples", "anomalies_detected", "anomaly_rate", "mean_anomaly_score", "std_anomaly_score")]
    return "\nUNION ALL ".join(parts)


@register("training_report_values", ("K7", "A20", "A21"), _training_sql())
def q_training_report_values(spark, sf):
    """The training report written and read back: the evaluation of the linear model and of the scoring flags."""
    from roadlens.operators import model as M
    from roadlens.plans import model_queries as Q
    base = _run_dir(spark, "training-values")
    data, model = Q._linear(spark, sf)
    test = M.linear_predict(model, data.filter(M.split_flag(*Q.SPLIT_KEYS)), "volume_vpd")
    flagged = T.devices(spark, sf).withColumns(D.scoring_columns())
    W.write_report(J.training_report(test, "volume_vpd", flagged, [("traffic_predictor", "LinearRegression", len(Q.X3))]), base)
    back = spark.read.schema("section string, entry string").json(base)
    keys = {"traffic_predictor": {"n": None, "mse": 1, "mae": 3, "r2": None},
            "anomaly_detector": dict.fromkeys(("total_samples", "anomalies_detected", "anomaly_rate", "mean_anomaly_score", "std_anomaly_score"))}

    def value(key, digits):
        v = F.get_json_object("entry", f"$.{key}").cast("double")
        return v if digits is None else F.round(v, digits)

    rows = [F.when(F.col("section") == s, F.struct(F.lit(k).alias("metric"), value(k, d).alias("value"))) for s, ks in keys.items() for k, d in ks.items()]
    return back.filter(F.col("section").isin(list(keys))).select("section", F.inline(F.filter(F.array(*rows), lambda r: r.isNotNull())))
