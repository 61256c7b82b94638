"""End-to-end jobs: the batch ETL run and the quality report run.

Batch ETL: source (JSON export / table / CSV by precedence) -> canonical
record -> fuzzy street matching -> row quality score and processing time ->
JSON records, keyed upsert into the versioned table, keyed envelopes.  Run
metrics (records, anomalies, mean quality score) are collected with
``observe`` on the JSON write itself, so they cost no extra pass; records/s
uses the driver clock around that write.
"""

from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from roadlens import fixed_values as fv
from roadlens.functions import derive as D
from roadlens.operators import etl as E
from roadlens.operators import fuzzy as Z
from roadlens.operators import model as M
from roadlens.operators import nested as N
from roadlens.operators import quality as Q
from roadlens.operators import report as R
from roadlens.operators.upsert import VersionedTable
from roadlens.sinks import writers as W
from roadlens.sources import files as FS

def enrich_records(canonical: DataFrame, refs: DataFrame | None = None,
                   as_of: dt.datetime | None = None) -> DataFrame:
    """Street fields matched to the reference list (when given), request
    scoring columns, row quality score and processing timestamp."""
    out = canonical
    if refs is not None:
        out = Z.apply_matches(out, list(E.STREET_FIELDS), refs)
    ts = F.lit(as_of).cast("timestamp") if as_of else F.current_timestamp()
    return out.withColumns(D.scoring_columns()).withColumns({
        "data_quality_score": D.row_quality_score(),
        "processing_timestamp": ts,
    })


def run_metrics(records: DataFrame) -> DataFrame:
    """The run's counters as a one-row frame (same aggregates ``observe`` uses)."""
    return records.agg(*_metric_exprs())


def _metric_exprs():
    return [F.count(F.lit(1)).alias("records"),
            F.sum(F.col("is_anomaly").cast("int")).cast("bigint").alias("anomalies"),
            F.round(F.avg("data_quality_score"), 6).alias("mean_quality_score")]


_ML_NAMES = {"predicted_volume": "ml_predicted_volume", "confidence": "ml_confidence"}


def with_models(records: DataFrame, volume_model=None, forest: bool = False) -> DataFrame:
    """The enriched record's columns: ml_predicted_volume and ml_confidence (of the ensemble, if there is one),
    is_anomaly and anomaly_score (of an isolation forest over the speeds, if asked for; else of the scoring rule)."""
    from roadlens.operators import iforest as I
    out = records
    if volume_model is not None:
        timed = M.prepare_features(out.withColumn("__ts", F.col("processing_timestamp")).drop("predicted_volume", "confidence"), "__ts")
        out = M.ensemble_predict(volume_model, timed).select(
            *[c for c in records.columns if c not in _ML_NAMES], *_ML_NAMES)
    if forest:
        flagged = I.detect(M.impute_means(out.drop("is_anomaly", "anomaly_score"), M.SPEED_FEATURES), M.SPEED_FEATURES, "__pos")
        out = flagged.drop("score_samples")
    return out.withColumnsRenamed(_ML_NAMES)


def camel_records(records: DataFrame) -> DataFrame:
    """Canonical records under the export's keys, with '' for a missing date; further columns as they are."""
    camel = {v: k for k, v in fv.CAMEL_TO_CANONICAL.items()}
    kinds = dict(E.CANONICAL)
    return records.select(*[
        (F.coalesce(F.col(c).cast("string"), F.lit("")) if kinds.get(c) == "d" else F.col(c)).alias(camel.get(c, c))
        for c in records.columns])


def run_batch_etl(spark: SparkSession, out_dir: str, table_path: str,
                  json_path: str | None = None, source_table: str | None = None,
                  csv_path: str | None = None, ref_paths: list[str] | None = None,
                  prefer_json: bool = True, as_of: dt.datetime | None = None,
                  volume_model=None, forest: bool = False) -> dict:
    """Run the batch ETL once; returns the run metrics and the new table version.

    Of several records with one key, the last of the source wins: rows carry
    their place in the source (files are read in splits, in order)."""
    raw = FS.extract(spark, json_path, source_table, csv_path, prefer_json)
    canonical = E.canonicalize(raw.withColumn("__pos", F.monotonically_increasing_id()), keep=("__pos",))
    refs = None
    if ref_paths:
        refs = FS.read_reference_names(spark, ref_paths).select(
            "ref_name", (F.col("file_pos") * F.lit(1 << 40) + F.col("line_pos")).alias("ref_pos"))
    records = with_models(enrich_records(canonical, refs, as_of), volume_model, forest)
    obs = Observation("etl_run")
    t0 = time.perf_counter()
    # Written once; the export, the upsert and the events read it from there.
    staged = f"{out_dir}/staged"
    records.observe(obs, *_metric_exprs()).write.mode("overwrite").parquet(staged)
    written = spark.read.parquet(staged)
    W.write_json_records(camel_records(written.drop("__pos")), f"{out_dir}/records", mode="overwrite")
    elapsed = time.perf_counter() - t0
    metrics = dict(obs.get)
    version, counts = VersionedTable(spark, table_path).upsert(written, "record_id", ["__pos"], as_of, drop=("__pos",))
    stamp = F.date_format("processing_timestamp", "yyyy-MM-dd'T'HH:mm:ss")
    envelopes = W.keyed_envelope(N.event_envelope(written, stamp, "ml_confidence"), "event_id")
    W.write_envelopes(envelopes, f"{out_dir}/envelopes", mode="overwrite")
    c = counts.collect()[0].asDict()
    metrics.update({"records_per_sec": metrics["records"] / elapsed if elapsed > 0 else None,
                    "version": version, **c})
    return metrics


def dashboard_report(df: DataFrame) -> dict[str, DataFrame]:
    """The dashboard's data: overview, alerts, and the prediction of every location."""
    predictions = df.select(
        F.concat_ws(" & ", "street_name", "intersection1").alias("location"), F.col("volume_vpd").alias("current_volume"),
        D.heuristic_volume().alias("predicted_volume"), F.lit(fv.HEURISTIC_CONFIDENCE).alias("confidence"))
    return {"overview": R.overview(df), "anomalies": R.alerts(df), "predictions": predictions}


def training_report(predicted: DataFrame, label: str, flagged: DataFrame, model_info: list[tuple[str, str, int]]) -> dict[str, DataFrame]:
    """Evaluation of the volume model on its test rows and of the anomaly flags, and what was trained."""
    info = predicted.sparkSession.createDataFrame(model_info, "model string, type string, features int")
    return {"traffic_predictor": M.regression_metrics(predicted, label, "predicted_volume"),
            "anomaly_detector": M.score_metrics(flagged, "is_anomaly", "anomaly_score"), "model_info": info}


def quality_report(df: DataFrame) -> dict[str, DataFrame]:
    """The report sections as small frames (written by ``write_report``)."""
    anomalies = Q.zscore_outliers(df)
    return {
        "completeness": Q.completeness(df),
        "duplicates": Q.duplicates(df),
        "data_types": Q.type_consistency(df),
        "column_analysis": Q.column_rules(df),
        "anomalies": anomalies,
        "issues": Q.business_rules(df),
        "score": Q.quality_score(df, anomalies),
        "recommendations": Q.recommendations(df, anomalies),
    }


def run_quality_report(df: DataFrame, path: str) -> None:
    W.write_report(quality_report(df), path)


def export_predictions_csv(predictions: DataFrame, path: str) -> None:
    """Prediction table export: location, class, volume, prediction, change %, confidence."""
    cols = [c for c in ("street_name", "road_type", "volume_vpd", "predicted_volume", "change_percent",
                        "confidence") if c in predictions.columns]
    W.write_csv(predictions.select(*cols), path)
