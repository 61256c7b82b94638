"""End-to-end batch ETL and report runs on a small CSV."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from roadlens.operators import jobs as J
from roadlens.operators import model as M
from roadlens.operators import attachments as A
from roadlens.sinks import writers as W


def test_batch_etl(spark, tmp_dir):
    csv = f"{tmp_dir}/inv.csv"
    open(csv, "w").write(
        "ID,Location - Street Name1,From - Street Name2,To - Street Name3,Road Classification,"
        "Date Data Received,Volume (vpd),Posted Speed Limit (km/h),Average Speed (km/h),Ranking\n"
        "A-001,main st,oak ave,pine rd,Residential,2024-01-01,1200,50,45,1\n"
        "A-001,main st,oak ave,pine rd,Residential,2024-02-01,1300,50,65,2\n"
        "A-002,elm street,,x,Collector,2024-01-03,0,40,38,1\n")
    refs = f"{tmp_dir}/refs.txt"
    open(refs, "w").write("Main Street\nOak Avenue\nElm Street\n")
    t = dt.datetime(2024, 3, 1)
    m = J.run_batch_etl(spark, f"{tmp_dir}/out", f"{tmp_dir}/table", json_path=f"{tmp_dir}/none.json",
                        csv_path=csv, ref_paths=[refs], as_of=t)
    assert m["records"] == 3 and m["anomalies"] == 1 and m["version"] == 1
    assert m["inserted"] == 2 and m["mean_quality_score"] == round((1.0 + 1.0 + 0.8) / 3, 6)
    table = {r.record_id: r for r in spark.read.parquet(f"{tmp_dir}/table/version=1").collect()}
    assert table["A-001"].volume_vpd == 1300 and table["A-001"].street_name == "Main Street"
    assert table["A-001"].intersection1 == "Oak Avenue"
    env = [json.loads(r.value) for r in spark.read.json(f"{tmp_dir}/out/envelopes").collect()]
    assert {e["event_id"] for e in env} == {"A-001", "A-002"}
    assert all(e["timestamp"] == "2024-03-01T00:00:00" and e["metadata"]["recordId"] == e["event_id"]
               and set(e) == {"event_id", "timestamp", "location", "event_type", "severity", "volume", "speed",
                              "confidence", "metadata"} for e in env)
    out = [json.loads(x.value) for x in spark.read.text(f"{tmp_dir}/out/records").collect()]
    assert {r["requestedAnalysisInfoDate"] for r in out} == {""} and out[0]["recordId"] == "A-001"
    assert out[0]["receivedAnalysisInfoDate"] == "2024-01-01"
    assert {"ml_predicted_volume", "ml_confidence", "is_anomaly", "anomaly_score", "data_quality_score",
            "processing_timestamp"} <= set(out[0]) and "__pos" not in out[0]


def test_last_of_the_batch_wins(spark, tmp_dir):
    """Whatever its dates and ranking; columns that only the table has survive."""
    csv = f"{tmp_dir}/inv.csv"
    open(csv, "w").write("ID,Location - Street Name1,Date Data Received,Volume (vpd),Ranking,Comments\n"
                         "A-001,first,2024-05-01,100,9,N/A\nA-001,last,2024-01-01,200,1,NaN\n")
    t = dt.datetime(2024, 3, 1)
    J.run_batch_etl(spark, f"{tmp_dir}/out", f"{tmp_dir}/table", csv_path=csv, as_of=t)
    r = spark.read.parquet(f"{tmp_dir}/table/version=1").collect()[0]
    assert (r.street_name, r.volume_vpd, r.comments, r.created_at) == ("last", 200, "", t)
    m = J.run_batch_etl(spark, f"{tmp_dir}/out2", f"{tmp_dir}/table", csv_path=csv, as_of=t + dt.timedelta(days=1))
    r = spark.read.parquet(f"{tmp_dir}/table/version=2").collect()[0]
    assert m["updated"] == 1 and (r.created_at, r.updated_at) == (t, t + dt.timedelta(days=1))


def test_models_in_the_job(spark, tmp_dir):
    rows = spark.createDataFrame([(f"A-{i:03d}", "s", "x", "Collector", i, 50, 40.0 + i % 9, 50.0 + i % 7) for i in range(1, 81)],
                                 "record_id string, street_name string, intersection1 string, road_type string, "
                                 "volume_vpd bigint, posted_speed_limit bigint, average_speed double, percentile_speed_85 double")
    timed = rows.withColumn("ts", F.lit("2024-01-01 10:00:00").cast("timestamp_ntz"))
    data = M.prepare_features(timed, "ts").withColumn("label", F.col("volume_vpd").cast("double"))
    model = M.fit_ensemble(data, M.FEATURES, "label")
    rows.write.parquet(f"{tmp_dir}/src")
    m = J.run_batch_etl(spark, f"{tmp_dir}/out", f"{tmp_dir}/table", source_table=f"{tmp_dir}/src", volume_model=model, forest=True)
    out = spark.read.parquet(f"{tmp_dir}/table/version=1")
    assert m["records"] == 80 and out.where("ml_predicted_volume > 0 and ml_confidence <= 1").count() == 80
    assert 1 <= out.where("is_anomaly").count() <= 16
    assert [tuple(r) for r in M.ensemble_predict(None, rows).select("predicted_volume", "confidence").distinct().collect()] == [(0.0, 0.0)]


def test_report_csv_and_model_save(spark, tmp_dir):
    df = spark.createDataFrame([("A-001", "Main", 100, 40.0, 50, 44.0), ("B-002", "Oak", 300, 60.0, 50, 70.0)],
                               "record_id string, street_name string, volume_vpd bigint, average_speed double, "
                               "posted_speed_limit bigint, percentile_speed_85 double")
    J.run_quality_report(df, f"{tmp_dir}/report")
    sections = {r.section for r in spark.read.json(f"{tmp_dir}/report").collect()}
    assert {"completeness", "duplicates", "score", "column_analysis"} <= sections
    J.export_predictions_csv(df.withColumn("predicted_volume", F.col("volume_vpd") * 2), f"{tmp_dir}/pred")
    assert spark.read.option("header", True).csv(f"{tmp_dir}/pred").count() == 2
    rows = spark.createDataFrame([(float(i), float(i % 7), float(2 * i + 1)) for i in range(60)], "a double, b double, y double")
    model = M.fit_linear(rows, ["a", "b"], "y")
    W.save_model(model, f"{tmp_dir}/model")
    assert os.path.isdir(f"{tmp_dir}/model/stages")


def test_explode_attachments(spark):
    df = spark.createDataFrame([("A-1", [("a.pdf", bytearray(b"x")), ("b.png", bytearray(b"y"))])],
                               "record_id string, attachments array<struct<file_name:string, content:binary>>")
    assert sorted(r.file_name for r in A.explode_attachments(df).collect()) == ["a.pdf", "b.png"]


def test_features_of_an_event(spark):
    df = spark.createDataFrame([("Highway", dt.datetime(2024, 1, 1, 17, 30), 50)],
                               "road_type string, at timestamp_ntz, posted_speed_limit bigint")
    r = M.prepare_features(df, "at").collect()[0]
    assert (r.road_type_encoded, r.time_of_day, r.day_of_week, r.speed_limit) == (4, 17, 0, 50.0)


def test_fractional_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.4), (2.0, 1.6), (3.0, 3.4), (4.0, 3.6)], "y double, p double")
    r = M.regression_metrics(df, "y", "p").collect()[0]
    assert (r.n, r.mse, r.rmse, r.mae, r.r2) == (4, 0.16, 0.4, 0.4, 0.872)


def test_dashboard_report_is_the_stored_output(spark, tmp_dir):
    from tests.test_golden import _sample
    W.write_report(J.dashboard_report(_sample(spark)), f"{tmp_dir}/dash")
    rows = [(r.section, json.loads(r.entry)) for r in spark.read.json(f"{tmp_dir}/dash").collect()]
    overview = [e for s, e in rows if s == "overview"][0]
    assert overview == {"total_locations": 5, "average_volume": 2500, "average_speed": 41.6, "congestion_level": "0.0%",
                        "anomalies_detected": 0}
    assert not [e for s, e in rows if s == "anomalies"]
    assert {"location": "Pine St & Third Ave", "current_volume": 4500, "predicted_volume": 6075, "confidence": 0.85} in [
        e for s, e in rows if s == "predictions"]
