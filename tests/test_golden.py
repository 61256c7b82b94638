"""The stored dashboard output of the five-row sample is reproduced exactly."""

from pyspark.sql import functions as F

from roadlens.functions import derive as D
from roadlens.operators import etl as E
from roadlens.operators import report as R

HEADER = ["ID", "Location - Street Name1", "From - Street Name2", "To - Street Name3",
          "Road Classification", "Status", "Volume (vpd)", "Posted Speed Limit (km/h)",
          "Average Speed (km/h)", "85th Percentile Speed (km/h)"]
ROWS = [
    ("A-001", "Main St", "First Ave", "Second Ave", "Residential", "Active", "1200", "50", "45", "55"),
    ("A-002", "Oak Ave", "Second St", "Third St", "Collector", "Pending", "2800", "40", "38", "47"),
    ("A-003", "Pine St", "Third Ave", "Fourth Ave", "Arterial", "Active", "4500", "60", "55", "65"),
    ("A-004", "Elm St", "Fourth St", "Fifth St", "Residential", "Completed", "800", "30", "28", "35"),
    ("A-005", "Cedar Ave", "Fifth Ave", "Sixth Ave", "Collector", "Active", "3200", "45", "42", "52"),
]


def _sample(spark):
    return E.canonicalize(spark.createDataFrame(ROWS, HEADER))


def test_predictions(spark):
    d = _sample(spark)
    got = (d.select(F.concat_ws(" & ", "street_name", "intersection1").alias("location"),
                    F.col("volume_vpd").alias("current_volume"),
                    D.heuristic_volume().alias("predicted_volume"))
            .orderBy("current_volume").collect())
    expected = {"Main St & First Ave": (1200, 864), "Oak Ave & Second St": (2800, 3024),
                "Pine St & Third Ave": (4500, 6075), "Elm St & Fourth St": (800, 576),
                "Cedar Ave & Fifth Ave": (3200, 3456)}
    assert {r.location: (r.current_volume, r.predicted_volume) for r in got} == expected


def test_overview(spark):
    o = R.overview(_sample(spark)).collect()[0]
    assert o.total_locations == 5
    assert o.average_volume == 2500
    assert o.average_speed == 41.6
    assert o.congestion_level == "0.0%"
    assert o.anomalies_detected == 0


def test_first_three_predictions(spark):
    d = _sample(spark).withColumn("predicted_volume", D.heuristic_volume())
    top = R.top_k(d, 3, ["record_id"]).collect()
    assert [r.predicted_volume for r in top] == [864, 3024, 6075]
