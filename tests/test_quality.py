"""Quality checks on literal rows."""

from roadlens.operators import quality as Q

SCHEMA = ("record_id string, street_name string, road_type string, volume_vpd bigint, "
          "average_speed double, posted_speed_limit bigint, percentile_speed_85 double")
ROWS = [
    ("A-001", "Main St", "Residential", 500, 40.0, 50, 45.0),
    ("A-001", "Main St", "Residential", 500, 40.0, 50, 45.0),    # duplicate
    ("B-2", "X", "Highway", 1000, 90.0, 60, 80.0),               # pattern, short, range, speed, p85
    (None, None, "Collector", None, None, 40, None),
    ("C-003", "Oak Ave", "Arterial", 60000, 30.0, 150, 35.0),     # above max, limit above max
]


def test_completeness_and_duplicates(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    comp = {r.column: r for r in Q.completeness(df).collect()}
    assert comp["record_id"].null_count == 1 and comp["record_id"].completeness_percentage == 80.0
    assert comp["record_id"].is_complete is False and comp["road_type"].is_complete is True
    dup = Q.duplicates(df).collect()[0]
    assert dup["count"] == 1 and dup.percentage == 20.0 and dup.is_acceptable is False


def test_column_rules(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    rules = {r.column: r for r in Q.column_rules(df).collect()}
    assert rules["record_id"].pattern_misses == 2      # 'B-2' and NULL
    assert rules["street_name"].short_strings == 1
    assert rules["volume_vpd"].above_max == 1 and rules["volume_vpd"].required_nulls == 1
    assert rules["posted_speed_limit"].above_max == 1
    assert rules["percentile_speed_85"].required_nulls is None
    assert rules["record_id"].issue_count == 2 and rules["record_id"].is_valid is False


def test_business_rules(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = {(r.rule, r.description): r["count"] for r in Q.business_rules(df).collect()}
    assert got[("speed_limit_violation", "Average speed exceeds posted limit by >20%")] == 1
    assert got[("percentile_speed_violation", "85th percentile speed lower than average speed")] == 1
    assert got[("volume_range_violation", "Volume outside expected range for Arterial")] == 1
    assert got[("volume_range_violation", "Volume outside expected range for Highway")] == 1
    assert ("volume_range_violation", "Volume outside expected range for Residential") not in got


def test_zscore_and_score(spark):
    rows = [(i, float(i % 7)) for i in range(200)] + [(1000, 500.0)]
    df = spark.createDataFrame(rows, "id long, v double")
    z = {r.column: r for r in Q.zscore_outliers(df, ["v"]).collect()}
    assert z["v"]["count"] == 1 and z["v"].severity == "medium"
    flat = spark.createDataFrame([(1, 2.0)] * 5, "id long, v double")
    kinds = {r.type for r in Q.zscore_outliers(flat, ["v"]).collect()}
    assert kinds == {"no_variation"}
    s = Q.quality_score(spark.createDataFrame(ROWS, SCHEMA)).collect()[0]
    assert 0.0 <= s.quality_score <= 1.0


def test_rows_that_repeat_nothing_are_not_shuffled(spark):
    """Only hashes are: the rows of the few groups that repeat are found by broadcast."""
    rows = spark.createDataFrame(ROWS, SCHEMA)
    df = rows.crossJoin(spark.range(3).withColumnRenamed("id", "i"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        dup = Q.duplicates(df)
        plan = dup._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in plan and "LeftSemi, BuildRight" in plan
    assert dup.first()["count"] == 3


def test_inputs_that_are_read_several_times_are_written_once(spark, monkeypatch):
    from roadlens.operators import iforest as I
    from roadlens.operators import jobs as J
    from roadlens.operators import model as M
    from roadlens.plans import io_queries, model_queries, quality_queries
    sf, read = "/root/testdata/sf0.001", []

    class Seen(Exception):
        pass

    def see(df, *rest, **more):
        read.append(df.inputFiles())
        raise Seen

    for place, name, query in ((Q, "quality_score", quality_queries.q_dataset_score), (Q, "recommendations", quality_queries.q_recommendations),
                               (J, "run_quality_report", io_queries.q_quality_report_sections), (J, "dashboard_report", io_queries.q_dashboard_report),
                               (J, "dashboard_report", io_queries.q_dashboard_report_values), (M, "impute_means", model_queries._linear),
                               (I, "detect", model_queries.q_isolation_forest), (M, "complete_rows", model_queries.q_feature_importance)):
        with monkeypatch.context() as m:
            m.setattr(place, name, see)
            try:
                query(spark, sf)
            except Seen:
                pass
    assert len(read) == 8
    assert all(files and not any("testdata" in f for f in files) for files in read), read
