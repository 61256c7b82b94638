"""Edge cases of the scalar functions: NULL, '', 0, negatives, bin edges, bad text."""

import pytest
from pyspark.sql import functions as F

from roadlens.functions import coerce as C
from roadlens.functions import derive as D
from roadlens.functions import text as X


def one_col(spark, values, typ="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {typ}")


def test_to_str(spark):
    df = one_col(spark, [None, "  a b\t", " x　", "", "\n"])
    assert [r[0] for r in df.select(C.to_str("x")).collect()] == ["", "a b", "x", "", ""]


def test_to_int_and_float(spark):
    vals = ["12.5", "-3.9", "", None, "abc", "nan", "7", " 8 ", "1e3", "inf"]
    df = one_col(spark, vals)
    ints = [r[0] for r in df.select(C.to_int("x")).collect()]
    floats = [r[0] for r in df.select(C.to_float("x")).collect()]
    assert ints == [12, -3, 0, 0, 0, 0, 7, 8, 1000, 0]
    assert floats[:9] == [12.5, -3.9, 0.0, 0.0, 0.0, 0.0, 7.0, 8.0, 1000.0]


def test_to_date(spark):
    vals = ["2024-01-05", "2024-1-5", "2024/01/05", "1/5/2024", "2024-01-05 10:20:30",
            "2024-01-05T10:20", "2024-02-30", "2024-01-05 25:00", "abc", "", None]
    df = one_col(spark, vals)
    got = [r[0] for r in df.select(C.date_text(C.to_date("x"))).collect()]
    assert got == ["2024-01-05"] * 6 + ["", "", "", "", ""]
    staged = C.parse_dates(df, {"d": "x"}).select(C.date_text("d")).collect()
    assert [r[0] for r in staged] == got


@pytest.mark.parametrize("inp,out", [
    ("main st", "Main Street"),
    ("MAIN ST. E", "Main Street East"),
    ("Queen Street", "Queen Street"),
    ("Queen Street W", "Queen Street W"),
    ("o'neil-park cres", "O'neilpark Crescent"),
    ("Broadway", "Broadway"),
    ("", ""),
])
def test_address_standardisation(spark, inp, out):
    df = one_col(spark, [inp])
    assert df.select(X.standardise_address("x")).collect()[0][0] == out
    staged = X.standardise_columns(df, {"y": "x"}).select("y").collect()[0][0]
    assert staged == out


def test_cleaning(spark):
    df = one_col(spark, ["a\r\nb\tc\x00d�e", "Brand#12 Ave!", "café-1", "http://x/#top"])
    rows = df.select(X.clean_string("x"), X.remove_special("x"), X.remove_hash("x")).collect()
    assert rows[0][0] == "abcde"
    assert rows[1][1] == "Brand12 Ave"
    assert rows[2][1] == "caf1"
    assert rows[3][2] == "http://x/top"


def test_volume_category_edges(spark):
    df = one_col(spark, [None, -5, 0, 1, 1000, 1001, 3000, 3001, 5000, 5001], "bigint")
    got = [r[0] for r in df.select(D.volume_category("x")).collect()]
    assert got == [None, None, None, "Low", "Low", "Medium", "Medium", "High", "High", "Very High"]


def test_congestion_and_violation(spark):
    df = spark.createDataFrame([(34.0, 50), (40.0, 50), (50.0, 50), (None, 50), (61.0, 50)],
                               "average_speed double, posted_speed_limit bigint")
    rows = df.select(D.congestion_by_speed(), D.congestion_by_ratio(D.speed_compliance()),
                     D.speed_violation(factor=1.2)).collect()
    assert [r[0] for r in rows] == ["High", "Medium", "Low", "Low", "Low"]
    assert [r[1] for r in rows] == ["High", "Medium", "Low", "Low", "Low"]
    assert [r[2] for r in rows] == [False, False, False, False, True]


def test_row_quality(spark):
    df = spark.createDataFrame(
        [("A-001", "Main", 100, 30.0, 50), ("", "Main", 0, 30.0, 50), ("A-1", "", -5, -1.0, -2)],
        "record_id string, street_name string, volume_vpd bigint, average_speed double, posted_speed_limit bigint")
    got = [round(r[0], 6) for r in df.select(D.row_quality_score()).collect()]
    assert got == [1.0, 0.6, 0.5]


def test_content_type_and_pattern(spark):
    df = one_col(spark, ["a.PDF", "b.png", "c.jpg", "d.JPEG", "e.txt", "noext"])
    got = [r[0] for r in df.select(X.content_type("x")).collect()]
    assert got == ["application/pdf", "image/png", "image/jpeg", "image/jpeg",
                   "application/octet-stream", "application/octet-stream"]
    ids = one_col(spark, ["A-001", "a-001", "AB-001", None, "Z-999"])
    assert [r[0] for r in ids.select(X.id_pattern_ok("x")).collect()] == [True, False, False, False, True]


def test_time_factor_and_agreement(spark):
    assert D.time_factor(14) == 0.9
    df = spark.createDataFrame([(100.0, 80.0), (0.5, 0.2)], "a double, b double")
    got = [round(r[0], 6) for r in df.select(D.agreement_confidence("a", "b")).collect()]
    assert got == [0.8, 0.7]


def test_date_spellings(spark):
    cases = {"Jan 5, 2024": "2024-01-05", "5-Jan-2024": "2024-01-05", "1/5/24": "2024-01-05", "05.01.2024": "2024-05-01",
             "25.01.2024": "2024-01-25", "13/01/2024": "2024-01-13", "5 January 2024": "2024-01-05", "05-01-2024": "2024-05-01",
             "1/5/80": "1980-01-05", "Sept 3 2020": "2020-09-03", "2024.01.05": "2024-01-05", "20240105": "2024-01-05",
             "January 5th, 2024": "2024-01-05", "12/13/24 3:04 PM": "2024-12-13", "5-jan-24": "2024-01-05",
             "Janus 5, 2024": "", "32/1/2024": "", "1/5/123": "", "mayor": "", "May": "", "13/13/2024": "", "Feb 30, 2024": "", "1.5": ""}
    df = one_col(spark, list(cases))
    assert [r[0] for r in df.select(C.date_text(C.to_date("x"))).collect()] == list(cases.values())
    assert [r[0] for r in C.parse_dates(df, {"d": "x"}).select(C.date_text("d")).collect()] == list(cases.values())
    got = C.coercion_losses(df, dates=["x"], numbers=["x"]).collect()
    assert [tuple(r) for r in got] == [("x", "date", 23, 8), ("x", "number", 23, 21)]


def test_suffixed_numbers_are_text(spark):
    from roadlens.operators import quality as Q
    df = spark.createDataFrame([("12d", "1e3", "", "nan", " 5 "), ("7", "-.5", "2", "1", "+6.")], "a string, b string, c string, d string, e string")
    assert {r["column"]: r["kind"] for r in Q.type_consistency(df).collect()} == {
        "a": "text", "b": "numeric_string", "c": "numeric_string", "d": "text", "e": "numeric_string"}


def test_metrics_of_diverging_predictions(spark):
    from roadlens.operators import model as M
    rows = [(100.0, 90.0), (200.0, 1e13), (3e15, 2.0), (0.0, 5.0), (None, 1.0)]
    r = M.regression_metrics(spark.createDataFrame(rows, "y double, p double"), "y", "p").first()
    errors = [p - y for y, p in rows[:4]]
    assert r.n == 4 and r.mae == pytest.approx(sum(map(abs, errors)) / 4) and r.mse == pytest.approx(sum(e * e for e in errors) / 4)
    r = M.regression_metrics(spark.createDataFrame([(1.0, float("inf")), (2.0, 2.0)], "y double, p double"), "y", "p").first()
    assert r.mae == float("inf") and r.n == 2


def test_a_date_is_read_by_few_matches(spark):
    """Groups come from one match each: not one match per group, use and spelling."""
    from roadlens.functions import coerce as C
    df = spark.createDataFrame([("3/14/2024 10:15",), ("14 mar 24",), ("2024-3-9T25:00",), ("2024.3.9",), (None,)], "x string")
    out = C.parse_dates(df, {"d": "x"})
    assert [str(r.d) for r in out.collect()] == ["2024-03-14", "2024-03-14", "None", "2024-03-09", "None"]
    assert [str(r[0]) for r in df.select(C.to_date("x")).collect()] == ["2024-03-14", "2024-03-14", "None", "2024-03-09", "None"]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract") == 0


def test_trim_by_the_ends(spark):
    """Visible ASCII at both ends leaves a text as it is; any other is trimmed of all that Python's strip removes."""
    texts = ["", " ", "a", "a b", " a", "a ", "\x1fa\x1c", "　a\xa0", "　 a \xa0", "é", "aé", "éa", "a\x7f", "\x7fa", "\x00a", "​a", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    want = {i: (t or "").strip() for i, t in enumerate(texts)}
    assert {r["i"]: r["v"] for r in df.select("i", C.to_str("t").alias("v")).collect()} == want
    assert {r["i"]: r["v"] for r in C.trim_columns(df, {"v": "t"}).collect()} == want
    assert "trim" not in str(C.to_str("t")).lower().split("else")[0]


def test_iso_date_equals_the_formatter(spark):
    """A date's text by a cast, for any year, as the formatter writes it; short texts are no dates."""
    days = spark.sql("select date_add(date'0001-01-01', cast(n * 1000 - 2000000 as int)) as d from range(6000) t(n)")
    assert days.filter(C.iso_date("d") != F.date_format("d", "yyyy-MM-dd")).count() == 0
    got = spark.createDataFrame([("1/1/76",), ("1/1/7",), ("12",), ("19990101",), (None,)], "t string").select(C.to_date("t").cast("string"))
    assert [r[0] for r in got.collect()] == ["1976-01-01", None, None, "1999-01-01", None]
