"""Nothing is lost silently: file shapes, messages, columns, empty tables, odd spellings."""

import json
import os

import pytest
from pyspark.sql import functions as F

from roadlens.functions import coerce as C
from roadlens.operators import attachments as A
from roadlens.operators import iforest as I
from roadlens.operators import quality as Q
from roadlens.operators import upsert as U
from roadlens.sources import files as FS
from roadlens.streaming import stream as S


def test_every_shape_of_export(spark, tmp_dir):
    """An object, a list, JSON Lines as a file and as a folder: the same records."""
    records = [{"recordId": f"A-{i}", "volume": i} for i in range(10)]
    base = f"{tmp_dir}/x"
    os.makedirs(f"{base}/folder")
    json.dump({"records": records}, open(f"{base}/object.json", "w"), indent=2)
    json.dump(records, open(f"{base}/list.json", "w"))
    with open(f"{base}/lines.json", "w") as f:
        f.write("\n".join(map(json.dumps, records)) + "\n\n")
    for part in (0, 1):
        with open(f"{base}/folder/part-{part}.json", "w") as f:
            f.write("\n".join(map(json.dumps, records[part::2])))
    want = sorted((r["recordId"], str(r["volume"])) for r in records)
    for path in ("object.json", "list.json", "lines.json", "folder"):
        df = FS.read_export_json(spark, f"{base}/{path}")
        assert sorted((r.recordId, r.volume) for r in df.collect()) == want, path
    json.dump([{"recordId": "B-1"}], open(f"{base}/folder/doc.json", "w"), indent=1)      # documents and lines together
    assert FS.read_export_json(spark, f"{base}/folder").count() == 11
    open(f"{base}/broken.json", "w").write("{ this is no JSON")
    with pytest.raises(Exception):
        FS.read_export_json(spark, f"{base}/broken.json").collect()


def test_positions_follow_the_file_names(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/p")
    open(f"{tmp_dir}/p/a.txt", "w").write("a1\na2\n")
    open(f"{tmp_dir}/p/b.txt", "w").write("".join(f"b{i}\n" for i in range(6)))
    got = {r.row_id: r.line for r in FS.read_positional_lines(spark, f"{tmp_dir}/p", first_id=1).collect()}
    assert got == dict(enumerate(["a1", "a2", "b0", "b1", "b2", "b3", "b4", "b5"], 1))


def test_missing_tokens_of_a_csv(spark, tmp_dir):
    open(f"{tmp_dir}/m.csv", "w").write("ID,Comments\n1,N/A\n2,NaN\n3,nab\n4,null\n5,\n")
    assert [r.Comments for r in FS.read_inventory_csv(spark, f"{tmp_dir}/m.csv").orderBy("ID").collect()] == [None, None, "nab", None, None]


def test_messages(spark):
    raw = spark.createDataFrame([(x,) for x in (
        '{"event_id": "A-1", "timestamp": "2024-02-01T10:00:00", "location": "x", "volume": 5, "speed": 40.5}',
        '{"event_id": 7, "ts": "2024-02-01 10:00:01", "location": "x", "volume": "many", "average_speed": 30}',
        "{no json", "", None)], "value string")
    got = sorted(tuple(r) for r in S.parse_messages(raw).select("event_id", F.col("ts").cast("string"), "volume", "average_speed", "speed")
                 .collect() if r.event_id)
    assert got == [("7", "2024-02-01 10:00:01", None, 30.0, None), ("A-1", "2024-02-01 10:00:00", 5.0, None, 40.5)]
    assert S.parse_messages(raw).count() + S.rejected_messages(raw).count() == 5
    assert "{no json" in {r.value for r in S.rejected_messages(raw).collect()}
    live = S.latest_metrics(S.enrich(S.parse_messages(raw).where("ts is not null"))).collect()
    assert len(live) == 1 and live[0].expires_at is not None


def test_columns_of_the_target_survive(spark):
    target = spark.createDataFrame([("a", 1, "note a"), ("b", 2, "note b")], "record_id string, v int, note string")
    source = spark.createDataFrame([("b", 20, True), ("c", 30, False)], "record_id string, v int, flag boolean")
    got = {r.record_id: (r.v, r.flag, r.note, r.op) for r in U.merge(target, source, "record_id", ["v"], audit=False).collect()}
    assert got == {"a": (1, None, "note a", "keep"), "b": (20, True, "note b", "update"), "c": (30, False, None, "insert")}


def test_forest_of_a_huge_table(spark):
    """The sampling rate of a table of 1e12 rows still picks hashes: with so many rows claimed, a tree's share of
    the range is far above zero, and of a small table all rows are taken."""
    assert int(2.0 * 256 / 1e12 * I._HASH_RANGE) > 10**9
    df = spark.range(500).select("id", (F.col("id") % 17).cast("double").alias("f"))
    assert I.fit(df, ["f"], "id", trees=5).where("not leaf").count() > 5
    empty = I.detect(df.where("id < 0"), ["f"], "id", trees=3)
    assert empty.count() == 0


def test_empty_tables(spark):
    df = spark.createDataFrame([], "record_id string, average_speed double, posted_speed_limit bigint, volume_vpd bigint, road_type string, percentile_speed_85 double")
    assert Q.quality_score(df).count() == 1 and Q.duplicates(df).collect()[0]["count"] == 0
    assert Q.completeness(df).where("completeness_percentage is null").count() == 6


def test_duplicates_are_counted_exactly(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "a"), (2, "a"), (1, None)], "a int, b string")
    r = Q.duplicates(df).collect()[0]
    assert (r["count"], r.percentage) == (2, 40.0)


def test_spellings(spark):
    nums = spark.createDataFrame([(x,) for x in ("12d", "12f", "7D", "7F", "1e3", " 4.5 ", ".5", "5.", "-3", "inf", "nan", "0x1", "1L")], "x string")
    got = {r.x: (r.i, r.f) for r in nums.select("x", C.to_int("x").alias("i"), C.to_float("x").alias("f")).collect()}
    assert all(got[x] == (0, 0.0) for x in ("12d", "12f", "7D", "7F", "nan", "0x1", "1L"))
    assert got["1e3"] == (1000, 1000.0) and got[" 4.5 "] == (4, 4.5) and got["-3"] == (-3, -3.0) and got[".5"] == (0, 0.5)
    dates = {"1/5/2024 0:00:00": "2024-01-05", "1/5/2024 11:30 PM": "2024-01-05", "1/5/2024 13:30 PM": None, "20240105": "2024-01-05",
             "2024-01-05T23:00:00+00:00": "2024-01-05", "2024-01-05T23:00:00Z": "2024-01-05", "2024/1/5 7:05": "2024-01-05",
             "20241305": None, "1/5/2024": "2024-01-05", "2024-01-05 24:00": None}
    df = spark.createDataFrame([(k,) for k in dates], "x string")
    for out in (df.withColumn("d", C.to_date("x")), C.parse_dates(df, {"d": "x"})):
        assert {r.x: (str(r.d) if r.d else None) for r in out.collect()} == dates


def test_empty_name_matches_every_returned_file(spark):
    local = spark.createDataFrame([("r", ""), ("r", "b.pdf"), ("q", "z")], "record_id string, file_name string")
    returned = spark.createDataFrame([("r", "1", "x/a.pdf"), ("r", "2", "x/b.pdf")], "record_id string, bin_id string, returned_name string")
    got = {(r.record_id, r.file_name, r.bin_id) for r in A.suffix_matches(local, returned).collect()}
    assert got == {("r", "", "1"), ("r", "", "2"), ("r", "b.pdf", "2"), ("q", "z", None)}
    uploads = {r.record_id: json.loads(r.uploads) for r in A.upload_results(local, returned).collect()}
    assert uploads["q"] == [{"filename": "z", "contentType": "application/octet-stream", "BIN_ID": []}]
    assert uploads["r"][1]["BIN_ID"] == [{"bin_id": "2", "file_name": "x/b.pdf"}]


def test_quartiles_are_exact(spark):
    import numpy as np
    from roadlens.operators import report as R
    rng = np.random.default_rng(5)
    sets = {"one": [3.0], "two": [1.0, 2.0], "three": [1.0, 2.0, 9.0], "ties": [5.0] * 50 + [6.0], "many": list(rng.normal(0, 1, 4000)),
            "coarse": [float(x) for x in rng.integers(0, 9, 3000)]}
    df = spark.createDataFrame([(k, float(v)) for k, vs in sets.items() for v in vs], "k string, v double").repartition(4)
    got = {r.k: (r.n, r.q0, r.q1, r.q2) for r in R.quartiles(df, "v", "k").collect()}
    for k, vs in sets.items():
        assert got[k] == pytest.approx((len(vs), *np.percentile(vs, [25, 50, 75]))), k
