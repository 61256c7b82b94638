"""Sources and sinks round trips on small files."""

import json
import os

from pyspark.sql import functions as F

from roadlens.operators import attachments as A
from roadlens.operators import etl as E
from roadlens.sinks import writers as W
from roadlens.sources import files as FS


def test_csv_all_strings_and_canonical(spark, tmp_dir):
    p = f"{tmp_dir}/inv.csv"
    open(p, "w").write('ID,Location - Street Name1,Volume (vpd),Date Data Received,Comments\n'
                       ' A-001 ,Main St,1200.7,2024/01/05,"said ""hi"""\n'
                       ',Oak Ave,5,,\n'
                       'A-002,,abc,2024-02-30,x\n')
    raw = FS.read_inventory_csv(spark, p)
    assert all(t == "string" for _, t in raw.dtypes)
    rows = E.canonicalize(raw).orderBy("record_id").collect()
    assert [r.record_id for r in rows] == ["A-001", "A-002"]
    assert rows[0].volume_vpd == 1200 and str(rows[0].received_analysis_date) == "2024-01-05"
    assert rows[0].comments == 'said "hi"' and rows[1].volume_vpd == 0
    assert rows[1].received_analysis_date is None and rows[1].estimated_cost == 0.0


def test_json_shapes(spark, tmp_dir):
    a = f"{tmp_dir}/a.json"
    b = f"{tmp_dir}/b.json"
    json.dump({"records": [{"recordId": "A-1", "volume": "12", "meta": {"x": 1}}]}, open(a, "w"))
    json.dump([{"recordId": "B-1", "volume": 7}], open(b, "w"))
    ra = FS.read_export_json(spark, a)
    rb = FS.read_export_json(spark, b)
    assert ra.collect()[0].recordId == "A-1"
    assert E.canonicalize(rb).collect()[0].volume_vpd == 7
    flat = FS.flatten(ra)
    assert "meta.x" in flat.columns


def test_reference_names(spark, tmp_dir):
    p1, p2 = f"{tmp_dir}/r1.txt", f"{tmp_dir}/r2.txt"
    open(p1, "w").write(" Main Street \n\nn/a\nOak Avenue\n")
    open(p2, "w").write("N/A\nPine Road\n")
    got = [r.ref_name for r in FS.read_reference_names(spark, [p1, p2]).orderBy("file_pos", "line_pos").collect()]
    assert got == ["Main Street", "Oak Avenue", "Pine Road"]


def test_attachment_folder_and_sinks(spark, tmp_dir):
    base = f"{tmp_dir}/att"
    for rid, names in {"A-001": ["x.pdf", "y.png"], "B-002": ["z.txt"]}.items():
        os.makedirs(f"{base}/{rid}")
        for n in names:
            open(f"{base}/{rid}/{n}", "w").write(n)
    files = FS.read_attachment_folder(spark, base)
    assert sorted((r.record_id, r.file_name) for r in files.collect()) == [
        ("A-001", "x.pdf"), ("A-001", "y.png"), ("B-002", "z.txt")]
    ups = {r.record_id: json.loads(r.uploads) for r in A.uploads_per_record(files).collect()}
    assert ups["A-001"] == [{"filename": "x.pdf", "contentType": "application/pdf"},
                            {"filename": "y.png", "contentType": "image/png"}]
    W.write_files_per_record(files, f"{tmp_dir}/out_files")
    assert os.path.isdir(f"{tmp_dir}/out_files/record_id=A-001")
    W.write_id_list(files.select("record_id").distinct(), f"{tmp_dir}/ids")
    assert sorted(r.value for r in spark.read.text(f"{tmp_dir}/ids").collect()) == ["A-001", "B-002"]
    W.write_json_records(files.select("record_id", "file_name", F.lit(None).cast("string").alias("n")),
                         f"{tmp_dir}/json")
    first = json.loads(spark.read.text(f"{tmp_dir}/json").first().value)
    assert "n" in first and first["n"] is None
    env = W.keyed_envelope(files.select("record_id", "file_name"), "record_id")
    assert json.loads(env.first().value).keys() == {"record_id", "file_name"}


def test_first_files_and_suffix(spark):
    files = spark.createDataFrame([("r", f"f{i:02d}.txt") for i in range(20)] + [("s", "a.txt")],
                                  "record_id string, file_name string")
    got = A.first_files(files, k=8, salt_buckets=4).collect()
    assert sorted(r.file_name for r in got if r.record_id == "r") == [f"f{i:02d}.txt" for i in range(8)]
    ret = spark.createDataFrame([("r", "up/f01.txt", "B1"), ("r", "up/xf01.txt", "B2"), ("s", "up/b.txt", "B3")],
                                "record_id string, returned_name string, bin_id string")
    m = A.suffix_matches(files, ret).collect()
    hits = sorted((r.file_name, r.bin_id) for r in m if r.bin_id)
    assert hits == [("f01.txt", "B1"), ("f01.txt", "B2")]
    assert sum(1 for r in m if r.file_name == "a.txt" and r.bin_id is None) == 1


def test_spread_only_when_scan_is_narrow(spark, tmp_dir):
    from roadlens.sources.tables import spread
    narrow = spark.range(100).coalesce(1)
    assert spread(narrow).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    wide = spark.range(100).repartition(spark.sparkContext.defaultParallelism * 2)
    assert spread(wide).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism * 2
