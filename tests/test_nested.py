"""The export's old columns, whatever their types and texts."""

import json

from pyspark.sql import functions as F

from roadlens import fixed_values as fv
from roadlens.operators import nested as N
from tests.conftest import SF_SMALL


def test_old_columns_as_texts(spark):
    """Dates, whole numbers and texts: a text that reads as a date is written yyyy-MM-dd, other text is cleaned."""
    df = spark.sql("""select * from values
      (1, date'2020-02-03', 45L, '2020/2/3', 'a\\tb'), (2, date'0000-06-01', 20200203L, '12', ' 2020-02-03'),
      (3, date'-0005-06-01', -7L, '1/1/76', '2020-02-03x'), (4, cast(null as date), cast(null as bigint), cast(null as string), '')
      as t(k, old_0, old_1, old_2, old_3)""")
    got = {r["k"]: tuple(r)[1:] for r in N._old_texts(df, [f"old_{i}" for i in range(4)]).select("k", *[f"__old_{i}" for i in range(4)]).collect()}
    year0 = df.filter("k = 2").select(F.date_format("old_0", "yyyy-MM-dd")).first()[0]
    assert got == {1: ("2020-02-03", "45", "2020-02-03", "ab"), 2: (year0, "2020-02-03", "12", " 2020-02-03"),
                   3: ("-0005-06-01", "-7", "1976-01-01", "2020-02-03x"), 4: ("", "", "", "")}


def test_export_is_stored_small(spark, tmp_dir):
    """A session built elsewhere writes the export with the field names found again (they were most of its files)."""
    from roadlens.plans import load_all
    other = spark.newSession()
    other.conf.set("spark.sql.parquet.compression.codec", "snappy")
    df = load_all()["nested_export"].build(other, SF_SMALL)
    assert other.conf.get("spark.sql.parquet.compression.codec") == "zstd"
    df.limit(2000).write.parquet(f"{tmp_dir}/zstd")
    df.limit(2000).write.option("compression", "snappy").parquet(f"{tmp_dir}/snappy")

    def size(path):
        import pathlib
        return sum(p.stat().st_size for p in pathlib.Path(path).glob("*.parquet"))
    assert size(f"{tmp_dir}/zstd") * 2 < size(f"{tmp_dir}/snappy")
    assert len(json.loads(df.first()["json"])["legacy_data"]) == len(fv.LEGACY_DEVICE_FIELDS) + len(fv.LEGACY_OLD_FIELDS)


def test_rows_without_a_text_to_read_are_not_read(spark):
    """No text of such a row goes into an array; other rows are read as before."""
    df = spark.sql("""select * from values (1, 'v1', 'a\tb'), (2, cast(null as string), '2020/2/3'), (3, '2020-02-03', 'v\r\n'),
      (4, '', ' '), (5, 'x\ufffd', cast(null as string)) as t(k, old_0, old_1)""")
    out = N._old_texts(df, ["old_0", "old_1"])
    got = {r["k"]: (r["__old_dates"], r["__old_0"], r["__old_1"]) for r in out.collect()}
    assert got == {1: (None, "v1", "ab"), 2: ([None, "2020-02-03"], "", "2020-02-03"), 3: (["2020-02-03", None], "2020-02-03", "v"),
                   4: (None, "", " "), 5: (None, "x", "")}
