"""Every query with an oracle matches DuckDB on the sf0.001 tables; the
rows-only queries run; the entry point returns rows."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as ENTRY
from roadlens.sources.tables import TABLES

SF = "/root/testdata/sf0.001"


def _canon(v):
    if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        v = v.item()
    if isinstance(v, float):
        return str(int(v)) if v.is_integer() and abs(v) < 2 ** 53 else repr(round(v, 9))
    if isinstance(v, pd.Timestamp):
        v = v.to_pydatetime()
    if hasattr(v, "isoformat"):
        s = v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
        return s[:-9] if s.endswith(" 00:00:00") else s
    return str(v)


def _rows(df):
    cols = sorted(df.columns)
    return sorted("|".join(_canon(x) for x in rec) for rec in df[cols].itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _with_sql():
    from roadlens.plans import load_all
    return sorted(n for n, q in load_all().items() if q.oracle)


@pytest.mark.parametrize("name", _with_sql())
def test_query_matches_oracle(spark, duck, name):
    got = ENTRY.queries()[name](spark, SF).toPandas()
    want = duck.execute(ENTRY.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert _rows(got) == _rows(want)


def _device_count(duck):
    return duck.execute("SELECT count(*) FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey").fetchall()[0][0]


def _flag_rate(df, duck):
    """The contamination, give or take ties at the quantile; every row is scored."""
    assert len(df) == _device_count(duck) and 0.05 <= df.is_anomaly.mean() <= 0.15


def _classes(df, duck):
    assert sorted(df.road_type) == ["Arterial", "Collector", "Highway", "Residential"]
    assert df.total_locations.sum() == _device_count(duck)


def _ensemble(df, duck):
    assert len(df) == _device_count(duck) and df.predicted_volume.notna().all() and (df.confidence <= 1).all()


def _importance(df, duck):
    assert df.groupby("model").importance.sum().round(6).eq(1.0).all() and len(df) == 12


def _canonical(df, duck):
    assert len(df) == _device_count(duck) and df.street_name.str.endswith("Street").any()


def _mapping(df, duck):
    assert df.name.is_unique and ((df.ratio.isna()) | (df.ratio >= 0.7)).all()
    assert (df.matched == df.best_ref.fillna(df.name)).all()


def _positional(df, duck):
    assert sorted(df.row_id) == list(range(371, 371 + len(df))) and df.original.is_monotonic_increasing


def _sections(df, duck):
    got = dict(zip(df.section, df.entries, strict=True))
    assert got["completeness"] == got["data_types"] == 22 and got["score"] == got["duplicates"] == 1


INVARIANTS = {"isolation_forest": _flag_rate, "forest_anomaly_summary": _classes, "boosted_ensemble": _ensemble,
              "feature_importance": _importance, "fuzzy_lookup": _canonical, "fuzzy_names": _mapping,
              "fuzzy_positional": _positional, "quality_report_sections": _sections}


def test_every_query_is_checked():
    """Queries without SQL have an invariant here; those of the subpackage have tests of their own."""
    from roadlens.plans import load_all
    assert {n for n, q in load_all().items() if not q.oracle} == set(INVARIANTS)


@pytest.mark.parametrize("name", sorted(INVARIANTS))
def test_invariants(spark, duck, name):
    INVARIANTS[name](ENTRY.queries()[name](spark, SF).toPandas(), duck)


def test_entry(spark):
    df = ENTRY.entry(spark)
    rows = df.collect()
    assert len(rows) == 4 and set(df.columns) >= {"road_type", "volume_mean", "speed_violations"}
