"""Settings that a query brings to a session built elsewhere."""

from roadlens.plans import load_all
from tests.conftest import SF_SMALL

LIMIT = "spark.sql.codegen.hugeMethodLimit"


def test_queries_limit_the_size_of_methods(spark):
    """A default session lets methods through that HotSpot never compiles; a lower limit stays."""
    for name in ("canonical_records", "address_standardise", "nested_reports", "event_envelope"):
        other = spark.newSession()
        other.conf.set(LIMIT, "65535")
        load_all()[name].build(other, SF_SMALL)
        assert other.conf.get(LIMIT) == "8000"
    other.conf.set(LIMIT, "5000")
    load_all()["address_standardise"].build(other, SF_SMALL)
    assert other.conf.get(LIMIT) == "5000"
