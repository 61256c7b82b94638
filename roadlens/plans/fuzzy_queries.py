"""Fuzzy street-name matching queries (no SQL form: rows-only checks, and a
brute-force comparison in the tests)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from roadlens import fixed_values as fv
from roadlens.operators import etl as E
from roadlens.operators import fuzzy as Z

from roadlens.plans.registry import register, with_views
from roadlens.session import scratch_path
from roadlens.sources import files as FS
from roadlens.sources import tables as T


def _refs(spark, sf):
    """Reference names; their list position is the alphabetical order, so the name itself."""
    return T.street_refs(spark, sf).withColumn("ref_pos", F.col("ref_name"))


# What SQL can say about a match: one row per name; a reference equal but for case has ratio 1 and is taken;
# a name without any reference in its length band stays.
_NAMES_SQL = """
WITH n AS (SELECT DISTINCT street_name AS name FROM devices WHERE street_name IS NOT NULL),
r AS (SELECT DISTINCT p_name || ' Street' AS ref FROM part),
x AS (SELECT name, count(*) FILTER (WHERE lower(ref) = lower(name)) > 0 AS exact,
        count(*) FILTER (WHERE length(ref) BETWEEN ceil(length(name) * (0.7 / 1.3)) AND floor(length(name) * (1.3 / 0.7))) = 0 AS alone
      FROM n, r GROUP BY name)
SELECT name, exact, alone, true AS as_stated FROM x"""


@register("fuzzy_lookup", ("J1", "W3", "F1"))
def q_fuzzy_lookup(spark, sf):
    """Canonical records with the three street fields replaced by their best
    reference name (ratio >= 0.7, lower-cased comparison)."""
    canon = E.canonicalize(E.raw_inventory(T.devices(spark, sf)))
    out = Z.apply_matches(canon, ["street_name", "intersection1", "intersection2"], _refs(spark, sf))
    return out.select("record_id", "street_name", "intersection1", "intersection2", "road_type")


@register("fuzzy_names", ("J1", "W3"))
def q_fuzzy_names(spark, sf):
    """The distinct-name mapping itself: name, best reference, ratio, output."""
    d = T.devices(spark, sf)
    names = d.select(F.col("street_name").alias("name"))
    return Z.best_matches(names, _refs(spark, sf))


@register("fuzzy_invariants", ("J1",), with_views(_NAMES_SQL, "devices"))
def q_fuzzy_invariants(spark, sf):
    """The mapping held against what is certain about it (see the oracle)."""
    m = q_fuzzy_names(spark, sf)
    refs = T.street_refs(spark, sf)
    exact = m.join(refs.select(F.lower("ref_name").alias("low")).distinct(), F.lower("name") == F.col("low"), "left")
    lo, hi = Z.length_band(F.length("name"), fv.FUZZY_THRESHOLD)
    lengths = refs.select(F.length("ref_name").alias("len")).distinct()
    near = (m.select("name").join(lengths, F.col("len").between(lo, hi)).select("name").distinct()
             .withColumn("__near", F.lit(True)))
    out = exact.join(near, "name", "left")
    is_exact, alone = F.col("low").isNotNull(), F.col("__near").isNull()
    ok = (F.when(is_exact, (F.col("ratio") == 1) & (F.lower("matched") == F.lower("name")))
           .when(alone, F.col("ratio").isNull() & (F.col("matched") == F.col("name")))
           .otherwise(F.coalesce(F.col("ratio") >= fv.FUZZY_THRESHOLD, F.col("matched") == F.col("name"))))
    return out.select("name", is_exact.alias("exact"), alone.alias("alone"), ok.alias("as_stated"))


@register("fuzzy_positional", ("J2", "S5", "S6", "U2"))
def q_fuzzy_positional(spark, sf):
    """Line-file matching: the distinct street names of the inventory and two
    reference lists are written as text files (in the shared checkpoint
    folder), read back positionally and matched case-sensitively."""
    base = scratch_path(spark, f"streets-{uuid.uuid4().hex[:12]}")
    d = T.devices(spark, sf)
    d.select("street_name").distinct().orderBy("street_name").write.mode("overwrite").text(f"{base}/bad")
    refs = T.street_refs(spark, sf)
    early = F.col("ref_name") < "m"
    for n, part in enumerate((refs.where(early), refs.where(~early))):
        part.orderBy("ref_name").write.mode("overwrite").text(f"{base}/good{n}")
    bad = FS.read_positional_lines(spark, f"{base}/bad")
    good = FS.read_reference_names(spark, [f"{base}/good0", f"{base}/good1"]).select(
        F.struct("file_pos", "line_pos").alias("row_id"), F.col("ref_name").alias("line"))
    return Z.positional_replace(bad, good)
