"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full into Spark's ``noop`` sink (every row is
computed, nothing is collected) and timed.  The first run of a query also
pays JVM warm-up (JIT of the code paths it touches, code generation); the
reported time is the best of $BENCH_REPEAT runs (default 2, i.e. warm), and
the first-run times are reported separately as ``cold``.  Prints one JSON
line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from roadlens.plans import load_all  # noqa: E402
from roadlens.session import build_session  # noqa: E402

HEADLINE = [
    "canonical_records",   # batch ETL: scan, join, coerce (the 1000 records/s claim)
    "road_profile",        # flagship dashboard aggregate
    "overview",
    "alerts_union",
    "kpi_cards",
    "box_summary",
    "volume_pivot",
    "dataset_score",       # fused quality passes
    "upsert_merge",        # keyed merge
    "address_standardise",
    "nested_export",
    "suffix_match",
    "latest_metric",
    "live_lookup",
    "fuzzy_lookup",
    "linear_regression",
    "isolation_forest",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "2")))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    scratch = tempfile.mkdtemp(prefix="roadlens-bench-")
    spark = build_session(f"local[{cpus}]", app_name="roadlens-bench", shuffle_partitions=cpus * 2,
                          extra={"spark.checkpoint.dir": f"{scratch}/ckpt",
                                 "spark.local.dir": f"{scratch}/local",
                                 "spark.driver.memory": "16g"})
    reg = load_all()
    names = only or HEADLINE
    # Warm-up: JVM, parquet footers, Python workers.
    reg["road_profile"].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
    times, cold = {}, {}
    for name in names:
        runs = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            reg[name].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        times[name] = round(min(runs), 3)
        cold[name] = round(runs[0], 3)
    rows = spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet").count()
    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {
        "metric": "headline_total_sec",
        "value": total,
        "unit": "sec",
        "queries": times,
        "cold": cold,
        "cold_total_sec": round(sum(cold.values()), 3),
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "etl_records_per_sec": round(rows / times["canonical_records"], 1) if "canonical_records" in times else None,
        "cpus": cpus,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
