"""Write the formatted physical plans of the headline queries to PLANS.md.

Usage: python tools/explain_plans.py [sf_dir]
"""
import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from roadlens.plans import load_all  # noqa: E402
from roadlens.session import build_session  # noqa: E402

QUERIES = ["road_profile", "overview", "alerts_union", "kpi_cards", "box_summary", "volume_pivot", "canonical_records",
           "dataset_score", "upsert_merge", "address_standardise", "nested_export", "suffix_match", "latest_metric",
           "live_lookup", "fuzzy_lookup", "linear_predictions", "isolation_forest", "first_8_files", "business_rules"]


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=16)
    reg = load_all()
    out = ["# Physical plans of headline queries", "",
           f"`explain('formatted')` at `{sf}` on local[8] (adaptive plans before execution).", ""]
    for name in QUERIES:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            reg[name].build(spark, sf).explain("formatted")
        out += [f"## {name}", "", "```", buf.getvalue().strip(), "```", ""]
    open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w").write(
        "\n".join(out))


if __name__ == "__main__":
    main()
