"""Write PLANS.md: final (AQE) physical plans of the headline queries, with scan details.

Usage: python tools/plans.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from regstar.plans.queries import QUERIES  # noqa: E402
from regstar.session import local_session  # noqa: E402

NAMES = ["silver", "dim_vehicle", "match_tiers", "fact_star", "v_fact", "keep_latest_events"]


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8, 8)
    out = ["# Physical plans", "",
           f"Final adaptive plans after running each query once at `{os.path.basename(sf)}` "
           "(`tools/plans.py`). Scan lines show the columns read and the filters pushed into parquet.", ""]
    for name in NAMES:
        df = QUERIES[name](spark, sf)
        df.collect()  # run through this DataFrame so the explain shows the final adaptive plan
        text = formatted(df)
        tree = text.split("\n\n")[0]
        scans = [ln for ln in text.splitlines() if ln.startswith(("ReadSchema", "PushedFilters"))]
        out += [f"## {name}", "", "```", tree.strip(), "```", ""]
        if scans:
            out += ["Scans:", "", "```", *sorted(set(scans)), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))


if __name__ == "__main__":
    main()
