"""Write PLANS.md: the physical plan (operators, exchanges, pushed filters,
read schemas) of the headline queries at a given scale."""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pluvio.plans import load_all  # noqa: E402
from pluvio.session import get_session  # noqa: E402

NAMES = ["feature_table", "feature_table_chunked", "weather_feature_table", "streak_single_series", "roc_auc", "cv_expanding",
         "upsert_latest", "monitor_metrics", "payload_to_rows", "forecast_vs_actual"]


def clean(line: str) -> str:
    line = re.sub(r"#\d+L?", "", line)
    line = re.sub(r"\[plan_id=\d+\]", "", line)
    line = re.sub(r"Location: InMemoryFileIndex\(1 paths\)\[[^\]]*\]", "", line)
    return line.rstrip()[:220]


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", shuffle_partitions=8)
    q, _ = load_all()
    out = ["# Physical plans of headline queries", "",
           f"Generated by `tools/plans.py` at `{sf}` (initial plan; AQE may coalesce partitions or switch a",
           "sort-merge join to broadcast at run time). Expression ids and paths stripped.", ""]
    for n in NAMES:
        plan = q[n](spark, sf)._jdf.queryExecution().executedPlan().toString()
        lines = [clean(ln) for ln in plan.split("\n") if ln.strip()]
        n_ex = sum("Exchange" in ln for ln in lines)
        out += [f"## {n}", "", f"Exchanges: {n_ex}", "", "```", *lines, "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
