"""Write the executed (post-adaptive) physical plans of the main queries to
docs/PLANS.md.  usage: python tools/dump_plans.py [sf_dir]"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from panelkit.plans import catalog  # noqa: E402
from panelkit.session import build_session  # noqa: E402

NAMES = ("j05_model_table", "c04_build_panel", "c05_yearly_indicators", "c06_monthly_indicators",
         "d01_dedup_by_key", "f01_encode_categories", "j02_prior_value", "m04_fit_per_class_regression")


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]")
    out = ["# Physical plans", "",
           f"Executed plans (after adaptive re-planning) of the main queries at `{os.path.basename(sf)}`, "
           "written by `tools/dump_plans.py`. Scans of stages materialized by an earlier step show up as reads "
           "of the Parquet tables in the shared checkpoint folder.", ""]
    for name in NAMES:
        df = catalog.QUERIES[name](spark, sf)
        df.collect()  # runs this DataFrame's own execution, so the plan below is the final adaptive one
        plan = df._jdf.queryExecution().executedPlan().toString()
        plan = "\n".join(line[:220] for line in plan.splitlines())
        out += [f"## {name}", "", "```", plan, "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "PLANS.md")
    with open(path, "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
