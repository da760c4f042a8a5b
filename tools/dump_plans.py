"""Write the physical plans of the model queries to docs/PLANS.md.

usage: python tools/dump_plans.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from sitelens.plans.pipeline import lazy_models_for  # noqa: E402
from sitelens.session import get_session  # noqa: E402

MODELS = ["stg_traffic", "organizations_enhanced", "traffic_enhanced", "company_web_bridge",
          "mart_company_performance", "mart_company_timeseries", "mart_category_insights"]


def tree(df) -> str:
    """The operator tree plus, for every parquet scan, its pushed filters and read schema."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    lines = buf.getvalue().split("\n")
    head = []
    for ln in lines:
        if not ln.strip() and head:
            break
        head.append(ln)
    scans, current = [], None
    for ln in lines[len(head):]:
        if re.match(r"^\(\d+\) Scan parquet", ln):
            current = [ln.strip()]
            scans.append(current)
        elif current is not None and ln.startswith(("PushedFilters", "ReadSchema")):
            current.append(ln[:400])
        elif not ln.strip():
            current = None
    return "\n".join(head + [""] + ["\n".join(s) for s in scans])


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", 8)
    m = lazy_models_for(spark, sf_dir)
    out = ["# Physical plans", "",
           f"`python tools/dump_plans.py {sf_dir}` - every model planned end to end from the raw inputs "
           "(nothing materialized), Spark 4.1.2, AQE on (the initial plan; AQE may coalesce partitions "
           "and turn joins into broadcast joins at run time).", ""]
    for name in MODELS:
        out += [f"## {name}", "", "```", tree(getattr(m, name)), "```", ""]
    with open(os.path.join(ROOT, "docs", "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))


if __name__ == "__main__":
    main()
