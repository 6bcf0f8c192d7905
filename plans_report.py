"""Write PLANS.md: the final (adaptive) physical plan of each headline query, condensed.

Usage: python plans_report.py [sf_dir]   (default /root/testdata/sf0.01)
Each query is executed once so adaptive decisions (broadcasts, coalescing) are
the ones actually taken; the tree keeps operator names, exchanges and scan schemas.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stratum.plans.registry import QUERIES  # noqa: E402
from stratum.session import get_spark  # noqa: E402

HEADLINE = ["silver", "fact", "dim_location", "monthly_metrics", "borough_metrics",
            "page_numbers", "incremental_window", "check_relationships"]


def condensed(plan: str) -> str:
    out = []
    for line in plan.splitlines():
        m = re.match(r"^([\s:+\-|]*)(\*\(\d+\) )?(\w+)", line)
        if not m:
            continue
        indent, codegen, op = m.group(1), m.group(2) or "", m.group(3)
        body = re.sub(r"#\d+L?", "", line[len(indent) + len(codegen):])
        detail = ""
        if op in ("Exchange", "BroadcastExchange"):
            detail = " " + body.split(" ", 1)[1][:100] if " " in body else ""
        elif op == "FileScan":
            schema = re.search(r"ReadSchema: (struct<[^>]*>)", body)
            pushed = re.search(r"PushedFilters: (\[[^\]]*\])", body)
            detail = (f" {schema.group(1) if schema else ''}"
                      f"{' pushed=' + pushed.group(1)[:120] if pushed and pushed.group(1) != '[]' else ''}")
        elif op == "WindowGroupLimit":
            detail = " (Partial)" if "Partial" in body else " (Final)" if "Final" in body else ""
        out.append(f"{indent}{codegen}{op}{detail}")
    return "\n".join(out)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark(app_name="stratum-plans")
    parts = ["# Physical plans (final adaptive plans, condensed)\n",
             f"Generated by `python plans_report.py {sf}` on local[8]. Exchanges are the "
             "shuffles; `BroadcastExchange` only appears for the size-proven calendar or where "
             "adaptive execution measured a small side at runtime. `*(n)` marks operators "
             "fused into whole-stage codegen stage n; the final plans of adaptive queries "
             "print their stages without these markers.\n"]
    for name in HEADLINE:
        df = QUERIES[name](spark, sf)
        df.collect()        # on the frame itself: only then does its plan hold what ran
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "AdaptiveSparkPlan" not in plan or "isFinalPlan=true" in plan
        plan = plan.split("== Initial Plan ==")[0]
        parts.append(f"## {name}\n\n```\n{condensed(plan)}\n```\n")
    with open(os.path.join(os.path.dirname(os.path.abspath(__file__)), "PLANS.md"), "w") as f:
        f.write("\n".join(parts))
    spark.stop()


if __name__ == "__main__":
    main()
