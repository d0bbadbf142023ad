"""Summarise docs/plans/*.txt (formatted physical plans) into docs/PLANS.md: per query the number
of shuffles, broadcasts, sort-merge joins, window group limits and Python (Arrow) steps."""

from __future__ import annotations

import os
import re

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
PLANS = os.path.join(ROOT, "docs", "plans")


def count(text: str, pattern: str) -> int:
    return len(re.findall(pattern, text, flags=re.M))


def main() -> None:
    rows = []
    for f in sorted(os.listdir(PLANS)):
        text = open(os.path.join(PLANS, f)).read()
        tree = text.split("\n\n")[0]  # the operator tree printed before the node details
        tree = tree.split("== Initial Plan ==")[0]  # adaptive plans print the final plan first
        rows.append((f[:-4],
                     count(tree, r"\bExchange \("),
                     count(tree, r"BroadcastExchange \("),
                     count(tree, r"SortMergeJoin"),
                     count(tree, r"WindowGroupLimit"),
                     count(tree, r"BroadcastNestedLoopJoin|CartesianProduct"),
                     count(tree, r"MapInArrow|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas|PythonMapInArrow"),
                     count(tree, r"Scan parquet|Scan binaryFile|Scan csv")))
    out = ["# Physical plans (sf0.01, after adaptive execution)", "",
           "Counts from the formatted plans in `docs/plans/` (generated by `tools/explain_plans.py`).",
           "Subquery plans (scalar subqueries) are printed separately and not counted here.", "",
           "| query | shuffles | broadcasts | sort-merge joins | window group limits | nested-loop / cartesian | Python steps | scans |",
           "|---|---|---|---|---|---|---|---|"]
    out += [f"| `{r[0]}` | {r[1]} | {r[2]} | {r[3]} | {r[4]} | {r[5]} | {r[6]} | {r[7]} |" for r in rows]
    with open(os.path.join(ROOT, "docs", "PLANS.md"), "w") as fh:
        fh.write("\n".join(out) + "\n")


if __name__ == "__main__":
    main()
