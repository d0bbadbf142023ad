"""Write the formatted physical plan of every registered query to docs/plans/<name>.txt (after one
execution, so the adaptive plan shows its final shape).  Usage:
python tools/explain_plans.py [data_dir] [name ...]"""

from __future__ import annotations

import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from headway.plans.registry import registry  # noqa: E402
from headway.session import build_session  # noqa: E402


def main() -> None:
    data_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    out = os.path.join(ROOT, "docs", "plans")
    os.makedirs(out, exist_ok=True)
    spark = build_session()
    for name, q in registry().items():
        if only and name not in only:
            continue
        df = q(spark, data_dir)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        with open(os.path.join(out, f"{name}.txt"), "w") as f:
            f.write(plan)
        print(name, "ok", flush=True)


if __name__ == "__main__":
    main()
