"""Print the formatted physical plan of registered queries.

Usage: python scripts/explain_plans.py [data_dir] [key ...]
Flags nested-loop or cartesian joins, and reports the number of exchanges
per plan, before printing it.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from salesmart.plans import queries as Q  # noqa: E402
from salesmart.session import build_session  # noqa: E402


def main() -> None:
    data_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or ["report_sales", "fx_convert", "multi_source_window", "load_summary"]
    spark = build_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    reg = Q.registry()
    for k in keys:
        df = reg[k](spark, data_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        bad = [w for w in ("NestedLoop", "Cartesian") if w in plan]
        print(f"=== {k}: exchanges={plan.count('Exchange')} flagged={bad}")
        df.explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()
