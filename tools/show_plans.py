"""Print the final (adaptive) physical plan of the headline batch queries.

Usage: python tools/show_plans.py [sf_dir] [name ...]
Runs each query once (noop sink is not enough: the plan is taken from the
query's own execution) and prints its executed plan, so exchanges, broadcast
joins, hash aggregates, pushed filters and codegen stages can be checked.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

HEADLINE = ["dwd_video_wide", "session_metrics", "rule_match", "completion_once"]


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or HEADLINE
    from watchtally.session import build_spark
    from watchtally.plans.catalog import registry
    spark = build_spark("local[8]")
    for name in names:
        df = registry()[name](spark, sf_dir)
        df.collect()
        final = df._jdf.queryExecution().executedPlan().toString()
        print(f"===== {name}")
        print(final.split("+- == Initial Plan ==")[0])
        print(spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
              .split("\n\n(")[0])


if __name__ == "__main__":
    main(sys.argv)
