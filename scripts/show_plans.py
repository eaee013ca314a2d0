"""Write the final (post-AQE) physical plans of the headline queries.

usage: python scripts/show_plans.py [sf_dir] > docs/PLANS.md
Broadcast joins are switched off (as when the join sides are large), each
query is executed, and the adaptive plan Spark actually ran is printed.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from followrec.plans.queries import REGISTRY  # noqa: E402
from followrec.session import build_session  # noqa: E402

NAMES = ["closest_connections", "final_reasons", "pad_sequences", "upsert_reasons"]


def final_plan(df) -> str:
    """The final part of the adaptive plan, without the plan it started from."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return "\n".join(line[:160] for line in plan.split("+- == Initial Plan ==")[0].splitlines())


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    print("# Final physical plans\n")
    print(f"Generated by `scripts/show_plans.py` on {os.path.basename(sf_dir)} with "
          "`spark.sql.autoBroadcastJoinThreshold=-1` (sort-merge joins, as for "
          "large sides), AQE on, 8 shuffle partitions. Each query was executed; the plans below are the adaptive "
          "plans Spark ran (`isFinalPlan=true`).\n")
    for name in NAMES:
        print(f"## {name}\n\n```")
        print(final_plan(REGISTRY[name](spark, sf_dir)).rstrip())
        print("```\n")


if __name__ == "__main__":
    main()
