"""Benchmark the headline queries.

Runs each query at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS] and forces full evaluation with the `noop` sink (nothing is
collected to the driver). Every query is first run once on the smallest test
scale to warm the JVM and Python workers; the timed pass runs once. Also
times one complete daily run: compute, publish three tables as new snapshot
versions, run the quality checks.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from followrec.params import Params  # noqa: E402
from followrec.plans.pipeline import run_daily  # noqa: E402
from followrec.plans.queries import REGISTRY  # noqa: E402
from followrec.session import build_session, scratch_path  # noqa: E402
from followrec.sources import testdata as td  # noqa: E402

HEADLINE = [
    "closest_connections",
    "second_degree_join",
    "final_recommendations",
    "final_reasons",
    "clean_text",
    "weekly_text",
    "reputation_score",
    "token_vocabulary",
    "pad_sequences",
    "upsert_reasons",
]


def run_noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus, app="followrec-bench")
    # warm-up of every timed code path (JIT, class loading, Python workers)
    # on the smallest scale; the timed pass below runs once
    warm = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm):
        for name in HEADLINE:
            run_noop(REGISTRY[name](spark, warm))
    times = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        run_noop(REGISTRY[name](spark, sf_dir))
        times[name] = round(time.perf_counter() - t0, 3)
    t0 = time.perf_counter()
    run_daily(spark, td.map_feeds(spark, sf_dir), td.map_messages(spark, sf_dir),
              Params(), scratch_path(spark, "bench-publish"))
    times["daily_run_publish_checks"] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "total_headline_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
