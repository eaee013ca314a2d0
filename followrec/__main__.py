"""Run one day: python -m followrec --feeds DIR --messages PATH --as-of YYYY-MM-DD ...

Reads the day's feeds (follow, reply, mention, like, user CSVs) and the
message JSON lines, computes, publishes the three tables as new snapshot
versions under --publish, runs the checks and prints the check report.
Exit status 1 when a check fails.
"""

from __future__ import annotations

import argparse
import sys
from datetime import datetime

from pyspark.sql import SparkSession

from followrec.operators import quality as dq
from followrec.operators import reputation as rp
from followrec.params import Params
from followrec.plans.pipeline import run_daily
from followrec.sources import read_feeds, read_messages


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="followrec")
    ap.add_argument("--feeds", required=True, help="folder with the day's feed CSVs")
    ap.add_argument("--messages", required=True, help="message JSON lines to score")
    ap.add_argument("--training-messages", help="labelled message JSON lines")
    ap.add_argument("--as-of", required=True, help="run time, YYYY-MM-DD[THH:MM:SS] (UTC)")
    ap.add_argument("--publish", required=True, help="root of the published tables")
    ap.add_argument("--outputs", help="root for the day's CSV files (yyyyMMdd folders)")
    ap.add_argument("--model", help="saved text model folder (fitted there if missing)")
    ap.add_argument("--label-share", action="store_true",
                    help="score weeks by their label share instead of a model")
    ap.add_argument("--lookback-days", type=int, default=90)
    ap.add_argument("--n-closest", type=int, default=50)
    ap.add_argument("--n-rec", type=int, default=20)
    ap.add_argument("--min-score", type=float, default=0.75)
    a = ap.parse_args(argv)

    spark = SparkSession.builder.appName("followrec-daily").getOrCreate()
    params = Params(as_of=datetime.fromisoformat(a.as_of), lookback_days=a.lookback_days,
                    n_closest=a.n_closest, n_rec=a.n_rec, min_score=a.min_score)
    scorer = rp.label_share_scorer if a.label_share else rp.SparkMLScorer(model_path=a.model)
    training = read_messages(spark, a.training_messages) if a.training_messages else None
    try:
        report = run_daily(spark, read_feeds(spark, a.feeds), read_messages(spark, a.messages),
                           params, a.publish, scorer=scorer, training_messages=training,
                           outputs_root=a.outputs)
    except dq.DataQualityError as e:
        print(f"data quality check failed: {e}", file=sys.stderr)
        return 1
    report.show(truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
