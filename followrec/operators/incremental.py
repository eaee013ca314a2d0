"""Decayed sums from daily summaries.

The weight of an engagement is linear in its time, so the sum of a pair over
any set of days follows from a count and a sum of times:

    sum(L - (as_of - t)) = n * (L - as_of) + sum(t)

Each complete day is summarised once per (user, target): n and the sum of
epoch seconds. A later run reads summaries for every day that lies wholly
inside the window, and raw engagements only for the day on the window's edge
(some of its engagements may already weigh nothing) and from the run's own day
on (still growing, and engagements may be dated ahead). So a run reads the raw
feeds of two days instead of `lookback_days`, and for old days one row per pair
instead of one per engagement. All sums are exact integers: the result equals
`closest.closest_connections` over the raw feeds.

Layout: `<root>/raw/ds=yyyyMMdd` (user_id, engaged_with_user_id, ts, source),
`<root>/daily/ds=yyyyMMdd` (user_id, engaged_with_user_id, n, sum_ts).
A day that late rows were added to is summarised again by naming it in `days`.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from followrec.functions import date_folder, epoch_seconds
from followrec.operators import closest as cl
from followrec.params import Params
from followrec.sources.feeds import Feeds

PAIR = ["user_id", "engaged_with_user_id"]
RAW = "user_id bigint, engaged_with_user_id bigint, ts timestamp_ntz, source string, ds string"
DAILY = "user_id bigint, engaged_with_user_id bigint, n bigint, sum_ts bigint, ds string"


def _ds(day: date) -> str:
    return f"{day:%Y%m%d}"


def write_raw(feeds: Feeds, root: str) -> None:
    """All engagements by day; one shuffle by day and pair hash, so files stay few
    and a busy day is written by many tasks."""
    parts = [getattr(feeds, n).select(*cl.ENGAGEMENT_COLS, F.lit(n).alias("source"))
             for n in ("reply", "mention", "like", "follow")]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    (rows.withColumn("ds", date_folder("ts")).write.mode("overwrite")
     .partitionBy("ds").parquet(f"{root}/raw"))


def raw_days(spark: SparkSession, root: str, first: date | None = None,
             last: date | None = None) -> DataFrame:
    """Raw engagements of the days first..last (partition filters)."""
    df = spark.read.schema(RAW).parquet(f"{root}/raw")
    if first is not None:
        df = df.filter(F.col("ds") >= _ds(first))
    return df if last is None else df.filter(F.col("ds") <= _ds(last))


def summarise(spark: SparkSession, root: str, first: date, last: date) -> None:
    """Write the summaries of the days first..last, each in place of what it had."""
    pairs = (raw_days(spark, root, first, last).groupBy("ds", *PAIR)
             .agg(F.count(F.lit(1)).alias("n"), F.sum(epoch_seconds("ts")).alias("sum_ts")))
    (pairs.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("ds").parquet(f"{root}/daily"))


def whole_days(params: Params) -> tuple[date, date]:
    """First and last day that lie wholly inside the window and before the run's day.

    The first engagement of a day may come at its midnight and must weigh more
    than nothing, hence the strict comparison.
    """
    edge = params.as_of - timedelta(seconds=params.lookback_seconds)
    first = edge.date() + timedelta(days=1)
    assert datetime.combine(first, datetime.min.time()) > edge
    return first, params.as_of.date() - timedelta(days=1)


def incremental_pairs(spark: SparkSession, root: str, params: Params) -> DataFrame:
    """`closest.pair_sums` of the window, from summaries and the raw days around them."""
    first, last = whole_days(params)
    edge = raw_days(spark, root, first - timedelta(days=1), first - timedelta(days=1))
    newest = raw_days(spark, root, max(first, last + timedelta(days=1)))
    raw = edge.unionByName(newest).drop("ds")
    raw = raw.filter((F.col("source") != "follow")
                     | (F.to_date("ts") >= F.lit(params.recent_since)))
    raw = (cl.weighted_engagements(raw, params).groupBy(*PAIR)
           .agg(F.count(F.lit(1)).alias("n"), F.sum("rem").alias("rem")))
    base = params.lookback_seconds - params.as_of_epoch
    old = (spark.read.schema(DAILY).parquet(f"{root}/daily")
           .filter(F.col("ds").between(_ds(first), _ds(last)))
           .select(*PAIR, "n", (F.col("n") * F.lit(base) + F.col("sum_ts")).alias("rem")))
    return (old.unionByName(raw).groupBy(*PAIR)
            .agg(F.sum("rem").alias("sum_rem"), F.sum("n").alias("n_engagements")))


def closest_incremental(spark: SparkSession, root: str, user: DataFrame,
                        params: Params) -> DataFrame:
    """X1 from daily summaries: equals `closest.closest_connections`."""
    return cl.ranked_pairs(incremental_pairs(spark, root, params), user, params)
