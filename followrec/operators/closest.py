"""Step 1: closest connections by time-decayed engagement.

Plan shape: four feed scans (the lookback bound is pushed into each) -> union
-> partial+final hash aggregate per (user, target) -> anti join on suspended
targets (broadcast when the planner or AQE measures it small, sort-merge
otherwise) -> per-user top-k window (Catalyst adds a partial
WindowGroupLimit before the exchange, so a user with huge fan-out ships at most
k rows per map task).
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from followrec.functions import decay_remainder, fixed8_text, recent_follow, round8, weight_decimal
from followrec.params import Params
from followrec.sources.feeds import Feeds

ENGAGEMENT_COLS = ["user_id", "engaged_with_user_id", "ts"]


def recent_follows(follow: DataFrame, params: Params) -> DataFrame:
    """Follows on or after the first day of the lookback window (date level)."""
    return follow.filter(recent_follow("ts", params.recent_since))


def union_engagements(feeds: Feeds, params: Params) -> DataFrame:
    """reply + mention + like + recent follow, by column name; adds `source`."""
    parts = [
        feeds.reply.select(*ENGAGEMENT_COLS, F.lit("reply").alias("source")),
        feeds.mention.select(*ENGAGEMENT_COLS, F.lit("mention").alias("source")),
        feeds.like.select(*ENGAGEMENT_COLS, F.lit("like").alias("source")),
        recent_follows(feeds.follow, params).select(
            *ENGAGEMENT_COLS, F.lit("follow").alias("source")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def suspended_users(user: DataFrame) -> DataFrame:
    """Users flagged suspended = 1 (null is not suspended). Distinct ids."""
    return user.filter(F.col("suspended") == 1).select("user_id").distinct()


def drop_suspended_targets(engagements: DataFrame, user: DataFrame) -> DataFrame:
    """Rows whose target is not suspended (left anti join).

    The suspended ids are not de-duplicated here (repeats cannot change an
    anti join), so both join inputs are plain shuffles and AQE can split a
    target engaged with by a large share of users.
    """
    s = (user.filter(F.col("suspended") == 1)
         .select(F.col("user_id").alias("engaged_with_user_id")))
    return engagements.join(s, ["engaged_with_user_id"], "left_anti")


def weighted_engagements(engagements: DataFrame, params: Params) -> DataFrame:
    """Adds rem = L - age (whole seconds) and keeps rem > 0 (weight > 0).

    The extra `ts` bound is implied by rem > 0; it is stated on the raw column
    so Catalyst pushes it through the union into every scan.
    """
    lower = params.as_of - timedelta(seconds=params.lookback_seconds + 1)
    bound = F.lit(lower.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    return (engagements.filter(F.col("ts") > bound)
            .withColumn("rem", decay_remainder("ts", params.as_of_epoch,
                                               params.lookback_seconds))
            .filter(F.col("rem") > 0))


def decay_weight(weighted: DataFrame, params: Params) -> DataFrame:
    """Per-engagement weight (double) next to its exact remainder."""
    return weighted.withColumn(
        "weight", F.col("rem").cast("double") / F.lit(float(params.lookback_seconds)))


def engagement_strength(weighted: DataFrame, params: Params) -> DataFrame:
    """Sum of decayed weight per (user, target): sum_rem exact, w8 rounded."""
    return with_w8(pair_sums(weighted), params)


def pair_sums(weighted: DataFrame) -> DataFrame:
    return (weighted.groupBy("user_id", "engaged_with_user_id")
            .agg(F.sum("rem").alias("sum_rem"), F.count(F.lit(1)).alias("n_engagements")))


def with_w8(df: DataFrame, params: Params) -> DataFrame:
    """The 8-decimal weight of the exact sum, as w8 = weight x 10^8."""
    return df.withColumn("w8", round8("sum_rem", params.lookback_seconds))


def rank_window(partition_col: str, order_col: str, tie_col: str):
    """Strongest first; ties go to the smaller id compared as text."""
    return Window.partitionBy(partition_col).orderBy(
        F.col(order_col).desc(), F.col(tie_col).cast("string").asc())


def top_closest(strength: DataFrame, params: Params) -> DataFrame:
    """Top n_closest targets per user (rank 1 = strongest)."""
    w = rank_window("user_id", "sum_rem", "engaged_with_user_id")
    return (strength.withColumn("rank", F.row_number().over(w))
            .filter(F.col("rank") <= params.n_closest))


def closest_long(top: DataFrame) -> DataFrame:
    """Published long form: user_id, engaged_with_user_id, weight DECIMAL(18,8)."""
    return top.select("user_id", "engaged_with_user_id",
                      weight_decimal("w8").alias("weight"))


def closest_lists(top: DataFrame) -> DataFrame:
    """Wide form: per user, ids and 8-decimal weights comma-joined in rank order.

    The list holds at most n_closest entries, so the collect is bounded.
    """
    entries = F.sort_array(F.collect_list(F.struct(
        F.col("rank"), F.col("engaged_with_user_id").cast("string").alias("id"),
        fixed8_text("w8").alias("w"))))
    return (top.groupBy("user_id").agg(entries.alias("e"))
            .select("user_id",
                    F.array_join(F.transform("e", lambda x: x["id"]), ",")
                    .alias("engaged_with_user_id"),
                    F.array_join(F.transform("e", lambda x: x["w"]), ",")
                    .alias("weight")))


def closest_connections(feeds: Feeds, params: Params) -> DataFrame:
    """X1: ranked closest connections (long, with rank, sum_rem and w8).

    Suspended targets are removed from the aggregated pairs rather than from
    the raw engagements: the predicate depends on the target only, so the
    result is the same, and when the suspended ids are too many to broadcast
    the anti join shuffles the pair table instead of every engagement.
    """
    eng = union_engagements(feeds, params)
    return ranked_pairs(pair_sums(weighted_engagements(eng, params)), feeds.user, params)


def ranked_pairs(pairs: DataFrame, user: DataFrame, params: Params) -> DataFrame:
    """Top pairs per user, without suspended targets, with their 8-decimal weight."""
    # w8 is derived after the window, so every consumer of this plan (both
    # sides of the self join) has the same plan below the window's exchange
    # and Spark computes that shuffle once.
    return with_w8(top_closest(drop_suspended_targets(pairs, user), params), params)
