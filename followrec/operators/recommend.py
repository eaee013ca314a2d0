"""Step 3: friends-of-friends recommendations and the reasons behind them.

Plan shape: closest (top-k per user, so at most k*k paths per user) joined to
its intermediaries' lists (a popular intermediary is salted over many tasks,
see operators.skew), sent to the user's partition and unnested there -> self
filter -> one aggregate per (user, candidate), in place, that carries sums only -> anti join on follows (co-partitioned on (user, candidate),
so only the follows move) -> per-user top-n window -> left-semi join on high
scores.

Reasons are materialised late: candidates are ranked on sums alone, then the
at most n_rec winners of a user go back to the user's paths. The list of a
user's winners (bounded) meets the user's first hops (at most k), and the
second hop keeps only what leads to a winner, so neither the follow anti join
nor the ranking ever carries a reason list.

Excluding followed users after the aggregate instead of before it gives the
same rows (both are per-(user, candidate) predicates) and moves the anti join
onto the much smaller pair table. Where (user, candidate) pairs are not
partitioned that way, `exclude_followed_split` shuffles only those that a
bitmap of the follows cannot rule out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from followrec.functions import fixed8_text, weight_decimal
from followrec.operators.closest import rank_window, suspended_users
from followrec.operators.skew import HOT_ROWS, SALT_BUCKETS, salted_join
from followrec.params import Params
from followrec.session import scratch_path
from followrec.sources.sinks import cut_lineage


def active_sources(closest: DataFrame, user: DataFrame) -> DataFrame:
    """Closest connections whose user is not suspended (anti join, no fan-out)."""
    s = suspended_users(user).withColumnRenamed("user_id", "_suspended_id")
    return closest.join(s, closest["user_id"] == s["_suspended_id"], "left_anti")


def _first_hops(active: DataFrame) -> DataFrame:
    return active.select("user_id",
                         F.col("engaged_with_user_id").alias("reason_id"),
                         F.col("rank").alias("reason_rank"))


def _second_hops(active: DataFrame) -> DataFrame:
    return active.select(F.col("user_id").alias("reason_id"),
                         F.col("engaged_with_user_id").alias("rec_id"), "w8")


def _hop_lists(active: DataFrame) -> DataFrame:
    """The second hops of an intermediary as one row of at most n_closest entries
    (two parallel arrays), written once to the shared scratch folder."""
    spark = active.sparkSession
    hops = (_second_hops(active).filter(F.col("reason_id").isNotNull())
            .groupBy("reason_id").agg(F.collect_list(F.struct("rec_id", "w8")).alias("hops"))
            .select("reason_id", F.col("hops.rec_id").alias("recs"),
                    F.col("hops.w8").alias("weights")))
    return cut_lineage(spark, hops, scratch_path(spark, "hop-lists"))


# Paths that one task sends or sums, about. An execution knob: results do not depend on it.
PATHS_PER_TASK = 2_000_000


def _path_tasks(lists: DataFrame, per_task: int) -> int:
    """Tasks for the paths over `lists`: the session's partitions, or as many as the paths need.

    Every row of `active` is one first and one second hop, so the lists also count the
    first hops, and each meets at most the longest list. A user has at most n_closest
    squared paths, so tasks are even.
    """
    entries, longest = lists.agg(F.sum(F.size("recs")), F.max(F.size("recs"))).first()
    n = int(lists.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(n, -(-(entries or 0) * (longest or 0) // per_task))


def second_degree_paths(active: DataFrame, hot_rows: int = HOT_ROWS,
                        buckets: int = SALT_BUCKETS,
                        per_task: int | None = None) -> DataFrame:
    """user -> reason -> rec paths.

    Keeps the rank of user -> reason (the reasons' order) and the weight of
    reason -> rec only; the first hop's weight does not count.
    Output: user_id, reason_id, reason_rank, rec_id, w8.

    A first hop meets its intermediary's second hops as one list and goes to its
    user's partition with it; paths are formed there. What is grouped by user
    or by (user, rec) afterwards moves no path: a shuffle carries one row per
    first hop instead of up to n_closest.

    Skew: the right side holds one row per intermediary, the left side
    one row per user reaching it, so a popular intermediary is a hot key: its
    left rows are salted by user over `buckets` tasks and its right
    row copied once per salt (operators.skew).

    Memory: a join task holds the lists it sends and a user's task the sums of its paths.
    First hops are small before they meet their lists, so partitions of a size that suits
    them would not do: the number of both tasks grows with the paths, about `per_task`
    (default PATHS_PER_TASK) in each.
    """
    hops = _hop_lists(active)
    n = _path_tasks(hops, per_task or PATHS_PER_TASK)
    lists = salted_join(_first_hops(active), hops, ["reason_id"], "inner",
                        ["user_id"], min_rows=hot_rows, buckets=buckets, partitions=n)
    # a fixed number: lists are small before they become paths, merging would undo the split
    return (lists.repartition(n, "user_id")
            .select("user_id", "reason_id", "reason_rank", "weights",
                    F.posexplode("recs").alias("_at", "rec_id"))
            .select("user_id", "reason_id", "reason_rank", "rec_id",
                    F.get("weights", F.col("_at")).alias("w8")))


def exclude_self(df: DataFrame) -> DataFrame:
    return df.filter(F.col("rec_id") != F.col("user_id"))


def exclude_followed(df: DataFrame, follow: DataFrame) -> DataFrame:
    """Drop (user, rec) pairs the user already follows (any time, all follows).

    Repeated follows of one pair are collapsed first (partial aggregation
    map-side), so a hot pair never reaches the join as a long run of rows.
    """
    f = follow.select(F.col("user_id").alias("_fu"),
                      F.col("engaged_with_user_id").alias("_fr")).distinct()
    return df.join(f, (df["user_id"] == f["_fu"]) & (df["rec_id"] == f["_fr"]),
                   "left_anti")


# Size of the bitmap that rules out follows (1 MiB); results do not depend on it.
FOLLOW_BITS = 1 << 23


def maybe_followed(df: DataFrame, follow: DataFrame, bits: int = FOLLOW_BITS) -> DataFrame:
    """Adds `maybe`: false when (user, rec) is surely no follow.

    Each follow sets one of `bits` bits, by a hash of the pair. The bitmap is
    built map-side by built-in aggregates, has bits / 32768 rows of 4 KiB
    whatever the number of follows, and is broadcast.
    """
    def position(user, rec):
        return F.pmod(F.xxhash64(user, rec), F.lit(bits)) + 1

    at = position("user_id", "engaged_with_user_id")
    bitmap = (follow.groupBy(F.bitmap_bucket_number(at).alias("_bucket"))
              .agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("_bits")))
    own = position("user_id", "rec_id")
    bit = F.bitmap_bit_position(own)
    byte = F.conv(F.hex(F.substring(F.col("_bits"), F.col("_byte"), F.lit(1))), 16, 10)
    return (df.withColumns({"_bucket": F.bitmap_bucket_number(own), "_bit": bit,
                            "_byte": (F.floor(bit / 8) + 1).cast("int")})
            .join(F.broadcast(bitmap), "_bucket", "left")
            .withColumn("maybe", F.coalesce(
                F.getbit(byte.cast("int"), (F.col("_bit") % 8).cast("int")) == 1, F.lit(False)))
            .drop("_bucket", "_bit", "_byte", "_bits"))


def exclude_followed_split(df: DataFrame, follow: DataFrame,
                           bits: int = FOLLOW_BITS) -> DataFrame:
    """`exclude_followed` for rows that are not partitioned by (user, rec).

    Rows that the bitmap rules out pass without a shuffle; only possible
    follows (the real ones, and a false share of about follows / bits) meet
    the follows in the anti join.
    """
    marked = maybe_followed(df, follow, bits)
    sure = marked.filter(~F.col("maybe")).drop("maybe")
    return sure.unionByName(exclude_followed(marked.filter("maybe").drop("maybe"), follow))


def exclude_followed_self(df: DataFrame, follow: DataFrame) -> DataFrame:
    """Paths to the user or to someone followed dropped, without moving a path.

    Only distinct (user, rec) pairs meet the follows. Those that are followed come
    back as one list per user, at most one entry per candidate, to the user's
    partition, where `second_degree_paths` has formed the paths; the lists are the
    hashed side of that join, so paths are not sorted either.
    """
    kept = exclude_self(df)
    f = follow.select("user_id", F.col("engaged_with_user_id").alias("rec_id")).distinct()
    followed = kept.select("user_id", "rec_id").distinct().join(f, ["user_id", "rec_id"])
    lists = followed.groupBy("user_id").agg(F.collect_list("rec_id").alias("_followed"))
    own = F.coalesce(F.array_contains("_followed", F.col("rec_id")), F.lit(False))
    return kept.join(lists.hint("shuffle_hash"), "user_id", "left").filter(~own).select(df.columns)


def second_degree_sums(paths: DataFrame) -> DataFrame:
    """Exact sum of second-hop weights per (user, candidate)."""
    return (paths.groupBy("user_id", "rec_id")
            .agg(F.sum("w8").alias("sum_w8"), F.count(F.lit(1)).alias("n_reasons")))


def second_degree_agg(paths: DataFrame) -> DataFrame:
    """Sum plus the reason list per (user, candidate).

    Each intermediary occurs once per (user, candidate), so the list holds at
    most n_closest entries. Sorted by the user's rank of the intermediary.
    """
    return (paths.groupBy("user_id", "rec_id")
            .agg(F.sum("w8").alias("sum_w8"),
                 F.count(F.lit(1)).alias("n_reasons"),
                 F.sort_array(F.collect_list(F.struct(
                     "reason_rank", "reason_id", "w8"))).alias("reasons")))


def reason_lists(agg: DataFrame) -> DataFrame:
    """Reasons and their weights as parallel comma-joined texts (same order)."""
    return agg.select(
        "user_id", "rec_id",
        F.array_join(F.transform("reasons", lambda r: r["reason_id"].cast("string")), ",")
        .alias("reasons"),
        F.array_join(F.transform("reasons", lambda r: fixed8_text(r["w8"])), ",")
        .alias("weights"))


def top_recommendations(agg: DataFrame, params: Params) -> DataFrame:
    """Top n_rec candidates per user by summed weight (before any score filter)."""
    w = rank_window("user_id", "sum_w8", "rec_id")
    return (agg.withColumn("rank", F.row_number().over(w))
            .filter(F.col("rank") <= params.n_rec))


def high_scores(scores: DataFrame, params: Params) -> DataFrame:
    return scores.filter(F.col("pred") > F.lit(params.min_score))


def keep_high_scores(recs: DataFrame, scores: DataFrame, params: Params) -> DataFrame:
    """Candidates with a score strictly above min_score; no score, no rec.

    A candidate recommended to a large share of users is a hot key. With
    written scores both sides are plain shuffles, which AQE splits.
    """
    h = high_scores(scores, params).select(F.col("user_id").alias("rec_id"))
    return recs.join(h, "rec_id", "left_semi").select(recs.columns)


def winners_reasons(top: DataFrame, active: DataFrame, hot_rows: int = HOT_ROWS,
                    buckets: int = SALT_BUCKETS) -> DataFrame:
    """The paths behind ranked (user, rec) rows: late materialisation.

    Output: user_id, rec_id, reason_id, reason_rank, w8. `top` holds at most
    n_rec rows per user, gathered into one list per user; the paths are formed
    again from the first hops of those users only and kept when they end in
    the list, without a shuffle by (user, rec).
    """
    wanted = top.groupBy("user_id").agg(F.collect_list("rec_id").alias("recs"))
    hop1 = _first_hops(active).join(wanted, "user_id")
    paths = salted_join(hop1, _second_hops(active), ["reason_id"], "inner", ["user_id"],
                        min_rows=hot_rows, buckets=buckets,
                        counted=_first_hops(active))
    return (paths.filter(F.array_contains("recs", F.col("rec_id")))
            .select("user_id", "rec_id", "reason_id", "reason_rank", "w8"))


def reason_rows(reasons: DataFrame) -> DataFrame:
    """One row per (user, rec, reason) with the reason's second-hop weight."""
    return reasons.select("user_id", "rec_id", "reason_id", weight_decimal("w8").alias("weight"))


def rec_rows(top: DataFrame) -> DataFrame:
    return top.select("user_id", "rec_id", "rank", weight_decimal("sum_w8").alias("weight"))


def ranked_from_active(active: DataFrame, follow: DataFrame, params: Params) -> DataFrame:
    """`ranked_candidates` from the closest connections of active users."""
    paths = exclude_self(second_degree_paths(active))
    return top_recommendations(exclude_followed(second_degree_sums(paths), follow), params)


def ranked_candidates(closest: DataFrame, follow: DataFrame, user: DataFrame,
                      params: Params) -> DataFrame:
    """Top n_rec candidates per user with sum and number of reasons (no score filter)."""
    return ranked_from_active(active_sources(closest, user), follow, params)


def recommendations(closest: DataFrame, follow: DataFrame, user: DataFrame,
                    scores: DataFrame, params: Params, active: DataFrame | None = None,
                    ranked: DataFrame | None = None):
    """X3: (recommendations, reasons) after the score filter.

    Active connections, read by both hops, and the final candidates, read by both
    results, are written to the shared scratch folder. `active` and `ranked` (of
    `ranked_from_active`) may be passed in when already written.
    """
    spark = closest.sparkSession
    if active is None:
        active = cut_lineage(spark, active_sources(closest, user), scratch_path(spark, "active"))
    if ranked is None:
        top = final_candidates(active, follow, scores, params)
    else:
        top = keep_high_scores(ranked, scores, params)
    top = cut_lineage(spark, top, scratch_path(spark, "final-candidates"))
    return rec_rows(top), reason_rows(winners_reasons(top, active))


def final_candidates(active: DataFrame, follow: DataFrame, scores: DataFrame,
                     params: Params) -> DataFrame:
    """Ranked candidates that score high enough."""
    return keep_high_scores(ranked_from_active(active, follow, params), scores, params)
