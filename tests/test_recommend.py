"""Step 3 edge rules and properties."""

from datetime import timedelta

from conftest import AS_OF, make_feeds
from pyspark.sql import functions as F

from followrec.operators import closest as cl
from followrec.operators import recommend as rc
from followrec.params import Params

P = Params(as_of=AS_OF)
TS = AS_OF - timedelta(days=1)


def recs_of(spark, f, scores, p=P):
    top = cl.closest_connections(f, p)
    s = spark.createDataFrame(scores, "user_id long, pred double")
    return rc.recommendations(top, f.follow, f.user, s, p)


def test_unfollowed_first_degree_can_be_recommended(spark):
    # u -> a, a -> b, u -> b (engaged but not followed): b reachable in two hops
    f = make_feeds(spark, reply=[(1, 2, TS), (2, 3, TS), (1, 3, TS), (1, 1, TS)])
    recs, reasons = recs_of(spark, f, [(3, 0.9), (1, 0.9)])
    got = sorted((r.user_id, r.rec_id) for r in recs.collect())
    # 1 -> 1 -> 3 and 1 -> 2 -> 3 make 3 a candidate (1 is its own closest
    # connection and intermediary); 1 itself is excluded, 2 has no score
    assert got == [(1, 3)]
    rs = sorted((r.reason_id, str(r.weight)) for r in reasons.collect())
    assert rs == [(1, "0.98888889"), (2, "0.98888889")]


def test_followed_excluded_even_when_old(spark):
    old = AS_OF - timedelta(days=400)
    f = make_feeds(spark, reply=[(1, 2, TS), (2, 3, TS)], follow=[(1, 3, old)])
    recs, _ = recs_of(spark, f, [(3, 0.9)])
    assert recs.count() == 0


def test_suspended_source_removed_as_intermediary(spark):
    f = make_feeds(spark, reply=[(1, 2, TS), (2, 3, TS)], users=[(2, 1)])
    # 2 is suspended: step 1 drops 1 -> 2 already (target), so nothing is left
    recs, _ = recs_of(spark, f, [(3, 0.9)])
    assert recs.count() == 0
    f = make_feeds(spark, reply=[(1, 4, TS), (4, 3, TS)], users=[(4, 0), (1, 1)])
    # suspended user 1 gets no recommendations
    recs, _ = recs_of(spark, f, [(3, 0.9)])
    assert recs.count() == 0


def test_top_before_score_and_strict_threshold(spark):
    # user 1 -> 2 -> candidates 100..124 with decreasing weight
    rows = [(1, 2, TS)] + [(2, 100 + i, AS_OF - timedelta(days=1 + i)) for i in range(25)]
    f = make_feeds(spark, reply=rows)
    scores = [(100 + i, 0.1 if i % 2 else 0.9) for i in range(25)]
    scores[0] = (100, 0.75)          # exactly the threshold: out
    scores[2] = (102, 0.7500001)     # just above: in
    scores = [s for s in scores if s[0] != 104]  # no score: out
    recs, reasons = recs_of(spark, f, scores)
    got = sorted(r.rec_id for r in recs.collect())
    # only ranks 1..20 are considered; of those the even ones score high
    assert got == [102, 106, 108, 110, 112, 114, 116, 118]
    assert reasons.count() == len(got)


def test_properties_on_generated_graph(spark):
    import random
    rnd = random.Random(7)
    rows = [(rnd.randrange(30), rnd.randrange(30), AS_OF - timedelta(seconds=rnd.randrange(90 * 86400)))
            for _ in range(1500)]
    follows = [(rnd.randrange(30), rnd.randrange(30), AS_OF - timedelta(days=rnd.randrange(200)))
               for _ in range(100)]
    users = [(i, 1 if i % 11 == 0 else 0) for i in range(30)]
    f = make_feeds(spark, reply=rows, follow=follows, users=users)
    p = P.with_(n_closest=5, n_rec=4)
    top = cl.closest_connections(f, p)
    assert top.groupBy("user_id").count().filter("count > 5").count() == 0
    ranked = rc.ranked_candidates(top, f.follow, f.user, p)
    assert ranked.groupBy("user_id").count().filter("count > 4").count() == 0
    assert ranked.filter("rec_id = user_id").count() == 0
    fol = f.follow.select("user_id", F.col("engaged_with_user_id").alias("rec_id"))
    assert ranked.join(fol, ["user_id", "rec_id"]).count() == 0
    assert ranked.filter("user_id % 11 = 0").count() == 0
    # the reasons' weights add up to the recommendation's weight
    paths = rc.winners_reasons(ranked, rc.active_sources(top, f.user))
    sums = paths.groupBy("user_id", "rec_id").agg(F.sum("w8").alias("s"),
                                                  F.count("*").alias("n"))
    joined = ranked.join(sums, ["user_id", "rec_id"], "left")
    assert joined.filter("s is null or s != sum_w8 or n != n_reasons").count() == 0
    assert sums.count() == ranked.count()


def test_reasons_are_materialised_after_ranking(spark):
    f = make_feeds(spark, reply=[(u, v, TS) for u in range(5) for v in range(5)])
    active = rc.active_sources(cl.closest_connections(f, P), f.user)
    active = spark.createDataFrame(active.collect(), active.schema)
    top = rc.ranked_from_active(active, f.follow, P)
    assert "collect_list" not in top._jdf.queryExecution().optimizedPlan().toString()
    plan = rc.winners_reasons(top, active)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("collect_list") == 1  # the winners of a user, above the rank window
    assert plan.index("collect_list") < plan.index("row_number")


def test_split_exclusion_equals_the_anti_join(spark):
    pairs = [(u, r, u * r) for u in range(60) for r in range(60)]
    df = spark.createDataFrame(pairs, "user_id long, rec_id long, w8 long")
    f = make_feeds(spark, follow=[(u, (7 * u + k) % 70, TS) for u in range(80) for k in (0, 3)] * 2)
    want = sorted(map(tuple, rc.exclude_followed(df, f.follow).collect()))
    followed = len(pairs) - len(want)
    for bits in (64, 1 << 15, 1 << 20):
        got = rc.exclude_followed_split(df, f.follow, bits)
        assert sorted(map(tuple, got.collect())) == want
        maybe = rc.maybe_followed(df, f.follow, bits).filter("maybe").count()
        assert followed <= maybe <= len(pairs)
    assert maybe <= followed + 5  # with a large bitmap hardly any other pair is shuffled


def test_paths_are_not_shuffled_once_formed(spark):
    rows = [(u, (u * k) % 23, TS) for u in range(40) for k in range(1, 9)] + [(3, None, TS)] * 2
    follows = [(u, (u + 3) % 23, TS) for u in range(40)] * 2 + [(None, 1, TS), (1, None, TS)]
    f = make_feeds(spark, reply=rows, follow=follows, users=[(5, 1)])
    active = rc.active_sources(cl.closest_connections(f, P), f.user)
    active = spark.createDataFrame(active.collect(), active.schema)
    paths = rc.second_degree_paths(active)
    a, b = active.alias("a"), active.alias("b")
    plain = a.join(b, F.col("a.engaged_with_user_id") == F.col("b.user_id")).select(
        "a.user_id", F.col("b.user_id").alias("reason_id"), F.col("a.rank").alias("reason_rank"),
        F.col("b.engaged_with_user_id").alias("rec_id"), "b.w8")
    assert sorted(map(str, paths.collect())) == sorted(map(str, plain.collect()))
    kept = rc.exclude_followed_self(paths, f.follow)
    want = rc.exclude_followed(rc.exclude_self(plain), f.follow)
    assert sorted(map(str, kept.collect())) == sorted(map(str, want.collect()))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for agg in (rc.second_degree_sums, rc.second_degree_agg):
            df = agg(rc.exclude_followed_self(rc.second_degree_paths(active), f.follow))
            tree = df._jdf.queryExecution().executedPlan().toString()
            # from the forming of the paths up to the result there is no exchange
            formed = next(i for i, x in enumerate(tree.splitlines()) if "posexplode" in x)
            assert "Exchange" not in "".join(tree.splitlines()[:formed]), tree
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_second_hop_ranks_on_8_decimal_weights(spark):
    # L = 1200 days: 1 s of age is below 1e-8 of weight. 2 -> 9 has rem 1001,
    # 2 -> 10 rem 1000: step 1 ranks 9 first, but both publish 0.00000965,
    # so step 3 sees a tie and '10' wins as text.
    p = P.with_(lookback_days=1200, n_rec=1)
    L = p.lookback_seconds
    f = make_feeds(spark, reply=[
        (1, 2, TS),
        (2, 9, AS_OF - timedelta(seconds=L - 1001)),
        (2, 10, AS_OF - timedelta(seconds=L - 1000))])
    top = {r.engaged_with_user_id: (r["rank"], r.w8)
           for r in cl.closest_connections(f, p).filter("user_id = 2").collect()}
    assert top == {9: (1, 965), 10: (2, 965)}
    recs, _ = recs_of(spark, f, [(9, 0.9), (10, 0.9)], p)
    assert [r.rec_id for r in recs.collect()] == [10]


def test_hot_intermediary_is_spread(spark):
    # every user reaches intermediary 7; 7 has 40 targets: all paths share a key
    rows = [(u, 7, TS) for u in range(1, 3001)] + [(7, 10_000 + i, TS) for i in range(40)]
    f = make_feeds(spark, reply=rows)
    active = rc.active_sources(cl.closest_connections(f, P), f.user)
    # as at cluster scale: sort-merge join, no partition coalescing
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    old_b = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        salted = rc.second_degree_paths(active, hot_rows=100)
        plain = rc.second_degree_paths(active, hot_rows=10**12)
        assert salted.exceptAll(plain).count() == 0 and plain.exceptAll(salted).count() == 0
        sizes = [r["count"] for r in salted.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) < 0.5 * sum(sizes)        # no task holds the hot key alone
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old_b)


def test_tasks_of_paths_grow_with_the_paths(spark):
    # 12 users reach each of 3 intermediaries, whose lists have 4 entries
    rows = [(u, r, 1, 1) for u in range(10, 22) for r in (1, 2, 3)]
    rows += [(r, 100 + k, 1 + k, 5) for r in (1, 2, 3) for k in range(4)]
    active = spark.createDataFrame(
        rows, "user_id long, engaged_with_user_id long, rank int, w8 long")
    session = int(spark.conf.get("spark.sql.shuffle.partitions"))
    few = rc.second_degree_paths(active)
    many = rc.second_degree_paths(active, per_task=10)
    assert few.rdd.getNumPartitions() == session
    # at most 48 first hops of 4 entries, 10 in a task
    assert many.rdd.getNumPartitions() == max(session, 20)
    assert sorted(many.collect()) == sorted(few.collect())
    assert many.count() == 12 * 3 * 4


def test_join_may_be_given_its_tasks(spark):
    from followrec.operators.skew import salted_join

    left = spark.createDataFrame([(k % 7, k) for k in range(200)], "k long, v long")
    right = spark.createDataFrame([(k, -k) for k in range(5)], "k long, w long")
    plain = salted_join(left, right, ["k"], "inner", ["v"], min_rows=20, buckets=4)
    given = salted_join(left, right, ["k"], "inner", ["v"], min_rows=20, buckets=4,
                        partitions=31)
    assert given.rdd.getNumPartitions() == 31
    assert sorted(given.collect()) == sorted(plain.collect())
