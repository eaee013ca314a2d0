"""Step 1 edge rules."""

from datetime import timedelta

from conftest import AS_OF, make_feeds

from followrec.operators import closest as cl
from followrec.params import Params

P = Params(as_of=AS_OF)
L = P.lookback_seconds


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_decay_boundaries(spark):
    ages = {1: timedelta(0), 2: timedelta(seconds=1),
            3: timedelta(days=89, hours=23, minutes=59, seconds=59),
            4: timedelta(days=90), 5: timedelta(days=91), 6: timedelta(days=-1)}
    f = make_feeds(spark, reply=[(100, t, AS_OF - a) for t, a in ages.items()])
    w = cl.decay_weight(cl.weighted_engagements(cl.union_engagements(f, P), P), P)
    got = {r["engaged_with_user_id"]: r["rem"] for r in w.collect()}
    # exactly 90 days weighs 0 and is dropped, older is dropped, future > 1
    assert got == {1: L, 2: L - 1, 3: 1, 6: L + 86400}
    top = {r["engaged_with_user_id"]: r["w8"] for r in cl.closest_connections(f, P).collect()}
    assert top[1] == 100_000_000 and top[6] == 101_111_111  # 1 + 1/90 rounded
    assert top[3] == 13  # 1 s / 90 days = 0.0000001286 -> 0.00000013


def test_fractional_seconds_are_dropped(spark):
    t = AS_OF - timedelta(days=1, microseconds=-900_000)  # 0.9 s after the whole second
    f = make_feeds(spark, reply=[(1, 2, t)])
    w = cl.weighted_engagements(cl.union_engagements(f, P), P).collect()
    assert w[0]["rem"] == L - 86400


def test_suspended_targets_only(spark):
    ts = AS_OF - timedelta(days=1)
    f = make_feeds(
        spark,
        reply=[(1, 2, ts), (1, 3, ts), (1, 4, ts), (1, 5, ts), (3, 1, ts)],
        users=[(2, 1), (3, None), (4, 0), (3, None), (1, 1)])
    top = cl.closest_connections(f, P)
    # 2 is suspended (dropped as target); 3 null, 4 not suspended, 5 absent
    # from the user table: all kept. Suspended user 1 keeps its own row as a
    # source, but is removed as target of 3.
    assert rows(top, "user_id", "engaged_with_user_id") == [(1, 3), (1, 4), (1, 5)]


def test_self_engagement_kept(spark):
    f = make_feeds(spark, like=[(7, 7, AS_OF - timedelta(hours=1))])
    assert rows(cl.closest_connections(f, P), "user_id", "engaged_with_user_id") == [(7, 7)]


def test_tie_break_text_order_and_top_k(spark):
    ts = AS_OF - timedelta(days=2)
    f = make_feeds(spark, mention=[(1, 9, ts), (1, 10, ts), (1, 8, ts)])
    top = cl.closest_connections(f, P.with_(n_closest=2))
    # equal weights: '10' < '8' < '9' as text
    assert rows(top, "rank", "engaged_with_user_id") == [(1, 10), (2, 8)]


def test_recent_follow_date_level(spark):
    p = P.with_(lookback_days=20)
    day = AS_OF - timedelta(days=20)
    f = make_feeds(spark, follow=[(1, 2, day), (1, 3, day - timedelta(seconds=1))])
    assert rows(cl.recent_follows(f.follow, p), "engaged_with_user_id") == [(2,)]
    # weight of a follow at exactly the window start is 0, so it never counts
    assert cl.closest_connections(f, p).count() == 0


def test_sum_is_exact_and_lists_formatted(spark):
    ts = AS_OF - timedelta(days=45)
    f = make_feeds(spark, reply=[(1, 2, ts), (1, 2, ts)], like=[(1, 3, AS_OF)])
    top = cl.closest_connections(f, P)
    got = {r["engaged_with_user_id"]: (r["sum_rem"], r["w8"]) for r in top.collect()}
    assert got[2] == (L, 100_000_000)
    lists = cl.closest_lists(top).collect()[0]
    assert lists["engaged_with_user_id"] == "2,3"
    assert lists["weight"] == "1.00000000,1.00000000"


def test_round_half_up_to_8_decimals(spark):
    # rem = 1 s of a 2 s window would be 0.5; use L = 3 days: 1 s / 259200 s
    p = P.with_(lookback_days=3)
    f = make_feeds(spark, reply=[(1, 2, AS_OF - timedelta(days=3, seconds=-1))])
    w8 = cl.closest_connections(f, p).collect()[0]["w8"]
    assert w8 == round(1 / (3 * 86400) * 1e8)  # 386 -> 0.00000386
