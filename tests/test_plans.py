"""Physical-plan properties the design relies on."""

import contextlib
import io

import pytest

from followrec.plans.queries import REGISTRY

SF = "/root/testdata/sf0.001"


def _depth(line: str) -> int:
    for marker in ("+- ", ":- "):
        i = line.find(marker)
        if i >= 0:
            return i
    return 0


def broadcasts_are_bounded(tree: str) -> bool:
    """Each BroadcastExchange holds a top-k report, hot keys (a share of all rows, by a
    scalar subquery) or a bitmap of fixed size."""
    lines = tree.splitlines()
    for i, line in enumerate(lines):
        if "BroadcastExchange" not in line:
            continue
        d = _depth(line)
        sub = []
        for nxt in lines[i + 1:]:
            if _depth(nxt) <= d:
                break
            sub.append(nxt)
        if not any(mark in x for x in sub for mark in (
                "TakeOrderedAndProject", "Filter", "ObjectHashAggregate", "vocabulary")):
            return False
    return True


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def sort_merge(spark):
    """Plan as at cluster scale, where the big sides do not fit a broadcast."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_filters_reach_the_scans(spark):
    p = plan(REGISTRY["closest_connections"](spark, SF))
    pushed = [line for line in p.splitlines() if "PushedFilters" in line]
    assert any("EqualTo(event_type,view)" in x and "GreaterThan(ts," in x for x in pushed)
    assert any("EqualTo(event_type,signup)" in x and "GreaterThanOrEqual(ts," in x
               for x in pushed)


def test_partial_top_k_before_shuffle(spark, sort_merge):
    p = plan(REGISTRY["final_recommendations"](spark, SF))
    tree = p.split("\n\n")[0]
    assert tree.count("WindowGroupLimit") >= 2   # partial + final; closest is staged
    for bad in ("NestedLoop", "Cartesian", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in p


def test_no_row_python_and_bounded_broadcasts(spark, sort_merge):
    for name in ("final_reasons", "pad_sequences", "upsert_reasons", "dq_report"):
        p = plan(REGISTRY[name](spark, SF))
        for bad in ("NestedLoop", "Cartesian", "BatchEvalPython"):
            assert bad not in p, (name, bad)
        # every broadcast is built from a bounded top-k report (hot keys,
        # vocabulary), never from a table that grows with the data
        assert broadcasts_are_bounded(p.split("\n\n")[0]), name


def test_only_vocabulary_is_broadcast_in_encoding(spark, sort_merge):
    from followrec.operators import reputation as rp
    from followrec.params import Params
    from followrec.sources import testdata as td

    p = Params()
    clean = rp.keyed_messages(rp.clean_messages(rp.message_frame(
        td.map_messages(spark, SF), p)))
    tree = plan(rp.encode_sequences(clean, rp.token_vocabulary(clean, p))).split("\n\n")[0]
    # the vocabulary (a top-k report, bounded by vocab_size) is broadcast
    assert tree.count("BroadcastExchange") >= 1
    assert broadcasts_are_bounded(tree)


def test_follows_collapsed_before_shuffle(spark, sort_merge):
    p = plan(REGISTRY["final_recommendations"](spark, SF)).split("\n\n")[0]
    assert "SortMergeJoin LeftAnti" in p and "HashAggregate" in p


def test_self_join_sides_share_the_closest_shuffle(spark, sort_merge):
    # the lazy composition (the registered queries stage closest connections)
    from followrec.operators import closest as cl
    from followrec.operators import recommend as rc
    from followrec.params import Params
    from followrec.sources import testdata as td

    f = td.map_feeds(spark, SF)
    df = rc.ranked_candidates(cl.closest_connections(f, Params()), f.follow, f.user, Params())
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in final
    # the right side of the self join reads the left side's window-input shuffle
    reused = [line for line in final.splitlines() if "ReusedExchange" in line]
    assert any("engaged_with_user_id" in line and "sum_rem" in line for line in reused)


def test_upsert_leaves_the_target_in_place(spark, sort_merge):
    p = plan(REGISTRY["upsert_reasons"](spark, SF)).split("\n\n")[0].splitlines()
    scan = next(i for i, line in enumerate(p) if "bucketed_" in line)
    depth, above = _depth(p[scan]), []
    for line in reversed(p[:scan]):  # the scan's ancestors only
        if _depth(line) < depth:
            depth = _depth(line)
            above.append(line)
    joins = [i for i, line in enumerate(above) if "SortMergeJoin FullOuter" in line]
    assert joins and not any("Exchange" in line for line in above[:joins[0]])
