"""Closest connections from daily summaries equal those from the raw feeds."""

import random
from datetime import datetime, timedelta

import pytest
from conftest import make_feeds

from followrec.operators import closest as cl
from followrec.operators import incremental as inc
from followrec.params import Params

P = Params(as_of=datetime(2024, 1, 31), lookback_days=10, n_closest=4)


def feeds(spark):
    rnd = random.Random(9)
    start = P.as_of - timedelta(days=15)

    def rows(n):
        out = []
        for _ in range(n):
            t = start + timedelta(seconds=rnd.randrange(18 * 86400))
            if rnd.random() < 0.2:  # at midnight, where windows begin
                t = datetime(t.year, t.month, t.day)
            out.append((rnd.randrange(12), rnd.randrange(12), t))
        return out

    return make_feeds(spark, follow=rows(300), reply=rows(300), mention=rows(200), like=rows(200),
                      users=[(u, int(u == 3)) for u in range(12)])


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    f, root = feeds(spark), str(tmp_path_factory.mktemp("engagements"))
    inc.write_raw(f, root)
    return f, root


@pytest.mark.parametrize("hours", [0, 13])
def test_three_days_running(spark, stored, hours):
    f, root = stored
    for day in range(3):
        p = P.with_(as_of=P.as_of + timedelta(days=day, hours=hours))
        first, last = inc.whole_days(p)
        # the first run summarises the window, later ones only the day that became complete
        inc.summarise(spark, root, first if day == 0 else last, last)
        want = cl.closest_connections(f, p)
        got = inc.closest_incremental(spark, root, f.user, p).select(want.columns)
        assert got.count() == want.count() > 0
        assert got.exceptAll(want).count() == 0


def test_only_raw_days_around_the_window_are_read(spark, stored):
    f, root = stored
    p = P.with_(as_of=P.as_of + timedelta(hours=5))
    inc.summarise(spark, root, *inc.whole_days(p))
    plan = inc.incremental_pairs(spark, root, p)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    raw = [line.split("PartitionFilters: ")[1].split("]")[0] for line in scans if "/raw]" in line]
    assert len(raw) == 2 and len(scans) == 3
    assert ">= 20240121" in raw[0] and "<= 20240121" in raw[0]  # the window's edge
    assert ">= 20240131" in raw[1]  # the run's day and later


def test_a_day_is_summarised_again(spark, stored):
    f, root = stored
    p = P.with_(as_of=P.as_of + timedelta(days=1))
    first, last = inc.whole_days(p)
    for _ in range(2):  # replaces, never adds
        inc.summarise(spark, root, first, last)
    want = cl.closest_connections(f, p)
    assert inc.closest_incremental(spark, root, f.user, p).select(
        want.columns).exceptAll(want).count() == 0
