"""Salted joins equal the plain join for every join type."""

import re

import pytest
from pyspark.sql import functions as F

from followrec.operators import skew


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_joins_equal_plain(spark, how):
    # key 0 holds most left rows; key 5 has no right row; right has 2 rows per key
    left = spark.createDataFrame(
        [(0 if i % 4 else i % 7, i) for i in range(2000)], "k long, id long")
    right = spark.createDataFrame(
        [(k, v) for k in (0, 1, 2, 3, 4, 6) for v in (10 * k, 10 * k + 1)], "k long, v long")
    want = sorted(map(tuple, left.join(right, ["k"], how).collect()))
    salted = skew.salted_join(left, right, ["k"], how, ["id"], min_rows=100, buckets=8)
    assert sorted(map(tuple, salted.collect())) == want
    elsewhere = skew.salted_join(left, right, ["k"], how, ["id"], min_rows=10, buckets=8,
                                 counted=left.filter("id < 500"))
    assert sorted(map(tuple, elsewhere.collect())) == want


def test_all_hot_keys_within_the_share(spark):
    # three keys with 500 rows each among 3,000: all of them, and by the share never more
    df = spark.createDataFrame([(i % 3 if i % 2 else i + 10, ) for i in range(3000)], "k long")
    got = sorted(r.k for r in skew.hot_keys(df, ["k"], min_rows=100, share=10).collect())
    assert got == [0, 1, 2]
    assert skew.hot_keys(df, ["k"], min_rows=100, share=5).count() == 0


def test_building_a_join_runs_no_job(spark):
    df = spark.createDataFrame([(1, 2)], "k long, id long").withColumn(
        "k", F.raise_error(F.lit("a job ran")).cast("long"))
    skew.salted_join(df, df.select("k"), ["k"], "left_semi", ["id"])


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_given_tasks_hold_whichever_side_is_ready_first(spark, how):
    # both sides fit a broadcast; of an inner join AQE broadcast the one that was ready first
    left = spark.createDataFrame(
        [(None if k % 11 == 0 else k % 7, k) for k in range(200)], "k long, v long")
    right = spark.createDataFrame([(k, w) for w, k in enumerate((0, 0, 1, 2, 3, None))], "k long, w long")
    want = sorted(map(tuple, left.join(right, ["k"], how).collect()), key=str)
    given = skew.salted_join(left, right, ["k"], how, ["v"], min_rows=20, buckets=4,
                             partitions=31)
    assert sorted(map(tuple, given.collect()), key=str) == want
    assert given.rdd.getNumPartitions() == 31
    final = given._jdf.queryExecution().executedPlan().executedPlan().toString()
    assert not re.search(r"BroadcastHashJoin \[k#\d+L, _salt", final)
