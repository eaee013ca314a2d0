"""Skew-safe running sums agree with a plain window, even for a hot group."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from followrec.operators.prefix import grouped_exclusive_sum


def test_matches_window_with_hot_group(spark, tmp_path):
    rnd = random.Random(3)
    rows = [(0 if i % 3 else rnd.randrange(1, 50), rnd.randrange(5), i, rnd.randrange(0, 7))
            for i in range(3000)]  # group 0 holds two thirds of the rows
    df = spark.createDataFrame(rows, "g long, day int, id long, v long")
    for stage in (None, str(tmp_path / "stage")):
        got = grouped_exclusive_sum(df, ["g"], ["day", "id"], "v", "before", "total",
                                    num_partitions=16, stage_path=stage)
        w = Window.partitionBy("g").orderBy("day", "id")
        want = df.select(
            "id",
            F.coalesce(F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, -1)),
                       F.lit(0)).alias("before"),
            F.sum("v").over(Window.partitionBy("g")).alias("total"))
        a = sorted(tuple(r) for r in got.select("id", "before", "total").collect())
        b = sorted(tuple(r) for r in want.collect())
        assert a == b


def test_split_path_keeps_hot_group_spread(spark):
    rows = [(0 if i % 3 else i % 50 + 1, i % 5, i, 1) for i in range(6000)]
    df = spark.createDataFrame(rows, "g long, day int, id long, v long")
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    old_b = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = grouped_exclusive_sum(df, ["g"], ["day", "id"], "v", "before", "total",
                                    num_partitions=16)
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) < 0.5 * sum(sizes)    # group 0 holds two thirds of the rows
        assert out.filter("g = 0").agg(F.max("before")).first()[0] == 3999
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old_b)
