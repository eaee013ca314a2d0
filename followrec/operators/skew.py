"""Joins whose left side may have hot keys.

AQE splits a skewed sort-merge join by bytes, and only when both inputs are
plain shuffles. A join that multiplies rows (the self join over popular
intermediaries) needs more: here the hot keys are found inside the plan (an
exact count per key, partially aggregated). A key is hot when it holds more
than `min_rows` rows and more than one in `share` of all rows. By that share
there are fewer than `share` hot keys, whatever the data, so their table has a
proven bound and is broadcast, and no key is left out of it. A hot key's left
rows get a salt from a hash of other left columns and its right rows (few per
key: the right side must hold a bounded number of rows per key) are copied once
per salt; other keys use salt 0. The join on (key, salt) then spreads a hot key
over `buckets` tasks and equals the plain join for inner, left outer, left
semi and left anti joins. Which keys are salted never changes the result, so
the counts may come from any cheap table that holds the left side's keys.

Building the join runs no job and looks at no size: a small right side is
broadcast by Spark's planner or by AQE from its measured size, unless the number
of tasks is given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Execution knobs only: results do not depend on them.
HOT_ROWS = 100_000
HOT_SHARE = 10_000
SALT_BUCKETS = 64


def hot_keys(df: DataFrame, keys, min_rows: int = HOT_ROWS,
             share: int = HOT_SHARE) -> DataFrame:
    """Keys with more than `min_rows` rows and over a `share`-th of all rows."""
    total = df.agg(F.count(F.lit(1))).scalar()
    return (df.groupBy(*keys).count()
            .filter((F.col("count") > min_rows) & (F.col("count") * share > total))
            .select(*keys))


def salted_join(left: DataFrame, right: DataFrame, on, how: str, spread_by,
                min_rows: int = HOT_ROWS, share: int = HOT_SHARE,
                buckets: int = SALT_BUCKETS, counted: DataFrame | None = None,
                partitions: int | None = None) -> DataFrame:
    """`left.join(right, on, how)` with the left side's hot keys salted.

    `on` names key columns present in both; `spread_by` are left columns
    whose hash spreads a hot key's rows; `how` is one of inner, left,
    left_semi, left_anti. `counted` (default: `left`) is where keys are counted.
    With `partitions` the left side goes to that many tasks, which are not merged; it
    is a sort-merge join then, since AQE may broadcast a small left side that is ready
    first, and the join would run in the right side's tasks.
    """
    on = list(on)
    hot = hot_keys(left if counted is None else counted, on, min_rows, share)
    hot = F.broadcast(hot.withColumn("_hot", F.lit(True)))
    is_hot = F.coalesce(F.col("_hot"), F.lit(False))
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in spread_by]), F.lit(buckets))
    lhs = (left.join(hot, on, "left")
           .withColumn("_salt", F.when(is_hot, salt).otherwise(F.lit(0)).cast("int"))
           .drop("_hot"))
    if partitions:
        lhs = lhs.repartition(partitions, *on, "_salt")
    rhs = (right.join(hot, on, "left")
           .withColumn("_salt", F.explode(
               F.when(is_hot, F.sequence(F.lit(0), F.lit(buckets - 1)))
               .otherwise(F.array(F.lit(0)))))
           .drop("_hot"))
    if partitions:
        rhs = rhs.hint("merge")
    return lhs.join(rhs, on + ["_salt"], how).drop("_salt")
