"""Running sums inside ordered groups that stay balanced when a group is huge.

A window `sum(...) over (partition by g order by o)` runs each group in one
task. Here rows are range-partitioned by (g, o), so that a hot group is cut
into contiguous slices spread over many tasks, and written with the number of
their slice. A window inside (slice, g) gives the local sums, one row per
(slice, g) gives each slice's offset, and the join of the two is keyed by
(slice, g): no step is keyed by a hot group alone. All steps are built-in
expressions, the same at every size, and no size is looked at beforehand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from followrec.session import scratch_path


def grouped_exclusive_sum(df: DataFrame, group_cols, order_cols, value_col: str,
                          out_col: str, total_col: str, num_partitions: int | None = None,
                          stage_path: str | None = None) -> DataFrame:
    """Adds `out_col` = sum of `value_col` over earlier rows of the same group
    (in `order_cols` order, which must make rows unique) and `total_col` = the
    group's total. `value_col` must be a non-negative integer.

    The sliced rows are written once (at `stage_path`, or in the shared
    scratch folder): all steps then see the same slices.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = stage_path or scratch_path(spark, "slices")
    (df.repartitionByRange(n, *group_cols, *order_cols)
     .withColumn("_slice", F.spark_partition_id()).write.mode("overwrite").parquet(path))
    sliced = spark.read.parquet(path)
    key = ["_slice", *group_cols]
    earlier = Window.unboundedPreceding, -1
    local = sliced.withColumn("_local", F.sum(value_col).over(
        Window.partitionBy(*key).orderBy(*order_cols).rowsBetween(*earlier)))
    # one row per slice and group: as many rows as slices for a hot group
    sums = sliced.groupBy(*key).agg(F.sum(value_col).alias("_sum"))
    offsets = sums.select(
        *key,
        F.sum("_sum").over(Window.partitionBy(*group_cols).orderBy("_slice")
                           .rowsBetween(*earlier)).alias("_offset"),
        F.sum("_sum").over(Window.partitionBy(*group_cols)).cast("long").alias(total_col))
    zero = F.lit(0)
    return (local.join(offsets, key)
            .withColumn(out_col, (F.coalesce("_local", zero) + F.coalesce("_offset", zero))
                        .cast("long"))
            .drop("_slice", "_local", "_offset"))
