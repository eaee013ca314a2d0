"""Publishing semantics: upsert on a key, then expire stale rows.

An upsert is one full outer join of the current table with the new batch on
the key: matched rows take the batch's values and the run time as
updated_at but keep their created_at; new rows get the run time for both;
rows only in the table are kept unchanged. The published table is bucketed by
the key, so only the batch is shuffled to meet it. Expiry then drops rows whose
updated_at is more than `retention_days` before the run time; a table stored by
day drops whole days without reading them and rewrites only the boundary day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType, TimestampNTZType

from followrec.params import Params
from followrec.session import scratch_path
from followrec.sources.sinks import STAGING_SCHEMAS, cut_lineage, drop_partitions

# Published tables: key columns and updatable value columns.
TABLES = {
    "closest_connections": (["user_id", "closest_connection"], ["weight"]),
    "recommendations": (["user_id", "rec_id", "type"], []),
    "rec_reasons": (["user_id", "rec_id", "reason_id", "type"], ["weight"]),
}
# Fixed value: recommendation kind written with every recommendation row.
REC_TYPE = "user"


def bucket_keys(name: str) -> list[str]:
    """Key columns that a published table is bucketed by: those that vary. `type` is one
    constant, which the optimizer takes out of the upsert's join keys."""
    return [k for k in TABLES[name][0] if k != "type"]


def ts_literal(dt) -> F.Column:
    return F.lit(dt.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def table_schema(name: str) -> StructType:
    keys, _ = TABLES[name]
    fields = list(STAGING_SCHEMAS[name].fields)
    if "type" in keys:
        fields.insert(2, StructField("type", StringType()))
    return StructType(fields + [StructField("created_at", TimestampNTZType()),
                                StructField("updated_at", TimestampNTZType())])


def to_batch(name: str, staged: DataFrame) -> DataFrame:
    """Staged rows in the published column order (adds type for recs/reasons)."""
    keys, values = TABLES[name]
    if "type" in keys:
        staged = staged.withColumn("type", F.lit(REC_TYPE))
    return staged.select(*keys, *values)


def duplicate_keys(batch: DataFrame, keys) -> DataFrame:
    return batch.groupBy(*keys).count().filter(F.col("count") > 1)


def assert_unique_keys(batch: DataFrame, keys, what: str) -> None:
    """A batch may hold each key once (an upsert cannot apply two rows)."""
    dup = duplicate_keys(batch, keys).limit(1).collect()
    if dup:
        raise ValueError(f"{what}: duplicate key in upsert batch: {dup[0].asDict()}")


def upsert(target: DataFrame, batch: DataFrame, keys, values, params: Params) -> DataFrame:
    now = ts_literal(params.as_of)
    t = target.select(*keys, *[F.col(v).alias(f"_t_{v}") for v in values],
                      "created_at", "updated_at")
    b = batch.select(*keys, *[F.col(v).alias(f"_b_{v}") for v in values],
                     F.lit(True).alias("_in_batch"))
    j = t.join(b.hint("merge"), list(keys), "full_outer")
    in_b = F.coalesce(F.col("_in_batch"), F.lit(False))
    cols = [F.col(k) for k in keys]
    cols += [F.when(in_b, F.col(f"_b_{v}")).otherwise(F.col(f"_t_{v}")).alias(v) for v in values]
    cols += [F.coalesce(F.col("created_at"), now).alias("created_at"),
             F.when(in_b, now).otherwise(F.col("updated_at")).alias("updated_at")]
    return j.select(*cols)


def expire(table: DataFrame, params: Params) -> DataFrame:
    """Delete rows with updated_at < as_of - retention (null is kept, as in SQL)."""
    cutoff = ts_literal(params.expiry_cutoff)
    return table.filter(~F.coalesce(F.col("updated_at") < cutoff, F.lit(False)))


# ---------------------------------------------------------------- tables stored by day
def write_days(table: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Store a table by the day of updated_at: `day=yyyy-MM-dd`, null in a day of its own."""
    (table.withColumn("day", F.to_date("updated_at")).write.mode(mode)
     .option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path))


def read_days(spark, path: str, schema: StructType) -> DataFrame:
    by_day = StructType(schema.fields + [StructField("day", DateType())])
    return spark.read.schema(by_day).parquet(path).select(schema.fieldNames())


def expire_days(spark, path: str, schema: StructType, params: Params) -> list:
    """Delete rows with updated_at < cutoff from a table of `write_days`.

    Days before the cutoff's day are dropped as folders, unread. The cutoff's
    own day is rewritten by dynamic partition overwrite, and only when the
    cutoff lies inside it. Files of later days are not touched. Returns the
    dropped days.
    """
    cutoff = params.expiry_cutoff
    dropped = drop_partitions(spark, path, "day", lambda d: d < f"{cutoff:%Y-%m-%d}")
    if (cutoff.hour, cutoff.minute, cutoff.second) != (0, 0, 0):
        by_day = StructType(schema.fields + [StructField("day", DateType())])
        day = spark.read.schema(by_day).parquet(path).filter(F.col("day") == F.lit(cutoff.date()))
        kept = cut_lineage(spark, day.filter(F.col("updated_at") >= ts_literal(cutoff)).drop("day"),
                           scratch_path(spark, "boundary-day"))
        if kept.isEmpty():
            dropped += drop_partitions(spark, path, "day", lambda d: d == f"{cutoff:%Y-%m-%d}")
        else:
            write_days(kept, path, "overwrite")
    return dropped


def checked_batch(batch: DataFrame, keys, values, what: str) -> DataFrame:
    """The batch with a duplicate key failing the job, inside the plan.

    One row per key (its count travels along); a key held twice raises when
    the plan runs, so the write that consumes it never commits. The result is
    hash-partitioned by the key, which the upsert's join then reuses: the
    check costs neither an extra job nor an extra shuffle.
    """
    agg = batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"),
                                   *[F.first(v).alias(v) for v in values])
    ok = F.when(F.col("_n") > 1,
                F.raise_error(F.lit(f"{what}: duplicate key in upsert batch"))
                ).otherwise(F.lit(True))
    return agg.filter(ok).drop("_n")


def publish_table(name: str, target: DataFrame, staged: DataFrame, params: Params,
                  check_keys: bool = True) -> DataFrame:
    """Upsert + expiry of one table; a duplicate key in the batch fails the
    job that evaluates it (before anything is written)."""
    keys, values = TABLES[name]
    batch = to_batch(name, staged)
    if check_keys:
        batch = checked_batch(batch, keys, values, name)
    return expire(upsert(target, batch, keys, values, params), params)
