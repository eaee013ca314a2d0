"""Sinks: CSV files, typed staging, published snapshots with one manifest, JDBC.

Parquet has no MERGE, so a published table is a series of immutable snapshot
folders ``<root>/<table>/v=<version>``, bucketed and sorted by the table's key so
that the next upsert reads them without a shuffle. A publish of all tables ends
with one small manifest file ``<root>/_manifests/<number>`` that names a snapshot
of every table. Readers follow the manifest with the highest number. Nothing is
ever overwritten while it may still be read.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, LongType, StructField, StructType

from followrec.sources.feeds import require_not_null

# Typed staging layouts of the three published tables (NOT NULL columns).
STAGING_SCHEMAS = {
    "closest_connections": StructType([
        StructField("user_id", LongType()),
        StructField("closest_connection", LongType()),
        StructField("weight", DecimalType(18, 8)),
    ]),
    "recommendations": StructType([
        StructField("user_id", LongType()),
        StructField("rec_id", LongType()),
    ]),
    "rec_reasons": StructType([
        StructField("user_id", LongType()),
        StructField("rec_id", LongType()),
        StructField("reason_id", LongType()),
        StructField("weight", DecimalType(18, 8)),
    ]),
}


def write_csv(df: DataFrame, path: str, header: bool = True) -> str:
    """CSV with header, overwrite (the dated object the next step reads)."""
    df.write.mode("overwrite").option("header", header).csv(path)
    return path


def load_staging(spark: SparkSession, path: str, table: str,
                 header: bool = True, view_name: str | None = None) -> DataFrame:
    """Bulk-load a CSV into the typed staging layout of `table`.

    FAILFAST makes a malformed value fail the load (like a typed COPY); every
    column is NOT NULL. With `view_name` the staging table is also registered
    as a session temp view (nothing to create or drop on disk).
    """
    schema = STAGING_SCHEMAS[table]
    df = (spark.read.schema(schema).option("header", header)
          .option("mode", "FAILFAST").csv(path))
    df = require_not_null(df, schema.fieldNames(), f"staging {table}")
    if view_name:
        df.createOrReplaceTempView(view_name)
    return df


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def write_text(spark: SparkSession, path: str, text: str) -> str:
    """One small file at `path` (any file system Spark knows); it must not exist."""
    fs, p = _fs(spark, path)
    out = fs.create(p, False)
    out.write(bytearray(text.encode()))
    out.close()
    return path


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, root = _fs(spark, folder)
    if not fs.exists(root):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(root))


def drop_partitions(spark: SparkSession, path: str, column: str, old) -> list[str]:
    """Delete the partition folders of `column` whose value `old` accepts; their values."""
    fs, root = _fs(spark, path)
    gone = []
    for name in _names(spark, path):
        key, _, value = name.partition("=")
        if key == column and value != "__HIVE_DEFAULT_PARTITION__" and old(value):
            fs.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root, name), True)
            gone.append(value)
    return gone


def _declare(spark: SparkSession, path: str, schema: StructType, keys, buckets: int) -> str:
    """Session table over a bucketed folder (the catalog holds nothing but its layout)."""
    name = f"bucketed_{hashlib.md5(path.encode()).hexdigest()}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    by = ", ".join(f"`{k}`" for k in keys)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
              f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return name


def write_bucketed(df: DataFrame, path: str, keys, buckets: int | None = None) -> str:
    """Write `df` bucketed and sorted by `keys`: one file per bucket.

    `buckets` defaults to the session's shuffle partitions; the number is kept
    next to the data, so any later session reads the same layout.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    data = f"{path.rstrip('/')}/data"
    if path_exists(spark, data):
        raise ValueError(f"{data} exists")
    name = _declare(spark, data, df.schema, keys, n)
    df.repartition(n, *keys).write.insertInto(name)
    spark.range(1).select(F.lit(n).cast("int").alias("buckets")).write.parquet(f"{path}/layout")
    return path


def read_bucketed(spark: SparkSession, path: str, schema: StructType, keys) -> DataFrame:
    """A folder of `write_bucketed`, with its bucketing known to the planner."""
    path = path.rstrip("/")
    n = spark.read.schema("buckets int").parquet(f"{path}/layout").first()[0]
    return spark.table(_declare(spark, f"{path}/data", schema, keys, n))


def write_snapshot(df: DataFrame, table_root: str, version: str, keys) -> str:
    """Write one immutable version; readers see it once a manifest names it."""
    path = f"{table_root.rstrip('/')}/v={version}"
    write_bucketed(df, path, keys)
    return f"{path}/data"


class PublishConflict(RuntimeError):
    """Another publish has been committed since this one began."""


@dataclass(frozen=True)
class Manifest:
    number: int
    tables: dict  # table name -> data folder of its snapshot


def latest_manifest(spark: SparkSession, root: str) -> Manifest | None:
    folder = f"{root.rstrip('/')}/_manifests"
    names = [n for n in _names(spark, folder) if n.isdigit()]
    if not names:
        return None
    row = spark.read.text(f"{folder}/{names[-1]}", wholetext=True).first()
    return Manifest(int(names[-1]), json.loads(row[0]))


def commit_manifest(spark: SparkSession, root: str, base: Manifest | None, tables: dict) -> Manifest:
    """Publish `tables` as the version after `base`, or fail if there is one already.

    The file is written aside and renamed without overwriting, so a reader
    never sees half a manifest and of two publishes with the same base one fails.
    """
    number = base.number + 1 if base else 1
    folder = f"{root.rstrip('/')}/_manifests"
    jvm = spark.sparkContext._jvm
    aside = jvm.org.apache.hadoop.fs.Path(
        write_text(spark, f"{folder}/.{uuid.uuid4().hex}", json.dumps(tables)))
    final = jvm.org.apache.hadoop.fs.Path(f"{folder}/{number:010d}")
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    fs = final.getFileSystem(conf)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        final.toUri(), conf) if final.toUri().getScheme() else \
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(conf)
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(aside, final, none)
    except Py4JJavaError as e:
        fs.delete(aside, False)
        if "FileAlreadyExists" in str(e.java_exception):
            raise PublishConflict(f"version {number} of {root} was published meanwhile") from None
        raise
    return Manifest(number, dict(tables))


def read_published(spark: SparkSession, root: str, name: str, schema: StructType, keys,
                   manifest: Manifest | None = None) -> DataFrame:
    """The published snapshot of one table, or an empty table of `schema`."""
    manifest = manifest or latest_manifest(spark, root)
    if manifest is None or name not in manifest.tables:
        return spark.createDataFrame([], schema)
    return read_bucketed(spark, manifest.tables[name].removesuffix("/data"), schema, keys)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict) -> None:
    """Publish to a relational table when a database is configured."""
    df.write.jdbc(url=url, table=table, mode="append", properties=properties)


def cut_lineage(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """Materialize to the shared folder and read back (survives lost executors)."""
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def as_weight(col) -> F.Column:
    return F.col(col).cast(DecimalType(18, 8))
