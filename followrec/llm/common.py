"""Reading tables, shared scratch space and connected components."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_root(spark: SparkSession) -> str:
    """Folder that the driver and all executors share (``spark.checkpoint.dir``).

    Only a session with a local master may go without the setting; it then gets
    a temporary folder that is removed when the program ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if spark.conf.get("spark.master", "").partition("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="llm-scratch-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", f"file://{root}")
    return f"file://{root}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate as Parquet in the shared folder and read it back.

    This cuts the lineage: a lost executor costs the tasks it was running, not
    the stages before.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of the undirected edges (a, b): columns node, comp.

    ``comp`` is the smallest node of the component. Every round hands each node
    the smallest label next to it and then follows labels twice as far, so the
    number of rounds grows with the logarithm of a component's diameter. Each
    round is staged; only the count of changed labels comes to the driver. A
    node with very many links is aggregated map-side, never gathered.
    """
    both = stage(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
                 .where("a <> b").distinct(), f"{name}-edges")
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                   .select("node", F.least("node", "m").alias("comp")), f"{name}-labels")
    while True:
        near = (both.join(labels, both.b == labels.node).groupBy("a")
                .agg(F.min("comp").alias("m")))
        step = stage(labels.join(near, labels.node == near.a, "left")
                     .select("node", F.col("comp").alias("was"),
                             F.least("comp", "m").alias("comp")), f"{name}-step")
        jump = step.select(F.col("node").alias("via"), F.col("comp").alias("far"))
        seen = Observation()  # counted while the labels are written
        labels = stage(step.join(jump, step.comp == jump.via, "left")
                       .select("node", "was", F.least("comp", "far").alias("comp"))
                       .observe(seen, F.count_if(F.col("comp") != F.col("was")).alias("changed")),
                       f"{name}-labels").select("node", "comp")
        if not seen.get["changed"]:
            return labels


def maybe_among(rows: DataFrame, keys: DataFrame, on: list[str], bits: int = 1 << 24) -> DataFrame:
    """Rows of ``rows`` without those whose columns ``on`` surely match no row of ``keys``.

    Every key sets one of ``bits`` bits, map-side; the bitmap has ``bits`` / 8 bytes (2 MB)
    whatever the number of keys and is broadcast. A wrong bit lets a row through, so a
    join must follow; it drops no match. ``rows`` has no columns of the names added here.
    """
    at = F.pmod(F.xxhash64(*on), F.lit(bits)) + 1
    bitmap = (keys.groupBy(F.bitmap_bucket_number(at).alias("_bucket"))
              .agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("_bits")))
    byte = F.substring("_bits", (F.floor(F.col("_bit") / 8) + 1).cast("int"), F.lit(1))
    return (rows.withColumns({"_bucket": F.bitmap_bucket_number(at),
                              "_bit": F.bitmap_bit_position(at)})
            .join(F.broadcast(bitmap), "_bucket")
            .where(F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"),
                            (F.col("_bit") % 8).cast("int")) == 1)
            .drop("_bucket", "_bit", "_bits"))


def marked_among(rows: DataFrame, keys: DataFrame, on: list[str], name: str,
                 bits: int = 1 << 24) -> DataFrame:
    """``rows`` with a column ``name``: false if ``on`` surely matches no row of ``keys``.

    As :func:`maybe_among`, but no row is left out. Equal keys get equal marks.
    """
    at = F.pmod(F.xxhash64(*on), F.lit(bits)) + 1
    bitmap = (keys.groupBy(F.bitmap_bucket_number(at).alias("_bucket"))
              .agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("_bits")))
    byte = F.substring("_bits", (F.floor(F.col("_bit") / 8) + 1).cast("int"), F.lit(1))
    mark = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (F.col("_bit") % 8).cast("int")) == 1
    return (rows.withColumns({"_bucket": F.bitmap_bucket_number(at),
                              "_bit": F.bitmap_bit_position(at)})
            .join(F.broadcast(bitmap), "_bucket", "left")
            .withColumn(name, F.coalesce(mark, F.lit(False)))
            .drop("_bucket", "_bit", "_bits"))


def bitmap_of(rows: DataFrame, column: str, bits: int) -> np.ndarray:
    """Bitmap of the lowest bits of a bigint column (``bits`` / 8 bytes; a power of two from 2^15 on)."""
    at = F.pmod(F.col(column), F.lit(bits)) + 1
    parts = rows.groupBy(F.bitmap_bucket_number(at).alias("b")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")).collect()
    size = len(parts[0].bits) if parts else 1
    out = np.zeros((max(bits // 8 // size, 1), size), np.uint8)
    for part in parts:  # at most bits / 8 bytes together
        out[part.b - 1] = np.frombuffer(part.bits, np.uint8)
    return out.ravel()


def in_bitmap(bitmap: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Whether the lowest bits of each value are set in a bitmap of :func:`bitmap_of`."""
    at = values.astype(np.int64) & (len(bitmap) * 8 - 1)
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


#: A key that holds more than this share of all rows is joined by a broadcast of its group.
HOT_SHARE = 1000


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size: str,
                total: int) -> DataFrame:
    """Inner join of ``rows`` with ``groups``, which has one row per key and its ``size``.

    A key with more than a thousandth of all ``total`` rows would make one long task of a
    shuffle join. There are fewer than 1,000 such keys, so their groups are broadcast;
    the rest meet by sorting. Keys are not null.
    """
    hot = groups.where(F.col(size) * HOT_SHARE > F.lit(total))
    cold = groups.where(F.col(size) * HOT_SHARE <= F.lit(total))
    spread = rows.join(F.broadcast(hot.select(keys)), keys, "left_anti")
    return (rows.join(F.broadcast(hot), keys)
            .unionByName(spread.join(cold.hint("merge"), keys)))
