"""Exact dedup against a persistent digest index (operator 11).

The index is a Parquet table, bucketed and sorted by the SHA-256 of the text, one row
per text that was ever kept: (digest, keep_id, arrival). Each arrival of new rows is
grouped by digest (map-side, so a text that a third of all rows hold is one row a task),
meets the index in a sort-merge anti join and is appended to it. The groups are dealt out
like the index's buckets, so the index itself is never shuffled. ``compact`` brings the
files of many arrivals back to one a bucket.

An entry names its arrival, which makes an arrival safe to repeat: texts that a broken
first attempt appended are recognised as its own, neither lost nor appended again.

Defined results: a null text counts as empty; texts are equal when their bytes are. Of
equal texts in one arrival the row with the largest doc_id is kept (a null id is the
smallest; of rows with equal id and text exactly one). A text that an earlier arrival
kept is dropped whatever its id. Empty tables give empty results; other columns are
carried along or ignored, whatever their names. Texts of any length are digested in the
scan and never shuffled by ``exact_duplicates``.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from followrec.llm.common import join_groups, scratch_root, stage

ENTRY = "digest binary, keep_id bigint, arrival string"


class DigestIndex:
    """The index in folder ``path`` (shared by driver and executors), made if it is new.

    ``buckets`` counts for a new index only; by default it has as many as the session
    has shuffle partitions.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        self.buckets = self._buckets(buckets)
        self.name = f"digest_index_{hashlib.md5(self.path.encode()).hexdigest()}"
        self._declare(self.name, f"{self.path}/entries", " IF NOT EXISTS")

    def _buckets(self, wanted: int | None) -> int:
        about = f"{self.path}/about"
        try:
            return int(self.spark.read.schema("buckets int").parquet(about).first()[0])
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
        n = wanted or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.spark.range(1).select(F.lit(n).cast("int").alias("buckets")).write.parquet(about)
        return n

    def _declare(self, name: str, path: str, how: str = "") -> None:
        self.spark.sql(f"CREATE TABLE{how} {name} ({ENTRY}) USING parquet "
                       f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS "
                       f"LOCATION '{path}'")

    def entries(self) -> DataFrame:
        return self.spark.table(self.name)

    def dealt(self, groups: DataFrame) -> DataFrame:
        """``groups`` partitioned as the buckets are, so that a join leaves the index in place."""
        return groups.repartition(self.buckets, "digest").hint("merge")

    def unseen(self, groups: DataFrame) -> DataFrame:
        """The rows of ``groups(digest, ...)``, one a digest, that the index does not hold."""
        return self.dealt(groups).join(self.entries(), "digest", "left_anti")

    def append(self, rows: DataFrame, arrival: str) -> None:
        """Enter the new texts of ``rows(digest, doc_id)`` under the name of their arrival."""
        groups = rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id"))
        (self.unseen(groups).select("digest", "keep_id", F.lit(arrival).alias("arrival"))
         .write.insertInto(self.name))

    def compact(self, path: str) -> DigestIndex:
        """A copy in a new folder with one sorted file a bucket."""
        out = DigestIndex(self.spark, path, self.buckets)
        self.entries().repartition(self.buckets, "digest").write.insertInto(out.name)
        return out


def digest_of(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def _numbered(rows: DataFrame) -> DataFrame:
    """Staged, so that every reader sees the same row numbers."""
    return stage(rows.withColumn("row_no", F.monotonically_increasing_id()), "digests")


def new_documents(docs: DataFrame, index: DigestIndex, arrival: str) -> DataFrame:
    """The rows of ``docs`` with a text that is new to the index, which takes it in.

    All columns of ``docs`` are returned. A repeated call under the same name returns
    the same texts.
    """
    rows = _numbered(docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
                                 F.col("doc_id").cast("bigint").alias("doc_id"),
                                 digest_of(F.col("text")).alias("digest")))
    index.append(rows, arrival)
    last = rows.groupBy("digest").agg(F.max(F.struct("doc_id", "row_no")).alias("last"))
    own = index.entries().where(F.col("arrival") == arrival).select("digest")
    kept = index.dealt(last).join(own, "digest", "left_semi").select(F.col("last.row_no"))
    out = rows.join(kept, "row_no", "left_semi")
    return out.select(*(F.col("row")[c].alias(c) for c in docs.columns))


def exact_duplicates(docs: DataFrame, index: DigestIndex | None = None,
                     arrivals: int = 2) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    The rows come to the index in ``arrivals`` parts of about equal size, those with the
    largest ids first: the index keeps the text that comes first, so the largest id of
    all stays. Where the parts are cut only decides how much is done at a time. A text
    that the given index held before keeps the id it had there, and none of its rows
    here is kept. group_size counts the rows here.
    """
    spark = docs.sparkSession
    run = uuid.uuid4().hex
    index = index or DigestIndex(spark, f"{scratch_root(spark)}/llm/digest-index-{run}")
    rows = _numbered(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                                 digest_of(F.col("text")).alias("digest")))
    shares = [1 - (k + 1) / arrivals for k in range(arrivals - 1)]
    cuts = rows.agg(F.percentile_approx("doc_id", shares)).first()[0] if shares else []
    upper = None
    for k, lower in enumerate([*(cuts or []), None]):
        part = rows if lower is None else rows.where(F.col("doc_id") >= lower)
        if upper is not None:
            part = part.where(F.col("doc_id").isNull() | (F.col("doc_id") < upper))
        index.append(part, f"{run}-{k}")
        upper = lower
    groups = rows.groupBy("digest").agg(F.count("*").alias("group_size"),
                                        F.max(F.struct("doc_id", "row_no")).alias("last"))
    known = index.dealt(groups).join(index.entries(), "digest")
    own = F.col("arrival").startswith(f"{run}-")
    known = stage(known.select("digest", "group_size", "keep_id",
                               F.when(own, F.col("last.row_no")).alias("keep_row")), "groups")
    out = join_groups(rows, known, ["digest"], "group_size", rows.count())
    return out.select(
        "doc_id", "keep_id", "group_size",
        F.coalesce(F.col("row_no") == F.col("keep_row"), F.lit(False)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


#: DuckDB SQL of the query (its ids are unique and not null).
ORACLE_SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
