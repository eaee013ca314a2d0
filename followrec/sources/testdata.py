"""Stand-in inputs built from the shared test tables.

This only gives rows in the schemas the jobs read (see FIXTURES.md section 2);
it does none of the jobs' work. Engagements come from `events`, messages from
`documents` and `labels`.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from followrec.sources.feeds import Feeds
from followrec.sources.schemas import LINK
from pyspark.sql.types import ArrayType

# Fixed values of the mapping (FIXTURES.md section 2).
ENGAGEMENT_EVENT_TYPES = {"reply": "view", "mention": "purchase", "like": "click"}
FOLLOW_EVENT_TYPE = "signup"
SUSPENDED_MODULUS = 17          # id % 17 = 0 suspended, = 1 unknown (null), else 0
MESSAGE_USERS = 100             # user_id = doc_id % 100
MESSAGE_DAYS = 400              # created_at = anchor + doc_id % 400 days
MESSAGE_ANCHOR = date(2018, 9, 9)
URL_EVERY = 5                   # doc_id % 5 = 0 gets a URL appended
URL_PREFIX = " https://example.org/"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Spread an under-split scan over the available cores.

    Each test table is one parquet file with a single row group, which Spark
    cannot split: all work before the first shuffle would run as one task.
    Only then are rows redistributed (round robin); a scan that already has
    at least `defaultParallelism` splits (any large input) is left alone.
    Filters and column pruning still reach the scan below the redistribution.
    Used for documents, whose per-row work (five regex passes over long
    texts) dominates; the light engagement scans are not worth a shuffle.
    """
    try:
        target = spark.sparkContext.defaultParallelism
        splits = df.rdd.getNumPartitions()
    except Exception:  # no RDD access (e.g. a remote session): leave the scan as is
        return df
    return df.repartition(target) if splits < target else df


def events_with_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", "ts", "user_id", "event_type",
                     F.get_json_object("props", "$.k").cast("bigint").alias("k"))


def map_feeds(spark: SparkSession, sf_dir: str) -> Feeds:
    ev = events_with_target(spark, sf_dir)

    def engagement(event_type: str) -> DataFrame:
        return (ev.filter(F.col("event_type") == event_type)
                .select("user_id", F.col("k").alias("engaged_with_user_id"),
                        F.col("event_id").alias("message_id"), "ts",
                        F.col("event_type").alias("rel_type")))

    follow = (ev.filter(F.col("event_type") == FOLLOW_EVENT_TYPE)
              .select("user_id", F.col("k").alias("engaged_with_user_id"), "ts",
                      F.lit(None).cast("string").alias("rel_type")))
    ids = (ev.select(F.col("user_id").alias("id"))
           .union(ev.select(F.col("k").alias("id"))).distinct())
    m = F.pmod(F.col("id"), F.lit(SUSPENDED_MODULUS))
    user = ids.select(
        F.col("id").alias("user_id"),
        F.when(m == 0, F.lit(1)).when(m == 1, F.lit(None)).otherwise(F.lit(0))
        .cast("int").alias("suspended"))
    return Feeds(follow=follow,
                 reply=engagement(ENGAGEMENT_EVENT_TYPES["reply"]),
                 mention=engagement(ENGAGEMENT_EVENT_TYPES["mention"]),
                 like=engagement(ENGAGEMENT_EVENT_TYPES["like"]),
                 user=user)


def map_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages in the JSON layout: user_id, msg_id, body, created_at, recommended, links."""
    docs = spread(spark, table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("recommended"))
    d = F.col("doc_id")
    created = F.date_add(F.lit(MESSAGE_ANCHOR), F.pmod(d, F.lit(MESSAGE_DAYS)).cast("int"))
    links = (F.when(F.pmod(d, F.lit(3)) == 0, F.lit(None).cast(ArrayType(LINK)))
             .when(F.pmod(d, F.lit(3)) == 1, F.array().cast(ArrayType(LINK)))
             .otherwise(F.array(F.struct(F.col("source").alias("description")))))
    body = F.when(F.pmod(d, F.lit(URL_EVERY)) == 0,
                  F.concat(F.col("text"), F.lit(URL_PREFIX), d.cast("string"))
                  ).otherwise(F.col("text"))
    return (docs.join(labels, "doc_id", "left")
            .select(F.pmod(d, F.lit(MESSAGE_USERS)).alias("user_id"),
                    d.alias("msg_id"),
                    body.alias("body"),
                    F.concat(F.date_format(created, "yyyy-MM-dd"), F.lit("T00:00:00Z"))
                    .alias("created_at"),
                    F.col("recommended").cast("int").alias("recommended"),
                    links.alias("links")))
