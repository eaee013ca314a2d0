"""Readers for the daily feeds.

Every reader declares its schema, keeps only the columns the pipeline uses
(the CSV parser prunes the rest) and rejects rows with a missing key or an
unreadable timestamp inside the plan (``raise_error``), so a bad file fails
the job instead of producing a 'nan' user or silently losing the row.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from followrec.functions import parse_ts_text, text_to_w8
from followrec.functions.timefns import date_folder
from followrec.sources import schemas

FEED_FILES = {
    "follow": "follow.csv",
    "reply": "reply.csv",
    "mention": "mention.csv",
    "like": "like.csv",
    "user": "user.csv",
}


@dataclass(frozen=True)
class Feeds:
    """Typed engagement feeds.

    follow: user_id, engaged_with_user_id, ts, rel_type
    reply / mention / like: user_id, engaged_with_user_id, message_id, ts, rel_type
    user: user_id, suspended
    """

    follow: DataFrame
    reply: DataFrame
    mention: DataFrame
    like: DataFrame
    user: DataFrame


def require_not_null(df: DataFrame, cols, what: str) -> DataFrame:
    """Fail the job on a null key; evaluated lazily inside the plan."""
    for c in cols:
        df = df.withColumn(
            c,
            F.when(F.col(c).isNull(),
                   F.raise_error(F.lit(f"{what}: null {c}"))).otherwise(F.col(c)),
        )
    return df


def number(col: str, what: str) -> Column:
    """Number in a text column: blank and 'nan' are null, '1.0' is 1, and other
    text that is no number fails the job."""
    text = F.trim(col)
    value = text.try_cast("double")
    return (F.when(text.isNull() | (text == "") | F.isnan(value), F.lit(None).cast("double"))
            .when(value.isNull(), F.raise_error(F.concat(F.lit(f"{what}: unreadable {col} "), text))
                  .cast("double"))
            .otherwise(value))


def _csv(spark: SparkSession, path: str, schema, header: bool = False) -> DataFrame:
    return (spark.read.schema(schema)
            .option("header", header)
            .option("mode", "PERMISSIVE")
            .csv(path))


def read_follow(spark: SparkSession, path: str) -> DataFrame:
    """follow.csv: 3 columns, or 4 with rel_type (one schema for both)."""
    df = _csv(spark, path, schemas.FOLLOW_CSV).select(
        "user_id", "engaged_with_user_id",
        parse_ts_text("timestamp").alias("ts"), "rel_type")
    return require_not_null(df, ["user_id", "engaged_with_user_id", "ts"], "follow")


def read_engagement(spark: SparkSession, path: str) -> DataFrame:
    """reply / mention / like: positions 0, 1, 3 are used, 2 and 4 kept typed."""
    df = _csv(spark, path, schemas.ENGAGEMENT_CSV).select(
        "user_id", "engaged_with_user_id", "message_id",
        parse_ts_text("timestamp").alias("ts"), "rel_type")
    return require_not_null(df, ["user_id", "engaged_with_user_id", "ts"], "engagement")


def read_user(spark: SparkSession, path: str) -> DataFrame:
    """user.csv: position 0 user_id, position 11 suspended (0, 1 or empty; 1.0 is 1)."""
    df = _csv(spark, path, schemas.USER_CSV).select(
        "user_id", number("suspended", "user").cast("int").alias("suspended"))
    return require_not_null(df, ["user_id"], "user")


def read_feeds(spark: SparkSession, folder: str) -> Feeds:
    f = FEED_FILES
    return Feeds(
        follow=read_follow(spark, f"{folder}/{f['follow']}"),
        reply=read_engagement(spark, f"{folder}/{f['reply']}"),
        mention=read_engagement(spark, f"{folder}/{f['mention']}"),
        like=read_engagement(spark, f"{folder}/{f['like']}"),
        user=read_user(spark, f"{folder}/{f['user']}"),
    )


def daily_folder(root: str, as_of: datetime) -> str:
    """The day's folder, root/yyyyMMdd (one folder per daily snapshot)."""
    return f"{root.rstrip('/')}/{as_of.strftime('%Y%m%d')}"


def read_daily_partition(spark: SparkSession, root: str, as_of: datetime,
                         fmt: str = "parquet") -> DataFrame:
    """Read one day of a `ds=yyyyMMdd` partitioned feed (partition pruning)."""
    df = spark.read.format(fmt).load(root)
    return df.filter(F.col("ds") == as_of.strftime("%Y%m%d"))


def read_closest_lists(spark: SparkSession, path: str) -> DataFrame:
    """Wide closest connections (header): user_id, 'a,b,c', '0.1,0.2,0.3'."""
    df = _csv(spark, path, schemas.CLOSEST_LISTS_CSV, header=True)
    return require_not_null(df, ["user_id"], "closest lists")


def parse_closest_lists(lists: DataFrame) -> DataFrame:
    """Wide lists to one row per (user, target) in list order.

    Ids and weights are split on ',' and zipped; lists of unequal length, and
    ids or weights that are no numbers, fail the job. The weight text is parsed
    back to its exact 8-decimal form.
    Output: user_id, engaged_with_user_id, rank (1-based), w8.
    """
    ids, weights = F.split("engaged_with_user_id", ","), F.split("weight", ",")
    zipped = F.arrays_zip(
        ids.alias("id"), F.transform(weights, lambda w: text_to_w8(w)).alias("w8"))
    unequal = F.coalesce(F.size(ids), F.lit(-1)) != F.coalesce(F.size(weights), F.lit(-1))
    pairs = F.when(unequal, F.raise_error(F.lit("closest lists: lists of unequal length"))
                   ).otherwise(zipped)
    return require_not_null(
        lists.select("user_id", F.posexplode(pairs).alias("pos", "e"))
        .select("user_id",
                F.trim(F.col("e.id")).cast("bigint").alias("engaged_with_user_id"),
                (F.col("pos") + 1).alias("rank"),
                F.col("e.w8").alias("w8")),
        ["engaged_with_user_id", "w8"], "closest lists")


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    """score.csv (header): user_id, pred."""
    df = _csv(spark, path, schemas.SCORE_CSV, header=True).select(
        "user_id", number("pred", "scores").alias("pred"))
    return require_not_null(df, ["user_id"], "scores")


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """Messages as JSON lines; malformed lines fail the read, and so does a
    message without user, body or creation time (`recommended`, `links` and
    `msg_id` are optional)."""
    df = (spark.read.schema(schemas.MESSAGE_JSON)
          .option("mode", "FAILFAST")
          .json(path))
    return require_not_null(df, ["user_id", "body", "created_at"], "message")


def preview(df: DataFrame, order_cols, n: int = 3) -> DataFrame:
    """First n rows in a stated order (a top-n, not an arbitrary head)."""
    return df.orderBy(*order_cols).limit(n)


def feed_as_csv_rows(df: DataFrame, kind: str, sep: str = " ") -> DataFrame:
    """Typed feed to the at-rest column layout (timestamp as text)."""
    ts_text = F.concat(F.date_format("ts", "yyyy-MM-dd"), F.lit(sep),
                       F.date_format("ts", "HH:mm:ss"))
    if kind == "follow":
        return df.select("user_id", "engaged_with_user_id", ts_text.alias("timestamp"))
    if kind == "user":
        fill = [F.lit(None).cast("string").alias(f"_c{i}")
                for i in range(1, schemas.USER_CSV_WIDTH - 1)]
        fill[0] = F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("_c1")
        return df.select("user_id", *fill, "suspended")
    return df.select("user_id", "engaged_with_user_id", "message_id",
                     ts_text.alias("timestamp"), "rel_type")


def write_feeds_csv(feeds: Feeds, folder: str) -> str:
    """Write feeds in the at-rest layout (headerless CSV, one folder each)."""
    for kind, df in (("follow", feeds.follow), ("reply", feeds.reply),
                     ("mention", feeds.mention), ("like", feeds.like),
                     ("user", feeds.user)):
        sep = " " if kind in ("follow", "user") else "T"
        (feed_as_csv_rows(df, kind, sep).write.mode("overwrite")
         .option("header", False).csv(f"{folder}/{FEED_FILES[kind]}"))
    return folder


def write_daily_partitioned(df: DataFrame, root: str, ts_col: str = "ts") -> str:
    """Write a feed partitioned by its day, ds=yyyyMMdd."""
    (df.withColumn("ds", date_folder(ts_col)).write.mode("overwrite")
     .partitionBy("ds").parquet(root))
    return root
