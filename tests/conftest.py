from __future__ import annotations

import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql.types import (  # noqa: E402
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from followrec.session import build_session  # noqa: E402
from followrec.sources.feeds import Feeds  # noqa: E402

AS_OF = datetime(2024, 1, 31)

FOLLOW = StructType([
    StructField("user_id", LongType()), StructField("engaged_with_user_id", LongType()),
    StructField("ts", TimestampNTZType()), StructField("rel_type", StringType())])
ENG = StructType([
    StructField("user_id", LongType()), StructField("engaged_with_user_id", LongType()),
    StructField("message_id", LongType()), StructField("ts", TimestampNTZType()),
    StructField("rel_type", StringType())])
USER = StructType([StructField("user_id", LongType()), StructField("suspended", IntegerType())])


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    s = build_session(master="local[4]", shuffle_partitions=4, app="followrec-tests")
    yield s


def make_feeds(spark, follow=(), reply=(), mention=(), like=(), users=()) -> Feeds:
    """Feeds from python rows: follow (u, e, ts); engagements (u, e, ts); users (u, s)."""
    def eng(rows, kind):
        return spark.createDataFrame(
            [(u, e, i, t, kind) for i, (u, e, t) in enumerate(rows)], ENG)
    return Feeds(
        follow=spark.createDataFrame([(u, e, t, None) for u, e, t in follow], FOLLOW),
        reply=eng(reply, "reply"), mention=eng(mention, "mention"), like=eng(like, "like"),
        user=spark.createDataFrame(list(users), USER))
