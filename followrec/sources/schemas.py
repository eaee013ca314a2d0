"""Schemas of the feeds at rest (read with an explicit schema, never inferred)."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# follow.csv, no header: user_id, engaged_with_user_id, timestamp [, rel_type]
FOLLOW_CSV = StructType([
    StructField("user_id", LongType()),
    StructField("engaged_with_user_id", LongType()),
    StructField("timestamp", StringType()),
    StructField("rel_type", StringType()),
])

# reply.csv / mention.csv / like.csv, no header
ENGAGEMENT_CSV = StructType([
    StructField("user_id", LongType()),
    StructField("engaged_with_user_id", LongType()),
    StructField("message_id", LongType()),
    StructField("timestamp", StringType()),
    StructField("rel_type", StringType()),
])

# user.csv, no header, 12 or more columns; only positions 0 and 11 are used.
USER_CSV_WIDTH = 12
USER_CSV = StructType(
    [StructField("user_id", LongType())]
    + [StructField(f"_c{i}", StringType()) for i in range(1, USER_CSV_WIDTH - 1)]
    + [StructField("suspended", StringType())]  # a number as text, parsed by the reader
)

# closest_connections.csv (wide, header): comma-joined ids and 8-decimal weights
CLOSEST_LISTS_CSV = StructType([
    StructField("user_id", LongType()),
    StructField("engaged_with_user_id", StringType()),
    StructField("weight", StringType()),
])

# closest_connections_data.csv (long, header)
CLOSEST_LONG_CSV = StructType([
    StructField("user_id", LongType()),
    StructField("engaged_with_user_id", LongType()),
    StructField("weight", StringType()),
])

# score.csv (header)
SCORE_CSV = StructType([
    StructField("user_id", LongType()),
    StructField("pred", StringType()),  # a number as text, parsed by the reader
])

# messages, JSON lines
LINK = StructType([StructField("description", StringType())])
MESSAGE_JSON = StructType([
    StructField("user_id", LongType()),
    StructField("msg_id", LongType()),
    StructField("body", StringType()),
    StructField("created_at", StringType()),
    StructField("recommended", IntegerType()),
    StructField("links", ArrayType(LINK)),
])
