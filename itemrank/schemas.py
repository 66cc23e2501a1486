"""Explicit schemas (no inference anywhere)."""

from pyspark.sql import types as T

RATINGS = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("movie_id", T.LongType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("timestamp", T.LongType()),
])

MOVIES_RAW = T.StructType([
    T.StructField("movie_id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("genres", T.StringType()),
])

USERS = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("gender", T.StringType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("occupation", T.IntegerType()),
    T.StructField("zip_code", T.StringType()),
])

# Rating events as they arrive: every field untrusted, validated by V1.
RATING_EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("movie_id", T.LongType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("timestamp", T.LongType()),
])

# Raw `events` fixture table the rating event stream is derived from.
EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])
