"""Typed schemas (S9): the wire event and the tables the pipeline writes."""

from pyspark.sql import types as T

# Event as it travels on the log: six nullable strings. `songId` may arrive
# as a JSON number; decoding into a string field accepts both.
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("userId", T.StringType()),
        T.StructField("songId", T.StringType()),
        T.StructField("genre", T.StringType()),
        T.StructField("role", T.StringType()),
        T.StructField("ts", T.StringType()),
    ]
)

# Raw log record (key/value as on a Kafka topic, plus an optional offset).
MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)

ARTISTS = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("name", T.StringType()),
        T.StructField("genre", T.StringType()),
    ]
)

SONGS = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("title", T.StringType()),
        T.StructField("artist_id", T.LongType()),
        T.StructField("genre", T.StringType()),
        T.StructField("duration_sec", T.IntegerType()),
        T.StructField("audio_key", T.StringType()),
        T.StructField("cover_url", T.StringType()),
        T.StructField("premium_only", T.BooleanType()),
    ]
)

USERS = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("email", T.StringType()),
        T.StructField("role", T.StringType()),
    ]
)

PLAYLISTS = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("user_id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("created_at", T.TimestampNTZType()),
    ]
)

PLAYLIST_SONGS = T.StructType(
    [
        T.StructField("playlist_id", T.LongType(), False),
        T.StructField("song_id", T.LongType(), False),
        T.StructField("position", T.IntegerType()),
    ]
)

# Rollup deltas written once per micro-batch under epoch=<id>.
SONG_MINUTE_DELTA = T.StructType(
    [
        T.StructField("song_id", T.LongType()),
        T.StructField("genre", T.StringType()),
        T.StructField("window_start", T.TimestampType()),
        T.StructField("plays", T.LongType()),
        T.StructField("uniq_approx", T.LongType()),
        T.StructField("uniq_sketch", T.BinaryType()),
        T.StructField("written_at", T.TimestampType()),
    ]
)

USER_GENRE_DELTA = T.StructType(
    [
        T.StructField("user_hash", T.StringType()),
        T.StructField("genre", T.StringType()),
        T.StructField("plays", T.LongType()),
        T.StructField("written_at", T.TimestampType()),
    ]
)

# Request log derived from service metrics / gateway lines.
REQUEST_LOG = T.StructType(
    [
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("service", T.StringType()),
        T.StructField("method", T.StringType()),
        T.StructField("route", T.StringType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("duration_seconds", T.DoubleType()),
    ]
)
