"""Event intake: validate requests, build keyed messages, decode them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamcharts.constants import EVENT_TYPES
from streamcharts.functions.privacy import pseudonym
from streamcharts.functions.scalars import premium_allowed
from streamcharts.functions.timefns import minute_floor, parse_iso, to_iso
from streamcharts.sources.schemas import EVENT_SCHEMA

# Reasons an interaction request is refused, in the order they are checked.
REJECT_INVALID_SONG_ID = "invalid_song_id"
REJECT_INVALID_TYPE = "invalid_type"
REJECT_SONG_NOT_FOUND = "song_not_found"
REJECT_PREMIUM_REQUIRED = "premium_required"

# Reasons a decoded log record is routed aside instead of stopping the job.
DECODE_MALFORMED_JSON = "malformed_json"
DECODE_UNKNOWN_TYPE = "unknown_type"
DECODE_BAD_SONG_ID = "bad_song_id"
DECODE_BAD_TS = "bad_ts"
DECODE_MISSING_GENRE = "missing_genre"

_CORRUPT = "_corrupt_record"


def accept_events(requests: DataFrame, songs: DataFrame, users: DataFrame) -> DataFrame:
    """Validate play/skip/like requests against the catalog and the account.

    ``requests`` needs ``type, user_id, song_id`` (song id may be any type).
    Output keeps every request with the song's ``genre``, the account's ``role``
    and a ``reject_reason`` (null when accepted), checked in the order: id,
    type, catalog, premium gate (plays only). Song and user lookups are plain
    equi-joins; Spark broadcasts the dimension only when its size estimate is
    under the threshold, and AQE splits hot song keys otherwise.
    """
    sid = requests["song_id"].try_cast("long")
    req = requests.withColumn("_sid", sid)
    s = songs.select(
        F.col("id").alias("_sid"), F.col("genre"), F.col("premium_only"), F.lit(True).alias("_found")
    )
    u = users.select(F.col("id").alias("user_id"), F.col("role"))
    joined = req.join(s, "_sid", "left").join(u, "user_id", "left")
    valid_id = F.coalesce(F.col("_sid") > 0, F.lit(False))
    reason = (
        F.when(~valid_id, F.lit(REJECT_INVALID_SONG_ID))
        .when(~F.coalesce(F.col("type").isin(*EVENT_TYPES), F.lit(False)), F.lit(REJECT_INVALID_TYPE))
        .when(F.col("_found").isNull(), F.lit(REJECT_SONG_NOT_FOUND))
        .when(
            (F.col("type") == "play") & ~premium_allowed(F.col("premium_only"), F.col("role")),
            F.lit(REJECT_PREMIUM_REQUIRED),
        )
    )
    return (
        joined.withColumn("reject_reason", reason)
        .withColumn("song_id", F.col("_sid"))
        .drop("_sid", "_found")
    )


def event_struct(accepted: DataFrame, ts: Column | None = None) -> Column:
    """The wire event (P19): type, raw user id, song id, catalog genre, role, ISO time."""
    ts = ts if ts is not None else F.col("ts")
    return F.struct(
        F.col("type").alias("type"),
        F.col("user_id").cast("string").alias("userId"),
        F.col("song_id").cast("string").alias("songId"),
        F.col("genre").alias("genre"),
        F.col("role").alias("role"),
        to_iso(ts).alias("ts"),
    )


def to_messages(accepted: DataFrame, ts: Column | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Keyed JSON records (K12/K13): key = song id, value = the event as JSON.

    Keying by song id keeps one song's events in one log partition, as the
    producer does; writing goes through ``write``/``writeStream`` with any sink.
    ``keep`` names columns to carry along (an event id, a time to order by).
    """
    return accepted.select(
        *keep,
        F.col("song_id").cast("string").alias("key"),
        F.to_json(event_struct(accepted, ts), {"ignoreNullFields": "false"}).alias("value"),
    )


def decode_messages(messages: DataFrame, salt: str | bytes) -> DataFrame:
    """Decode log records (P1-P7) and pseudonymize before anything else.

    Output columns: ``type, songId, genre, role, ts, window_start, user_hash``,
    plus ``song_id`` (bigint) and ``decode_error`` (null for good rows); other
    message columns (log offsets, an event id) pass through. The raw
    user id is dropped in the same projection that hashes it. Bad input is
    flagged, never raised: ANSI mode would otherwise stop the stream.
    """
    schema = T.StructType(EVENT_SCHEMA.fields + [T.StructField(_CORRUPT, T.StringType())])
    extra = [c for c in messages.columns if c not in ("key", "value")]  # offsets, ids, log time
    decoded = messages.select(
        *extra,
        F.from_json(
            F.col("value").cast("string"), schema, {"columnNameOfCorruptRecord": _CORRUPT}
        ).alias("e"),
    ).select(
        *extra,
        F.col("e.type").alias("type"),
        F.col("e.songId").alias("songId"),
        F.col("e.genre").alias("genre"),
        F.col("e.role").alias("role"),
        pseudonym(F.col("e.userId"), salt).alias("user_hash"),
        parse_iso(F.col("e.ts")).cast("timestamp_ntz").alias("ts"),
        (F.col(f"e.{_CORRUPT}").isNotNull() | F.col("e").isNull()).alias("_malformed"),
    )
    song_id = F.col("songId").try_cast("long")
    error = (
        F.when(F.col("_malformed"), F.lit(DECODE_MALFORMED_JSON))
        .when(~F.coalesce(F.col("type").isin(*EVENT_TYPES), F.lit(False)), F.lit(DECODE_UNKNOWN_TYPE))
        .when(song_id.isNull(), F.lit(DECODE_BAD_SONG_ID))
        .when(F.col("ts").isNull(), F.lit(DECODE_BAD_TS))
        .when(F.col("genre").isNull(), F.lit(DECODE_MISSING_GENRE))
    )
    return (
        decoded.withColumn("song_id", song_id)
        .withColumn("window_start", minute_floor(F.col("ts")))
        .withColumn("decode_error", error)
        .drop("_malformed")
    )


def good_plays(decoded: DataFrame) -> DataFrame:
    """Rows that feed the rollups: decodable plays only (P5)."""
    return decoded.filter(F.col("decode_error").isNull() & (F.col("type") == "play"))


def play_rows(events: DataFrame, salt: str | bytes) -> DataFrame:
    """Plays from the event table, hashed, without the catalog lookup.

    ``event_id, song_id, user_hash, ts, window_start``. Rollups built from this
    aggregate first and join the catalog per song afterwards (see
    ``rollups.*_from_plays``), so the catalog join never sees one row per event.
    """
    keep = ["event_id"] if "event_id" in events.columns else []
    return events.filter(F.col("type") == "play").select(
        *keep,
        "song_id",
        pseudonym(F.col("user_id"), salt).alias("user_hash"),
        "ts",
        minute_floor(F.col("ts")).alias("window_start"),
    )
