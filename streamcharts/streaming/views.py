"""Read views over the delta log written by ``RollupSink`` (K4-K7, A4-A7, Q1 over stored state).

Every view is an aggregate over the compacted base's segments and the epochs above its pointer
(``compaction.log_rows``), so late events and replayed batches need no merge step and a
read touches the open epochs only. Filters on ``window_start`` and ``written_at`` reach
the scans as parquet predicates.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamcharts.constants import TREND_TTL_SECONDS, TRENDING_WINDOW_MINUTES
from streamcharts.functions.timefns import epoch_minute
from streamcharts.operators import rollups as ru
from streamcharts.operators import trending as tr
from streamcharts.streaming import compaction


def deltas(spark: SparkSession, root: str, table: str) -> DataFrame:
    """All rows of one table, folded or not; ``epoch`` is a cross-run order (first write time)."""
    if table not in compaction.KEYS:
        df = spark.read.parquet(f"{root.rstrip('/')}/{table}")
        return df.withColumn("epoch", F.unix_micros("written_at"))
    return compaction.log_rows(spark, root, table).withColumn("epoch", F.unix_micros("first_written")).drop("first_written")


def minute_play_counts(spark: SparkSession, root: str) -> DataFrame:
    return ru.minute_play_counts(deltas(spark, root, "song_minute"))


def unique_listeners(spark: SparkSession, root: str, mode: str = "union") -> DataFrame:
    return ru.unique_listeners(deltas(spark, root, "song_minute"), mode)


def user_genre_affinity(spark: SparkSession, root: str) -> DataFrame:
    return ru.user_genre_affinity(deltas(spark, root, "user_genre"))


def buckets(spark: SparkSession, root: str) -> DataFrame:
    """Minute buckets for the trending reads (song_id, genre, window_start, plays)."""
    return deltas(spark, root, "song_minute").select(
        "song_id", "genre", F.col("window_start").cast("timestamp_ntz").alias("window_start"), "plays", "day"
    )


def cover(low: int, high: int, spans: tuple[int, ...] = (1, *compaction.SPANS)) -> list[tuple[int, int, int]]:
    """The minutes [low, high) as ranges (span, from, to) of whole spans, the coarsest that fit: at most two ranges a span."""
    *finer, span = spans
    first, last = -(-low // span) * span, high // span * span
    if first < last:
        return (cover(low, first, tuple(finer)) if finer and low < first else []) + [(span, first, last)] + (
            cover(last, high, tuple(finer)) if finer and last < high else [])
    return cover(low, high, tuple(finer)) if finer and low < high else []


def window_plays(spark: SparkSession, root: str, asof: str | dt.datetime | None = None,
                 window_minutes: int = TRENDING_WINDOW_MINUTES) -> DataFrame:
    """Plays of the window's minutes (``trending.in_window``) as few rows, for the trending reads.

    Whole days and hours come from the base's coarser sums and single minutes only from the window's ends, so a folded
    window costs a song at most two hours' minutes, two days' hours and its days; open epochs are read by minute. ``window_start`` is
    the window's last minute in every row, ``span`` the minutes that a row sums.
    """
    at = dt.datetime.now(dt.timezone.utc) if asof is None else dt.datetime.fromisoformat(asof) if isinstance(asof, str) else asof
    at = (at if at.tzinfo else at.replace(tzinfo=dt.timezone.utc)).astimezone(dt.timezone.utc)
    high = int(at.timestamp()) // 60 + 1
    low = high - int(window_minutes)
    m = compaction.manifest(spark, root)

    def within(rows: DataFrame, first: int, last: int) -> DataFrame:
        moment = lambda minute: F.timestamp_seconds(F.lit(minute * 60)).cast(rows.schema["window_start"].dataType)
        day = lambda minute: F.lit(dt.datetime.fromtimestamp(minute * 60, dt.timezone.utc).date())
        return rows.filter(F.col("day").between(day(first), day(last - 1)) & (F.col("window_start") >= moment(first)) & (F.col("window_start") < moment(last)))

    def iso(minute: int) -> str:
        return dt.datetime.fromtimestamp(minute * 60, dt.timezone.utc).date().isoformat()

    parts = [within(compaction.epoch_rows(spark, root, "song_minute", m), low, high).withColumn("span", F.lit(1))]
    for span, first, last in cover(low, high):
        rows = compaction.base_rows(spark, root, "song_minute" if span == 1 else "song_span", m, (iso(first), iso(last - 1)))
        if rows is not None:
            rows = rows.withColumn("span", F.lit(1)) if span == 1 else rows.filter(F.col("span") == span)
            parts.append(within(rows, first, last))
    out = None
    for p in parts:
        p = p.select("song_id", "genre", F.timestamp_seconds(F.lit((high - 1) * 60)).cast("timestamp_ntz").alias("window_start"), "plays", "span")
        out = p if out is None else out.unionByName(p)
    return out


def live_buckets(spark: SparkSession, root: str, asof=None, ttl_seconds: int = TREND_TTL_SECONDS) -> DataFrame:
    rows = deltas(spark, root, "song_minute").withColumn("minute", epoch_minute(F.col("window_start")))
    return ru.live_buckets(rows, tr.asof_column(asof).cast("timestamp"), ttl_seconds)


def reject_counts(spark: SparkSession, root: str) -> DataFrame:
    """Rejected records by reason over all batches."""
    per_batch = deltas(spark, root, "batches").select(F.explode("rejected_by_reason").alias("decode_error", "n"))
    return per_batch.groupBy("decode_error").agg(F.sum("n").alias("rows"))


def batch_log(spark: SparkSession, root: str) -> DataFrame:
    return deltas(spark, root, "batches").drop("epoch")
