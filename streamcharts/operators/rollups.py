"""Minute rollups (A1-A7) and their replay-safe merge (K2-K7).

Every micro-batch (or batch slice) produces *delta* rows tagged with its
``epoch``. The stored tables are the union of deltas; the values the
reference kept by upserting (``old + new``, ``GREATEST``, ``now()``) are
aggregates over the deltas:

* play counts        = ``sum(plays)``  per (song, minute)       -- K5 / A5
* unique listeners   = ``max(uniq)`` (reference) or the HLL union  -- K6 / A6
* genre affinity     = ``sum(plays)``, ``max(written_at)``       -- K7 / A7

Rewriting one epoch's deltas (a replayed batch) therefore changes nothing,
and late events simply add a delta to an old minute.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamcharts.constants import TREND_TTL_SECONDS
from streamcharts.functions.timefns import epoch_minute, window_end

HLL_LG_K = 12  # sketch size 2^12 registers: ~1.6 % relative error, 4 KiB per key


def minute_deltas(plays: DataFrame, epoch: Column | int = 0, written_at: Column | None = None) -> DataFrame:
    """Per (song, genre, minute): plays, approximate uniques and a mergeable sketch (A1, A2).

    A partial + final hash aggregate; map-side combine means a hot song costs
    one row per map task before the shuffle.
    """
    epoch_col = epoch if isinstance(epoch, Column) else F.lit(epoch).cast("long")
    written = written_at if written_at is not None else F.max("ts")
    return plays.groupBy("song_id", "genre", "window_start").agg(
        F.count(F.lit(1)).alias("plays"),
        F.approx_count_distinct("user_hash").alias("uniq_approx"),
        F.hll_sketch_agg("user_hash", HLL_LG_K).alias("uniq_sketch"),
        written.alias("written_at"),
    ).withColumn("epoch", epoch_col)


def user_genre_deltas(plays: DataFrame, epoch: Column | int = 0, written_at: Column | None = None) -> DataFrame:
    """Per (user_hash, genre): plays in this slice (A3)."""
    epoch_col = epoch if isinstance(epoch, Column) else F.lit(epoch).cast("long")
    written = written_at if written_at is not None else F.max("ts")
    return plays.groupBy("user_hash", "genre").agg(
        F.count(F.lit(1)).alias("plays"), written.alias("written_at")
    ).withColumn("epoch", epoch_col)


def _catalog_genre(songs: DataFrame) -> DataFrame:
    return songs.select(F.col("id").alias("song_id"), "genre")


def minute_deltas_from_plays(plays: DataFrame, songs: DataFrame, epoch: Column | str | int = 0) -> DataFrame:
    """``minute_deltas`` for plays that carry no genre (the batch event table).

    Aggregated per (song, minute) first -- the genre is a function of the song --
    then joined to the catalog, which also drops songs the intake would have
    refused. ``epoch`` may name a column of ``plays`` to keep batches apart.
    """
    keys = ["song_id", "window_start"] + ([epoch] if isinstance(epoch, str) else [])
    per = plays.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("plays"),
        F.approx_count_distinct("user_hash").alias("uniq_approx"),
        F.hll_sketch_agg("user_hash", HLL_LG_K).alias("uniq_sketch"),
        F.max("ts").alias("written_at"),
    )
    if not isinstance(epoch, str):
        epoch_col = epoch if isinstance(epoch, Column) else F.lit(epoch).cast("long")
        per = per.withColumn("epoch", epoch_col)
    return per.join(_catalog_genre(songs), "song_id", "inner")


def user_genre_deltas_from_plays(plays: DataFrame, songs: DataFrame, epoch: int = 0) -> DataFrame:
    """``user_genre_deltas`` for plays without genre: per (user, song) first, then
    catalog genre, then per (user, genre); both aggregates combine map-side."""
    per_song = plays.groupBy("user_hash", "song_id").agg(
        F.count(F.lit(1)).alias("plays"), F.max("ts").alias("written_at")
    )
    return (
        per_song.join(_catalog_genre(songs), "song_id", "inner")
        .groupBy("user_hash", "genre")
        .agg(F.sum("plays").cast("long").alias("plays"), F.max("written_at").alias("written_at"))
        .withColumn("epoch", F.lit(epoch).cast("long"))
    )


def known_songs(df: DataFrame, songs: DataFrame) -> DataFrame:
    """Keep rows whose song is in the catalog (a semi-join on already aggregated rows)."""
    return df.join(songs.select(F.col("id").alias("song_id")), "song_id", "left_semi")


def minute_play_counts(deltas: DataFrame) -> DataFrame:
    """``song_play_counts``: key (song, minute), additive over epochs (K5).

    The reference keyed the upsert without genre; the genre kept is the one
    of the earliest epoch (smallest name on a tie), so a song seen under two
    genres in a minute still yields one row.
    """
    return deltas.groupBy("song_id", "window_start").agg(
        F.min_by("genre", F.struct("epoch", "genre")).alias("genre"),
        F.sum("plays").cast("long").alias("play_count"),
    ).select(
        "song_id",
        "genre",
        "window_start",
        window_end(F.col("window_start")).alias("window_end"),
        "play_count",
    )


def unique_listeners(deltas: DataFrame, mode: str = "union") -> DataFrame:
    """``song_unique_listeners`` per (song, minute).

    ``mode="union"`` merges the HLL sketches (true distinct over all epochs);
    ``mode="max"`` keeps the reference's ``GREATEST`` of per-batch estimates,
    which undercounts listeners spread over several batches.
    """
    if mode == "union":
        agg = F.hll_sketch_estimate(F.hll_union_agg("uniq_sketch", True))
    elif mode == "max":
        agg = F.max("uniq_approx")
    else:
        raise ValueError(f"mode must be 'union' or 'max', got {mode!r}")
    return deltas.groupBy("song_id", "window_start").agg(agg.cast("long").alias("unique_listeners"))


def unique_listeners_exact(plays: DataFrame) -> DataFrame:
    """Exact distinct listeners per (song, minute) for batch use (A2 exact form).

    Spark plans a single distinct as aggregate-on-(key, user) first, so the
    shuffle is keyed by the pair and a hot song does not land on one reducer.
    """
    return plays.groupBy("song_id", "window_start").agg(
        F.countDistinct("user_hash").alias("unique_listeners")
    )


def user_genre_affinity(deltas: DataFrame) -> DataFrame:
    """``user_genre_affinity``: lifetime plays per (user_hash, genre), last touch time (K7)."""
    return deltas.groupBy("user_hash", "genre").agg(
        F.sum("plays").cast("long").alias("play_count"),
        F.max("written_at").alias("updated_at"),
    )


def leaderboard_rows(deltas: DataFrame) -> DataFrame:
    """Leaderboard buckets (K2/K3): (minute, genre, song_id, plays, written_at).

    One table holds both key families: the per-genre bucket is a row, the
    global bucket of a minute is the sum over its genres at read time.
    """
    return deltas.groupBy(
        epoch_minute(F.col("window_start")).alias("minute"), "genre", "song_id"
    ).agg(F.sum("plays").cast("long").alias("plays"), F.max("written_at").alias("written_at"))


def live_buckets(rows: DataFrame, asof: Column, ttl_seconds: int = TREND_TTL_SECONDS) -> DataFrame:
    """Bucket keys still alive at ``asof``.

    Each write renews a key's expiry, so a key lives until its last write plus
    the TTL. A row written before that bound keeps no key alive and cannot be the
    last write of one that lives, so the bound is applied first, at the scan. Global keys (one per minute) and genre keys (per genre and minute)
    are both reported, with ``scope`` telling them apart.
    """
    ttl = F.expr(f"INTERVAL {int(ttl_seconds)} SECONDS")
    # one pass: rollup gives (minute, genre) = genre keys and (minute) = global keys
    keys = rows.filter(F.col("written_at") > asof - ttl).rollup("minute", "genre").agg(
        (F.max("written_at") + ttl).alias("expires_at"), F.grouping_id().alias("_gid")
    )
    return keys.filter(F.col("_gid") <= 1).select(
        F.when(F.col("_gid") == 0, F.lit("genre")).otherwise(F.lit("global")).alias("scope"),
        "genre",
        "minute",
        "expires_at",
    )


def events_by_type(events: DataFrame) -> DataFrame:
    """Events per type (A10)."""
    return events.groupBy("type").agg(F.count(F.lit(1)).alias("events"))
