"""Trending now, per-genre top lists, for-you.

Input is any frame of minute buckets ``(song_id, [genre,] window_start, plays[, ts])``:
the rollup deltas or the stored delta log (genre as published with the event),
or raw plays with ``plays = 1`` and no genre, which are summed per song before
the catalog supplies the genre.
"""

from __future__ import annotations

import datetime as dt

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streamcharts.constants import (
    ALL_GENRES,
    FOR_YOU_LIMIT,
    GLOBAL_TRENDING,
    TRENDING_DEFAULT_LIMIT,
    TRENDING_MAX_LIMIT,
    TRENDING_WINDOW_MINUTES,
)
from streamcharts.functions.privacy import pseudonym
from streamcharts.functions.scalars import clamp_limit


def asof_column(asof: str | dt.datetime | Column | None) -> Column:
    """Read anchor as a zone-less UTC timestamp; default: now."""
    if asof is None:
        return F.current_timestamp().cast("timestamp_ntz")
    if isinstance(asof, Column):
        return asof.cast("timestamp_ntz")
    if isinstance(asof, dt.datetime):
        if asof.tzinfo is not None:
            asof = asof.astimezone(dt.timezone.utc)
        asof = asof.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(str(asof)).cast("timestamp_ntz")


def in_window(window_start: Column, asof: Column, window_minutes: int) -> Column:
    """Current (incomplete) minute and the ``window_minutes - 1`` before it."""
    hi = F.date_trunc("minute", asof).cast("timestamp_ntz")
    lo = hi - F.expr(f"INTERVAL {int(window_minutes) - 1} MINUTES")
    return (window_start >= lo) & (window_start <= hi)


def leaderboard_order() -> list[Column]:
    """Score descending, ties by member text descending (sorted-set reverse range order)."""
    return [F.col("plays").desc(), F.col("song_id").cast("string").desc()]


def in_time_window(buckets: DataFrame, asof=None, window_minutes: int = TRENDING_WINDOW_MINUTES) -> DataFrame:
    """Rows whose minute is in the window. When raw event times are present the
    equivalent ``ts`` range is added too, so the predicate reaches the parquet scan;
    on stored deltas the ``day`` range prunes partitions."""
    a = asof_column(asof)
    b = buckets.filter(in_window(F.col("window_start"), a, window_minutes))
    hi = F.date_trunc("minute", a).cast("timestamp_ntz")
    lo = hi - F.expr(f"INTERVAL {int(window_minutes) - 1} MINUTES")
    if "ts" in buckets.columns:
        b = b.filter((F.col("ts") >= lo) & (F.col("ts") < hi + F.expr("INTERVAL 1 MINUTE")))
    if "day" in buckets.columns:  # stored deltas: prune day partitions
        b = b.filter((F.col("day") >= F.to_date(lo)) & (F.col("day") <= F.to_date(hi)))
    return b


def per_song_genre(buckets: DataFrame, songs: DataFrame | None) -> DataFrame:
    """Plays per (genre, song_id) in an already filtered frame.

    Stored buckets carry the genre the event was published with. Raw plays
    without one are summed per song *first* and only then joined to the
    catalog for the genre: the join sees one row per song instead of one per
    event. A song that the catalog does not know has no genre to be listed under.
    """
    if "genre" in buckets.columns:
        return buckets.groupBy("genre", "song_id").agg(F.sum("plays").cast("long").alias("plays"))
    if songs is None:
        raise ValueError("buckets without a genre column need the songs table")
    per_song = buckets.groupBy("song_id").agg(F.sum("plays").cast("long").alias("plays"))
    return per_song.join(songs.select(F.col("id").alias("song_id"), "genre"), "song_id", "inner")


def windowed_plays(buckets: DataFrame, asof=None, window_minutes: int = TRENDING_WINDOW_MINUTES,
                   genre: str | None = None, songs: DataFrame | None = None) -> DataFrame:
    """Sum of plays per song over the trailing window.

    Without a genre every id counts, known to the catalog or not; unknown ones leave after the
    limit, when the cards are attached (P17), whether or not the buckets carry a genre.
    """
    b = in_time_window(buckets, asof, window_minutes)
    if genre and "genre" not in b.columns:
        return per_song_genre(b, songs).filter(F.col("genre") == genre).select("song_id", "plays")
    if genre:
        b = b.filter(F.col("genre") == genre)
    return b.groupBy("song_id").agg(F.sum("plays").cast("long").alias("plays"))


def top_songs(buckets: DataFrame, genre: str | None = None, limit=None, asof=None,
              window_minutes: int = TRENDING_WINDOW_MINUTES, songs: DataFrame | None = None) -> DataFrame:
    """Top-N song ids with plays and rank (T1). ``orderBy + limit`` plans as a
    TakeOrderedAndProject: each task keeps its own top N, so nothing big moves."""
    n = clamp_limit(limit, TRENDING_DEFAULT_LIMIT, TRENDING_MAX_LIMIT)
    top = windowed_plays(buckets, asof, window_minutes, genre, songs).orderBy(*leaderboard_order()).limit(n)
    # at most n (<= 50) rows: a single-partition window here is bounded
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*leaderboard_order())))


def song_cards(songs: DataFrame, artists: DataFrame) -> DataFrame:
    """Song card projection joined with the artist name."""
    a = artists.select(F.col("id").alias("artist_id"), F.col("name").alias("artist"))
    return songs.join(a, "artist_id", "inner").select(
        "id", "title", "genre", "duration_sec", "audio_key", "cover_url", "premium_only", "artist"
    )


def enrich(ranked: DataFrame, songs: DataFrame, artists: DataFrame) -> DataFrame:
    """Attach title/genre/cover/artist to a ranked frame of at most 50 ids.

    The ranked side is bounded by the clamped limit, so broadcasting it (and
    the <= 50-row result of its join with songs) is safe at any catalog size.
    Unknown ids drop out, after the limit, as in the reference.
    """
    s = songs.select(F.col("id").alias("song_id"), "title", "genre", "cover_url", "artist_id")
    with_song = F.broadcast(ranked).join(s, "song_id", "inner")
    a = artists.select(F.col("id").alias("artist_id"), F.col("name").alias("artist"))
    return F.broadcast(with_song).join(a, "artist_id", "inner").drop("artist_id")


def trending(buckets: DataFrame, songs: DataFrame, artists: DataFrame, genre: str | None = None,
             limit=None, asof=None, window_minutes: int = TRENDING_WINDOW_MINUTES) -> DataFrame:
    """Q1: ``id, title, genre, cover_url, artist, plays, rank`` ordered by rank."""
    ranked = top_songs(buckets, genre, limit, asof, window_minutes, songs)
    return (
        enrich(ranked, songs, artists)
        .select(F.col("song_id").alias("id"), "title", "genre", "cover_url", "artist", "plays", "rank")
        .orderBy("rank")
    )


def top_per_genre(buckets: DataFrame, limit=None, asof=None,
                  window_minutes: int = TRENDING_WINDOW_MINUTES, songs: DataFrame | None = None) -> DataFrame:
    """Every genre's top N at once: ``genre, song_id, plays, rank``.

    ``row_number() <= n`` lets Spark insert a partial WindowGroupLimit before
    the shuffle, so each task forwards at most n rows per genre even when one
    genre holds most of the plays.
    """
    n = clamp_limit(limit, TRENDING_DEFAULT_LIMIT, TRENDING_MAX_LIMIT)
    per_song = per_song_genre(in_time_window(buckets, asof, window_minutes), songs)
    w = Window.partitionBy("genre").orderBy(*leaderboard_order())
    return per_song.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def trending_by_genre(buckets: DataFrame, songs: DataFrame, artists: DataFrame, limit=None, asof=None,
                      window_minutes: int = TRENDING_WINDOW_MINUTES) -> DataFrame:
    """Per-genre trending, enriched. The top lists hold at most n rows a genre; adaptive execution sees
    their size when they are there and broadcasts them into the catalog joins if it is small."""
    n = clamp_limit(limit, TRENDING_DEFAULT_LIMIT, TRENDING_MAX_LIMIT)
    top = top_per_genre(buckets, n, asof, window_minutes, songs)
    s = songs.select(F.col("id").alias("song_id"), "title", "cover_url", "artist_id")
    a = artists.select(F.col("id").alias("artist_id"), F.col("name").alias("artist"))
    return top.join(s, "song_id", "inner").join(a, "artist_id", "inner").select(
        "genre", F.col("song_id").alias("id"), "title", "cover_url", "artist", "plays", "rank"
    )


def trending_share(buckets: DataFrame, songs: DataFrame, artists: DataFrame, genre: str | None = None,
                   limit=None, asof=None, window_minutes: int = TRENDING_WINDOW_MINUTES) -> DataFrame:
    """Each trending song's plays relative to the leader, ``plays / max(1, max plays)``."""
    t = trending(buckets, songs, artists, genre, limit, asof, window_minutes)
    lead = F.greatest(F.max("plays").over(Window.partitionBy()), F.lit(1))  # <= 50 rows
    return t.select("id", "plays", "rank", F.round(F.col("plays") / lead, 6).alias("share"))


def sliding_trending(plays: DataFrame, window: str = "10 days", slide: str = "1 day") -> DataFrame:
    """R3 batch form: plays per song for every sliding window that has plays.

    ``window()`` emits each row into window/slide windows (a fixed factor); where the slide divides the
    window, plays are counted per slide step before that. No per-song partition has to fit anywhere.
    """
    ts, plays_in = F.col("ts").cast("timestamp"), F.count(F.lit(1))
    if pd.Timedelta(window) % pd.Timedelta(slide) == pd.Timedelta(0):
        # every window is made of whole slide steps: count per (song, step) first, then expand those
        step = F.window(ts, slide)
        plays = plays.groupBy(step.alias("s"), "song_id").agg(plays_in.alias("n")).select(
            F.col("s.start").alias("ts"), "song_id", "n")
        ts, plays_in = F.col("ts"), F.sum("n")
    return plays.groupBy(F.window(ts, window, slide).alias("w"), "song_id").agg(plays_in.cast("long").alias("plays")).select(
        F.col("w.start").cast("timestamp_ntz").alias("window_start"),
        F.col("w.end").cast("timestamp_ntz").alias("window_end"),
        "song_id",
        "plays",
    )


def favourite_genre(affinity: DataFrame) -> DataFrame:
    """Each user's top genre by lifetime plays, ties by genre name ascending.

    Affinity rows are already one per (user, genre), so a user's partition holds
    at most one row per genre however many plays the user made.
    """
    w = Window.partitionBy("user_hash").orderBy(F.col("play_count").desc(), F.col("genre").asc())
    return (
        affinity.withColumn("_rn", F.row_number().over(w))
        .filter(F.col("_rn") == 1)
        .select("user_hash", "genre", "play_count")
    )


def for_you(users: DataFrame, affinity: DataFrame, buckets: DataFrame, songs: DataFrame,
            artists: DataFrame, asof=None, window_minutes: int = TRENDING_WINDOW_MINUTES,
            *, salt: str | bytes) -> DataFrame:
    """Q2 for every user at once: ``user_id, based_on, rank, id, title, genre, cover_url, artist``;
    a user whose list is empty gets one row with null song columns.

    Users are joined through the pseudonym to their favourite genre (J6), then
    to the per-genre top 10 or, with no affinity, to the global top 10. The
    lists hold 10 x (genres + 1) rows; users are never paired with songs
    beyond those lists. Both lists come from one aggregate of the plays. Adaptive
    execution broadcasts the cards when it sees that they are small, so the user
    side is neither shuffled nor skewed by genre.
    """
    fav = favourite_genre(affinity).select("user_hash", F.col("genre").alias("fav_genre"))
    u = users.select(F.col("id").alias("user_id"), pseudonym(F.col("id"), salt).alias("user_hash"))
    picked = u.join(fav, "user_hash", "left").select(
        "user_id", F.coalesce(F.col("fav_genre"), F.lit(GLOBAL_TRENDING)).alias("based_on")
    )
    per_genre = top_per_genre(buckets, FOR_YOU_LIMIT, asof, window_minutes, songs).select(
        F.col("genre").alias("based_on"), "song_id", "rank"
    )
    global_top = top_songs(buckets, None, FOR_YOU_LIMIT, asof, window_minutes, songs).select(
        F.lit(GLOBAL_TRENDING).alias("based_on"), "song_id", "rank"
    )
    lists = per_genre.unionByName(global_top)
    s = songs.select(F.col("id").alias("song_id"), "title", "genre", "cover_url", "artist_id")
    a = artists.select(F.col("id").alias("artist_id"), F.col("name").alias("artist"))
    cards = lists.join(s, "song_id", "inner").join(a, "artist_id", "inner").drop("artist_id")
    # left: a user whose list is empty still gets one row (null song), like an empty response
    return picked.join(cards, "based_on", "left").select(
        "user_id", "based_on", "rank", F.col("song_id").alias("id"), "title", "genre", "cover_url", "artist"
    )


def for_user(user_id, users: DataFrame, affinity: DataFrame, buckets: DataFrame, songs: DataFrame,
             artists: DataFrame, asof=None, window_minutes: int = TRENDING_WINDOW_MINUTES,
             *, salt: str | bytes) -> DataFrame:
    """Q2 for one user (the service call): ``based_on`` and the ranked songs, same plan as
    ``for_you`` on a one-row user frame, so the user's pseudonym is never computed apart."""
    one = users.filter(F.col("id") == F.lit(user_id))
    return for_you(one, affinity, buckets, songs, artists, asof, window_minutes, salt=salt).orderBy("rank")


def with_request_labels(trending_rows: DataFrame, genre: str | None = None,
                        window_minutes: int = TRENDING_WINDOW_MINUTES) -> DataFrame:
    """P20: the response fields of a trending read: the window length and the requested
    genre, ``all`` when none was given."""
    return trending_rows.withColumn("window_minutes", F.lit(int(window_minutes))).withColumn(
        "requested_genre", F.lit(genre or ALL_GENRES)
    )
