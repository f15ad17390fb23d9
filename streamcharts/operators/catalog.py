"""Catalog, playlist and account operators."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamcharts.constants import CATALOG_DEFAULT_LIMIT, CATALOG_MAX_LIMIT
from streamcharts.functions.scalars import (
    clamp_limit,
    duration_text,
    numbered,
    role_at_least,
    role_rank,
    valid_email,
    valid_password,
)
from streamcharts.operators.ranking import ranked
from streamcharts.operators.trending import song_cards


# ----------------------------------------------------------------- songs
def list_songs(songs: DataFrame, artists: DataFrame, genre: str | None = None, q: str | None = None,
               limit=None) -> DataFrame:
    """Q3: optional genre equality AND title/artist substring (case-insensitive), by id, top n.

    ``%``/``_`` in ``q`` act as wildcards, as in the reference. ``orderBy + limit``
    becomes a per-task top-n, so the catalog is never sorted as a whole; without
    ``q`` the page is taken before the artist join.
    """
    n = clamp_limit(limit, CATALOG_DEFAULT_LIMIT, CATALOG_MAX_LIMIT)
    if genre:
        songs = songs.filter(F.col("genre") == genre)
    if q:
        # the text may match the artist name, so the join has to come first
        pattern = f"%{q}%"
        cards = song_cards(songs, artists)
        return cards.filter(F.col("title").ilike(pattern) | F.col("artist").ilike(pattern)).orderBy("id").limit(n)
    # artist_id is a foreign key (erasure cascades keep it so): the join drops no song, so the
    # page is cut from the songs alone (per-task top-n) and only its n rows meet the artists
    page = F.broadcast(songs.orderBy("id").limit(n))
    return song_cards(page, artists).orderBy("id")


def get_song(songs: DataFrame, artists: DataFrame, song_id) -> DataFrame:
    """Q4: one song card; the id must be a positive integer (else ValueError)."""
    try:
        number = Decimal(str(song_id))  # exact for every bigint, unlike a float
        sid = int(number)
    except (ArithmeticError, ValueError):
        raise ValueError(f"invalid song id {song_id!r}") from None
    if sid != number or not 0 < sid < 2**63:
        raise ValueError(f"invalid song id {song_id!r}")
    # id is the primary key: at most one row, a safe broadcast into the artists scan
    return song_cards(F.broadcast(songs.filter(F.col("id") == sid)), artists)


def list_artists(artists: DataFrame) -> DataFrame:
    """Q5: artists by name (id breaks ties)."""
    return artists.select("id", "name", "genre").orderBy("name", "id")


def genre_counts(songs: DataFrame) -> DataFrame:
    """Songs per genre as int, by genre."""
    return songs.groupBy("genre").agg(F.count(F.lit(1)).cast("int").alias("count")).orderBy("genre")


def song_durations(songs: DataFrame) -> DataFrame:
    """F16: ``m:ss`` text of each song's duration."""
    return songs.select("id", "duration_sec", duration_text(F.col("duration_sec")).alias("duration_text"))


# ------------------------------------------------------------- playlists
def playlist_tracks(playlist_songs: DataFrame, bounds_from: DataFrame | None = None) -> DataFrame:
    """``playlist_id, rank, song_id``: every track's place by (position, song id), from 1."""
    return ranked(playlist_songs, ["position", "song_id"], ["playlist_id"], bounds_from=bounds_from).select(
        "playlist_id", F.col("_rank").alias("rank"), "song_id")


def track_arrays(tracks: DataFrame, chunk_size: int) -> DataFrame:
    """Tracks as ordered arrays of at most ``chunk_size`` ids, one row per (playlist, chunk).

    For callers that want arrays and say how long one may get; no group exceeds that size.
    """
    return tracks.withColumn("chunk", F.floor((F.col("rank") - 1) / F.lit(chunk_size)).cast("int")).groupBy(
        "playlist_id", "chunk").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "song_id"))), lambda x: x["song_id"]).alias("song_ids"))


def user_playlists(playlists: DataFrame, playlist_songs: DataFrame, user_id=None,
                   chunk_size: int | None = None) -> DataFrame:
    """Playlists (optionally of one user), newest first, one row per track in order; a
    playlist without tracks is one row with a null track.

    With ``chunk_size`` the tracks come as arrays of at most that many ids (``chunk``, ``song_ids``),
    an empty playlist as ``[]``. Tracks are narrowed to the wanted playlists before they are ranked.
    """
    p = playlists if user_id is None else playlists.filter(F.col("user_id") == F.lit(user_id))
    songs = playlist_songs
    if user_id is not None:
        songs = songs.join(p.select(F.col("id").alias("playlist_id")), "playlist_id", "left_semi")
    tracks = playlist_tracks(songs)
    head = ["id", "user_id", "name", "created_at"]
    newest = [F.col("created_at").desc(), F.col("id")]
    if chunk_size is None:
        return p.join(tracks, p["id"] == tracks["playlist_id"], "left").select(*head, "rank", "song_id").orderBy(*newest, "rank")
    arrays = track_arrays(tracks, chunk_size)
    return p.join(arrays, p["id"] == arrays["playlist_id"], "left").select(
        *head,
        F.coalesce(F.col("chunk"), F.lit(0)).alias("chunk"),
        F.coalesce(F.col("song_ids"), F.array().cast("array<bigint>")).alias("song_ids"),
    ).orderBy(*newest, "chunk")


def owner_check(requests: DataFrame, playlists: DataFrame) -> DataFrame:
    """Requests ``(user_id, playlist_id, ...)`` flagged ``owned`` when the playlist is the user's.

    A left join on the playlist's primary key, so no request is duplicated.
    """
    p = playlists.select(F.col("id").alias("playlist_id"), F.col("user_id").alias("_owner"))
    return requests.join(p, "playlist_id", "left").withColumn(
        "owned", F.coalesce(F.col("_owner") == F.col("user_id"), F.lit(False))
    ).drop("_owner")


def add_playlist_songs(requests: DataFrame, playlists: DataFrame, playlist_songs: DataFrame) -> DataFrame:
    """Rows to append to playlist_songs: owned, new, once per (playlist, song), position 0."""
    owned = owner_check(requests, playlists).filter("owned")
    new = owned.select("playlist_id", "song_id").dropDuplicates(["playlist_id", "song_id"])
    # A left-anti join cannot broadcast its left side, so anti-joining the (small) requests
    # with the whole track table would shuffle that table. Narrow it first: the requested
    # pairs that already exist (a semi-join the requests can be broadcast into), then anti-join.
    present = playlist_songs.select("playlist_id", "song_id").join(new, ["playlist_id", "song_id"], "left_semi")
    return new.join(present, ["playlist_id", "song_id"], "left_anti").withColumn(
        "position", F.lit(0).cast("int")
    )


def newest_playlist(playlists: DataFrame) -> DataFrame:
    """Each user's most recent playlist (id breaks ties); a partial aggregate, not a window."""
    return playlists.groupBy("user_id").agg(
        F.max_by("id", F.struct("created_at", "id")).alias("playlist_id")
    )


def create_playlists(new_rows: DataFrame, playlists: DataFrame) -> DataFrame:
    """Give new ``(user_id, name)`` rows ids after the current maximum.

    Dense ids in (user_id, name) order come from ``ranking.ranked`` over the
    whole frame (range chunks, no single-partition window); the current
    maximum is a scalar subquery.
    """
    r = ranked(new_rows.select("user_id", "name"), ["user_id", "name"])
    base = playlists.select(F.coalesce(F.max("id"), F.lit(0)).alias("m")).scalar()
    return r.select((base + F.col("_rank")).cast("long").alias("id"), "user_id", "name")


def track_neighbours(playlist_songs: DataFrame, partitions: int | None = None, bounds_from: DataFrame | None = None) -> DataFrame:
    """Per playlist, the 1-based track number (``01``) and the next track, wrapping around.

    A window partitioned by playlist would put a playlist holding a third of all
    rows into one task; ``ranking.ranked`` cuts large playlists into range chunks.
    """
    r = ranked(playlist_songs, ["position", "song_id"], ["playlist_id"], next_of="song_id", partitions=partitions, bounds_from=bounds_from)
    track_no = F.col("_rank").cast("int")
    return r.select(
        "playlist_id",
        "song_id",
        track_no.alias("track_no"),
        numbered(track_no).alias("label"),
        F.col("_next").alias("next_song_id"),
    )


# -------------------------------------------------------------- accounts
OUTCOME_INVALID = "invalid"
OUTCOME_CONFLICT = "conflict"
OUTCOME_ACCEPTED = "accepted"


def find_users(users: DataFrame, emails: DataFrame) -> DataFrame:
    """Accounts for the given addresses (any case), minimal projection ``id, email, role``.

    ``emails`` is a frame with an ``email`` column, so a batch of logins is one
    equi-join on the lower-cased address rather than a lookup per address.
    """
    wanted = emails.select(F.lower(F.col("email")).alias("_key")).distinct()
    return users.join(wanted, F.lower(users["email"]) == wanted["_key"], "left_semi").select("id", "email", "role")


def register_users(requests: DataFrame, users: DataFrame) -> DataFrame:
    """Classify registrations ``(request_id, requested_at, email, password)``.

    Invalid email or short password -> ``invalid``; an address (lower-cased)
    already taken, or taken by an earlier request in the same batch (by request
    time, then id) -> ``conflict``; otherwise ``accepted`` with ``role = 'free'``.
    The password never leaves this function.
    """
    r = requests.select(
        "request_id",
        "requested_at",
        F.lower(F.col("email")).alias("email"),
        (valid_email(F.col("email")) & valid_password(F.col("password"))).alias("_valid"),
    )
    first = r.filter("_valid").groupBy("email").agg(
        F.min(F.struct("requested_at", "request_id"))["request_id"].alias("_first")
    )
    # only accounts whose address was asked for; the distinct runs on that matched set
    wanted = r.select("email").distinct()
    taken = (
        users.select(F.lower(F.col("email")).alias("email"))
        .join(wanted, "email", "left_semi")
        .distinct()
        .withColumn("_taken", F.lit(True))
    )
    j = r.join(first, "email", "left").join(taken, "email", "left")
    outcome = (
        F.when(~F.col("_valid"), F.lit(OUTCOME_INVALID))
        .when(F.col("_taken") | (F.col("request_id") != F.col("_first")), F.lit(OUTCOME_CONFLICT))
        .otherwise(F.lit(OUTCOME_ACCEPTED))
    )
    return j.select(
        "request_id",
        "email",
        outcome.alias("outcome"),
        F.when(outcome == OUTCOME_ACCEPTED, F.lit("free")).alias("role"),
    )


def role_flags(users: DataFrame) -> DataFrame:
    """Role rank and at-least tests for each role."""
    return users.select(
        "id",
        "role",
        role_rank(F.col("role")).alias("rank"),
        role_at_least(F.col("role"), "free").alias("at_least_free"),
        role_at_least(F.col("role"), "premium").alias("at_least_premium"),
        role_at_least(F.col("role"), "admin").alias("at_least_admin"),
    )
