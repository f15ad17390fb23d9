"""Erasure cascade and data export.

Deleting a user removes their account, their playlists and those playlists'
tracks; deleting an artist removes their songs and every playlist entry of
those songs. Each step is an anti-join against the erased keys (semi-joins
find the dependent keys), so nothing is collected to the driver.
The stored rollups are keyed by the user's hash; ``streaming.compaction.erase`` takes hashes out of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def erase_users(erase_ids: DataFrame, users: DataFrame, playlists: DataFrame,
                playlist_songs: DataFrame) -> dict[str, DataFrame]:
    """Tables after erasing ``erase_ids(id)``: users, playlists, playlist_songs."""
    ids = erase_ids.select("id").distinct()
    kept_users = users.join(ids, "id", "left_anti")
    gone_pl = playlists.join(ids.withColumnRenamed("id", "user_id"), "user_id", "left_semi").select(
        F.col("id").alias("playlist_id")
    )
    kept_pl = playlists.join(ids.withColumnRenamed("id", "user_id"), "user_id", "left_anti")
    kept_tracks = playlist_songs.join(gone_pl, "playlist_id", "left_anti")
    return {"users": kept_users, "playlists": kept_pl, "playlist_songs": kept_tracks}


def erase_artists(erase_ids: DataFrame, artists: DataFrame, songs: DataFrame,
                  playlist_songs: DataFrame) -> dict[str, DataFrame]:
    """Tables after erasing ``erase_ids(id)`` artists: artists, songs, playlist_songs."""
    ids = erase_ids.select("id").distinct()
    kept_artists = artists.join(ids, "id", "left_anti")
    gone_songs = songs.join(ids.withColumnRenamed("id", "artist_id"), "artist_id", "left_semi").select(
        F.col("id").alias("song_id")
    )
    kept_songs = songs.join(ids.withColumnRenamed("id", "artist_id"), "artist_id", "left_anti")
    kept_tracks = playlist_songs.join(gone_songs, "song_id", "left_anti")
    return {"artists": kept_artists, "songs": kept_songs, "playlist_songs": kept_tracks}


def cascade_flags(erase_ids: DataFrame, tables: dict[str, tuple[DataFrame, str]]) -> dict[str, DataFrame]:
    """Each table with ``erased``, in one pass: the first by its own key column, every further one by the
    keys (``id``) that the table before it loses.

    ``tables``: name -> (frame, key column); the first table's key column is ``id``.
    """
    gone, out = erase_ids.select(F.col("id").alias("_gone")).distinct(), {}
    for name, (frame, key) in tables.items():
        flagged = frame.join(gone, frame[key] == gone["_gone"], "left").withColumn(
            "erased", F.col("_gone").isNotNull()).drop("_gone")
        out[name] = flagged
        # users lose playlists, artists lose songs: the dependent table's own ids go on
        gone = flagged.filter("erased").select(F.col("id").alias("_gone")) if "id" in frame.columns else gone
    return out


def cascade_counts(flagged: dict[str, DataFrame]) -> DataFrame:
    """Rows kept and erased per table: one aggregate over one scan each."""
    out = None
    for name, frame in flagged.items():
        counts = frame.agg(
            F.count_if(~F.col("erased")).alias("kept"), F.count_if("erased").alias("erased"),
        ).select(F.lit(name).alias("table"), "kept", "erased")
        out = counts if out is None else out.unionByName(counts)
    return out


def export_users(export_ids: DataFrame, users: DataFrame, playlists: DataFrame,
                 playlist_songs: DataFrame, bounds_from: DataFrame | None = None) -> DataFrame:
    """Q12 export: JSON lines, one per (user, playlist, track); a playlist without tracks and a user
    without playlists are one line each, with nulls.

    The requested users narrow playlists, and those narrow the tracks, by semi-joins *before* the
    tracks are ranked, so an export touches the requested users' data only (beyond the scans). ``bounds_from``: a cheaper frame of tracks, of any playlists, for ``ranked``.
    """
    from streamcharts.operators.catalog import playlist_tracks

    u = users.join(export_ids.select("id").distinct(), "id", "left_semi")
    mine = playlists.join(u.select(F.col("id").alias("user_id")), "user_id", "left_semi")
    tracks = playlist_tracks(
        playlist_songs.join(mine.select(F.col("id").alias("playlist_id")), "playlist_id", "left_semi"),
        bounds_from,
    )
    p = mine.join(tracks.withColumnRenamed("playlist_id", "_playlist"), F.col("id") == F.col("_playlist"), "left").select(
        "user_id",
        F.col("id").alias("playlist_id"),
        "name",
        F.date_format("created_at", "yyyy-MM-dd").alias("created"),
        "rank",
        "song_id",
    )
    j = u.join(p, u["id"] == p["user_id"], "left")
    doc = F.to_json(
        F.struct(
            F.col("id").alias("user_id"),
            F.col("email"),
            F.col("role"),
            F.col("playlist_id"),
            F.col("name").alias("playlist_name"),
            F.col("created"),
            F.col("rank"),
            F.col("song_id"),
        ),
        {"ignoreNullFields": "false"},
    )
    return j.select(F.col("id").alias("user_id"), "playlist_id", "rank", doc.alias("document"))
