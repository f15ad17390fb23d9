import datetime as dt

import pytest

from streamcharts.operators import catalog as cat


def _songs(spark):
    return spark.createDataFrame(
        [(1, "Midnight Drive", 1, "pop", 200, "a1", None, False), (2, "Red Lights", 2, "rock", 195, "a2", None, True),
         (3, "Voltage", 1, "electronic", 240, "a3", None, True), (4, "100% Pure", 2, "rock", 180, "a4", None, False)],
        "id bigint, title string, artist_id bigint, genre string, duration_sec int, audio_key string, "
        "cover_url string, premium_only boolean",
    )


def _artists(spark):
    return spark.createDataFrame([(1, "Neon Sky", "pop"), (2, "Crimson Ave", "rock")], "id bigint, name string, genre string")


def test_list_songs_filters(spark):
    s, a = _songs(spark), _artists(spark)
    assert [r.id for r in cat.list_songs(s, a).collect()] == [1, 2, 3, 4]
    assert [r.id for r in cat.list_songs(s, a, genre="rock").collect()] == [2, 4]
    assert [r.id for r in cat.list_songs(s, a, q="NEON").collect()] == [1, 3]  # artist match, any case
    assert [r.id for r in cat.list_songs(s, a, q="red", genre="rock").collect()] == [2]
    assert [r.id for r in cat.list_songs(s, a, limit=2).collect()] == [1, 2]
    assert [r.id for r in cat.list_songs(s, a, q="0%").collect()] == [4]  # % is a wildcard, as in SQL


def test_get_song_guards(spark):
    s, a = _songs(spark), _artists(spark)
    assert cat.get_song(s, a, 3).first().artist == "Neon Sky"
    assert cat.get_song(s, a, 99).count() == 0
    for bad in (0, -1, "x", 1.5, None):
        with pytest.raises(ValueError):
            cat.get_song(s, a, bad)


def test_genre_counts(spark):
    got = [tuple(r) for r in cat.genre_counts(_songs(spark)).collect()]
    assert got == [("electronic", 1), ("pop", 1), ("rock", 2)]


def test_playlists(spark):
    t = dt.datetime(2024, 1, 1)
    pl = spark.createDataFrame([(1, 7, "empty", t), (2, 7, "zeros", t + dt.timedelta(days=1)), (3, 8, "x", t)],
                               "id bigint, user_id bigint, name string, created_at timestamp_ntz")
    ps = spark.createDataFrame([(2, 30, 0), (2, 10, 0), (2, 20, 0), (3, 5, 2), (3, 6, 1)],
                               "playlist_id bigint, song_id bigint, position int")
    got = [(r.id, r.rank, r.song_id) for r in cat.user_playlists(pl, ps, user_id=7).collect()]
    assert got == [(2, 1, 10), (2, 2, 20), (2, 3, 30), (1, None, None)]  # newest first; all-zero positions by song id
    got = [(r.id, r.chunk, r.song_ids) for r in cat.user_playlists(pl, ps, user_id=7, chunk_size=2).collect()]
    assert got == [(2, 0, [10, 20]), (2, 1, [30]), (1, 0, [])]
    assert cat.user_playlists(pl, ps, chunk_size=10).filter("id = 3").first().song_ids == [6, 5]


def test_song_ids_beyond_floats(spark):
    s = spark.createDataFrame([(2**53 + 1, "t", 1)], "id bigint, title string, artist_id bigint").selectExpr(
        "*", "'g' genre", "1 duration_sec", "'k' audio_key", "'c' cover_url", "false premium_only")
    a = spark.createDataFrame([(1, "n")], "id bigint, name string")
    assert cat.get_song(s, a, str(2**53 + 1)).count() == cat.get_song(s, a, 2**53 + 1).count() == 1
    for bad in (str(2**63), "1e400", "nan", "0x1", 1.5):
        with pytest.raises(ValueError):
            cat.get_song(s, a, bad)


def test_add_songs_owner_dedupe_anti(spark):
    pl = spark.createDataFrame([(1, 7), (2, 8)], "id bigint, user_id bigint")
    ps = spark.createDataFrame([(1, 100, 3)], "playlist_id bigint, song_id bigint, position int")
    reqs = spark.createDataFrame([(7, 1, 100), (7, 1, 101), (7, 1, 101), (7, 2, 102), (8, 2, 103)],
                                 "user_id bigint, playlist_id bigint, song_id bigint")
    got = sorted(tuple(r) for r in cat.add_playlist_songs(reqs, pl, ps).collect())
    assert got == [(1, 101, 0), (2, 103, 0)]


def test_create_playlists_dense_ids(spark):
    pl = spark.createDataFrame([(5, 1), (9, 2)], "id bigint, user_id bigint")
    new = spark.createDataFrame([(3, "b"), (3, "a"), (1, "z")], "user_id bigint, name string").repartition(3)
    got = sorted(tuple(r) for r in cat.create_playlists(new, pl).collect())
    assert got == [(10, 1, "z"), (11, 3, "a"), (12, 3, "b")]


def test_register_users(spark):
    users = spark.createDataFrame([(1, "taken@x.io")], "id bigint, email string")
    reqs = spark.createDataFrame(
        [("r1", 1, "TAKEN@x.io", "longenough"), ("r10", 2, "new@x.io", "longenough"), ("r2", 3, "NEW@X.IO", "longenough"),
         ("r4", 4, "bad email@x.io", "longenough"), ("r5", 5, "short@x.io", "short"), ("r6", 6, "no-at-sign", "longenough")],
        "request_id string, requested_at bigint, email string, password string",
    )
    got = {r.request_id: r.outcome for r in cat.register_users(reqs, users).collect()}
    assert got == {"r1": "conflict", "r10": "accepted", "r2": "conflict", "r4": "invalid", "r5": "invalid",
                   "r6": "invalid"}
    assert "password" not in cat.register_users(reqs, users).columns


def test_track_neighbours_wraps(spark):
    ps = spark.createDataFrame([(1, 10, 1), (1, 20, 2), (1, 30, 3), (2, 5, 0)], "playlist_id bigint, song_id bigint, position int")
    got = {(r.playlist_id, r.song_id): (r.label, r.next_song_id) for r in cat.track_neighbours(ps).collect()}
    assert got == {(1, 10): ("01", 20), (1, 20): ("02", 30), (1, 30): ("03", 10), (2, 5): ("01", 5)}


def test_track_neighbours_hot_playlist_matches_brute_force(spark):
    """One playlist holds most rows and spans many range partitions."""
    import random

    rnd = random.Random(7)
    rows = [(1, sid, rnd.randint(0, 50)) for sid in range(3000)]           # the hot playlist
    rows += [(p, 10_000 + p * 10 + k, k % 3) for p in range(2, 60) for k in range(rnd.randint(1, 6))]
    ps = spark.createDataFrame(rows, "playlist_id bigint, song_id bigint, position int")
    got = {(r.playlist_id, r.song_id): (r.track_no, r.next_song_id)
           for r in cat.track_neighbours(ps, partitions=16).collect()}
    expected = {}
    by = {}
    for p, s, pos in rows:
        by.setdefault(p, []).append((pos, s))
    for p, items in by.items():
        items.sort()
        for i, (_, s) in enumerate(items):
            expected[(p, s)] = (i + 1, items[(i + 1) % len(items)][1])
    assert got == expected


def test_find_users_any_case(spark):
    users = spark.createDataFrame([(1, "a@x.io", "free"), (2, "b@x.io", "admin")], "id bigint, email string, role string")
    emails = spark.createDataFrame([("A@X.IO",), ("nobody@x.io",), ("a@x.io",)], "email string")
    assert [tuple(r) for r in cat.find_users(users, emails).collect()] == [(1, "a@x.io", "free")]


def test_playlist_arrays_are_chunked_and_ordered(spark):
    t = dt.datetime(2024, 1, 1)
    pl = spark.createDataFrame([(1, 7, "big", t), (2, 7, "small", t), (3, 8, "empty", t)],
                               "id bigint, user_id bigint, name string, created_at timestamp_ntz")
    rows = [(1, 1000 - i, i % 4) for i in range(50)] + [(2, 5, 1), (2, 6, 0)]
    ps = spark.createDataFrame(rows, "playlist_id bigint, song_id bigint, position int")
    got = cat.user_playlists(pl, ps, chunk_size=8).collect()
    big = [r for r in got if r.id == 1]
    assert [r.chunk for r in big] == list(range(7)) and all(len(r.song_ids) <= 8 for r in big)
    flat = [s for r in big for s in r.song_ids]
    assert flat == [s for _, s in sorted((pos, s) for _, s, pos in rows[:50])]
    assert [(r.chunk, r.song_ids) for r in got if r.id == 2] == [(0, [6, 5])]
    assert [(r.chunk, r.song_ids) for r in got if r.id == 3] == [(0, [])]
