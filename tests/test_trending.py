import datetime as dt

from streamcharts.plans.params import SALT
from streamcharts.operators import trending as tr

T0 = dt.datetime(2024, 1, 1, 12, 0)


def _buckets(spark, rows):
    return spark.createDataFrame(rows, "song_id bigint, genre string, window_start timestamp_ntz, plays bigint")


def _catalog(spark, ids):
    songs = spark.createDataFrame(
        [(i, f"t{i}", i % 2, "pop", f"c{i}") for i in ids], "id bigint, title string, artist_id bigint, genre string, cover_url string"
    )
    artists = spark.createDataFrame([(0, "A0"), (1, "A1")], "id bigint, name string")
    return songs, artists


def test_ties_order_by_member_text_desc(spark):
    b = _buckets(spark, [(9, "pop", T0, 5), (12, "pop", T0, 5), (3, "pop", T0, 7)])
    songs, artists = _catalog(spark, [3, 9, 12])
    got = [(r.id, r.rank) for r in tr.trending(b, songs, artists, asof=T0, window_minutes=10).collect()]
    assert got == [(3, 1), (9, 2), (12, 3)]  # "9" > "12" as text


def test_window_is_current_minute_and_nine_before(spark):
    rows = [(1, "pop", T0 - dt.timedelta(minutes=9), 1), (2, "pop", T0 - dt.timedelta(minutes=10), 5),
            (3, "pop", T0 + dt.timedelta(minutes=1), 5), (4, "pop", T0, 1)]
    got = {r.song_id for r in tr.windowed_plays(_buckets(spark, rows), asof=T0 + dt.timedelta(seconds=30)).collect()}
    assert got == {1, 4}


def test_unknown_songs_drop_after_limit(spark):
    b = _buckets(spark, [(1, "pop", T0, 9), (77, "pop", T0, 8), (2, "pop", T0, 1)])
    songs, artists = _catalog(spark, [1, 2])
    got = [r.id for r in tr.trending(b, songs, artists, limit=2, asof=T0).collect()]
    assert got == [1]  # 77 took a slot in the top 2, then had no catalog row


def test_genre_filter_and_share(spark):
    b = _buckets(spark, [(1, "pop", T0, 4), (2, "rock", T0, 8), (3, "pop", T0, 2)])
    songs, artists = _catalog(spark, [1, 2, 3])
    assert [r.id for r in tr.trending(b, songs, artists, genre="pop", asof=T0).collect()] == [1, 3]
    shares = {r.id: r.share for r in tr.trending_share(b, songs, artists, asof=T0).collect()}
    assert shares == {2: 1.0, 1: 0.5, 3: 0.25}


def test_top_per_genre_limits_each_genre(spark):
    rows = [(i, "pop", T0, i) for i in range(1, 30)] + [(100 + i, "rock", T0, i) for i in range(1, 4)]
    got = tr.top_per_genre(_buckets(spark, rows), limit=5, asof=T0).collect()
    by = {}
    for r in got:
        by.setdefault(r.genre, []).append(r.song_id)
    assert sorted(by["pop"]) == [25, 26, 27, 28, 29] and sorted(by["rock"]) == [101, 102, 103]


def test_favourite_genre_ties_by_name(spark):
    aff = spark.createDataFrame([("u", "rock", 3), ("u", "pop", 3), ("v", "lofi", 1)],
                                "user_hash string, genre string, play_count bigint")
    got = {r.user_hash: r.genre for r in tr.favourite_genre(aff).collect()}
    assert got == {"u": "pop", "v": "lofi"}


def test_for_you_falls_back_to_global(spark):
    from conftest import pseudonym
    from pyspark.sql import functions as F

    users = spark.createDataFrame([(1,), (2,)], "id bigint")
    h1 = users.filter("id = 1").select(pseudonym(F.col("id"))).first()[0]
    aff = spark.createDataFrame([(h1, "rock", 3)], "user_hash string, genre string, play_count bigint")
    b = _buckets(spark, [(1, "pop", T0, 4), (2, "rock", T0, 8)])
    songs, artists = _catalog(spark, [1, 2])
    got = {(r.user_id, r.based_on, r.id) for r in tr.for_you(users, aff, b, songs, artists, asof=T0, salt=SALT).collect()}
    assert got == {(1, "rock", 2), (2, "global-trending", 2), (2, "global-trending", 1)}


def test_top_per_genre_plans_a_group_limit(spark):
    rows = [(i, "pop", T0, i) for i in range(1, 30)]
    plan = tr.top_per_genre(_buckets(spark, rows), limit=5, asof=T0)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_for_you_empty_genre_list_still_answers(spark):
    from pyspark.sql import functions as F

    from conftest import pseudonym

    users = spark.createDataFrame([(1,)], "id bigint")
    h1 = users.select(pseudonym(F.col("id"))).first()[0]
    aff = spark.createDataFrame([(h1, "jazz", 3)], "user_hash string, genre string, play_count bigint")
    b = _buckets(spark, [(1, "pop", T0, 4)])
    songs, artists = _catalog(spark, [1])
    got = [(r.user_id, r.based_on, r.id) for r in tr.for_you(users, aff, b, songs, artists, asof=T0, salt=SALT).collect()]
    assert got == [(1, "jazz", None)]


def test_for_user_matches_the_batch_rows(spark):
    from streamcharts.plans import registry as R
    from conftest import SF_SMALL

    sf = SF_SMALL
    aff = R._affinity(spark, sf)
    args = (R.tb.users(spark, sf), aff, R._buckets(spark, sf), R.tb.songs(spark, sf), R.tb.artists(spark, sf))
    everyone = tr.for_you(*args, asof="2024-01-30 23:59:00", window_minutes=1440, salt=SALT)
    uid = everyone.filter("based_on != 'global-trending'").first().user_id
    one = tr.for_user(uid, *args, asof="2024-01-30 23:59:00", window_minutes=1440, salt=SALT)
    assert [tuple(r) for r in one.collect()] == [tuple(r) for r in everyone.filter(f"user_id = {uid}").orderBy("rank").collect()]


def test_request_labels_default_to_all(spark):
    b = _buckets(spark, [(1, "pop", T0, 4)])
    songs, artists = _catalog(spark, [1])
    r = tr.with_request_labels(tr.trending(b, songs, artists, asof=T0)).first()
    assert (r.window_minutes, r.requested_genre) == (10, "all")
    r = tr.with_request_labels(tr.trending(b, songs, artists, genre="pop", asof=T0), "pop", 10).first()
    assert r.requested_genre == "pop"


def test_anchor_with_a_zone_is_read_as_utc(spark):
    import datetime as dt

    at = dt.datetime(2024, 1, 1, 12, 0, tzinfo=dt.timezone(dt.timedelta(hours=2)))
    assert spark.range(1).select(tr.asof_column(at)).first()[0] == dt.datetime(2024, 1, 1, 10, 0)


def test_unknown_songs_take_a_place_with_and_without_a_genre_column(spark):
    import datetime as dt

    t = dt.datetime(2024, 1, 1, 12, 0)
    songs = spark.createDataFrame([(1, "a", "g", "c", 1), (2, "b", "g", "c", 1)],
                                  "id bigint, title string, genre string, cover_url string, artist_id bigint")
    artists = spark.createDataFrame([(1, "n")], "id bigint, name string")
    plays = spark.createDataFrame([(9, t, 5), (1, t, 3), (2, t, 1)], "song_id bigint, window_start timestamp_ntz, plays bigint")
    for b in (plays, plays.selectExpr("*", "'g' genre")):
        got = [(r.id, r.rank) for r in tr.trending(b, songs, artists, limit=2, asof=t).collect()]
        assert got == [(1, 2)]  # the unknown song 9 is first and leaves after the limit
