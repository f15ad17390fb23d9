"""Decode and intake edge cases (FIXTURES §2)."""

import json

from pyspark.sql import functions as F

from conftest import pseudonym
from streamcharts.operators.events import accept_events, good_plays
from conftest import decode_messages


def _msgs(spark, values):
    return spark.createDataFrame([("k", v) for v in values], "key string, value string")


def _ev(**kw):
    base = {"type": "play", "userId": "u1", "songId": "9", "genre": "pop", "role": "free",
            "ts": "2024-01-01T00:00:59.999Z"}
    base.update(kw)
    return json.dumps(base)


def test_decode_edge_cases(spark):
    values = [
        _ev(),                                  # good
        _ev(userId=None),                       # null user -> anon
        json.dumps({"type": "play", "userId": "u1", "songId": 12, "genre": "pop",
                    "ts": "2024-01-01T00:01:00.000Z"}),   # numeric song id
        _ev(songId="x"),                        # non-numeric id
        _ev(songId=None),                       # null id
        _ev(ts="yesterday"),                    # malformed time
        _ev(ts=None),                           # null time
        "not json at all",                      # not JSON
        _ev(type="dance"),                      # unknown type
        _ev(genre=None),                        # null genre
        _ev(type="skip"),                       # valid non-play
    ]
    out = decode_messages(_msgs(spark, values), salt="s").collect()
    errs = [r["decode_error"] for r in out]
    assert errs == [None, None, None, "bad_song_id", "bad_song_id", "bad_ts", "bad_ts", "malformed_json",
                    "unknown_type", "missing_genre", None]
    assert out[1]["user_hash"] == "anon"
    assert out[2]["song_id"] == 12 and out[2]["songId"] == "12"
    # minute edges: :59.999 stays in minute 0, :00.000 opens minute 1
    assert str(out[0]["window_start"]) == "2024-01-01 00:00:00"
    assert str(out[2]["window_start"]) == "2024-01-01 00:01:00"
    assert "userId" not in decode_messages(_msgs(spark, values)).columns
    plays = good_plays(decode_messages(_msgs(spark, values)))
    assert plays.count() == 3


def test_no_raw_user_id_survives_decode(spark):
    values = [_ev(userId="raw-secret-id-123")]
    rows = decode_messages(_msgs(spark, values)).collect()
    assert all("raw-secret-id-123" not in str(v) for r in rows for v in r)


def test_accept_events_reasons(spark):
    songs = spark.createDataFrame(
        [(1, "pop", False), (4, "rock", True)], "id bigint, genre string, premium_only boolean"
    )
    users = spark.createDataFrame([(10, "free"), (11, "premium")], "id bigint, role string")
    reqs = spark.createDataFrame(
        [
            (1, "play", 10, "1"),     # ok
            (2, "play", 10, "4"),     # premium song, free user
            (3, "play", 11, "4"),     # premium user: ok
            (4, "like", 10, "4"),     # the gate only applies to plays
            (5, "play", 10, "0"),     # id must be positive
            (6, "play", 10, "x"),     # not an integer
            (7, "dance", 10, "1"),    # unknown type
            (8, "play", 10, "99"),    # not in the catalog
        ],
        "event_id int, type string, user_id bigint, song_id string",
    )
    got = {r.event_id: r.reject_reason for r in accept_events(reqs, songs, users).collect()}
    assert got == {1: None, 2: "premium_required", 3: None, 4: None, 5: "invalid_song_id",
                   6: "invalid_song_id", 7: "invalid_type", 8: "song_not_found"}


def test_pseudonym_joins_users_to_events(spark):
    df = spark.createDataFrame([(5,)], "id bigint")
    a = df.select(pseudonym(F.col("id"))).first()[0]
    b = decode_messages(_msgs(spark, [_ev(userId="5")])).first()["user_hash"]
    assert a == b
