"""Exact listeners over epochs, and boards that expire, against plain counting."""

import datetime as dt
import os
import random

from pyspark.sql import functions as F

from streamcharts.streaming import leaderboard as lb
from streamcharts.streaming import listeners as ls

T0 = dt.datetime(2024, 1, 1)
PLAYS = "song_id bigint, genre string, window_start timestamp_ntz, user_hash string"


def plays(seed, n=300, users=60):
    rng = random.Random(seed)
    return [(1 if rng.random() < 1 / 3 else rng.randrange(2, 6), rng.choice(["a", "b"]), T0 + dt.timedelta(minutes=rng.randrange(3), days=rng.randrange(2)),
             f"u{rng.randrange(seed * 20, seed * 20 + users)}") for _ in range(n)]


def distinct(rows, cut=lambda t: t):
    seen = {}
    for song, _, t, u in rows:
        seen.setdefault((song, cut(t)), set()).add(u)
    return sorted((k[0], k[1], len(v)) for k, v in seen.items())


def test_listeners_are_exact_over_epochs_and_replays(spark, scratch):
    sink, parts = ls.ListenerSink(scratch, "r1", lanes=8), [plays(k) for k in range(3)]
    frames = [spark.createDataFrame(p, PLAYS) for p in parts]
    for k in (0, 1, 2, 1, 2):          # the last two epochs are delivered again
        sink(frames[k], k)
    whole = [r for p in parts for r in p]
    got = lambda grain: sorted(tuple(r) for r in ls.unique_listeners(spark, scratch, grain).collect())
    assert got("minute") == distinct(whole)
    assert got("day") == distinct(whole, lambda t: t.replace(hour=0, minute=0))
    users = spark.read.parquet(f"{scratch}/users").collect()
    assert len({r.user_hash for r in users}) == len({r.user_no for r in users}) == len(users) == len({r[3] for r in whole})
    assert min(r.user_no for r in users) >= 1 and max(r.user_no for r in users) < 3 * len(users) + 8
    ls.ListenerSink(scratch, "r2", lanes=8)(frames[0], 0)   # another run's epoch with known listeners
    assert got("minute") == distinct(whole)


def test_users_beyond_one_piece(spark, scratch):
    rows = spark.range(70_000).select(F.lit(1).cast("long").alias("song_id"), F.lit(T0).cast("timestamp_ntz").alias("window_start"),
                                      F.concat(F.lit("u"), F.col("id").cast("string")).alias("user_hash"))
    sink = ls.ListenerSink(scratch, "r1")
    sink(rows, 0)
    sink(rows.filter("song_id = 1").limit(500), 1)
    assert [r.unique_listeners for r in ls.unique_listeners(spark, scratch).collect()] == [70_000]
    assert spark.read.parquet(f"{scratch}/listeners").select("piece").distinct().count() >= 3


def boards(spark, root, asof, ttl=1800):
    return {(r.scope, r.minute, r.genre, r.song_id): r.plays for r in lb.live(spark, root, F.lit(asof).cast("timestamp"), ttl).collect()}


def slots_on_disk(root):
    return sorted(d for d in os.listdir(f"{root}/leaderboard") if d.startswith("slot="))


def test_ttl_is_renewed_and_dead_buckets_leave_the_disk(spark, scratch):
    sink = lb.LeaderboardSink(scratch, "r1", 1)
    m = int(T0.replace(tzinfo=dt.timezone.utc).timestamp()) // 60

    def write(epoch, minute, rows):
        sink(spark.createDataFrame([(s, g, T0 + dt.timedelta(minutes=k)) for s, g, k in rows], "song_id bigint, genre string, window_start timestamp_ntz"),
             epoch, F.lit(T0 + dt.timedelta(minutes=minute)).cast("timestamp"))

    at = lambda minute: T0 + dt.timedelta(minutes=minute)
    write(0, 1, [(1, "a", 0), (1, "a", 0), (2, "b", 0)])
    write(1, 21, [(1, "a", 0), (3, "a", 1)])             # renews genre a and the board of all; b goes on ageing
    assert boards(spark, scratch, at(30)) == {("genre", m, "a", 1): 3, ("genre", m, "b", 2): 1, ("global", m, None, 1): 3, ("global", m, None, 2): 1,
                                              ("genre", m + 1, "a", 3): 1, ("global", m + 1, None, 3): 1}
    after = boards(spark, scratch, at(31))               # b ended at minute 31, the board of all still counts its play
    assert ("genre", m, "b", 2) not in after and after["global", m, None, 2] == 1 and after["genre", m, "a", 1] == 3
    assert lb.expire(spark, scratch, F.lit(at(31)).cast("timestamp")) == 0 and boards(spark, scratch, at(31)) == after
    write(2, 60, [(3, "a", 1)])                          # minute 1 was dead since 51: the late write begins it anew
    assert boards(spark, scratch, at(60)) == {("genre", m + 1, "a", 3): 1, ("global", m + 1, None, 3): 1}
    assert lb.expire(spark, scratch, F.lit(at(60)).cast("timestamp")) == 3
    assert slots_on_disk(scratch) == [f"slot={m + 1}"]
    assert boards(spark, scratch, at(60)) == {("genre", m + 1, "a", 3): 1, ("global", m + 1, None, 3): 1}
    write(2, 61, [(3, "a", 1)])                          # the epoch again: rewritten, not added
    assert boards(spark, scratch, at(62))["genre", m + 1, "a", 3] == 1
    assert lb.expire(spark, scratch, F.lit(at(91)).cast("timestamp")) == 1 and slots_on_disk(scratch) == []
