"""Events get the genre that their song had at their time, whatever way events and changes arrive within the delay."""

import datetime as dt
import random

from streamcharts.streaming import catalog_feed as cf

T0 = dt.datetime(2024, 1, 1)
REQUESTS = "event_id bigint, type string, song_id bigint, ts timestamp_ntz"
CHANGES = "song_id bigint, genre string, premium_only boolean, live boolean, valid_from timestamp_ntz, changed_at timestamp_ntz"


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def plain(requests, changes):
    out = []
    for i, kind, song, ts in requests:
        seen = [c for c in changes if c[0] == song and c[0] is not None and c[4] <= ts]
        v = max(seen, key=lambda c: c[4], default=None)
        out.append((i, kind, song, ts, v[1] if v and v[3] else None, v[2] if v and v[3] else None, bool(v and v[3])))
    return sorted(out, key=str)


def deliver(spark, scratch, requests, changes, salts=3):
    if requests:
        spark.createDataFrame(requests, REQUESTS).write.mode("append").parquet(f"{scratch}/requests")
    if changes:
        spark.createDataFrame(changes, CHANGES).write.mode("append").parquet(f"{scratch}/changes")
    cf.start_catalog_asof(spark.readStream.schema(REQUESTS).parquet(f"{scratch}/requests"), spark.readStream.schema(CHANGES).parquet(f"{scratch}/changes"),
                          f"{scratch}/out", f"{scratch}/ck", "30 minutes", salts, {"availableNow": True}).awaitTermination()
    got = cf.read_events(spark, f"{scratch}/out", spark.createDataFrame([], REQUESTS).schema)
    return sorted((tuple(r) for r in got.collect()), key=str)


def test_genre_as_of_the_event_over_restarts(spark, scratch):
    rng = random.Random(1)
    kinds = ["play", "like"]
    requests = [(k, rng.choice(kinds), 1 if rng.random() < 1 / 3 else rng.choice([2, 3, 4, 9, None]), at(rng.randrange(0, 300) + rng.random())) for k in range(400)]
    changes = [(s, f"g{s}", s == 2, True, at(-1000), at(-1000)) for s in (1, 2, 3, 4)]
    changes += [(1, "second", False, True, at(70), at(70)), (1, "third", True, True, at(150), at(165)),   # told a quarter of an hour late
                (2, "other", False, True, at(95), at(118)), (3, "g3", False, False, at(120), at(120)),    # 3 is taken out and comes back
                (3, "back", False, True, at(200), at(201)), (4, "early", False, True, at(-2000), at(10))]
    for a, b in ((-5000, 100), (100, 180), (180, 400)):
        got = deliver(spark, scratch, sorted([r for r in requests if at(a) <= r[3] < at(b)], key=lambda r: rng.random()),
                      [c for c in changes if at(a) <= c[5] < at(b)])
        want = plain(requests, changes)
        assert set(got) <= set(want) and len(got) < len(want)     # emitted when final only
    beat = (None, None, None, at(9000))
    got = deliver(spark, scratch, [beat], [(None, None, None, None, None, at(9000))])
    assert got == want
    assert {r[4] for r in got if r[2] == 1} == {"g1", "second", "third"}


def test_a_silent_feed_holds_events_back(spark, scratch):
    first = [(1, "g", False, True, at(-10), at(-10))]
    assert deliver(spark, scratch, [(1, "play", 1, at(5)), (2, "play", 1, at(500))], first) == []
    late = [(1, "now", False, True, at(4), at(499)), (None, None, None, None, None, at(900))]   # known long after the event, which still waits
    got = deliver(spark, scratch, [(None, None, None, at(900))], late)
    assert [(r[0], r[4]) for r in got] == [(1, "now"), (2, "now")]
