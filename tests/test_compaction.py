"""Levelled compaction: views stay as they are, writes follow the new rows, erasure reaches the files, windows read few rows."""

import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, decode_messages
from streamcharts.plans import registry as R
from streamcharts.streaming import compaction as cp
from streamcharts.streaming import views as V
from streamcharts.streaming.processor import RollupSink


def play(user, song, ts, genre="pop"):
    return (str(song), '{"type":"play","userId":"%s","songId":"%s","genre":"%s","ts":"%s"}' % (user, song, genre, ts))


def plays(spark, rows):
    return decode_messages(spark.createDataFrame(rows, "key string, value string"))


def counts(spark, out):
    return sorted((r.song_id, str(r.window_start), r.play_count) for r in V.minute_play_counts(spark, out).collect())


def affinity(spark, out):
    return sorted((r.user_hash, r.genre, r.play_count) for r in V.user_genre_affinity(spark, out).collect())


def day_rows(day, n, seed):
    rng = random.Random(seed)
    return [play(rng.randrange(30), rng.randrange(8), f"2024-01-{day:02d}T{rng.randrange(24):02d}:{rng.randrange(60):02d}:00Z") for _ in range(n)]


def written(spark, out, version):
    """Bytes of the song tables' new files, and new rows of all tables."""
    size = sum(os.path.getsize(os.path.join(d, f)) for t in ("song_minute", "song_span") for d, _, fs in os.walk(f"{out}/base/{t}") for f in fs
               if f.endswith(".parquet") and f"segment={version:08d}-" in d)
    return size, sum(p.rows for p in cp.manifest(spark, out, version).pieces if p.since == version)


def test_levels_keep_every_view(spark, scratch):
    sink = RollupSink(scratch, "r1")
    for n in range(5):
        sink(plays(spark, day_rows(1 + n // 4, 60, n)), n)
        if n in (1, 4):
            before = counts(spark, scratch), affinity(spark, scratch)
        cp.compact(spark, scratch, fan=2)
        if n in (1, 4):
            assert (counts(spark, scratch), affinity(spark, scratch)) == before
    m = cp.manifest(spark, scratch)
    assert m.folded == {"r1": 3} and {p.level for p in m.of("song_minute")} == {3}
    per_part = {}
    for p in m.pieces:
        per_part.setdefault((p.table, p.part, p.level), []).append(p)
    assert all(len(v) < 2 for v in per_part.values())
    cp.vacuum(spark, scratch)
    sink(plays(spark, day_rows(1, 60, 2)), 2)  # a folded epoch again
    assert (counts(spark, scratch), affinity(spark, scratch)) == before
    names = {f"segment={p.segment}" for p in m.pieces}
    assert {d for t in cp.KEYS for d in os.listdir(f"{scratch}/base/{t}") if d.startswith("segment=")
            and any(x.startswith(cp.PART[t]) for x in os.listdir(f"{scratch}/base/{t}/{d}"))} <= names


def test_a_compaction_writes_what_is_new(spark, scratch):
    sink = RollupSink(scratch, "r1")
    sink(plays(spark, [r for d in range(1, 9) for r in day_rows(d, 400, d)]), 0)   # a large base of eight days
    sink(plays(spark, day_rows(9, 20, 100)), 1)
    cp.compact(spark, scratch)
    large = written(spark, scratch, 1)
    kept = {(p.part, p.segment) for p in cp.manifest(spark, scratch).of("song_minute")}
    for n in range(2, 5):
        sink(plays(spark, day_rows(9, 20, n)), n)
        assert cp.compact(spark, scratch) == n
        assert all(new < old / 8 for new, old in zip(written(spark, scratch, n), large, strict=True))
    m = cp.manifest(spark, scratch)
    assert kept <= {(p.part, p.segment) for p in m.of("song_minute")}               # old days lie where they were
    sink(plays(spark, day_rows(9, 20, 5)), 5)
    cp.compact(spark, scratch)                                                      # four segments of day 9: merged into one
    day9 = [p for p in cp.manifest(spark, scratch).of("song_minute") if p.part == "2024-01-09"]
    assert [p.level for p in day9] == [2]
    assert kept <= {(p.part, p.segment) for p in cp.manifest(spark, scratch).of("song_minute")}


def test_a_compaction_that_breaks_off_changes_nothing(spark, scratch, monkeypatch):
    sink = RollupSink(scratch, "r1")
    for n in range(3):
        sink(plays(spark, day_rows(1, 40, n)), n)
    before = counts(spark, scratch)
    commit = cp._commit
    monkeypatch.setattr(cp, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        cp.compact(spark, scratch)
    assert counts(spark, scratch) == before and cp.pointer(spark, scratch) == (0, {})
    monkeypatch.setattr(cp, "_commit", commit)
    assert cp.compact(spark, scratch) == 1 and counts(spark, scratch) == before


def test_erasure_reaches_reads_files_and_replays(spark, scratch):
    sink = RollupSink(scratch, "r1")
    parts = [day_rows(1 + n, 150, n) for n in range(4)]
    for n in range(3):
        sink(plays(spark, parts[n]), n)
    cp.compact(spark, scratch)
    whole, songs = affinity(spark, scratch), counts(spark, scratch)
    gone = {whole[0][0], whole[-1][0]}
    cp.erase(spark, scratch, spark.createDataFrame([(h,) for h in gone] + [("nobody",), (None,)], "user_hash string"))
    rest = [r for r in whole if r[0] not in gone]
    assert affinity(spark, scratch) == rest and counts(spark, scratch) == songs
    sink(plays(spark, parts[2]), 2)                      # the open epoch again, and a folded one
    sink(plays(spark, parts[0]), 0)
    assert affinity(spark, scratch) == rest
    before = {(p.part, p.segment) for p in cp.manifest(spark, scratch).of("user_genre")}
    assert cp.compact(spark, scratch) == 2 and affinity(spark, scratch) == rest
    after = {(p.part, p.segment) for p in cp.manifest(spark, scratch).of("user_genre")}
    hit = {str(r.b) for r in spark.createDataFrame([(h,) for h in gone], "user_hash string").select(cp.bucket(cp.BUCKETS).alias("b")).collect()}
    assert {p for p, s in before - after} <= hit         # only folders that may hold a hash were written again
    held = cp._pieces(spark, scratch, cp.manifest(spark, scratch).of("user_genre")).filter(F.col("user_hash").isin(sorted(gone)))
    assert held.count() == 0 and counts(spark, scratch) == songs
    sink(plays(spark, parts[3]), 3)                      # what an erased user does later counts
    fresh = affinity(spark, scratch)
    assert any(r[0] in gone for r in fresh)
    cp.compact(spark, scratch)
    assert affinity(spark, scratch) == fresh
    cp.vacuum(spark, scratch)
    assert affinity(spark, scratch) == fresh


def test_an_erasure_before_the_first_compaction(spark, scratch):
    sink = RollupSink(scratch, "r1")
    for n in range(2):
        sink(plays(spark, day_rows(1, 80, n)), n)
    whole = affinity(spark, scratch)
    cp.erase(spark, scratch, spark.createDataFrame([(whole[0][0],)], "user_hash string"))
    rest = [r for r in whole if r[0] != whole[0][0]]
    assert affinity(spark, scratch) == rest
    cp.compact(spark, scratch)
    assert affinity(spark, scratch) == rest


# -- windows ----------------------------------------------------------------------------------------------------------


def test_cover_is_the_window_in_few_ranges():
    rng = random.Random(1)
    for _ in range(500):
        low = rng.randrange(10**5)
        high = low + rng.choice([0, 1, 59, 60, 61, 1439, 1440, 5000, 60_000])
        ranges = V.cover(low, high)
        assert [m for s, a, b in ranges for m in range(a, b)] == list(range(low, high))
        assert all(a % s == 0 and b % s == 0 and a < b for s, a, b in ranges)
        assert sum((b - a) // s for s, a, b in ranges) <= 2 * 59 + 2 * 23 + (high - low) // 1440


@pytest.fixture(scope="module")
def log_of_weeks(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("weeks"))
    sink = RollupSink(out, "r1")
    for n, epoch in enumerate(R._weekly_epochs(spark, SF_SMALL)):
        sink(epoch, n)
    cp.compact(spark, out)
    return out


def test_any_window_equals_the_scan_over_minutes(spark, log_of_weeks):
    rng = random.Random(2)
    minutes = V.buckets(spark, log_of_weeks)
    for asof, n in [("2024-01-30 23:59:00", 1440), ("2024-01-01 00:00:00", 1), ("2024-01-20 12:34:56", 1), ("2023-01-01", 500)] + [
            (f"2024-01-{rng.randrange(1, 31):02d} {rng.randrange(24):02d}:{rng.randrange(60):02d}:30", rng.randrange(1, 40_000)) for _ in range(4)]:
        from streamcharts.operators import trending as tr

        want = sorted(tuple(r) for r in tr.windowed_plays(minutes, asof, n).collect())
        got = V.window_plays(spark, log_of_weeks, asof, n)
        assert sorted(tuple(r) for r in got.groupBy("song_id").agg(F.sum("plays")).collect()) == want
        assert sorted(tuple(r) for r in tr.windowed_plays(got, asof, n).collect()) == want  # the trending reads take it as it is


def test_a_window_of_days_reads_few_rows(spark, scratch):
    """One song played every minute of six days: a window of four days and a bit is days, hours and minutes."""
    sink = RollupSink(scratch, "r1")
    for d in range(1, 7):
        ticks = spark.range(1440).selectExpr("'1' AS key", """concat('{"type":"play","userId":"', id %% 7, '","songId":"1","genre":"pop","ts":"',
            date_format(timestamp_seconds(unix_seconds(timestamp'2024-01-0%d 00:00:00') + id * 60), "yyyy-MM-dd'T'HH:mm:ss'Z'"), '"}') AS value""" % d)
        sink(decode_messages(ticks), d - 1)
    sink(plays(spark, [play(1, 1, "2024-01-09T00:00:00Z")]), 6)
    cp.compact(spark, scratch)
    rows = V.window_plays(spark, scratch, "2024-01-06 02:29:00", 4 * 1440 + 150)
    assert rows.agg(F.sum("plays")).first()[0] == 4 * 1440 + 150
    assert rows.count() == 4 + 2 + 30
    assert {r.span: r["count"] for r in rows.groupBy("span").count().collect()} == {1440: 4, 60: 2, 1: 30}
