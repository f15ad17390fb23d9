"""Streaming job: stream == batch, replay is idempotent, restart continues, rejects counted."""

import os

from pyspark.sql import functions as F

from streamcharts.plans import registry as R
from streamcharts.sources.streams import message_stream
from streamcharts.streaming import stateful
from streamcharts.streaming import views as V
from streamcharts.streaming.processor import RollupSink, run_id_for
from conftest import start_rollups
from conftest import decode_messages

from conftest import SF_SMALL


def _write_input(spark, path, parts=3):
    R._messages(spark, SF_SMALL).repartition(parts).write.mode("overwrite").json(path)


def _counts(df):
    return sorted(tuple(r) for r in df.select("song_id", "window_start", "play_count").collect())


def test_stream_equals_batch_and_restart(spark, scratch):
    src, out, ck = f"{scratch}/in", f"{scratch}/out", f"{scratch}/ck"
    _write_input(spark, f"{src}/part1")
    stream = message_stream(spark, "json", f"{src}/*", max_per_trigger=2)
    start_rollups(stream, out, ck, trigger={"availableNow": True}).awaitTermination()
    first = V.batch_log(spark, out).count()
    assert first >= 2
    # restart on the same checkpoint with no new input: nothing is reprocessed
    start_rollups(message_stream(spark, "json", f"{src}/*"), out, ck, trigger={"availableNow": True}).awaitTermination()
    assert V.batch_log(spark, out).count() == first
    batch = R.minute_play_counts(spark, SF_SMALL)
    stream_counts = V.minute_play_counts(spark, out)
    assert _counts(stream_counts) == _counts(batch)
    assert V.reject_counts(spark, out).filter("decode_error = 'unknown_type'").first().rows > 0
    aff = V.user_genre_affinity(spark, out).select("user_hash", "genre", "play_count")
    assert sorted(map(tuple, aff.collect())) == sorted(
        map(tuple, R.user_genre_affinity(spark, SF_SMALL).select("user_hash", "genre", "play_count").collect())
    )


def test_replayed_epoch_changes_nothing(spark, scratch):
    msgs = R._messages(spark, SF_SMALL)
    decoded = decode_messages(msgs)
    sink = RollupSink(f"{scratch}/out", "run1")
    sink(decoded, 0)
    before = _counts(V.minute_play_counts(spark, f"{scratch}/out"))
    sink(decoded, 0)  # the same batch delivered again
    assert _counts(V.minute_play_counts(spark, f"{scratch}/out")) == before
    sink(decoded, 1)  # a genuinely new batch with the same rows doubles the counts
    doubled = _counts(V.minute_play_counts(spark, f"{scratch}/out"))
    assert [c for *_, c in doubled] == [2 * c for *_, c in before]


def test_empty_batch_writes_nothing(spark, scratch):
    empty = decode_messages(spark.createDataFrame([], "key string, value string"))
    RollupSink(f"{scratch}/out", "r")(empty, 0)
    assert not os.path.exists(f"{scratch}/out")


def test_run_id_is_bound_to_checkpoint(spark, scratch):
    a = run_id_for(spark, f"{scratch}/ck1")
    assert run_id_for(spark, f"{scratch}/ck1") == a
    assert run_id_for(spark, f"{scratch}/ck2") != a


def test_union_sketch_beats_max(spark, scratch):
    # the same song-minute heard by different users in two batches
    rows = [("k", '{"type":"play","userId":"%s","songId":"1","genre":"pop","ts":"2024-01-01T00:00:10Z"}' % u)
            for u in range(20)]
    msgs = spark.createDataFrame(rows, "key string, value string")
    d = decode_messages(msgs)
    sink = RollupSink(f"{scratch}/out", "r")
    sink(d.filter(F.col("user_hash") < "8"), 0)
    sink(d.filter(F.col("user_hash") >= "8"), 1)
    union = V.unique_listeners(spark, f"{scratch}/out", "union").first().unique_listeners
    mx = V.unique_listeners(spark, f"{scratch}/out", "max").first().unique_listeners
    assert union == 20 and mx < 20


def test_stateful_windowed_counts(spark, scratch):
    src = f"{scratch}/in"
    _write_input(spark, src, parts=2)
    decoded = decode_messages(message_stream(spark, "json", src, max_per_trigger=1))
    agg = stateful.windowed_minute_counts(decoded, watermark="100000 days")
    q = (agg.select("song_id", "window_start", "plays").writeStream.format("memory").queryName("wm_counts")
         .outputMode("update").trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.sql("SELECT song_id, window_start, sum(plays) AS plays FROM (SELECT song_id, window_start, "
                    "max(plays) AS plays FROM wm_counts GROUP BY ALL) GROUP BY ALL")
    expected = R.minute_play_counts(spark, SF_SMALL)
    assert got.count() == expected.count()


def test_intake_stream_matches_batch_acceptance(spark):
    out = R._run_intake(spark, SF_SMALL)
    from streamcharts.streaming import intake as si

    got = sorted(map(tuple, si.refused_counts(spark, out).collect()))
    expected = sorted(map(tuple, R.QUERIES["reject_reasons"](spark, SF_SMALL).collect()))
    assert got == expected
    published = spark.read.json(si.published_messages_path(out))
    assert published.count() == R.QUERIES["accept_events"](spark, SF_SMALL).count()
    assert set(published.columns) >= {"key", "value"}


def test_stateful_sliding_windows_match_batch(spark, scratch):
    src = f"{scratch}/in"
    _write_input(spark, src, parts=2)
    decoded = decode_messages(message_stream(spark, "json", src, max_per_trigger=1))
    agg = stateful.sliding_trending_counts(decoded, length="10 days", slide="1 day", watermark="100000 days")
    q = (agg.writeStream.format("memory").queryName("sliding_counts").outputMode("complete")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = sorted((r.window_start.replace(tzinfo=None), r.song_id, r.plays)
                 for r in spark.sql("SELECT * FROM sliding_counts").collect())
    batch = R.QUERIES["sliding_trending"](spark, SF_SMALL)
    expected = sorted((r.window_start, r.song_id, r.plays) for r in batch.collect())
    assert got == expected


def test_dedupe_within_watermark(spark, scratch):
    """The wire event has no id in the reference; when the log carries one, replays collapse."""
    src = f"{scratch}/dups"
    rows = []
    for i in range(9):
        ts = "2024-01-01T00:00:%02dZ" % (i % 3)
        value = '{"type":"play","userId":"1","songId":"5","genre":"pop","ts":"%s"}' % ts
        rows.append(("5", value, f"e{i % 3}"))  # three events, each delivered three times
    spark.createDataFrame(rows, "key string, value string, event_id string").coalesce(1).write.json(src)
    stream = (spark.readStream.schema("key string, value string, event_id string").json(src))
    agg = stateful.windowed_minute_counts(decode_messages(stream), watermark="1 hour", dedupe_on="event_id")
    q = (agg.select("song_id", "plays").writeStream.format("memory").queryName("dedupe_counts")
         .outputMode("update").trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.sql("SELECT max(plays) FROM dedupe_counts").first()[0] == 3


def test_windowed_counts_latest_value_across_batches(spark, scratch):
    ev = '{"type":"play","userId":"%d","songId":"5","genre":"pop","ts":"2024-01-01T00:00:%02dZ"}'
    for i in range(2):  # two files -> two micro-batches updating the same window
        spark.createDataFrame([("5", ev % (u, u)) for u in range(i * 3, i * 3 + 3)], "key string, value string") \
            .coalesce(1).write.mode("append").json(f"{scratch}/in")
    decoded = decode_messages(message_stream(spark, "json", f"{scratch}/in", max_per_trigger=1))
    stateful.start_windowed_counts(decoded, f"{scratch}/out", f"{scratch}/ck", watermark="1 hour",
                                   trigger={"availableNow": True}).awaitTermination()
    assert spark.read.parquet(f"{scratch}/out").select("run", "epoch").distinct().count() == 2
    rows = stateful.latest_windows(spark, f"{scratch}/out").collect()
    assert [(r.song_id, r.plays) for r in rows] == [(5, 6)]


def _ev_json(user, song, genre, ts):
    return '{"type":"play","userId":"%s","songId":"%s","genre":"%s","ts":"%s"}' % (user, song, genre, ts)


def test_two_genres_same_minute_keep_earliest_batch(spark, scratch):
    sink = RollupSink(f"{scratch}/out", "r")
    first = spark.createDataFrame([("7", _ev_json(1, 7, "rock", "2024-01-01T00:00:05Z"))], "key string, value string")
    second = spark.createDataFrame([("7", _ev_json(2, 7, "pop", "2024-01-01T00:00:30Z")),
                                    ("7", _ev_json(3, 7, "pop", "2024-01-01T00:00:40Z"))], "key string, value string")
    sink(decode_messages(first), 0)
    sink(decode_messages(second), 1)
    (row,) = V.minute_play_counts(spark, f"{scratch}/out").collect()
    assert (row.song_id, row.genre, row.play_count) == (7, "rock", 3)  # one row per (song, minute)


def test_late_and_future_events(spark, scratch):
    from streamcharts.operators import trending as tr

    sink = RollupSink(f"{scratch}/out", "r")
    now = spark.createDataFrame([("1", _ev_json(1, 1, "pop", "2024-01-01T12:00:10Z"))], "key string, value string")
    late = spark.createDataFrame([("1", _ev_json(2, 1, "pop", "2024-01-01T09:00:10Z"))], "key string, value string")
    future = spark.createDataFrame([("2", _ev_json(3, 2, "pop", "2024-01-02T12:00:00Z"))], "key string, value string")
    sink(decode_messages(now), 0)
    sink(decode_messages(late), 1)     # hours late: still added to its own old minute
    sink(decode_messages(future), 2)   # future-dated: stored, invisible until its minute comes
    counts = {(str(r.window_start), r.play_count) for r in V.minute_play_counts(spark, f"{scratch}/out").collect()}
    assert ("2024-01-01 09:00:00", 1) in counts and ("2024-01-01 12:00:00", 1) in counts
    b = V.buckets(spark, f"{scratch}/out")
    assert [r.song_id for r in tr.windowed_plays(b, asof="2024-01-01 12:05:00").collect()] == [1]
    assert [r.song_id for r in tr.windowed_plays(b, asof="2024-01-02 12:00:30").collect()] == [2]


def test_rollups_can_count_other_event_types(spark, scratch):
    src = f"{scratch}/in"
    rows = [("1", '{"type":"%s","userId":"1","songId":"1","genre":"pop","ts":"2024-01-01T00:00:10Z"}' % t)
            for t in ("play", "like", "like", "skip")]
    spark.createDataFrame(rows, "key string, value string").coalesce(1).write.json(src)
    start_rollups(message_stream(spark, "json", src), f"{scratch}/out", f"{scratch}/ck",
                  trigger={"availableNow": True}, event_types=("like",)).awaitTermination()
    assert [r.play_count for r in V.minute_play_counts(spark, f"{scratch}/out").collect()] == [2]


def test_command_line_launcher(spark, scratch):
    from streamcharts.streaming import run

    _write_input(spark, f"{scratch}/in", parts=2)
    with open(f"{scratch}/salt", "w") as f:
        f.write("s3cret\n")
    run.main(["--format", "json", "--path", f"{scratch}/in", "--output", f"{scratch}/out",
              "--checkpoint", f"{scratch}/ck", "--once", "--max-per-trigger", "1",
              "--salt-file", f"{scratch}/salt"], spark=spark)
    assert V.batch_log(spark, f"{scratch}/out").count() == 2
    from streamcharts.functions.privacy import hmac_sha256_hex
    hashes = {r.user_hash for r in V.user_genre_affinity(spark, f"{scratch}/out").collect()}
    uid = R.tb.events(spark, SF_SMALL).filter("type = 'play'").first().user_id
    expected = spark.range(1).select(hmac_sha256_hex(F.lit(str(uid)), b"s3cret")).first()[0]
    assert expected in hashes


def test_live_buckets_expire_after_ttl(spark, scratch):
    import datetime as _dt

    sink = RollupSink(f"{scratch}/out", "r")
    msgs = spark.createDataFrame([("1", _ev_json(1, 1, "pop", "2024-01-01T00:00:10Z")),
                                  ("2", _ev_json(2, 2, "rock", "2024-01-01T00:00:20Z"))], "key string, value string")
    sink(decode_messages(msgs), 0)
    written = V.batch_log(spark, f"{scratch}/out").first().written_at
    live = V.live_buckets(spark, f"{scratch}/out", asof=written + _dt.timedelta(minutes=29))
    assert sorted((r.scope, r.genre) for r in live.collect()) == [("genre", "pop"), ("genre", "rock"), ("global", None)]
    assert V.live_buckets(spark, f"{scratch}/out", asof=written + _dt.timedelta(minutes=31)).count() == 0


def test_checkpoint_bound_to_its_output_root(spark, scratch):
    import pytest

    a = run_id_for(spark, f"{scratch}/ck", f"{scratch}/out1")
    assert run_id_for(spark, f"{scratch}/ck", f"{scratch}/out1") == a
    with pytest.raises(ValueError):
        run_id_for(spark, f"{scratch}/ck", f"{scratch}/out2")


def test_songs_added_while_the_intake_runs_are_known(spark, scratch):
    from streamcharts.streaming.intake import refused_counts, start_intake

    song = "id bigint, genre string, premium_only boolean"
    load = lambda s: s.read.schema(song).parquet(f"{scratch}/songs")
    users = lambda s: s.createDataFrame([(1, "free")], "id bigint, role string")
    schema = "type string, user_id bigint, song_id bigint, ts timestamp_ntz"
    for known, asked in ((1, 1), (2, 2)):
        spark.createDataFrame([(known, "g", False)], song).write.mode("append").parquet(f"{scratch}/songs")
        spark.createDataFrame([("play", 1, asked), ("play", 1, 77)], "type string, user_id bigint, song_id bigint").selectExpr(
            "*", "timestamp_ntz'2024-01-01 00:00:00' ts").write.mode("append").json(f"{scratch}/in")
        if known == 1:
            q = start_intake(spark.readStream.schema(schema).json(f"{scratch}/in"), load, users, f"{scratch}/out", f"{scratch}/ck",
                             trigger={"processingTime": "1 second"})
        q.processAllAvailable()
    q.stop()
    assert {r.reject_reason: r.rejected for r in refused_counts(spark, f"{scratch}/out").collect()} == {"song_not_found": 2}


def test_an_unreadable_run_marker_stops_the_start(spark, scratch):
    import pytest

    rid = run_id_for(spark, f"{scratch}/ck", f"{scratch}/out")
    assert run_id_for(spark, f"{scratch}/ck", f"{scratch}/out") == rid

    class Broken:
        class read:  # noqa: N801
            @staticmethod
            def text(path):
                raise OSError("permission denied")

    with pytest.raises(OSError):
        run_id_for(Broken, f"{scratch}/ck", f"{scratch}/out")
    assert run_id_for(spark, f"{scratch}/ck") == rid


def test_compaction_keeps_every_view_and_reads_open_epochs_only(spark, scratch):
    from streamcharts.streaming import compaction as cp

    decoded = decode_messages(R._messages(spark, SF_SMALL))
    out = f"{scratch}/out"
    part = lambda k: decoded.filter(F.pmod(F.xxhash64("ts", "user_hash"), F.lit(4)) == k)
    sink = RollupSink(out, "r1")

    def views():
        return [_counts(V.minute_play_counts(spark, out)),
                sorted(map(tuple, V.user_genre_affinity(spark, out).select("user_hash", "genre", "play_count").collect())),
                sorted(tuple(r) for r in V.unique_listeners(spark, out).collect()),
                sorted(map(str, V.live_buckets(spark, out, asof="2024-01-01", ttl_seconds=10**10).select("scope", "genre", "minute").collect()))]

    for k in range(3):
        sink(part(k), k)
    before = views()
    assert cp.compact(spark, out) == 1 and cp.compact(spark, out) == 1 and views() == before
    gone = cp.vacuum(spark, out)
    assert gone and views() == before
    sink(part(2), 2), sink(part(0), 0)  # the newest epoch again, and a folded one
    assert views() == before
    sink(part(3), 3)
    whole = views()
    assert cp.compact(spark, out) == 2 and views() == whole
    assert cp.pointer(spark, out) == (2, {"r1": 2})
    files = cp.log_rows(spark, out, "user_genre").inputFiles()
    plan = cp.open_epochs(spark.read.parquet(f"{out}/user_genre"), {"r1": 2})._jdf.queryExecution().toString()
    assert files and "PartitionFilters" in plan
    cp.vacuum(spark, out)
    assert views() == whole
