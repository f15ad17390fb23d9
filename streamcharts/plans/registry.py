"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Every query reads the whole given tables; parameters come from ``params``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamcharts.constants import CATALOG_DEFAULT_LIMIT, CATALOG_MAX_LIMIT, TRENDING_DEFAULT_LIMIT, TRENDING_MAX_LIMIT
from streamcharts.functions.privacy import pseudonym
from streamcharts.functions.scalars import clamped_limit
from streamcharts.functions.timefns import epoch_minute, minute_floor
from streamcharts.operators import asof
from streamcharts.operators import catalog as cat
from streamcharts.operators import events as ev
from streamcharts.operators import latency as lt
from streamcharts.operators import observability as ob
from streamcharts.operators import privacy as pv
from streamcharts.operators import rollups as ru
from streamcharts.operators import search as sx
from streamcharts.operators import throttling as th
from streamcharts.operators import trending as tr
from streamcharts.plans import params as P
from streamcharts.session import scratch_path
from streamcharts.sources import logs as lg
from streamcharts.sources import tables as tb
from streamcharts.sources.schemas import MESSAGE_SCHEMA
from streamcharts.sources.streams import message_stream, write_messages
from streamcharts.streaming import catalog_feed as cf
from streamcharts.streaming import compaction as cp
from streamcharts.streaming import intake as si
from streamcharts.streaming import leaderboard as lb
from streamcharts.streaming import listeners as ls
from streamcharts.streaming import stateful as st
from streamcharts.streaming import throttling as sth
from streamcharts.streaming import views as sv
from streamcharts.streaming.processor import RollupSink, start_rollups

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn

    return deco


# ---------------------------------------------------------------- helpers
def _plays(spark, sf):
    """Hashed plays without genre; rollups aggregate them before the catalog join."""
    return ev.play_rows(tb.events(spark, sf, types=("play",)), P.SALT)


def _buckets(spark, sf):
    """Raw plays as one-play buckets without a genre: the trending reads sum
    them per song and look the genre up in the catalog afterwards."""
    e = tb.events(spark, sf, types=("play",)).filter(F.col("song_id").isNotNull())
    return e.select(
        "song_id", "ts", minute_floor(F.col("ts")).alias("window_start"), F.lit(1).cast("long").alias("plays")
    )


def _batch_epoch():
    """Events dealt round-robin into simulated micro-batches for the merge checks."""
    return (F.col("event_id") % P.MERGE_BATCHES).cast("long")


def _messages(spark, sf, keep=()):
    """Every event as a keyed wire record, genre and role looked up (P19, K12); ``keep`` names event columns to
    carry along."""
    e = tb.events(spark, sf)
    s = tb.songs(spark, sf).select(F.col("id").alias("song_id"), "genre")
    u = tb.users(spark, sf).select(F.col("id").alias("user_id"), "role")
    enriched = e.join(s, "song_id", "left").join(u, "user_id", "left")
    return ev.to_messages(enriched, keep=keep)


# ------------------------------------------------------------ trending
@register("trending_global")
def trending_global(spark, sf):
    return tr.trending(_buckets(spark, sf), tb.songs(spark, sf), tb.artists(spark, sf),
                       asof=P.ASOF, window_minutes=P.WINDOW_MINUTES)


@register("trending_genre")
def trending_genre(spark, sf):
    return tr.trending(_buckets(spark, sf), tb.songs(spark, sf), tb.artists(spark, sf),
                       genre=P.SEARCH_GENRE, limit=50, asof=P.ASOF, window_minutes=P.WINDOW_MINUTES)


@register("trending_by_genre")
def trending_by_genre(spark, sf):
    return tr.trending_by_genre(_buckets(spark, sf), tb.songs(spark, sf), tb.artists(spark, sf),
                                asof=P.ASOF, window_minutes=P.WINDOW_MINUTES)


@register("trending_share")
def trending_share(spark, sf):
    return tr.trending_share(_buckets(spark, sf), tb.songs(spark, sf), tb.artists(spark, sf),
                             limit=50, asof=P.ASOF, window_minutes=P.WINDOW_MINUTES)


@register("sliding_trending")
def sliding_trending(spark, sf):
    out = tr.sliding_trending(_plays(spark, sf), P.SLIDING_WINDOW, P.SLIDING_SLIDE)
    return ru.known_songs(out, tb.songs(spark, sf))


def _affinity(spark, sf):
    return ru.user_genre_affinity(ru.user_genre_deltas_from_plays(_plays(spark, sf), tb.songs(spark, sf)))


@register("favourite_genre")
def favourite_genre(spark, sf):
    return tr.favourite_genre(_affinity(spark, sf))


@register("for_you_all")
def for_you_all(spark, sf):
    aff = _affinity(spark, sf)
    return tr.for_you(tb.users(spark, sf), aff, _buckets(spark, sf), tb.songs(spark, sf), tb.artists(spark, sf),
                      asof=P.ASOF, window_minutes=P.WINDOW_MINUTES, salt=P.SALT)


# ------------------------------------------------------------- decode
@register("event_messages")
def event_messages(spark, sf):
    return _messages(spark, sf)


@register("decode_events")
def decode_events(spark, sf):
    return ev.decode_messages(_messages(spark, sf), P.SALT).select(
        "type", "songId", "genre", "role", "ts", "window_start", "user_hash", "song_id", "decode_error"
    )


@register("published_log")
def published_log(spark, sf):
    """The whole log published in one batch write, read back and decoded."""
    path = scratch_path(spark, "published")
    write_messages(_messages(spark, sf), "json", path)
    return ev.decode_messages(spark.read.schema(MESSAGE_SCHEMA).json(path), P.SALT).select(
        "type", "songId", "genre", "role", "ts", "window_start", "user_hash", "song_id", "decode_error")


@register("page_limits")
def page_limits(spark, sf):
    """Requested page sizes as clients send them (numbers, nothing, text) and what the two lists make of them."""
    e = tb.read(spark, sf, "events")
    asked = F.when(e.event_id % 7 == 0, F.lit(None)).when(e.event_id % 7 == 1, F.lit("many")).otherwise(
        (e.value - 20).cast("string"))
    return e.select("event_id", clamped_limit(asked, TRENDING_DEFAULT_LIMIT, TRENDING_MAX_LIMIT).alias("trending_limit"),
                    clamped_limit(asked, CATALOG_DEFAULT_LIMIT, CATALOG_MAX_LIMIT).alias("catalog_limit"))


@register("pseudonymize")
def pseudonymize(spark, sf):
    e = tb.events(spark, sf)
    return e.select("event_id", pseudonym(F.col("user_id"), P.SALT).alias("user_hash"))


@register("events_by_type")
def events_by_type(spark, sf):
    return ru.events_by_type(tb.events(spark, sf))


# ------------------------------------------------------------ rollups
@register("minute_play_counts")
def minute_play_counts(spark, sf):
    return ru.minute_play_counts(ru.minute_deltas_from_plays(_plays(spark, sf), tb.songs(spark, sf)))


@register("minute_unique_exact")
def minute_unique_exact(spark, sf):
    return ru.known_songs(ru.unique_listeners_exact(_plays(spark, sf)), tb.songs(spark, sf))


def _within_error(spark, sf, estimate):
    """Each (song, minute) of the estimate with whether it is within the sketch's stated error of the
    exact count; a key that either side lacks counts as outside."""
    exact = ru.known_songs(ru.unique_listeners_exact(_plays(spark, sf)), tb.songs(spark, sf)).withColumnRenamed(
        "unique_listeners", "exact")
    both = exact.join(estimate, ["song_id", "window_start"], "full")
    near = F.abs(F.col("unique_listeners") - F.col("exact")) <= F.greatest(F.lit(1.0), F.col("exact") * P.SKETCH_ERROR)
    return both.select("song_id", "window_start", F.coalesce(near, F.lit(False)).alias("within_error"))


@register("minute_unique_approx")
def minute_unique_approx(spark, sf):
    return _within_error(spark, sf, ru.unique_listeners(
        ru.minute_deltas_from_plays(_plays(spark, sf), tb.songs(spark, sf)), mode="max"))


def _epoch_deltas(spark, sf):
    """Minute deltas per simulated batch: one delta row per (batch, song, minute)."""
    plays = _plays(spark, sf).withColumn("epoch", _batch_epoch())
    return ru.minute_deltas_from_plays(plays, tb.songs(spark, sf), epoch="epoch")


@register("unique_union_sketch")
def unique_union_sketch(spark, sf):
    return _within_error(spark, sf, ru.unique_listeners(_epoch_deltas(spark, sf), mode="union"))


@register("unique_max_merge")
def unique_max_merge(spark, sf):
    """Reference merge (max across batches) of exact per-batch distinct counts."""
    per_batch = _plays(spark, sf).withColumn("epoch", _batch_epoch()).groupBy(
        "epoch", "song_id", "window_start"
    ).agg(F.countDistinct("user_hash").alias("uniq_approx"))
    return ru.unique_listeners(ru.known_songs(per_batch, tb.songs(spark, sf)), mode="max")


@register("merge_additive")
def merge_additive(spark, sf):
    return ru.minute_play_counts(_epoch_deltas(spark, sf))


@register("user_genre_affinity")
def user_genre_affinity(spark, sf):
    return _affinity(spark, sf)


@register("ttl_live_buckets")
def ttl_live_buckets(spark, sf):
    rows = ru.minute_deltas_from_plays(_plays(spark, sf), tb.songs(spark, sf)).withColumn(
        "minute", epoch_minute(F.col("window_start")))
    return ru.live_buckets(rows, tr.asof_column(P.ASOF))


# ------------------------------------------------------------ catalog


@register("list_songs")
def list_songs(spark, sf):
    return cat.list_songs(tb.songs(spark, sf), tb.artists(spark, sf))


@register("search_songs")
def search_songs(spark, sf):
    return cat.list_songs(tb.songs(spark, sf), tb.artists(spark, sf), genre=P.SEARCH_GENRE,
                          q=P.SEARCH_TEXT, limit=200)


def _search_index(spark, sf):
    """The catalog's cards and the path of their trigram index."""
    cards, path = tr.song_cards(tb.songs(spark, sf), tb.artists(spark, sf)), scratch_path(spark, "search-index")
    sx.build_index(cards, path)
    return cards, path


@register("search_songs_indexed")
def search_songs_indexed(spark, sf):
    cards, path = _search_index(spark, sf)
    return sx.search(cards, path, P.SEARCH_TEXT, P.SEARCH_GENRE, 200)


@register("search_patterns")
def search_patterns(spark, sf):
    """Every word of a title and every artist's name, and patterns with wildcards: how many cards match, and which in sum."""
    cards, path = _search_index(spark, sf)
    words = tb.songs(spark, sf).select(F.explode(F.split("title", " ")).alias("pattern")).unionByName(
        tb.artists(spark, sf).select(F.col("name").alias("pattern"))).unionByName(
        spark.range(1).select(F.explode(F.array(*[F.lit(x) for x in P.SEARCH_PATTERNS])).alias("pattern")))
    return sx.search_all(cards, path, words).groupBy("pattern").agg(
        F.count(F.lit(1)).alias("matches"), F.sum("id").alias("id_sum"), F.min("id").alias("first_id"))


@register("get_song")
def get_song(spark, sf):
    return cat.get_song(tb.songs(spark, sf), tb.artists(spark, sf), P.SONG_ID)


@register("list_artists")
def list_artists(spark, sf):
    return cat.list_artists(tb.artists(spark, sf))


@register("genre_counts")
def genre_counts(spark, sf):
    return cat.genre_counts(tb.songs(spark, sf))


@register("duration_text")
def duration_text(spark, sf):
    return cat.song_durations(tb.songs(spark, sf))


@register("playlists")
def playlists(spark, sf):
    return cat.user_playlists(tb.playlists(spark, sf), tb.playlist_songs(spark, sf))


def _playlist_requests(spark, sf):
    """Add-track requests: each like names a playlist id taken from the event id."""
    e = tb.events(spark, sf).filter(F.col("type") == "like")
    return e.select("event_id", "user_id", F.col("event_id").alias("playlist_id"), "song_id")


@register("playlist_owner_check")
def playlist_owner_check(spark, sf):
    return cat.owner_check(_playlist_requests(spark, sf), tb.playlists(spark, sf)).select(
        "event_id", "user_id", "playlist_id", "song_id", "owned"
    )


@register("playlist_insert_new")
def playlist_insert_new(spark, sf):
    """Each like adds the song to the user's newest playlist unless already there."""
    pl = tb.playlists(spark, sf)
    likes = tb.events(spark, sf).filter(F.col("type") == "like").select("user_id", "song_id")
    reqs = likes.join(cat.newest_playlist(pl), "user_id", "inner")
    return cat.add_playlist_songs(reqs, pl, tb.playlist_songs(spark, sf))


@register("playlist_create")
def playlist_create(spark, sf):
    """Every user who liked a song gets a new "Liked songs" playlist."""
    u, pl = tb.users(spark, sf), tb.playlists(spark, sf)
    likers = tb.events(spark, sf).filter(F.col("type") == "like").select(F.col("user_id").alias("id"))
    new = u.join(likers, "id", "left_semi").select(
        F.col("id").alias("user_id"), F.lit("Liked songs").alias("name")
    )
    return cat.create_playlists(new, pl)


@register("next_track")
def next_track(spark, sf):
    return cat.track_neighbours(tb.playlist_songs(spark, sf), bounds_from=tb.playlist_rows(spark, sf)).select(
        "playlist_id", "song_id", "next_song_id"
    )


@register("numbered_listing")
def numbered_listing(spark, sf):
    return cat.track_neighbours(tb.playlist_songs(spark, sf), bounds_from=tb.playlist_rows(spark, sf)).select(
        "playlist_id", "song_id", "track_no", "label"
    )


def _registrations(spark, sf):
    """Sign-ups derived from the tables: suppliers register (twice, the second time
    with an upper-cased address), customers re-register with a mixed-case address.
    ``requested_at`` is the order in which they come in."""
    s = tb.read(spark, sf, "supplier")
    c = tb.read(spark, sf, "customer")
    first = s.select(
        F.concat(F.lit("s1-"), s.s_suppkey.cast("string")).alias("request_id"),
        (s.s_suppkey * 2).cast("long").alias("requested_at"),
        F.concat(F.lower(s.s_name), F.lit("@x.io")).alias("email"),
        s.s_name.alias("password"),
    )
    again = s.select(
        F.concat(F.lit("s2-"), s.s_suppkey.cast("string")).alias("request_id"),
        (s.s_suppkey * 2 + F.when(s.s_suppkey % 3 == 0, -1).otherwise(1)).cast("long").alias("requested_at"),
        F.concat(F.upper(s.s_name), F.lit("@X.IO")).alias("email"),
        F.repeat(F.lit("p"), s.s_nationkey).alias("password"),
    )
    cust = c.select(
        F.concat(F.lit("c-"), c.c_custkey.cast("string")).alias("request_id"),
        c.c_custkey.cast("long").alias("requested_at"),
        F.concat(c.c_name, F.lit("@X.io")).alias("email"),
        F.repeat(F.lit("p"), c.c_nationkey).alias("password"),
    )
    return first.unionByName(again).unionByName(cust)


@register("register_split")
def register_split(spark, sf):
    return cat.register_users(_registrations(spark, sf), tb.users(spark, sf))


@register("role_at_least")
def role_at_least(spark, sf):
    return cat.role_flags(tb.users(spark, sf))


def _erase_ids(spark, sf):
    """Erasure requests: customers with a negative balance close their accounts."""
    c = tb.read(spark, sf, "customer")
    return c.filter(c.c_acctbal < 0).select(c.c_custkey.cast("long").alias("id"))


@register("erase_user_cascade")
def erase_user_cascade(spark, sf):
    return pv.cascade_counts(pv.cascade_flags(_erase_ids(spark, sf), {
        "users": (tb.users(spark, sf), "id"),
        "playlists": (tb.playlists(spark, sf), "user_id"),
        "playlist_songs": (tb.playlist_songs(spark, sf), "playlist_id"),
    }))


@register("erase_artist_cascade")
def erase_artist_cascade(spark, sf):
    """Artists with a negative balance are taken down with their songs."""
    s = tb.read(spark, sf, "supplier")
    ids = s.filter(s.s_acctbal < 0).select(s.s_suppkey.cast("long").alias("id"))
    return pv.cascade_counts(pv.cascade_flags(ids, {
        "artists": (tb.artists(spark, sf), "id"),
        "songs": (tb.songs(spark, sf), "artist_id"),
        "playlist_songs": (tb.playlist_songs(spark, sf), "song_id"),
    }))


@register("export_user")
def export_user(spark, sf):
    ids, playlists = _erase_ids(spark, sf), tb.playlists(spark, sf)
    theirs = playlists.join(ids.withColumnRenamed("id", "user_id"), "user_id", "left_semi").select(F.col("id").alias("playlist_id"))
    return pv.export_users(ids, tb.users(spark, sf), playlists, tb.playlist_songs(spark, sf, theirs), tb.playlist_rows(spark, sf))


# ------------------------------------------------------------- intake
def _requests(spark, sf):
    return tb.events(spark, sf).select("event_id", "type", "user_id", "song_id", "ts")


@register("accept_events")
def accept_events(spark, sf):
    out = ev.accept_events(_requests(spark, sf), tb.songs(spark, sf), tb.users(spark, sf))
    return out.filter(F.col("reject_reason").isNull()).select(
        "event_id", "type", "user_id", "song_id", "genre", "role"
    )


@register("reject_reasons")
def reject_reasons(spark, sf):
    out = ev.accept_events(_requests(spark, sf), tb.songs(spark, sf), tb.users(spark, sf))
    return out.filter(F.col("reject_reason").isNotNull()).groupBy("reject_reason").agg(
        F.count(F.lit(1)).alias("rejected")
    )


# ------------------------------------------------------- observability


@register("requests_by_route")
def requests_by_route(spark, sf):
    return ob.requests_by_route(tb.request_log(spark, sf))


@register("latency_histogram")
def latency_histogram(spark, sf):
    return ob.latency_histogram(tb.request_log(spark, sf))


@register("histogram_p95")
def histogram_p95(spark, sf):
    return ob.histogram_p95(tb.request_log(spark, sf), P.HISTOGRAM_GRAIN)


@register("throughput_rate")
def throughput_rate(spark, sf):
    return ob.throughput_rate(tb.request_log(spark, sf))


@register("error_rate")
def error_rate(spark, sf):
    return ob.throughput_rate(tb.request_log(spark, sf), status_filter=ob.server_errors()).withColumnRenamed(
        "rate", "error_rate"
    )


@register("latest_up")
def latest_up(spark, sf):
    return ob.latest_up(tb.request_log(spark, sf))


@register("load_summary")
def load_summary(spark, sf):
    return ob.load_summary(tb.request_log(spark, sf))


@register("slo_check")
def slo_check(spark, sf):
    return ob.slo_check(ob.load_summary(tb.request_log(spark, sf)))


@register("run_compare")
def run_compare(spark, sf):
    return ob.run_compare(tb.request_log(spark, sf), P.RUN_GRAIN)


@register("metric_rate")
def metric_rate(spark, sf):
    """Rates of stored counter samples: the event table's values, which come unevenly and go down as well."""
    return ob.counter_rate(tb.metric_samples(spark, sf), window_seconds=P.RATE_WINDOW_SECONDS)


@register("metric_instant")
def metric_instant(spark, sf):
    """What the dashboard shows at each step: the last sample, if it is not stale."""
    return asof.instant_values(tb.metric_samples(spark, sf), ("service",), P.PANEL_START, P.PANEL_END, P.PANEL_STEP_SECONDS)


@register("metric_extrapolated_rate")
def metric_extrapolated_rate(spark, sf):
    return asof.extrapolated_rate(tb.metric_samples(spark, sf), ("service",), P.PANEL_START, P.PANEL_END, P.PANEL_STEP_SECONDS,
                                  P.PANEL_RANGE_SECONDS)


def _latency_state(spark, sf) -> str:
    """The request log week by week into the latency state, one week delivered twice. Returns the root."""
    out, log = scratch_path(spark, "latency"), tb.request_log(spark, sf)
    sink, at = lt.LatencySink(out, "r1"), lambda d: F.lit(d).cast("timestamp_ntz")
    cuts = ["1970-01-01", *P.STREAM_CUTS, "9999-01-01"]
    for n in (0, 1, 2, 3, 1):
        sink(log.filter((F.col("ts") >= at(cuts[n])) & (F.col("ts") < at(cuts[n + 1]))), n)
    return out


@register("stream_latency_quantiles")
def stream_latency_quantiles(spark, sf):
    """Quantiles per service and day out of merged minute counts; the weeks in the middle of the data only."""
    rows = lt.state(spark, _latency_state(spark, sf), *P.STREAM_CUTS[::2])
    return lt.quantiles(rows, ["service", F.date_trunc("day", "window_start").cast("timestamp_ntz").alias("day")])


@register("stream_latency_runs")
def stream_latency_runs(spark, sf):
    return lt.run_compare(lt.state(spark, _latency_state(spark, sf)), P.RUN_GRAIN)


def _access_lines(spark, sf):
    """Gateway log lines of the request log: every fifth request was tried on another replica first, and
    every eleventh line is cut short."""
    r = tb.request_log(spark, sf)
    addr = F.format_string("10.0.%d.%d", (r.client / 256).cast("long") % 256, r.client % 256)
    replica = lambda k: F.concat(r.service, F.lit(":"), (F.lit(4000) + k % P.UPSTREAM_REPLICAS).cast("string"))
    answered = replica(r.event_id)
    upstream = F.when(r.event_id % 5 == 0, F.concat(replica(r.event_id + 1), F.lit(", "), answered)).otherwise(answered)
    line = lg.format_access_line(addr, r.method, F.concat(F.lit("/api/"), r.route), r.status,
                                 r.duration_seconds, upstream)
    line = F.when(r.event_id % 11 == 0, F.substring(line, 1, 12)).otherwise(line)
    return r.select(line.alias("value"))


def _access_log(spark, sf) -> str:
    """Those lines as files; returns their path."""
    path = scratch_path(spark, "access-log")
    _access_lines(spark, sf).write.text(path)
    return path


@register("access_log")
def access_log(spark, sf):
    """The log files read back: requests by method, path, status and number of tries; unparsed lines apart."""
    return lg.read_access_log(spark, _access_log(spark, sf)).groupBy("parsed", "method", "path", "status", "tries").agg(
        F.count(F.lit(1)).alias("requests"))


@register("upstream_share")
def upstream_share(spark, sf):
    return ob.upstream_share(lg.read_access_log(spark, _access_log(spark, sf)))


@register("throttled_clients")
def throttled_clients(spark, sf):
    return ob.throttled_clients(tb.request_log(spark, sf), P.ATTEMPT_WINDOW)


@register("throttle_windows")
def throttle_windows(spark, sf):
    return th.attempt_windows(tb.request_log(spark, sf), P.ATTEMPT_SECONDS, P.ATTEMPT_LIMIT)


@register("service_overview")
def service_overview(spark, sf):
    return ob.service_overview(tb.request_log(spark, sf))


@register("find_users")
def find_users(spark, sf):
    """Login lookups: every sign-up's address, in whatever case it was typed."""
    return cat.find_users(tb.users(spark, sf), _registrations(spark, sf).select("email"))


@register("trending_labels")
def trending_labels(spark, sf):
    rows = tr.trending(_buckets(spark, sf), tb.songs(spark, sf), tb.artists(spark, sf), genre=P.SEARCH_GENRE,
                       asof=P.ASOF, window_minutes=P.WINDOW_MINUTES)
    return tr.with_request_labels(rows, P.SEARCH_GENRE, P.WINDOW_MINUTES).select(
        "id", "plays", "rank", "window_minutes", "requested_genre")


# ------------------------------------------------- streaming job, end to end
def _log_files(spark, records: DataFrame, name: str) -> tuple[str, int]:
    """Records as files, written by as many tasks as their size asks for; returns the path and how many files
    a micro-batch takes so that a few batches read them all."""
    path = scratch_path(spark, name)
    records.write.option("maxRecordsPerFile", max(1, records.count() // P.STREAM_BATCHES)).json(path)
    files = len(spark.read.text(path).inputFiles())
    return path, max(1, files // P.STREAM_BATCHES)


def _run_stream(spark, sf) -> str:
    """Publish the whole event log as keyed records, run the rollup job over it in
    several micro-batches (availableNow) and return the output root."""
    src, per_batch = _log_files(spark, _messages(spark, sf), "stream-in")
    out, ck = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ckpt")
    q = start_rollups(message_stream(spark, "json", src, max_per_trigger=per_batch), out, ck,
                      trigger={"availableNow": True}, salt=P.SALT)
    q.awaitTermination()
    return out


@register("stream_minute_counts")
def stream_minute_counts(spark, sf):
    return _ntz(sv.minute_play_counts(spark, _run_stream(spark, sf)))


def _ntz(counts):
    return counts.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")).withColumn(
        "window_end", F.col("window_end").cast("timestamp_ntz"))


@register("stream_batch_log")
def stream_batch_log(spark, sf):
    """The per-batch audit rows, added up over the batches."""
    log = sv.batch_log(spark, _run_stream(spark, sf))
    return log.agg(*[F.sum(c).cast("long").alias(c) for c in ("rows", "plays", "rejected")])


@register("stream_compacted_counts")
def stream_compacted_counts(spark, sf):
    """Three epochs, a compaction and a clean-up, then the last epoch and a folded one delivered again."""
    epochs = _stored_epochs(spark, sf, F.pmod(F.xxhash64("user_hash", "ts"), F.lit(3)).cast("int"), 3)
    out = scratch_path(spark, "compacted")
    sink = RollupSink(out, "r1")
    for epoch in (0, 1, 2):
        sink(epochs[epoch], epoch)
    cp.compact(spark, out)
    cp.vacuum(spark, out)
    for epoch in (2, 0):
        sink(epochs[epoch], epoch)
    return _ntz(sv.minute_play_counts(spark, out))


def _stored_epochs(spark, sf, epoch, count: int):
    """The event log decoded and stored once, by the number of the epoch that a row comes in: an epoch reads its own rows."""
    decoded = ev.decode_messages(_messages(spark, sf), P.SALT).withColumn("_epoch", epoch)
    path = scratch_path(spark, "decoded")
    decoded.write.partitionBy("_epoch").parquet(path)
    rows = spark.read.schema(decoded.schema).parquet(path)
    return [rows.filter(F.col("_epoch") == n).drop("_epoch") for n in range(count)]


def _weekly_epochs(spark, sf):
    """The event log decoded, cut into epochs week by week."""
    ts = F.coalesce(F.col("ts"), F.lit("1970-01-01").cast("timestamp_ntz"))
    week = F.lit(0)
    for d in P.STREAM_CUTS:
        week = week + (ts >= F.lit(d).cast("timestamp_ntz")).cast("int")
    return _stored_epochs(spark, sf, week, len(P.STREAM_CUTS) + 1)


def _levelled(spark, sf) -> tuple:
    """Weekly epochs, folded one by one as they come and merged level by level; the last stays open. Returns the root and the epochs."""
    out, weeks = scratch_path(spark, "levelled"), _weekly_epochs(spark, sf)
    sink = RollupSink(out, "r1")
    for n, epoch in enumerate(weeks):
        sink(epoch, n)
        cp.compact(spark, out, P.MERGE_FAN)
    cp.vacuum(spark, out)
    return out, weeks


@register("stream_levelled_counts")
def stream_levelled_counts(spark, sf):
    """Minute counts out of segments of several levels, after a folded epoch was delivered again."""
    out, weeks = _levelled(spark, sf)
    RollupSink(out, "r1")(weeks[1], 1)
    return _ntz(sv.minute_play_counts(spark, out))


@register("stream_window_tree")
def stream_window_tree(spark, sf):
    """Plays per song of windows of minutes up to weeks, from days, hours and minutes."""
    (out, _), rows = _levelled(spark, sf), None
    for n, (asof, minutes) in enumerate(P.TREE_WINDOWS):
        one = sv.window_plays(spark, out, asof, minutes).groupBy("song_id").agg(F.sum("plays").alias("plays")).select(
            F.lit(n).alias("window_no"), "song_id", "plays")
        rows = one if rows is None else rows.unionByName(one)
    return rows


@register("stream_erased_affinity")
def stream_erased_affinity(spark, sf):
    """Users with a negative balance are erased after the second week: what they did until then is gone from the base
    and stays away when an epoch of that time is delivered again; what they do later counts."""
    out, weeks = scratch_path(spark, "erased"), _weekly_epochs(spark, sf)
    sink = RollupSink(out, "r1")
    for n in (0, 1):
        sink(weeks[n], n)
    cp.compact(spark, out, P.MERGE_FAN)
    cp.erase(spark, out, _erase_ids(spark, sf).select(pseudonym(F.col("id").cast("string"), P.SALT).alias("user_hash")))
    sink(weeks[1], 1)
    cp.compact(spark, out, P.MERGE_FAN)
    for n in (2, 3):
        sink(weeks[n], n)
    return sv.user_genre_affinity(spark, out).select("user_hash", "genre", "play_count")


def _listeners(spark, sf) -> str:
    """Weekly epochs as listeners' bitmaps, one delivered again. Returns the root."""
    out = scratch_path(spark, "listeners")
    sink = ls.ListenerSink(out, "r1")
    weeks = _weekly_epochs(spark, sf)
    for n in (0, 1, 2, 3, 3):
        sink(ev.good_plays(weeks[n]), n)
    return out


@register("stream_unique_exact")
def stream_unique_exact(spark, sf):
    rows = ls.unique_listeners(spark, _listeners(spark, sf))
    return rows.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@register("stream_unique_daily")
def stream_unique_daily(spark, sf):
    rows = ls.unique_listeners(spark, _listeners(spark, sf), "day")
    return rows.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@register("stream_leaderboard")
def stream_leaderboard(spark, sf):
    """Plays dealt to three writes at set times; what has expired by the anchor is removed, the boards alive are left."""
    out = scratch_path(spark, "leaderboard")
    sink = lb.LeaderboardSink(out, "r1", 1440)  # the log is spread over a month
    plays = _plays(spark, sf).join(tb.songs(spark, sf).select(F.col("id").alias("song_id"), "genre"), "song_id")
    asof = F.lit(P.ASOF).cast("timestamp")
    for epoch, age in enumerate(P.BOARD_AGES):
        sink(plays.filter(_batch_epoch() == epoch), epoch, asof - F.expr(f"INTERVAL {age} MINUTES"))
    lb.expire(spark, out, asof)
    return lb.live(spark, out, asof).withColumn("expires_at", F.col("expires_at").cast("timestamp_ntz"))


@register("stream_affinity")
def stream_affinity(spark, sf):
    return sv.user_genre_affinity(spark, _run_stream(spark, sf)).select("user_hash", "genre", "play_count")


@register("stream_trending")
def stream_trending(spark, sf):
    return tr.trending(sv.buckets(spark, _run_stream(spark, sf)), tb.songs(spark, sf), tb.artists(spark, sf),
                       asof=P.ASOF, window_minutes=P.WINDOW_MINUTES)


REQUEST_SCHEMA = "event_id bigint, type string, user_id bigint, song_id bigint, ts timestamp_ntz"


def _run_intake(spark, sf) -> str:
    """Requests (every event, as a client call) through the intake stream; returns its output root."""
    src, per_batch = _log_files(spark, _requests(spark, sf), "requests-in")
    reqs = spark.readStream.schema(REQUEST_SCHEMA).option("maxFilesPerTrigger", per_batch).json(src)
    out, ck = scratch_path(spark, "intake-out"), scratch_path(spark, "intake-ckpt")
    si.start_intake(reqs, lambda s: tb.songs(s, sf), lambda s: tb.users(s, sf), out, ck,
                    trigger={"availableNow": True}).awaitTermination()
    return out


@register("stream_intake_rejects")
def stream_intake_rejects(spark, sf):
    return si.refused_counts(spark, _run_intake(spark, sf))


@register("stream_end_to_end")
def stream_end_to_end(spark, sf):
    """Requests -> intake stream -> keyed log -> rollup stream -> minute play counts."""
    published = si.published_messages_path(_run_intake(spark, sf))
    out, ck = scratch_path(spark, "e2e-out"), scratch_path(spark, "e2e-ckpt")
    start_rollups(message_stream(spark, "json", published, max_per_trigger=2), out, ck,
                  trigger={"availableNow": True}, salt=P.SALT).awaitTermination()
    return sv.minute_play_counts(spark, out).select("song_id", "genre", "window_start", "play_count")


@register("stream_throttle_windows")
def stream_throttle_windows(spark, sf):
    """Attempts week by week, the job restarted on its checkpoint for each; at last a heartbeat, which ends all windows."""
    src, out, ck = (scratch_path(spark, f"throttling-{x}") for x in ("in", "out", "ckpt"))
    attempts = tb.request_log(spark, sf).select("client", "ts")
    at = lambda d: F.lit(d).cast("timestamp_ntz")
    cuts = [None, *P.STREAM_CUTS, None]
    deliveries = [attempts.filter((F.col("ts") >= at(a) if a else F.lit(True)) & (F.col("ts") < at(b) if b else F.lit(True)))
                  for a, b in zip(cuts[:-1], cuts[1:])]
    deliveries.append(spark.range(1).select(F.lit(None).cast("long").alias("client"), at(P.HEARTBEAT).alias("ts")))
    for rows in deliveries:
        rows.write.mode("append").parquet(src)
        sth.start_throttling(spark.readStream.schema(attempts.schema).parquet(src), out, ck, P.ATTEMPT_SECONDS, "1 hour",
                             {"availableNow": True}).awaitTermination()
    return sth.read_windows(spark, out, P.ATTEMPT_LIMIT)


def _catalog_changes(spark, sf):
    """A change feed of the catalog: every song's first row; every third one gets another genre in the third week, of every
    fiftieth a row that takes it out. ``changed_at`` is when the feed had it: some genres were known half a day late."""
    s = tb.songs(spark, sf).select(F.col("id").alias("song_id"), "genre", "premium_only")
    at = lambda d: F.lit(d).cast("timestamp_ntz")
    first = s.select("song_id", "genre", "premium_only", F.lit(True).alias("live"), at("2000-01-01").alias("valid_from"), at(P.CATALOG_FROM).alias("changed_at"))
    moved = at(P.STREAM_CUTS[1]) + F.expr("make_dt_interval(0, song_id % 24)")
    late = F.expr("make_dt_interval(0, song_id % 2 * 12)")
    other = s.filter("song_id % 3 = 0").select("song_id", F.concat(F.lit("NEW "), "genre").alias("genre"), "premium_only", F.lit(True).alias("live"),
                                               moved.alias("valid_from"), (moved + late).alias("changed_at"))
    gone = s.filter("song_id % 50 = 7").select("song_id", "genre", "premium_only", F.lit(False).alias("live"), at(P.STREAM_CUTS[2]).alias("valid_from"),
                                               at(P.STREAM_CUTS[2]).alias("changed_at"))
    return first.unionByName(other).unionByName(gone)


@register("stream_catalog_asof")
def stream_catalog_asof(spark, sf):
    """Requests and catalog changes as two streams, week by week as they were known, restarted for each: events by the genre
    that their song had when they happened. A heartbeat in both ends the wait."""
    ins, out, ck = [scratch_path(spark, f"catalog-{x}") for x in ("requests", "changes")], scratch_path(spark, "catalog-out"), scratch_path(spark, "catalog-ck")
    at = lambda d: F.lit(d).cast("timestamp_ntz")
    requests, changes = _requests(spark, sf).filter("ts is not null"), _catalog_changes(spark, sf)
    beat = spark.range(1).select(at(P.HEARTBEAT).alias("ts"))
    cuts = ["1970-01-01", *P.STREAM_CUTS, P.HEARTBEAT]
    for a, b in [*zip(cuts[:-1], cuts[1:]), (None, None)]:
        if a:
            requests.filter((F.col("ts") >= at(a)) & (F.col("ts") < at(b))).write.mode("append").parquet(ins[0])
            changes.filter((F.col("changed_at") >= at(a)) & (F.col("changed_at") < at(b))).write.mode("append").parquet(ins[1])
        else:
            beat.write.mode("append").parquet(ins[0])
            beat.withColumnRenamed("ts", "changed_at").write.mode("append").parquet(ins[1])
        cf.start_catalog_asof(spark.readStream.schema(requests.schema).parquet(ins[0]), spark.readStream.schema(changes.schema).parquet(ins[1]),
                              out, ck, watermark="1 day", salts=2, trigger={"availableNow": True}).awaitTermination()
    return cf.read_events(spark, out, requests.schema).groupBy("type", "genre", "known").agg(F.count(F.lit(1)).alias("events"))


def _windowed(spark, deliveries, watermark, dedupe_on=None):
    """The watermark variant: each delivery arrives when the ones before it are processed. Current windows."""
    src, out, ck = (scratch_path(spark, f"stateful-{x}") for x in ("in", "out", "ckpt"))
    schema = "key string, value string" + (f", {dedupe_on} bigint" if dedupe_on else "")
    for records in deliveries:
        records.write.mode("append").json(src)
        stream = spark.readStream.schema(schema).json(src)
        st.start_windowed_counts(ev.decode_messages(stream, P.SALT), out, ck, watermark=watermark, dedupe_on=dedupe_on,
                                 trigger={"availableNow": True}).awaitTermination()
    return st.latest_windows(spark, out)


def _between(messages, low, high):
    at = lambda d: F.lit(d).cast("timestamp_ntz")
    ts = F.col("ts")
    return messages.filter((ts >= at(low) if low else F.lit(True)) & (ts < at(high) if high else F.lit(True))).drop("ts")


@register("stream_windowed_counts")
def stream_windowed_counts(spark, sf):
    """Watermarked windowed counts, state kept by Spark, update mode. The log arrives week by week, so a
    watermark of a day loses nothing and closes the windows of the weeks before."""
    messages = _messages(spark, sf, keep=("ts",))
    cuts = [None, *P.STREAM_CUTS, None]
    return _windowed(spark, [_between(messages, a, b) for a, b in zip(cuts[:-1], cuts[1:])], "1 day")


@register("stream_late_dropped")
def stream_late_dropped(spark, sf):
    """The log's first weeks arrive after the last ones, days behind the watermark: they are dropped."""
    messages, cut = _messages(spark, sf, keep=("ts",)), P.STREAM_CUTS[1]
    return _windowed(spark, [_between(messages, cut, None), _between(messages, None, cut)], "1 day")


@register("stream_deduplicated")
def stream_deduplicated(spark, sf):
    """Every record is delivered again; its copy is within the watermark and is dropped by event id."""
    messages = _messages(spark, sf, keep=("event_id",))
    return _windowed(spark, [messages, messages], "40 days", dedupe_on="event_id")
