"""Domain tables read from parquet.

The driver's test tables are mapped onto the music data model:

* songs          <- part        (id, title, genre = p_type, artist = id % 10)
* artists        <- supplier    (genre = first genre among the artist's songs)
* users          <- customer    (role from the id, email from the name)
* playlists      <- orders      (owner, name = priority, created_at)
* playlist_songs <- lineitem    (position = line number), one row per (playlist, song)
* events         <- events      (view/click/error -> play/like/skip, song = props.k)
* request log    <- events      (duration = value / 1000, error -> 500)

Every reader selects only the columns it maps, so the parquet scans prune.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streamcharts.session import ensure_conf

# --- fixed values: mapping of the generic event types onto the domain ----
EVENT_TYPE_MAP = {"view": "play", "click": "like", "error": "skip"}
ARTIST_MODULUS = 10       # song's artist id = song id % 10
PREMIUM_MODULUS = 4       # song is premium-only when id % 4 = 0
EMAIL_DOMAIN = "@x.io"
SERVICE_MODULUS = 5       # request log: service = 'svc-' || user_id % 5


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_conf(spark)
    return spark.read.parquet(table_path(sf_dir, name))


def songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part")
    return p.select(
        p.p_partkey.cast("long").alias("id"),
        p.p_name.alias("title"),
        (p.p_partkey % ARTIST_MODULUS).cast("long").alias("artist_id"),
        p.p_type.alias("genre"),
        (F.lit(120) + p.p_size).cast("int").alias("duration_sec"),
        F.concat(F.lit("track-"), p.p_partkey.cast("string"), F.lit(".wav")).alias("audio_key"),
        F.concat(F.lit("covers/"), p.p_partkey.cast("string"), F.lit(".jpg")).alias("cover_url"),
        ((p.p_partkey % PREMIUM_MODULUS) == 0).alias("premium_only"),
    )


def artists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Artists with a genre: the alphabetically first genre among their songs.

    The per-artist min is a partial (map-side) aggregate, so an artist that
    owns a third of the catalog costs one row per map task, not a hot reducer.
    """
    s = read(spark, sf_dir, "supplier")
    first_genre = (
        songs(spark, sf_dir).groupBy("artist_id").agg(F.min("genre").alias("genre"))
    )
    return s.select(s.s_suppkey.cast("long").alias("id"), s.s_name.alias("name")).join(
        first_genre.withColumnRenamed("artist_id", "id"), "id", "left"
    )


def user_role(custkey: Column) -> Column:
    m = custkey % 10
    return (
        F.when(m == 0, F.lit("admin"))
        .when(m.between(1, 3), F.lit("premium"))
        .otherwise(F.lit("free"))
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer")
    return c.select(
        c.c_custkey.cast("long").alias("id"),
        F.concat(F.lower(c.c_name), F.lit(EMAIL_DOMAIN)).alias("email"),
        user_role(c.c_custkey).alias("role"),
    )


def playlists(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    return o.select(
        o.o_orderkey.cast("long").alias("id"),
        o.o_custkey.cast("long").alias("user_id"),
        o.o_orderpriority.alias("name"),
        o.o_orderdate.cast("timestamp_ntz").alias("created_at"),
    )


def playlist_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracks per playlist as stored, a pair perhaps more than once."""
    li = read(spark, sf_dir, "lineitem")
    return li.select(
        li.l_orderkey.cast("long").alias("playlist_id"),
        li.l_partkey.cast("long").alias("song_id"),
        li.l_linenumber.cast("int").alias("position"),
    )


def playlist_songs(spark: SparkSession, sf_dir: str, of: DataFrame | None = None) -> DataFrame:
    """Tracks per playlist with the (playlist_id, song_id) key enforced.

    The source may repeat a pair; the first position wins. The dedupe is a
    hash aggregate with map-side combine on the composite key, so a very
    large playlist still spreads over many reducers. ``of``: a frame of the ``playlist_id`` wanted; the others'
    rows are left out first, and one shuffle by playlist serves that and the dedupe.
    """
    rows = playlist_rows(spark, sf_dir)
    if of is not None:
        rows = rows.join(of, "playlist_id", "left_semi")
    return rows.groupBy("playlist_id", "song_id").agg(F.min("position").alias("position"))


def song_id_from_props(props: Column) -> Column:
    return F.get_json_object(props, "$.k").try_cast("long")


def domain_type(event_type: Column) -> Column:
    """view/click/error -> play/like/skip; other types pass through (and are rejected later)."""
    expr = F.when(F.lit(False), F.lit(None).cast("string"))
    for src, dst in EVENT_TYPE_MAP.items():
        expr = expr.when(event_type == src, F.lit(dst))
    return expr.otherwise(event_type)


def events(spark: SparkSession, sf_dir: str, types: tuple[str, ...] | None = None) -> DataFrame:
    """Interaction events: type, user, song, event time (UTC, no zone).

    ``types`` keeps only those domain types, as a predicate on the stored
    column so that it reaches the parquet scan (the mapped CASE would not).
    """
    e = read(spark, sf_dir, "events")
    if types is not None:
        back = {v: k for k, v in EVENT_TYPE_MAP.items()}
        raw = [back.get(t, t) for t in types]
        e = e.filter(e.event_type.isin(*raw))
    return e.select(
        e.event_id,
        domain_type(e.event_type).alias("type"),
        e.user_id.cast("long").alias("user_id"),
        song_id_from_props(e.props).alias("song_id"),
        e.ts.cast("timestamp_ntz").alias("ts"),
    )


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request samples: one row per request with service, route, status, seconds."""
    e = read(spark, sf_dir, "events")
    return e.select(
        e.event_id,
        e.ts.cast("timestamp_ntz").alias("ts"),
        F.concat(F.lit("svc-"), (e.user_id % SERVICE_MODULUS).cast("string")).alias("service"),
        F.lit("GET").alias("method"),
        e.event_type.alias("route"),
        F.when(e.event_type == "error", F.lit(500)).otherwise(F.lit(200)).alias("status"),
        (e.value / 1000.0).alias("duration_seconds"),
        e.user_id.cast("long").alias("client"),
    )


def metric_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored counter samples (S11) ``(service, ts, value)``: what a scraper wrote at uneven times."""
    e = read(spark, sf_dir, "events")
    return e.select(
        F.concat(F.lit("svc-"), (e.user_id % SERVICE_MODULUS).cast("string")).alias("service"),
        e.ts.cast("timestamp_ntz").alias("ts"),
        e.value.cast("double").alias("value"),
    )


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str | None = None,
              lower_bound: int | None = None, upper_bound: int | None = None, num_partitions: int = 1,
              properties: dict | None = None, fetch_size: int = 10_000) -> DataFrame:
    """A catalog table straight from the operational database (S2 alternative to parquet).

    With ``partition_column`` and bounds, Spark issues ``num_partitions`` range
    queries in parallel instead of one full-table cursor. Not exercised in the
    tests here (no database is run); the parquet readers above are.
    """
    ensure_conf(spark)
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).option("fetchsize", fetch_size)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", lower_bound)
            .option("upperBound", upper_bound)
            .option("numPartitions", num_partitions)
        )
    return reader.load()
