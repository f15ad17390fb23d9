"""Requests joined with a catalog change feed as of the events' times.

Both are streams with watermarks. A change ``(song_id, genre, premium_only, live, valid_from, changed_at)`` holds from
``valid_from`` on; the feed had it at ``changed_at``, its event time here, so a change told late is no late row. An event waits until the
watermark, the older of both streams', has passed it: every change told within the delay is then known, and the event
gets the version that was valid at its time. A feed that stands still holds events back; heartbeats, rows without a song, move it on.

State, in RocksDB: the versions that an event still to come may need (older ones than the last before the watermark
are removed), and the waiting events. A song may have a large part of all events, so events are dealt to ``salts`` places a
song and the few changes go to each of them. Places are hashed to ``buckets`` keys: a bucket's versions are one value of the state,
its waiting events a value for some thousands of them, so calls to the state store are counted by buckets and parts and not by songs. The number
of buckets stays with a checkpoint; a bucket's versions have to fit into a task.

Requests and changes without a time are never due and are left out, as is a change without a song.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import StructType

from streamcharts.operators.throttling import micros
from streamcharts.session import ensure_conf, scratch_path
from streamcharts.streaming.stateful import Alarm, WaitingRows, frames, packed, unpacked, use_rocksdb_state

# JSON keeps milliseconds unless told otherwise
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
_IN = ("at", "song_id", "unnamed", "payload", "live", "genre", "premium_only")
_OUT = {"song_id": "Int64", "payload": "object", "genre": "object", "premium_only": "boolean", "known": "bool"}
BUCKETS = 256


_WAITING = pa.schema([("at", pa.int64()), ("song_id", pa.int64()), ("payload", pa.string())])
_VERSIONS = pa.schema([("song_id", pa.int64()), ("at", pa.int64()), ("live", pa.bool_()), ("genre", pa.string()), ("premium_only", pa.bool_())])


class CatalogAsOf(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.versions = handle.getValueState("versions", "rows binary")
        self.waiting = WaitingRows(handle, "waiting", _WAITING)
        self.alarm = Alarm(handle)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N803 - the engine's names
        if key[0] < 0:  # heartbeats
            return
        changes: dict[tuple, tuple] = {}

        def requests():
            for frame in rows:
                for at, song, unnamed, payload, live, genre, premium in zip(*[frame[c].tolist() for c in _IN]):
                    if payload is not None:
                        yield at, None if unnamed else song, payload
                    else:
                        _add_version(changes, (song, at), (live, genre, premium))

        self.waiting.load()
        before = len(self.waiting.index)
        self.waiting.add(requests())
        events = self._advance(timerValues.getCurrentWatermarkInMs() * 1000, changes, len(self.waiting.index) > before)
        yield from frames(events, _OUT)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N803
        self.alarm.rang()
        self.waiting.load()
        yield from frames(self._advance(timerValues.getCurrentWatermarkInMs() * 1000, {}, False), _OUT)

    def _advance(self, watermark: int, changes: dict, added: bool) -> Iterator[tuple]:
        """Takes the changes up, emits the events before the watermark, forgets versions that none to come needs, sets the timer."""
        soonest = self.waiting.soonest()
        due = soonest is not None and soonest < watermark
        if changes or due:
            known = {(song, at): tuple(v) for song, at, *v in unpacked(self.versions.get()[0])} if self.versions.exists() else {}
            for place, version in changes.items():
                _add_version(known, place, version)
            songs: dict[int, list] = {}
            for song, at in sorted(known):
                songs.setdefault(song, []).append(at)
            if due:
                for at, song, payload in self.waiting.take(watermark):
                    times = songs.get(song, ())
                    i = bisect_right(times, at)
                    live, genre, premium = known[song, times[i - 1]] if i else (False, None, None)
                    yield song, payload, genre if live else None, premium if live else None, bool(live)
            kept = [(song, at, *known[song, at]) for song, times in songs.items() for at in times[max(0, bisect_right(times, watermark - 1) - 1):]]
            if changes or len(kept) < len(known):
                self.versions.update((packed(kept, _VERSIONS),))
        if due or added:
            self.waiting.store()
        self.alarm.set(self.waiting.soonest())

    def close(self) -> None:
        pass


def _add_version(versions: dict, place: tuple, version: tuple) -> None:
    """Of one time, one version, whatever the order in which they come."""
    old = versions.get(place)
    versions[place] = version if old is None else max(old, version, key=str)


def catalog_asof(requests: DataFrame, changes: DataFrame, watermark: str = "10 minutes", salts: int = 4,
                 buckets: int = BUCKETS) -> DataFrame:
    """A stream of ``(song_id, payload, genre, premium_only, known)``: each request (``payload``: its columns as JSON) once, with its
    song's version at ``ts``. ``known`` is false for songs that the catalog did not have then."""
    payload = F.to_json(F.struct(*[F.col(c) for c in requests.columns]), _JSON)
    # songs without a number wait like the others; their keys are told from heartbeats by the salt
    beat = F.lit(True)
    for c in requests.columns:
        if c != "ts":
            beat = beat & F.col(c).isNull()
    beat = beat | F.col("ts").isNull()

    def rows(frame, song, salt, at, *rest):
        """Numbers are never null here: pandas would turn them into doubles."""
        bucket = F.when(salt < 0, F.lit(-1)).otherwise(F.pmod(F.xxhash64(song, salt), F.lit(buckets)).cast("int"))
        return frame.select(bucket.alias("bucket"), "event_time", F.coalesce(micros(at), F.lit(0)).alias("at"),
                            F.coalesce(song, F.lit(0)).alias("song_id"), song.isNull().alias("unnamed"), *rest)

    song = F.col("song_id").cast("long")
    e = rows(requests.withColumn("event_time", F.col("ts").cast("timestamp")).withWatermark("event_time", watermark),
             song, F.when(beat, F.lit(-1)).otherwise(F.pmod(F.xxhash64(payload), F.lit(salts)).cast("int")), F.col("event_time"),
             F.when(~beat, payload).alias("payload"), F.lit(None).cast("boolean").alias("live"), F.lit(None).cast("string").alias("genre"),
             F.lit(None).cast("boolean").alias("premium_only"))
    copies = F.when(F.col("song_id").isNull() | F.col("valid_from").isNull(), F.array(F.lit(-1))).otherwise(F.array(*[F.lit(i) for i in range(salts)]))
    c = rows(changes.withColumn("event_time", F.col("changed_at").cast("timestamp")).withWatermark("event_time", watermark).withColumn("salt", F.explode(copies)),
             song, F.col("salt"), F.col("valid_from"), F.lit(None).cast("string").alias("payload"), "live", "genre", "premium_only")
    out = "song_id bigint, payload string, genre string, premium_only boolean, known boolean"
    return e.unionByName(c).groupBy("bucket").transformWithStateInPandas(CatalogAsOf(), out, outputMode="Append", timeMode="EventTime")


def start_catalog_asof(requests: DataFrame, changes: DataFrame, output: str, checkpoint: str | None = None, watermark: str = "10 minutes",
                       salts: int = 4, trigger: dict | None = None) -> StreamingQuery:
    """Write the joined events to ``output`` (parquet, each once)."""
    spark = requests.sparkSession
    ensure_conf(spark)
    use_rocksdb_state(spark)
    return catalog_asof(requests, changes, watermark, salts).writeStream.format("parquet").option("path", output).option(
        "checkpointLocation", checkpoint or scratch_path(spark, "catalog-checkpoint")).outputMode("append").trigger(
        **(trigger or {"processingTime": "5 seconds"})).start()


def read_events(spark: SparkSession, output: str, schema: StructType) -> DataFrame:
    """The requests' columns with ``genre``, ``premium_only`` and ``known``."""
    rows = spark.read.parquet(output)
    return rows.select(F.from_json("payload", schema, _JSON).alias("e"), "genre", "premium_only", "known").select("e.*", "genre", "premium_only", "known")
