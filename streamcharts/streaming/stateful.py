"""Watermarked stateful variant of the rollups.

Spark keeps the per-window state itself (partitioned into
``spark.sql.shuffle.partitions`` state partitions, fixed when a checkpoint is
first used -- size it for the target scale before the first start) and drops
events later than the watermark (the reference accepted them forever; the delta-log job in
``processor`` still does). Distinct listeners use the mergeable HLL sketch,
since exact distinct is not supported on streams.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable, Iterator
from itertools import islice
from operator import itemgetter

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessorHandle

from streamcharts.operators.events import good_plays
from streamcharts.operators.rollups import HLL_LG_K

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb_state(spark) -> None:
    """Keep window state in RocksDB on local disk instead of the executor heap.

    Must be set before the query's first start (a checkpoint keeps its provider).
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)


def packed(rows: list[tuple], schema: pa.Schema) -> bytes:
    """Rows as one state value: a call to the state store costs about the same for a thousand rows as for one."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [()] * len(schema), schema)], schema=schema))
    return sink.getvalue().to_pybytes()


def unpacked(data: bytes) -> Iterator[tuple]:
    return zip(*[c.to_pylist() for c in pa.ipc.open_stream(pa.py_buffer(bytes(data))).read_all().columns])


def frames(rows: Iterable[tuple], types: dict[str, str], size: int = 10_000) -> Iterator[pd.DataFrame]:
    """Rows as frames of ``size``, columns by name and pandas type."""
    rows = iter(rows)
    while block := list(islice(rows, size)):
        yield pd.DataFrame({name: pd.array(list(c), dtype=kind) for (name, kind), c in zip(types.items(), zip(*block))})


class WaitingRows:
    """State of one key: rows ``(at, ...)`` that wait for the watermark, in parts of ``PART`` rows that follow each other in time.

    An index names the parts and their times, so only the parts that the watermark has reached are read, and no more than
    ``SORTED`` new rows or the parts of overlapping times are held at once.
    """

    PART, SORTED = 4096, 65_536
    _INDEX = pa.schema([("part", pa.int64()), ("first", pa.int64())])

    def __init__(self, handle: StatefulProcessorHandle, name: str, schema: pa.Schema):
        self.schema = schema
        self.parts = handle.getMapState(name, "part bigint", "rows binary")
        self.stored = handle.getValueState(f"{name}Index", "rows binary")

    def load(self) -> None:
        """Before the other calls, for each key."""
        self.index = list(unpacked(self.stored.get()[0])) if self.stored.exists() else []

    def add(self, rows: Iterable[tuple]) -> None:
        block = []
        for r in rows:
            block.append(r)
            if len(block) == self.SORTED:
                self._add(block)
                block = []
        self._add(block)

    def _add(self, block: list[tuple]) -> None:
        block.sort(key=itemgetter(0))
        for i in range(0, len(block), self.PART):
            rows, part = block[i:i + self.PART], max((p for p, _ in self.index), default=-1) + 1
            self.parts.updateValue((part,), (packed(rows, self.schema),))
            self.index.append((part, rows[0][0]))

    def soonest(self) -> int | None:
        return min((first for _, first in self.index), default=None)

    def take(self, watermark: int) -> Iterator[tuple]:
        """The rows before the watermark in the order of their times; they are no longer kept."""
        due = sorted((x for x in self.index if x[1] < watermark), key=itemgetter(1))
        if not due:
            return
        rows = []
        for (part, _), (_, upto) in zip(due, [*due[1:], (None, watermark)]):
            rows += unpacked(self.parts.getValue((part,))[0])
            rows.sort(key=itemgetter(0))
            cut = bisect_left(rows, upto, key=itemgetter(0))
            yield from rows[:cut]
            rows = rows[cut:]
        for part, _ in due:
            self.parts.removeKey((part,))
        self.index = [x for x in self.index if x[1] >= watermark]
        self.add(rows)

    def store(self) -> None:
        """After the other calls, if they changed anything."""
        if self.index:
            self.stored.update((packed(self.index, self._INDEX),))
        else:
            self.stored.clear()


class Alarm:
    """State of one key: its one event-time timer, set for a time in microseconds."""

    def __init__(self, handle: StatefulProcessorHandle):
        self.handle = handle
        self.state = handle.getValueState("timer", "at bigint")

    def at(self) -> int | None:
        return self.state.get()[0] if self.state.exists() else None

    def set(self, at: int | None) -> None:
        old = self.at()
        if old == at:
            return
        if old is not None:
            self.handle.deleteTimer(old // 1000 + 1)
        if at is None:
            self.state.clear()
        else:
            self.handle.registerTimer(at // 1000 + 1)
            self.state.update((at,))

    def rang(self) -> None:
        self.state.clear()


def _event_time(decoded: DataFrame, watermark: str, dedupe_on: str | None) -> DataFrame:
    """Plays with an event-time column and watermark; optional dedupe by an event id.

    Streaming deduplication shuffles every copy of an id to one task before the
    state store (there is no map-side combine for it). The default delta-log job
    needs no per-id state: a re-delivered batch overwrites its own epoch.
    """
    plays = good_plays(decoded).withColumn("event_time", F.col("ts").cast("timestamp"))
    plays = plays.withWatermark("event_time", watermark)
    if dedupe_on:
        plays = plays.dropDuplicatesWithinWatermark([dedupe_on])
    return plays


def windowed_minute_counts(decoded: DataFrame, watermark: str = "10 minutes",
                           dedupe_on: str | None = None) -> DataFrame:
    """Per (1-minute window, song, genre): plays and a listener sketch; append-mode safe."""
    plays = _event_time(decoded, watermark, dedupe_on)
    return plays.groupBy(F.window("event_time", "1 minute").alias("w"), "song_id", "genre").agg(
        F.count(F.lit(1)).alias("plays"),
        F.hll_sketch_agg("user_hash", HLL_LG_K).alias("uniq_sketch"),
    ).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
        "song_id", "genre", "plays", "uniq_sketch",
    )


def sliding_trending_counts(decoded: DataFrame, length: str = "10 minutes", slide: str = "1 minute",
                            watermark: str = "10 minutes") -> DataFrame:
    """R3 on a stream: plays per song for each sliding window (``window(ts, length, slide)``)."""
    plays = _event_time(decoded, watermark, None)
    return plays.groupBy(F.window("event_time", length, slide).alias("w"), "song_id").agg(
        F.count(F.lit(1)).alias("plays")
    ).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "song_id", "plays")


def start_windowed_counts(decoded: DataFrame, output_root: str, checkpoint: str, watermark: str = "10 minutes",
                          trigger: dict | None = None, dedupe_on: str | None = None):
    """Run ``windowed_minute_counts`` in update mode; each micro-batch writes the windows it
    changed under ``run=<id>/epoch=<batch>`` (dynamic overwrite, so a replay rewrites its own
    files). Nothing goes through the driver; ``latest_windows`` reads the current values."""
    from streamcharts.streaming.processor import run_id_for

    run_id = run_id_for(decoded.sparkSession, checkpoint, output_root)

    def sink(batch: DataFrame, epoch_id: int) -> None:
        (
            batch.drop("uniq_sketch")
            .withColumn("run", F.lit(run_id))
            .withColumn("epoch", F.lit(int(epoch_id)).cast("long"))
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("run", "epoch").parquet(output_root)
        )

    counts = windowed_minute_counts(decoded, watermark, dedupe_on)
    return (
        counts.writeStream.outputMode("update").foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .start()
    )


def latest_windows(spark, output_root: str) -> DataFrame:
    """Current count of every emitted window.

    Within a run the latest batch that updated a window holds its count; a new
    run (fresh checkpoint, fresh state) counts only what it read, so runs add up.
    """
    rows = spark.read.parquet(output_root)
    per_run = rows.groupBy("run", "window_start", "song_id", "genre").agg(
        F.max_by("plays", "epoch").alias("plays")
    )
    return per_run.groupBy("window_start", "song_id", "genre").agg(F.sum("plays").cast("long").alias("plays")).select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"), "song_id", "genre", "plays"
    )
