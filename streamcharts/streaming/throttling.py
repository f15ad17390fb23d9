"""First-attempt rate-limit windows on a stream (A22): a state machine for a bucket of clients with event-time timers.

State, in RocksDB: each client's open window (its start and attempts so far) and the attempts that the watermark has not reached. Clients are hashed
to ``buckets`` keys, whose open windows are one value of the state and whose attempts a value for some thousands, so calls to the state
store are counted by buckets and parts and not by clients or attempts. The number of buckets stays with a checkpoint.
Attempts are taken in the order of their times once the watermark has passed them, so the order in which they arrive
within the watermark's delay does not matter. A timer wakes the bucket for its next waiting attempt or the end of its earliest open
window, whichever comes first; a window is emitted once, when the watermark has passed its end. Results equal
``operators.throttling.attempt_windows`` over the same attempts.

Attempts behind the watermark are dropped, as in every watermarked query here. The end of a quiet stream's last windows
comes with the watermark: a heartbeat, a record without client, moves it on.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import IntegralType, LongType, StructField, StructType

from streamcharts.constants import RATE_LIMIT_MAX_ATTEMPTS, RATE_LIMIT_WINDOW_SECONDS
from streamcharts.operators.throttling import micros, verdicts
from streamcharts.session import ensure_conf, scratch_path
from streamcharts.streaming.stateful import Alarm, WaitingRows, frames, packed, unpacked, use_rocksdb_state


BUCKETS = 256
_OUT = {"client": None, "begun": "int64", "attempts": "int64"}


class FirstAttemptWindows(StatefulProcessor):
    def __init__(self, window_seconds: int, client: pa.DataType):
        self.window = int(window_seconds) * 1_000_000
        self.attempt = pa.schema([("at", pa.int64()), ("client", client), ("n", pa.int64())])
        self.opened = pa.schema([("client", client), ("start", pa.int64()), ("attempts", pa.int64())])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.open = handle.getValueState("open", "rows binary")
        self.waiting = WaitingRows(handle, "waiting", self.attempt)
        self.alarm = Alarm(handle)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N803 - the engine's names
        if key[0] < 0:  # heartbeats
            return
        self.waiting.load()
        self.waiting.add(r for frame in rows for r in zip(*[frame[c].tolist() for c in ("at", "client", "n")]))
        due, watermark = self.alarm.at(), timerValues.getCurrentWatermarkInMs() * 1000
        due = min(x for x in (due, self.waiting.soonest()) if x is not None)
        if due <= watermark:
            yield from frames(self._advance(watermark), _OUT)
        else:
            self.waiting.store()
            self.alarm.set(due)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.alarm.rang()
        self.waiting.load()
        yield from frames(self._advance(timerValues.getCurrentWatermarkInMs() * 1000), _OUT)

    def _advance(self, watermark: int) -> Iterator[tuple]:
        """Takes the waiting attempts before the watermark in order, emits the windows that end by it, sets the timer."""
        opened = {client: (start, n) for client, start, n in unpacked(self.open.get()[0])} if self.open.exists() else {}
        for at, client, n in self.waiting.take(watermark):
            start, attempts = opened.get(client, (None, 0))
            if start is not None and at >= start + self.window:
                yield client, start, attempts
                start, attempts = None, 0
            opened[client] = (at if start is None else start, attempts + n)
        self.waiting.store()
        rest = []
        for client, (start, attempts) in opened.items():
            if start + self.window <= watermark:
                yield client, start, attempts
            else:
                rest.append((client, start, attempts))
        if rest:
            self.open.update((packed(rest, self.opened),))
        else:
            self.open.clear()
        ends = min((start + self.window for _, start, _ in rest), default=None)
        self.alarm.set(min((x for x in (ends, self.waiting.soonest()) if x is not None), default=None))

    def close(self) -> None:
        pass


def _combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal attempts of a task's batch as one row, before they are shuffled to their client."""
    for b in batches:
        t = pa.Table.from_batches([b]).group_by(["client", "ts"]).aggregate([([], "count_all")])
        yield from t.rename_columns(["client", "ts", "n"]).to_batches()


def attempt_windows(attempts: DataFrame, window_seconds: int = RATE_LIMIT_WINDOW_SECONDS, watermark: str = "10 minutes",
                    buckets: int = BUCKETS) -> DataFrame:
    """Closed windows ``(client, begun, attempts)`` of a stream of ``(client, ts)``; append mode."""
    kind = attempts.schema["client"].dataType
    rows = attempts.select("client", F.col("ts").cast("timestamp").alias("ts")).filter(F.col("ts").isNotNull())
    counted = rows.mapInArrow(_combined, StructType([*rows.schema.fields, StructField("n", LongType())])).withWatermark(
        "ts", watermark).withColumn("at", micros(F.col("ts")))
    out = StructType([StructField("client", kind), StructField("begun", LongType()), StructField("attempts", LongType())])
    counted = counted.withColumn("bucket", F.when(F.col("client").isNull(), F.lit(-1)).otherwise(F.pmod(F.xxhash64("client"), F.lit(buckets)).cast("int")))
    if isinstance(kind, IntegralType):  # pandas would turn numbers beside a heartbeat's null into doubles
        counted = counted.withColumn("client", F.coalesce("client", F.lit(0).cast(kind)))
    return counted.groupBy("bucket").transformWithStateInPandas(
        FirstAttemptWindows(window_seconds, to_arrow_type(kind)), out, outputMode="Append", timeMode="EventTime")


def start_throttling(attempts: DataFrame, output: str, checkpoint: str | None = None, window_seconds: int = RATE_LIMIT_WINDOW_SECONDS,
                     watermark: str = "10 minutes", trigger: dict | None = None) -> StreamingQuery:
    """Write closed windows to ``output`` (parquet, each once)."""
    spark = attempts.sparkSession
    ensure_conf(spark)
    use_rocksdb_state(spark)
    return attempt_windows(attempts, window_seconds, watermark).writeStream.format("parquet").option("path", output).option(
        "checkpointLocation", checkpoint or scratch_path(spark, "throttling-checkpoint")).outputMode("append").trigger(
        **(trigger or {"processingTime": "5 seconds"})).start()


def read_windows(spark, output: str, max_attempts: int = RATE_LIMIT_MAX_ATTEMPTS) -> DataFrame:
    """client, window_start, attempts, refused, throttled of the closed windows."""
    rows = spark.read.parquet(output)
    return verdicts(rows.select("client", F.timestamp_micros("begun").cast("timestamp_ntz").alias("window_start"), "attempts"), max_attempts)
