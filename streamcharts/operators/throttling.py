"""Rate-limit windows that open at a client's first attempt.

A client's window opens with an attempt and lasts a fixed time; the first attempt after it opens the next one. Which
attempt that is depends on all earlier ones, so a client is a chain. To follow the chain of a client with a large
part of all attempts in more than one task, time is cut into units of ``cells`` windows:

1. each (client, unit) is worked out alone, for every attempt that the chain may enter it by (those of its first
   window's length, and the next): the last window that opens in the unit. Entries with the same last window are one row;
2. a client's units are walked in order over those rows, which tells when the window that reaches into each unit ends;
3. each unit, told that, cuts its attempts into windows; a window over a unit's edge is summed from its parts.

Attempts at the same microsecond are counted before anything is shuffled. A task holds the attempts of a few
units, or of one large one, in arrays; the walk holds one number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from streamcharts.constants import RATE_LIMIT_MAX_ATTEMPTS, RATE_LIMIT_WINDOW_SECONDS

CELLS = 16  # windows to a unit of time


def verdicts(windows: DataFrame, max_attempts: int = RATE_LIMIT_MAX_ATTEMPTS) -> DataFrame:
    """Windows ``(client, window_start, attempts)`` with how many attempts were refused, and whether any was."""
    return windows.withColumn("refused", F.greatest(F.col("attempts") - max_attempts, F.lit(0).cast("long"))).withColumn(
        "throttled", F.col("attempts") > max_attempts)


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


class Units:
    """Whole (client, unit) groups of attempts in arrays; ``first``: where each begins."""

    def __init__(self, t: pa.Table, window: int, cells: int):
        self.client, self.at = t.column("client").combine_chunks(), np.asarray(t.column("at"))
        self.unit, self.n, self.reset = np.asarray(t.column("unit")), np.asarray(t.column("n")), np.asarray(t.column("reset"))
        code = np.asarray(self.client.dictionary_encode().indices)
        self.first = np.flatnonzero((np.diff(code, prepend=-1) != 0) | (np.diff(self.unit, prepend=0) != 0)) if len(code) else np.zeros(0, np.int64)
        self.first = np.unique(np.append(0, self.first)) if len(code) else self.first
        self.no = np.repeat(np.arange(len(self.first)), np.diff(self.first, append=len(code)))
        self.into = self.at - self.unit * window * cells             # time since the unit's beginning
        self.key = self.no * (2 * window * cells) + self.into         # rises; units lie further apart than a window
        self.next = np.searchsorted(self.key, self.key + window)      # the attempt that opens the window after one's own
        self.next[self.next == len(code)] = 0
        self.next = np.where((self.next > 0) & (self.no[self.next] == self.no), self.next, -1)

    def last_opened(self, entry: np.ndarray) -> np.ndarray:
        """The last attempt of the unit that opens a window, if ``entry`` opens one."""
        while len(entry) and (self.next[entry] >= 0).any():
            entry = np.where(self.next[entry] >= 0, self.next[entry], entry)
        return entry

    def opening(self, entry: np.ndarray) -> np.ndarray:
        """Whether each attempt opens a window, if the chain enters the units at ``entry``."""
        opens = np.zeros(len(self.at), bool)
        while len(entry):
            opens[entry] = True
            entry = self.next[entry]
            entry = entry[entry >= 0]
        return opens


def _whole_units(batches: Iterator[pa.RecordBatch], window: int, cells: int) -> Iterator[Units]:
    """Rows sorted by client, unit and time, as arrays that end where a unit does."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        client, unit = batch.column("client"), batch.column("unit")
        last = pc.and_(pc.equal(client, client[batch.num_rows - 1]), pc.equal(unit, unit[batch.num_rows - 1]))
        begins = batch.num_rows - pc.sum(last).as_py()   # of the batch's last unit, which may go on
        if begins:
            yield Units(pa.Table.from_batches([*held, batch.slice(0, begins)]), window, cells)
            held = []
        elif held and (held[-1].column("client")[-1] != client[0] or held[-1].column("unit")[-1] != unit[0]):
            yield Units(pa.Table.from_batches(held), window, cells)
            held = []
        held.append(batch.slice(begins))
    if held:
        yield Units(pa.Table.from_batches(held), window, cells)


def attempt_windows(log: DataFrame, window_seconds: int = RATE_LIMIT_WINDOW_SECONDS, max_attempts: int = RATE_LIMIT_MAX_ATTEMPTS,
                    cells: int = CELLS) -> DataFrame:
    """client, window_start, attempts, refused, throttled of every window of every client of ``log(client, ts)``.

    An attempt at a window's end opens the next one. Rows without client or time are no attempts.
    """
    window = int(window_seconds) * 1_000_000
    kind = log.schema["client"].dataType
    attempts = log.select("client", micros(F.col("ts")).alias("at")).filter("client is not null and at is not null").groupBy(
        "client", "at").agg(F.count(F.lit(1)).alias("n")).withColumn("unit", F.floor(F.col("at") / (window * cells))).withColumn(
        "reset", F.lit(0).cast("long"))

    def by_unit(df: DataFrame) -> DataFrame:
        return df.select("client", "unit", "at", "n", "reset").repartition("client", "unit").sortWithinPartitions("client", "unit", "at")

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for u in _whole_units(batches, window, cells):
            late = u.into >= window
            entry = np.flatnonzero(~late | (late & ~np.append(False, late[:-1] & (u.no[1:] == u.no[:-1]))))
            left = u.at[u.last_opened(entry)]
            kept = np.append((left[1:] != left[:-1]) | (u.no[entry][1:] != u.no[entry][:-1]), True)
            at = entry[kept]
            yield pa.RecordBatch.from_arrays([u.client.take(pa.array(at)), pa.array(u.unit[at]), pa.array(u.at[at]), pa.array(left[kept])],
                                             ["client", "unit", "entry", "last"])

    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client, unit, ends, entered = None, None, None, False  # ends: of the window that reaches into the unit
        for b in batches:
            out = []
            for i, (c, k, entry, last) in enumerate(zip(*[b.column(j).to_pylist() for j in range(4)], strict=True)):
                if c != client:
                    client, unit, ends = c, None, None
                if k != unit:
                    unit, entered = k, False
                    if ends is not None and ends > k * window * cells:
                        out.append((i, ends))
                if not entered and (ends is None or entry >= ends):
                    ends, entered = last + window, True
            at = [i for i, _ in out]
            reset = pa.array([e for _, e in out], pa.int64())
            unit_ = b.column(1).take(pa.array(at, pa.int64()))
            before = pc.subtract(pc.multiply(unit_, window * cells), 1)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), unit_, before, pa.array([0] * len(at), pa.int64()), reset],
                                             ["client", "unit", "at", "n", "reset"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for u in _whole_units(batches, window, cells):
            told = u.n[u.first] == 0                       # the row that tells of the reset comes first
            ends = np.where(told, u.reset[u.first], np.iinfo(np.int64).min)[u.no]
            real = u.n > 0
            free = np.flatnonzero(real & (u.at >= ends))
            entry = free[np.diff(u.no[free], prepend=-1) != 0]
            opens = u.opening(entry)
            # the window of an attempt: the last opened before it in the unit, else the one that reaches in
            start = np.maximum.accumulate(np.where(opens, np.arange(len(u.at)), -1)) if len(u.at) else np.zeros(0, np.int64)
            own = (start >= 0) & (u.no[np.maximum(start, 0)] == u.no)
            begun = np.where(own, u.at[np.maximum(start, 0)], ends - window)
            at = np.flatnonzero(real)
            if not len(at):
                continue
            runs = np.flatnonzero((np.diff(begun[at], prepend=begun[at[0]] - 1) != 0) | (np.diff(u.no[at], prepend=-1) != 0))
            yield pa.RecordBatch.from_arrays([u.client.take(pa.array(at[runs])), pa.array(begun[at[runs]]), pa.array(np.add.reduceat(u.n[at], runs))],
                                             ["client", "begun", "attempts"])

    def schema(*names: str) -> StructType:
        return StructType([StructField("client", kind), *[StructField(n, LongType()) for n in names]])

    summaries = by_unit(attempts).mapInArrow(entries, schema("unit", "entry", "last"))
    resets = summaries.repartition("client").sortWithinPartitions("client", "unit", "entry").mapInArrow(walked, schema("unit", "at", "n", "reset"))
    parts = by_unit(attempts.unionByName(resets)).mapInArrow(cut, schema("begun", "attempts"))
    windows = parts.groupBy("client", "begun").agg(F.sum("attempts").alias("attempts"))
    return verdicts(windows.select("client", F.timestamp_micros("begun").cast("timestamp_ntz").alias("window_start"), "attempts"), max_attempts)
