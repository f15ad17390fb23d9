"""Windows that open at a client's first attempt: batch and stream against a plain walk in time order."""

import datetime as dt
import random

import pytest

from streamcharts.operators import throttling as th
from streamcharts.streaming import throttling as sth

T0 = dt.datetime(2024, 1, 1)


def walk(rows, window):
    """(client, window start, attempts) in order, one attempt after the other."""
    out = {}
    opened = {}
    for client, ts in sorted((c, t) for c, t in rows if c is not None and t is not None):
        if client not in opened or ts >= opened[client] + dt.timedelta(seconds=window):
            opened[client] = ts
        out[client, opened[client]] = out.get((client, opened[client]), 0) + 1
    return sorted((c, t, n, max(0, n - 20), n > 20) for (c, t), n in out.items())


def attempts(seed, clients=40, n=3000, seconds=4000, step=0.001):
    """Random attempts; client 0 has a third of them, without a pause as long as a window."""
    rng = random.Random(seed)
    rows = [(0 if rng.random() < 1 / 3 else rng.randrange(1, clients), T0 + dt.timedelta(seconds=round(rng.randrange(int(seconds / step)) * step, 6)))
            for _ in range(n)]
    rows += [(1, T0 + dt.timedelta(seconds=60 * k)) for k in range(5)]          # each at the end of the window before
    rows += [(2, T0 + dt.timedelta(microseconds=59_999_999 * k)) for k in range(30)]
    rows += [(3, T0)] * 50 + [(None, T0), (4, None)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "client bigint, ts timestamp_ntz")


def found(df):
    return sorted(tuple(r) for r in df.select("client", "window_start", "attempts", "refused", "throttled").collect())


@pytest.mark.parametrize("cells,seconds,step", [(1, 4000, 0.001), (16, 4000, 0.001), (2, 900, 1.0), (3, 100_000, 0.5)])
def test_batch_equals_the_walk(spark, cells, seconds, step):
    rows = attempts(cells, seconds=seconds, step=step)
    got = found(th.attempt_windows(frame(spark, rows).repartition(5), 60, cells=cells))
    assert got == walk(rows, 60)
    assert any(r[-1] for r in got)


def test_units_over_several_arrow_batches(spark):
    rows = attempts(9, n=2000)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
        assert found(th.attempt_windows(frame(spark, rows), 60, cells=4)) == walk(rows, 60)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_clients_may_be_addresses_and_tables_empty(spark):
    rows = [(f"10.0.0.{c}" if c is not None else None, t) for c, t in attempts(5, n=300)]
    got = found(th.attempt_windows(spark.createDataFrame(rows, "client string, ts timestamp_ntz"), 60))
    assert got == walk(rows, 60)
    assert th.attempt_windows(frame(spark, []), 60).collect() == []


def test_stream_with_restarts_equals_the_walk(spark, scratch):
    rows = [r for r in attempts(6, clients=12, n=1500, seconds=2000) if r[1] is not None]
    rows.sort(key=lambda r: r[1])
    rng = random.Random(7)
    cuts = [0, 500, 900, len(rows)]
    for a, b in zip(cuts[:-1], cuts[1:]):
        part = rows[a:b]
        rng.shuffle(part)  # any order within a delivery
        frame(spark, part).repartition(3).write.mode("append").parquet(f"{scratch}/in")
        stream = spark.readStream.schema("client bigint, ts timestamp_ntz").parquet(f"{scratch}/in")
        sth.start_throttling(stream, f"{scratch}/out", f"{scratch}/ck", 60, "10 minutes", {"availableNow": True}).awaitTermination()
    early = found(sth.read_windows(spark, f"{scratch}/out"))
    want = walk(rows, 60)
    assert 0 < len(early) < len(want) and set(early) <= set(want)  # nothing is emitted before it is final
    frame(spark, [(None, T0 + dt.timedelta(days=9))]).write.mode("append").parquet(f"{scratch}/in")
    stream = spark.readStream.schema("client bigint, ts timestamp_ntz").parquet(f"{scratch}/in")
    sth.start_throttling(stream, f"{scratch}/out", f"{scratch}/ck", 60, "10 minutes", {"availableNow": True}).awaitTermination()
    assert found(sth.read_windows(spark, f"{scratch}/out")) == want
    assert found(th.attempt_windows(frame(spark, rows), 60)) == want


def test_plan_combines_equal_attempts_before_the_shuffle(spark):
    df = th.attempt_windows(frame(spark, attempts(1, n=50)), 60)
    plan = df._jdf.queryExecution().toString()
    assert "partial_count(1)" in plan and "CartesianProduct" not in plan
