"""State of the event-time machines: kept by buckets and parts, so calls to the store do not grow with songs, clients or events one by one."""

import datetime as dt
import random

import pyarrow as pa

from streamcharts.streaming import catalog_feed as cf
from streamcharts.streaming import throttling as sth
from streamcharts.streaming.stateful import WaitingRows

T0 = dt.datetime(2024, 1, 1)
BIG = 1 << 60


def state_rows(query):
    return max(o["numRowsTotal"] for p in query.recentProgress for o in p["stateOperators"])


def test_a_catalog_is_a_few_values_of_state(spark, scratch):
    requests, changes = "song_id bigint, n bigint, ts timestamp_ntz", "song_id bigint, genre string, premium_only boolean, live boolean, valid_from timestamp_ntz, changed_at timestamp_ntz"
    spark.range(3000).selectExpr("id + 1 song_id", "id n", "timestamp_ntz'2024-01-01 01:00:00' ts").write.parquet(f"{scratch}/requests")
    spark.range(3000).selectExpr("id + 1 song_id", "'g' || id genre", "true premium_only", "true live", "timestamp_ntz'2023-01-01' valid_from",
                                 "timestamp_ntz'2024-01-01' changed_at").write.parquet(f"{scratch}/changes")
    spark.createDataFrame([(BIG + 1, "odd", True, True, None, T0)], changes).write.mode("append").parquet(f"{scratch}/changes")  # no time: left out
    q = cf.start_catalog_asof(spark.readStream.schema(requests).parquet(f"{scratch}/requests"), spark.readStream.schema(changes).parquet(f"{scratch}/changes"),
                              f"{scratch}/out", f"{scratch}/ck", salts=1, trigger={"availableNow": True})
    q.awaitTermination()
    assert 0 < state_rows(q) <= 256 * 5


def test_windows_of_many_clients_are_a_few_values_of_state(spark, scratch):
    rows = [(BIG + k, T0 + dt.timedelta(seconds=s)) for k in range(2000) for s in (0, 1, 100)] + [(None, T0)]
    spark.createDataFrame(rows, "client bigint, ts timestamp_ntz").write.parquet(f"{scratch}/in")

    def go():
        q = sth.start_throttling(spark.readStream.schema("client bigint, ts timestamp_ntz").parquet(f"{scratch}/in"), f"{scratch}/out", f"{scratch}/ck", 60,
                                 trigger={"availableNow": True})
        q.awaitTermination()
        return q

    assert 0 < state_rows(go()) <= 256 * 5
    spark.createDataFrame([(None, T0 + dt.timedelta(days=9))], "client bigint, ts timestamp_ntz").write.mode("append").parquet(f"{scratch}/in")
    go()
    got = sorted(tuple(r) for r in sth.read_windows(spark, f"{scratch}/out").select("client", "window_start", "attempts").collect())
    assert got == sorted((BIG + k, T0 + dt.timedelta(seconds=s), n) for k in range(2000) for s, n in ((0, 2), (100, 1)))


class _Map(dict):
    def updateValue(self, k, v):  # noqa: N802
        self[k] = v

    def getValue(self, k):  # noqa: N802
        return self[k]

    def removeKey(self, k):  # noqa: N802
        del self[k]


class _Value:
    value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, v):
        self.value = v

    def clear(self):
        self.value = None


class _Handle:
    def getMapState(self, *_):  # noqa: N802
        return _Map()

    def getValueState(self, *_):  # noqa: N802
        return _Value()


def test_waiting_rows_come_in_order_and_once(monkeypatch):
    monkeypatch.setattr(WaitingRows, "PART", 7)
    monkeypatch.setattr(WaitingRows, "SORTED", 30)
    rng, rows = random.Random(5), WaitingRows(_Handle(), "w", pa.schema([("at", pa.int64()), ("n", pa.int64())]))
    rest, n = [], 0
    for watermark in (0, 50, 50, 51, 300, 900, 2000):
        rows.load()
        new = [(rng.randrange(watermark, watermark + 500), n + k) for k in range(rng.randrange(100))]
        n += len(new)
        rows.add(iter(new))
        rest += new
        taken = list(rows.take(watermark))
        assert [at for at, _ in taken] == sorted(at for at, _ in taken)
        assert sorted(taken) == sorted(r for r in rest if r[0] < watermark)
        rest = [r for r in rest if r[0] >= watermark]
        assert rows.soonest() == min((at for at, _ in rest), default=None)
        rows.store()
    rows.load()
    assert sorted(rows.take(10_000)) == sorted(rest)
    rows.store()
    assert not rows.parts and not rows.stored.exists()
