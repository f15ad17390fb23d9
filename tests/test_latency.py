"""Quantiles from merged minute counts: within the stated error of the exact ones, whatever way the log came in."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from streamcharts.operators import latency as lt

LOG = "service string, ts timestamp_ntz, status int, duration_seconds double"
T0 = dt.datetime(2024, 1, 1)


def log(seed, n=4000):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        s = "hot" if rng.random() < 0.5 else rng.choice(["a", "b"])
        d = rng.choice([rng.expovariate(10), 10 ** rng.uniform(-6, 3), 0.0, 0.25, -rng.random()])
        rows.append((s, T0 + dt.timedelta(seconds=rng.randrange(3 * 86400)), rng.choice([200, 200, 200, 404, 500]), d if rng.random() > 0.01 else None))
    return rows + [("silent", T0, 200, None), ("a", None, 200, 1.0)]


def exact(values, p):
    values = sorted(values)
    return values[math.floor(p * (len(values) - 1))]


def close(got_ms, want_s, error):
    return abs(got_ms / 1000 - want_s) <= error * abs(want_s) + 1e-9


@pytest.mark.parametrize("error", [0.01, 0.05])
def test_quantiles_are_within_the_stated_error(spark, error):
    rows = log(1)
    got = lt.quantiles(lt.minute_state(spark.createDataFrame(rows, LOG), error), ["service"], error=error).collect()
    assert {r.service for r in got} == {"hot", "a", "b", "silent"}
    for r in got:
        mine = [x for x in rows if x[0] == r.service and x[1] is not None]
        timed = [x[3] for x in mine if x[3] is not None]
        assert r.requests == len(mine) and r.error_rate == pytest.approx(sum(x[2] >= 400 for x in mine) / len(mine), abs=1e-6)
        for p in lt.PCTS:
            v = r[f"p{int(p * 100)}_ms"]
            assert close(v, exact(timed, p), error) if timed else v is None


def test_a_bucket_holds_what_is_near_its_middle(spark):
    rng = random.Random(2)
    values = [(s * 10 ** rng.uniform(-11, 11),) for _ in range(2000) for s in (1, -1)] + [(0.0,), (1e-13,)]
    rows = spark.createDataFrame(values, "v double").select("v", lt.bucket(F.col("v")).alias("b")).withColumn("m", lt.bucket_value(F.col("b"))).collect()
    assert all(abs(r.m - r.v) <= 0.0100001 * abs(r.v) + 1e-12 for r in rows)
    ordered = sorted(rows, key=lambda r: r.v)
    assert [r.b for r in ordered] == sorted(r.b for r in rows)


def test_epochs_replays_and_late_rows_merge(spark, scratch):
    rows = log(3)
    df = spark.createDataFrame(rows, LOG).withColumn("k", F.pmod(F.xxhash64("ts", "duration_seconds"), F.lit(3)))
    sink = lt.LatencySink(scratch, "r1")
    for k in (0, 1, 2, 1, 0):
        sink(df.filter(F.col("k") == k), k)
    whole = lt.quantiles(lt.minute_state(df), ["service"])
    assert sorted(lt.quantiles(lt.state(spark, scratch), ["service"]).collect()) == sorted(whole.collect())
    lt.LatencySink(scratch, "r2")(df.filter("k = 0"), 0)  # another run's epoch adds to it
    assert lt.state(spark, scratch).agg(F.sum("requests")).first()[0] > df.filter("ts is not null").count()


def test_a_part_of_the_time_reads_its_days_only(spark, scratch):
    df = spark.createDataFrame(log(4), LOG)
    lt.LatencySink(scratch, "r1")(df, 0)
    since, until = "2024-01-02 06:00:00", "2024-01-02 18:30:00"
    part = lt.state(spark, scratch, since, until)
    want = lt.quantiles(lt.minute_state(df.filter(f"ts >= timestamp_ntz'{since}' and ts < timestamp_ntz'{until}'")), ["service"])
    assert sorted(lt.quantiles(part, ["service"]).collect()) == sorted(want.collect())
    assert all("day=2024-01-02" in f for f in part.inputFiles()) or "PartitionFilters" in part._jdf.queryExecution().toString()


def test_runs_compared(spark):
    rows = log(5)
    got = {(r.service, r.run): r for r in lt.run_compare(lt.minute_state(spark.createDataFrame(rows, LOG))).collect()}
    for (s, run), r in got.items():
        day = [x for x in rows if x[0] == s and x[1] is not None and x[1].date() == run.date()]
        before = [x for x in rows if x[0] == s and x[1] is not None and x[1].date() == run.date() - dt.timedelta(days=1)]
        assert r.requests == len(day)
        assert r.throughput_ratio == (pytest.approx(len(day) / len(before), abs=1e-6) if before else None)
