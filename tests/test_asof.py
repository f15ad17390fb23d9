"""As-of joins and the dashboard's rules against plain loops."""

import datetime as dt
import random

import pytest

from streamcharts.operators import asof

T0 = dt.datetime(2024, 1, 1)
SAMPLES = "s string, ts timestamp_ntz, value double"


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def samples(seed, n=400, span=7200):
    """A third or more of all samples are of one series; equal times, resets, a null series, rows that are none."""
    rng = random.Random(seed)
    rows = [("hot" if rng.random() < 0.4 else rng.choice(["a", "b", None]), at(rng.randrange(span * 2) / 2), float(rng.randrange(0, 50))) for _ in range(n)]
    return rows + [("hot", None, 1.0), ("hot", at(3), None), ("lone", at(span - 1), 5.0)]


def plain_asof(probes, rows, age=None):
    out = []
    for s, t, k in probes:
        seen = [(u, v) for x, u, v in rows if x == s and u is not None and v is not None and t is not None and u <= t]
        best = max(seen, default=(None, None))
        if age is not None and best[0] is not None and (t - best[0]).total_seconds() >= age:
            best = (None, None)
        out.append((s, t, k, *best))
    return sorted(out, key=str)


@pytest.mark.parametrize("cell,age", [(60, None), (3600, None), (600, 300), (100, 30), (3600, 0.5)])
def test_asof_equals_the_loop(spark, cell, age):
    rows, rng = samples(cell), random.Random(1)
    probes = [(rng.choice(["hot", "a", "b", None, "none"]), at(rng.randrange(-100, 8000)), k) for k in range(300)] + [("a", None, 999)]
    got = asof.asof_join(spark.createDataFrame(probes, "s string, ts timestamp_ntz, k int"), spark.createDataFrame(rows, SAMPLES), ("s",),
                         max_age_seconds=age, cell_seconds=cell)
    assert got.columns == ["s", "ts", "k", "sample_ts", "value"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_asof(probes, rows, age)


def test_instant_values_leave_stale_steps_out(spark):
    rows = samples(3)
    got = asof.instant_values(spark.createDataFrame(rows, SAMPLES), ("s",), str(at(0)), str(at(9000)), 60).collect()
    steps = [(s, at(60 * k), None) for s in {r[0] for r in rows} for k in range(151)]
    want = [(s, t, u, v) for s, t, _, u, v in plain_asof(steps, rows, 300) if v is not None]
    assert sorted((tuple(r) for r in got), key=str) == sorted(want, key=str)
    assert not any(r.ts > at(7200 + 300) for r in got)


def plain_rate(rows, start, end, step, range_):
    """The rule for one series at a time, sample by sample."""
    out = []
    for s in {r[0] for r in rows}:
        points = {}
        for x, t, v in rows:
            if x == s and t is not None and v is not None:
                points[t] = max(v, points.get(t, v))
        series = sorted(points.items())
        t = start
        while t <= end:
            w = [(u, v) for u, v in series if t - dt.timedelta(seconds=range_) < u <= t]
            if len(w) > 1:
                grown = sum(v2 if v2 < v1 else v2 - v1 for (_, v1), (_, v2) in zip(w[:-1], w[1:]))
                sampled = (w[-1][0] - w[0][0]).total_seconds()
                mean = sampled / (len(w) - 1)
                to_start, to_end = range_ - (t - w[0][0]).total_seconds(), (t - w[-1][0]).total_seconds()
                to_start, to_end = (x if x < 1.1 * mean else mean / 2 for x in (to_start, to_end))
                if grown > 0 and w[0][1] >= 0:
                    to_start = min(to_start, sampled * w[0][1] / grown)
                out.append((s, t, grown * (sampled + to_start + to_end) / sampled / range_))
            t += dt.timedelta(seconds=step)
    return out


@pytest.mark.parametrize("cell,step,range_", [(3600, 60, 300), (100, 45, 60), (500, 300, 290)])
def test_extrapolated_rate_equals_the_loop(spark, cell, step, range_):
    rows = samples(8, n=900)
    got = asof.extrapolated_rate(spark.createDataFrame(rows, SAMPLES), ("s",), str(at(0)), str(at(8000)), step, range_, cell)
    got = {(r.s, r.ts): r.rate for r in got.collect()}
    want = {(s, t): v for s, t, v in plain_rate(rows, at(0), at(8000), step, range_)}
    assert got.keys() == want.keys() and len(want) > 50
    assert all(got[k] == pytest.approx(want[k], abs=2e-6) for k in want)


def test_empty_tables(spark):
    none = spark.createDataFrame([], SAMPLES)
    probes = spark.createDataFrame([("a", at(1), 1)], "s string, ts timestamp_ntz, k int")
    assert [tuple(r) for r in asof.asof_join(probes, none, ("s",)).collect()] == [("a", at(1), 1, None, None)]
    assert asof.extrapolated_rate(none, ("s",), str(at(0)), str(at(60)), 60, 60).collect() == []
