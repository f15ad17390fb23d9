import datetime as dt

import pytest

from streamcharts.operators import observability as ob
from streamcharts.sources.logs import parse_access_lines

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def _log(spark, rows):
    return spark.createDataFrame(
        [(T0 + dt.timedelta(seconds=s), svc, "GET", "/x", st, d, c) for s, svc, st, d, c in rows],
        "ts timestamp_ntz, service string, method string, route string, status int, duration_seconds double, client bigint",
    )


def test_histogram_cumulative(spark):
    log = _log(spark, [(1, "a", 200, 0.004, 1), (2, "a", 200, 0.2, 1), (3, "a", 500, 7.0, 1)])
    got = {r.le: r["count"] for r in ob.latency_histogram(log).collect()}
    assert got["0.005"] == 1 and got["0.1"] == 1 and got["0.25"] == 2 and got["5"] == 2 and got["+Inf"] == 3


def test_quantile_interpolates(spark):
    # 10 samples: 5 in (0.05, 0.1], 5 in (0.1, 0.25]; p95 rank 9.5 -> 0.1 + 0.15 * (4.5 / 5)
    rows = [(i, "a", 200, 0.07, 1) for i in range(5)] + [(i + 5, "a", 200, 0.2, 1) for i in range(5)]
    got = ob.histogram_p95(_log(spark, rows), "1 hour").first().p95_seconds
    assert got == pytest.approx(0.1 + 0.15 * 4.5 / 5)
    inf = ob.histogram_p95(_log(spark, [(1, "a", 200, 9.0, 1)]), "1 hour").first().p95_seconds
    assert inf == 5.0


def test_counter_rate_handles_reset(spark):
    samples = spark.createDataFrame(
        [("a", T0, 10.0), ("a", T0 + dt.timedelta(minutes=1), 70.0), ("a", T0 + dt.timedelta(minutes=2), 30.0)],
        "service string, ts timestamp_ntz, value double",
    )
    got = [r.rate for r in ob.counter_rate(samples).orderBy("ts").collect()]
    assert got == pytest.approx([0.0, 1.0, 0.5])  # a first sample is no increase; a restart counts from 0


def test_counter_rate_does_not_depend_on_the_scrape_interval(spark):
    """A steady 2 requests a second, scraped each 5, 20 and 3 seconds."""
    for every in (5, 20, 3):
        rows = [("a", T0 + dt.timedelta(seconds=k), 2.0 * k) for k in range(0, 300, every)]
        samples = spark.createDataFrame(rows, "service string, ts timestamp_ntz, value double")
        got = [r.rate for r in ob.counter_rate(samples).orderBy("ts").collect()]
        assert got[-5:] == pytest.approx([2.0] * 5, abs=0.2), every
    uneven = [("a", T0 + dt.timedelta(seconds=k), v) for k, v in ((0, 5.0), (1, 7.0), (2, 1.0), (58, 4.0), (61, None), (200, 10.0))]
    got = [r.rate for r in ob.counter_rate(
        spark.createDataFrame(uneven, "service string, ts timestamp_ntz, value double")).orderBy("ts").collect()]
    assert got == pytest.approx([3 / 60, 6 / 60, 6 / 60], abs=1e-6)


def test_rates_are_zero_in_steps_without_requests(spark):
    log = _log(spark, [(0, "a", 200, 0.1, 1), (1, "a", 500, 0.1, 1), (185, "a", 200, 0.1, 1)])
    assert [r.rate for r in ob.throughput_rate(log).orderBy("window_start").collect()] == pytest.approx([2 / 60, 0, 0, 1 / 60], abs=1e-6)
    errors = ob.throughput_rate(log, status_filter=ob.server_errors()).orderBy("window_start").collect()
    assert [r.rate for r in errors] == pytest.approx([1 / 60, 0, 0, 0], abs=1e-6)


def test_percentiles_are_exact_over_chunks(spark):
    import random

    import numpy as np
    from streamcharts.operators.ranking import percentiles

    rnd, ps = random.Random(1), (0.0, 0.5, 0.9, 0.95, 0.99, 1.0)
    rows = [(rnd.choice(["a", "a", "a", None, "b"]), rnd.choice([rnd.random(), 0.25, None])) for _ in range(5000)] + [("one", 3.0)]
    got = {r.g: r._p for r in percentiles(spark.createDataFrame(rows, "g string, v double"), "v", ps, ["g"]).collect()}
    for g in ("a", None, "b", "one"):
        assert got[g] == pytest.approx(np.quantile([v for k, v in rows if k == g and v is not None], ps))


def test_summary_and_slo(spark):
    rows = [(i, "a", 200, 0.1, 1) for i in range(99)] + [(99, "a", 503, 2.0, 1)]
    s = ob.load_summary(_log(spark, rows)).first()
    assert s.requests == 100 and s.error_rate == 0.01 and s.max_ms == 2000.0 and s.p50_ms == pytest.approx(100.0)
    flags = ob.slo_check(ob.load_summary(_log(spark, rows))).first()
    assert flags.load_error_rate_ok is False and flags.stress_passed is True


def test_access_line_parse(spark):
    lines = spark.createDataFrame([('10.0.0.7 "GET /api/songs HTTP/1.1" 200 0.012s -> 172.18.0.5:4002',),
                                   ("garbage",)], "value string")
    a, b = parse_access_lines(lines).collect()
    assert (a.addr, a.method, a.path, a.status, a.request_seconds, a.upstream, a.parsed) == (
        "10.0.0.7", "GET", "/api/songs", 200, 0.012, "172.18.0.5:4002", True)
    assert b.parsed is False


def test_throttle_flag(spark):
    rows = [(i, "a", 200, 0.1, 7) for i in range(21)] + [(i, "a", 200, 0.1, 8) for i in range(20)]
    got = {r.client: r.throttled for r in ob.throttled_clients(_log(spark, rows)).collect()}
    assert got == {7: True, 8: False}


def test_summary_with_bounded_percentiles_close_to_exact(spark):
    rows = [(i, "a", 200, (i % 97) / 100.0, 1) for i in range(2000)]
    exact = ob.load_summary(_log(spark, rows)).first()
    approx = ob.load_summary(_log(spark, rows), exact=False).first()
    for col in ("p50_ms", "p90_ms", "p95_ms", "p99_ms"):
        assert approx[col] == pytest.approx(exact[col], abs=15.0), col
    assert approx.requests == exact.requests and approx.max_ms == exact.max_ms


def test_zero_latency_runs_do_not_raise(spark):
    rows = [(i * 86400, "a", 200, 0.0, 1) for i in range(3)]
    got = ob.run_compare(_log(spark, rows)).orderBy("run").collect()
    assert [r.p95_change_pct for r in got] == [None, None, None]
    assert [r.throughput_ratio for r in got] == [None, 1.0, 1.0]
