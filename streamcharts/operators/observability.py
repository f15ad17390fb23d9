"""Request-log analytics.

The reference exposed these as service counters/histograms read by a
dashboard and as load-test summaries. Here they are aggregates over a request
log ``(ts, service, method, route, status, duration_seconds, client)``, or over
cumulative metric samples ``(ts, series..., value)`` when that is what a
scraper stored. Every aggregate is partial + final (map-side combine); windows
only run over already-aggregated per-series time buckets, whose length is
bounded by the time range, not by the request volume.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streamcharts.constants import (
    LATENCY_BUCKETS_SECONDS,
    RATE_LIMIT_MAX_ATTEMPTS,
    RATE_WINDOW_SECONDS,
    SLO_THRESHOLDS,
)
from streamcharts.operators.asof import increments
from streamcharts.operators.ranking import percentiles


def le_label(bound: float) -> str:
    return f"{bound:g}"


LE_LABELS = [le_label(b) for b in LATENCY_BUCKETS_SECONDS] + ["+Inf"]


def _bucket_counts(log: DataFrame, keys: list[str | Column]) -> DataFrame:
    """Cumulative bucket counts ``c0..c9`` and ``c_inf`` per group, in one aggregate."""
    d = F.col("duration_seconds")
    aggs = [F.count_if(d <= F.lit(b)).alias(f"c{i}") for i, b in enumerate(LATENCY_BUCKETS_SECONDS)]
    aggs.append(F.count(F.lit(1)).alias("c_inf"))
    return log.groupBy(*keys).agg(*aggs)


def requests_by_route(log: DataFrame) -> DataFrame:
    """``http_requests_total`` per (method, route, status, service)."""
    return log.groupBy("method", "route", "status", "service").agg(F.count(F.lit(1)).alias("requests"))


def latency_histogram(log: DataFrame, by: tuple[str, ...] = ("service",)) -> DataFrame:
    """Cumulative histogram rows ``(*by, le, count)`` with the fixed bounds plus ``+Inf``.

    One conditional-count aggregate, then ``stack`` into rows: no join with a
    bounds table and no group ever materialised.
    """
    wide = _bucket_counts(log, list(by))
    n = len(LE_LABELS)
    cols = [f"c{i}" for i in range(len(LATENCY_BUCKETS_SECONDS))] + ["c_inf"]
    pairs = ", ".join(f"'{lab}', {c}" for lab, c in zip(LE_LABELS, cols))
    return wide.selectExpr(*by, f"stack({n}, {pairs}) AS (le, count)")


def quantile_from_buckets(q: float) -> Column:
    """Histogram quantile over columns ``c0..c9, c_inf`` (cumulative), linear inside the bucket.

    Same rule as the dashboard's ``histogram_quantile``: rank = q * total; the
    first finite bucket whose cumulative count reaches the rank holds it; in
    the ``+Inf`` bucket the answer is the largest finite bound; no samples ->
    null. Prometheus' extrapolation of rates at window edges cancels out of
    the ratio and is not modelled.
    """
    bounds = LATENCY_BUCKETS_SECONDS
    rank = F.lit(q) * F.col("c_inf")
    expr = F.lit(bounds[-1])  # rank beyond every finite bucket
    for i in reversed(range(len(bounds))):
        upper = F.lit(bounds[i])
        lower = F.lit(bounds[i - 1] if i else 0.0)
        below = F.col(f"c{i - 1}") if i else F.lit(0)
        inside = F.col(f"c{i}") - below
        value = lower + (upper - lower) * F.try_divide(rank - below, inside)
        expr = F.when(F.col(f"c{i}") >= rank, value).otherwise(expr)
    return F.when(F.col("c_inf") > 0, expr)


def histogram_p95(log: DataFrame, grain: str = "1 minute", q: float = 0.95) -> DataFrame:
    """``histogram_quantile(q, sum by (le, service) (rate(...)))`` per service and time bucket."""
    w = F.window(F.col("ts").cast("timestamp"), grain)
    wide = _bucket_counts(log, ["service", w.alias("w")])
    return wide.select(
        "service",
        F.col("w.start").cast("timestamp_ntz").alias("window_start"),
        F.round(quantile_from_buckets(q), 6).alias("p95_seconds"),
    )


def counter_rate(samples: DataFrame, series: tuple[str, ...] = ("service",),
                 window_seconds: int = RATE_WINDOW_SECONDS, grain_seconds: int = 5) -> DataFrame:
    """Per-second rate of stored cumulative counter samples ``(series..., ts, value)`` over a
    trailing window, reset-aware, at every scrape step of ``grain_seconds`` that has samples.

    Increases are found sample by sample in cells of time (``asof.increments``), so no step of a fast series is
    held as a list, and summed to one row per (series, step); the trailing sum runs over those rows. Between two samples the
    increase is the difference, or the new value when the counter went down (the process restarted); a series' first
    sample gives none. A window holds the increases that end in it, divided by its length.
    """
    grain = int(grain_seconds)
    second = F.floor(F.col("_at") / 1_000_000)
    per_step = increments(samples, series).groupBy(*series, (second - F.pmod(second, F.lit(grain)) + grain).alias("_end")).agg(
        F.sum("_inc").alias("_inc"))
    trailing = Window.partitionBy(*series).orderBy("_end").rangeBetween(-int(window_seconds) + 1, 0)
    return per_step.select(
        *series, F.timestamp_seconds("_end").cast("timestamp_ntz").alias("ts"),
        F.round(F.sum("_inc").over(trailing) / float(window_seconds), 6).alias("rate"))


def throughput_rate(log: DataFrame, step_seconds: int = RATE_WINDOW_SECONDS,
                    status_filter: Column | None = None) -> DataFrame:
    """A16 over a request log: requests per second of each service in every calendar step.

    Steps between a service's first and last request without a request (or without one that
    passes the filter) have rate 0, as the dashboard draws them.
    """
    counted = F.lit(True) if status_filter is None else F.coalesce(status_filter, F.lit(False))
    step = F.window(F.col("ts").cast("timestamp"), f"{int(step_seconds)} seconds")
    per = log.groupBy("service", step.alias("w")).agg(F.count_if(counted).alias("n")).select(
        "service", F.unix_seconds(F.col("w.start")).alias("at"), "n")
    # a gap is filled from the step before it: one row per step of a service meets the window
    after = F.lead("at").over(Window.partitionBy("service").orderBy("at"))
    gap = F.sequence("at", F.coalesce(after, F.col("at") + step_seconds) - step_seconds, F.lit(int(step_seconds)).cast("long"))
    return per.withColumn("_gap", gap).select("service", "n", "at", F.explode("_gap").alias("_at")).select(
        "service", F.timestamp_seconds("_at").cast("timestamp_ntz").alias("window_start"),
        F.round(F.when(F.col("_at") == F.col("at"), F.col("n")).otherwise(0) / float(step_seconds), 6).alias("rate"))


def server_errors() -> Column:
    """``status=~"5.."``."""
    return F.col("status").cast("string").rlike("^5..$")


def _up_flag() -> Column:
    return F.when(F.col("status") < 500, F.lit(1)).otherwise(F.lit(0))


def _last_up_key() -> Column:
    """One bigint ordered like (ts, up): ``max`` of it is the latest sample, a later
    success winning a tie. A fixed-width max plans as a hash aggregate, where
    ``max_by(up, struct(ts, up))`` would need a sort aggregate."""
    return F.max(F.unix_micros(F.col("ts").cast("timestamp")) * 2 + _up_flag())


def latest_up(log: DataFrame, by: str = "service") -> DataFrame:
    """The latest ``up`` flag per instance: 1 when its last request did not fail with 5xx."""
    return log.groupBy(by).agg(_last_up_key().alias("_k"), F.max("ts").alias("last_seen")).select(
        by, (F.col("_k") % 2).cast("int").alias("up"), "last_seen"
    )


PCTS = (0.5, 0.9, 0.95, 0.99)


def _with_percentiles(agg: DataFrame, pct: DataFrame, by: list[str]) -> DataFrame:
    """Per-group aggregates with their percentiles; a group of null latencies only has none."""
    p = pct.select(*[F.col(k).alias(f"_p_{k}") for k in by], "_p")
    return agg.join(p, [F.col(k).eqNullSafe(F.col(f"_p_{k}")) for k in by], "left").drop(*[f"_p_{k}" for k in by])


def load_summary(log: DataFrame, by: tuple[str, ...] = ("service",), exact: bool = True) -> DataFrame:
    """Count, req/s, failed share, avg/median/p90/p95/p99/max latency in ms.

    Exact percentiles come from counted latencies in sort order (``ranking.percentiles``), so a
    service with nearly as many latencies as requests needs no buffer of them;
    ``exact=False`` switches to the bounded-size ``percentile_approx`` sketch.
    """
    log = log.withColumn("_ms", F.col("duration_seconds") * 1000.0)
    ms = F.col("_ms")
    span = (F.unix_micros(F.max("ts").cast("timestamp")) - F.unix_micros(F.min("ts").cast("timestamp"))) / 1e6
    agg = log.groupBy(*by).agg(
        F.count(F.lit(1)).alias("requests"),
        span.alias("_span"),
        (F.count_if(F.col("status") >= 400) / F.count(F.lit(1))).alias("error_rate"),
        F.avg(ms).alias("avg_ms"),
        *([] if exact else [F.percentile_approx(ms, list(PCTS), 10000).alias("_p")]),
        F.max(ms).alias("max_ms"),
    )
    if exact:
        agg = _with_percentiles(agg, percentiles(log, "_ms", PCTS, list(by)), list(by))
    return agg.select(
        *by,
        "requests",
        F.round(F.col("requests") / F.when(F.col("_span") > 0, F.col("_span")), 6).alias("req_per_s"),
        F.round("error_rate", 6).alias("error_rate"),
        F.round("avg_ms", 6).alias("avg_ms"),
        *[F.round(F.col("_p")[i], 6).alias(f"p{int(p * 100)}_ms") for i, p in enumerate(PCTS)],
        F.round("max_ms", 6).alias("max_ms"),
    )


def slo_check(summary: DataFrame) -> DataFrame:
    """Every threshold as a flag column, plus one verdict per test profile."""
    ops = {"<": lambda a, b: a < b, "<=": lambda a, b: a <= b}
    flags, per_profile = [], {}
    for profile, metric, op, bound in SLO_THRESHOLDS:
        name = f"{profile}_{metric}_ok"
        flags.append(F.coalesce(ops[op](F.col(metric), F.lit(bound)), F.lit(False)).alias(name))
        per_profile.setdefault(profile, []).append(name)
    keys = [c for c in summary.columns if c not in {"requests", "req_per_s", "error_rate", "avg_ms",
                                                    "p50_ms", "p90_ms", "p95_ms", "p99_ms", "max_ms"}]
    out = summary.select(*keys, *flags)
    for profile, names in per_profile.items():
        verdict = F.lit(True)
        for n in names:
            verdict = verdict & F.col(n)
        out = out.withColumn(f"{profile}_passed", verdict)
    return out


def run_compare(log: DataFrame, run: str = "1 day") -> DataFrame:
    """Each run (a day per service) against the previous one: throughput ratio, p95 change %.

    Summaries are computed per (service, run) first; the lag then runs over
    one row per run of a service.
    """
    w = F.window(F.col("ts").cast("timestamp"), run)
    runs = log.withColumn("run", w.start.cast("timestamp_ntz")).withColumn("_ms", F.col("duration_seconds") * 1000.0)
    per_run = _with_percentiles(
        runs.groupBy("service", "run").agg(F.count(F.lit(1)).alias("requests")),
        percentiles(runs, "_ms", (0.95,), ["service", "run"]), ["service", "run"],
    ).withColumn("p95_ms", F.col("_p")[0])
    order = Window.partitionBy("service").orderBy("run")
    prev_n, prev_p = F.lag("requests").over(order), F.lag("p95_ms").over(order)
    return per_run.select(
        "service",
        "run",
        "requests",
        F.round("p95_ms", 6).alias("p95_ms"),
        F.round(F.try_divide(F.col("requests"), prev_n), 6).alias("throughput_ratio"),
        F.round(F.try_divide(F.col("p95_ms") - prev_p, prev_p) * 100.0, 6).alias("p95_change_pct"),
    )


def upstream_share(parsed: DataFrame) -> DataFrame:
    """Requests per upstream replica that answered, and their share of all parsed lines.

    Lines that do not parse are counted apart, as the row without an upstream; they have no share.
    """
    per = parsed.withColumn("upstream", F.when(F.col("parsed"), F.col("upstream"))).groupBy("upstream").agg(F.count(F.lit(1)).alias("requests"))
    known = F.when(F.col("upstream").isNotNull(), F.col("requests"))
    total = F.sum(known).over(Window.partitionBy())  # one row per upstream: bounded
    return per.select("upstream", "requests", F.round(known / total, 6).alias("share"))


def throttled_clients(log: DataFrame, window: str = "1 minute",
                      max_attempts: int = RATE_LIMIT_MAX_ATTEMPTS) -> DataFrame:
    """Attempts per client per fixed (calendar-aligned) window, flagged above the limit."""
    w = F.window(F.col("ts").cast("timestamp"), window)
    return log.groupBy("client", w.alias("w")).agg(F.count(F.lit(1)).alias("attempts")).select(
        "client",
        F.col("w.start").cast("timestamp_ntz").alias("window_start"),
        "attempts",
        (F.col("attempts") > max_attempts).alias("throttled"),
    )


def service_overview(log: DataFrame, grain: str = "1 minute", q: float = 0.95) -> DataFrame:
    """Q13: the dashboard's four panels per (service, time bucket) from one aggregate.

    Request rate and 5xx rate per second, latency quantile from the histogram
    buckets, and ``up`` as of the bucket's last request; one pass over the
    log instead of four plans.
    """
    w = F.window(F.col("ts").cast("timestamp"), grain)
    d = F.col("duration_seconds")
    seconds = F.unix_micros(F.col("w.end")) - F.unix_micros(F.col("w.start"))
    aggs = [F.count_if(d <= F.lit(b)).alias(f"c{i}") for i, b in enumerate(LATENCY_BUCKETS_SECONDS)]
    wide = log.groupBy("service", w.alias("w")).agg(
        *aggs,
        F.count(F.lit(1)).alias("c_inf"),
        F.count_if(server_errors()).alias("errors"),
        _last_up_key().alias("_k"),
    )
    return wide.select(
        "service",
        F.col("w.start").cast("timestamp_ntz").alias("window_start"),
        F.round(F.col("c_inf") / (seconds / 1e6), 6).alias("req_rate"),
        F.round(F.col("errors") / (seconds / 1e6), 6).alias("error_rate"),
        F.round(quantile_from_buckets(q), 6).alias("p95_seconds"),
        (F.col("_k") % 2).cast("int").alias("up"),
    )
