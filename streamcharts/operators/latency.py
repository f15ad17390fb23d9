"""Latency quantiles that merge over time.

State: for each service and minute, how many requests fell into each bucket of a logarithmic scale. A bucket holds the values in
(g^(i-1), g^i] with g = (1 + a) / (1 - a); its middle 2 g^i / (g + 1) is within the relative error ``a`` of each of them. Counts
add up, so the state of any services and any time is the sum of rows: epochs, late rows, hours, days. A scale's buckets
are bounded by the range of the values (about 1,000 from a microsecond to a quarter of an hour at one per cent).

``LatencySink`` keeps it as a delta log: each micro-batch writes its counts under ``day=/run=/epoch=`` and a replayed one
rewrites its own, as the rollups do. ``quantiles`` reads any part of it. Quantile q of n values is the one at
rank floor(q (n - 1)), from 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

ERROR = 0.01
PCTS = (0.5, 0.9, 0.95, 0.99)


def _base(error: float) -> float:
    return (1 + error) / (1 - error)


def bucket(value: Column, error: float = ERROR) -> Column:
    """Place of a value on the scale: rises with the value, 0 for zero; magnitudes below 1e-12 count as zero."""
    size = F.abs(value)
    # magnitudes from 1e-12 on have places from 1 on; negative values mirror them
    place = F.ceil(F.log(size / 1e-12) / F.log(F.lit(_base(error)))).cast("int") + 1
    return F.when(size < 1e-12, F.lit(0)).when(value > 0, place).otherwise(-place)


def bucket_value(place: Column, error: float = ERROR) -> Column:
    """The middle of a bucket."""
    g = _base(error)
    size = 2e-12 * F.pow(F.lit(g), F.abs(place) - 1) / (g + 1)
    return F.when(place == 0, F.lit(0.0)).when(place > 0, size).otherwise(-size)


def minute_state(log: DataFrame, error: float = ERROR) -> DataFrame:
    """(service, window_start, bucket, requests, failed) of a request log; requests without a latency have no bucket (null)."""
    return log.filter("ts is not null").groupBy(
        "service", F.date_trunc("minute", F.col("ts")).cast("timestamp_ntz").alias("window_start"), bucket(F.col("duration_seconds"), error).alias("bucket")).agg(
        F.count(F.lit(1)).alias("requests"), F.count_if(F.col("status") >= 400).alias("failed"))


class LatencySink:
    """``foreachBatch`` callback: a micro-batch's counts under ``root/latency``; a replay rewrites its own."""

    def __init__(self, root: str, run_id: str, error: float = ERROR):
        self.root, self.run_id, self.error = root.rstrip("/"), run_id, error

    def __call__(self, batch: DataFrame, epoch_id: int) -> None:
        minute_state(batch, self.error).withColumn("day", F.to_date("window_start")).withColumn("run", F.lit(self.run_id)).withColumn(
            "epoch", F.lit(int(epoch_id)).cast("long")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "day", "run", "epoch").parquet(f"{self.root}/latency")


def state(spark: SparkSession, root: str, since: str | None = None, until: str | None = None) -> DataFrame:
    """The stored counts of the minutes in [since, until); whole days outside are not listed."""
    rows = spark.read.parquet(f"{root.rstrip('/')}/latency")
    for t, keep in ((since, lambda x, m: x >= m), (until, lambda x, m: x <= m)):
        if t is not None:
            moment = F.lit(t).cast("timestamp_ntz")
            rows = rows.filter(keep(F.col("day"), F.to_date(moment)))
            rows = rows.filter(F.col("window_start") >= moment if t is since else F.col("window_start") < moment)
    return rows.drop("day", "run", "epoch")


def quantiles(state: DataFrame, by: list[str | Column], pcts: tuple[float, ...] = PCTS, error: float = ERROR) -> DataFrame:
    """(*by, requests, error_rate, p50_ms, ...) of the state summed by ``by``; null where no request has a latency."""
    per = state.groupBy(*by, "bucket").agg(F.sum("requests").alias("n"), F.sum("failed").alias("failed"))
    names = [c for c in per.columns if c not in ("bucket", "n", "failed")]
    group = Window.partitionBy(*names)  # a row a bucket of the scale
    timed = F.when(F.col("bucket").isNotNull(), F.col("n")).otherwise(0)
    upto = per.withColumn("_timed", F.sum(timed).over(group)).withColumn(
        "_upto", F.sum(timed).over(group.orderBy(F.col("bucket").asc_nulls_first())))
    # the first bucket that ends beyond the rank
    found = [F.min(F.when(F.col("bucket").isNotNull() & (F.col("_upto") > F.floor(F.lit(p) * (F.col("_timed") - 1))), F.col("bucket"))).alias(f"_b{i}")
             for i, p in enumerate(pcts)]
    out = upto.groupBy(*names).agg(F.sum("n").alias("requests"), F.sum("failed").alias("failed"), *found)
    return out.select(*names, "requests", F.round(F.col("failed") / F.col("requests"), 6).alias("error_rate"), *[
        F.round(bucket_value(F.col(f"_b{i}"), error) * 1000.0, 6).alias(f"p{int(p * 100)}_ms") for i, p in enumerate(pcts)])


def run_compare(state: DataFrame, run: str = "1 day", error: float = ERROR) -> DataFrame:
    """A20 over the state: each run of a service against the one before: throughput ratio, p95 change in per cent."""
    start = F.window(F.col("window_start").cast("timestamp"), run).start.cast("timestamp_ntz")
    per = quantiles(state.withColumn("run", start), ["service", "run"], (0.95,), error)
    order = Window.partitionBy("service").orderBy("run")  # a row a run
    prev_n, prev_p = F.lag("requests").over(order), F.lag("p95_ms").over(order)
    return per.select("service", "run", "requests", "p95_ms", F.round(F.try_divide(F.col("requests"), prev_n), 6).alias("throughput_ratio"),
                      F.round(F.try_divide(F.col("p95_ms") - prev_p, prev_p) * 100.0, 6).alias("p95_change_pct"))
