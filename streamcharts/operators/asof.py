"""As-of joins, and the dashboard's rules for stored samples (S11, A14, A17): staleness and extrapolated rates.

A series with a large part of all samples must not be one task's sort. Time is cut into cells; samples and probes are
matched inside each (series, cell), and what a cell is entered with, its series' last sample of any earlier cell, is
carried over one summary row a cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

CELL_SECONDS = 3600
STALENESS_SECONDS = 300  # fixed value: the dashboard's look-back


def _micros(ts: str | Column) -> Column:
    return F.unix_micros((F.col(ts) if isinstance(ts, str) else ts).cast("timestamp"))


def _same(left: DataFrame, right: DataFrame, columns: list[str]) -> list[Column]:
    return [left[c].eqNullSafe(right[c]) for c in columns]


def asof_join(probes: DataFrame, samples: DataFrame, by: tuple[str, ...], value: str = "value", ts: str = "ts",
              max_age_seconds: float | None = None, cell_seconds: int = CELL_SECONDS) -> DataFrame:
    """Each probe with ``sample_ts`` and ``value`` of the last sample of its series at or before it; null where there is none.

    Of samples at the same time the largest value counts. With ``max_age_seconds`` a sample must be younger than that.
    Samples without time or value are none; probes without time match nothing.
    """
    cell = F.floor(F.col("_at") / (int(cell_seconds) * 1_000_000)).alias("_cell")
    s = samples.select(*by, _micros(ts).alias("_at"), F.struct(_micros(ts).alias("at"), F.col(value).alias("value")).alias("_sample")).filter(
        f"_at is not null and {'`' + value + '`'} is not null")
    s = s.select(*by, "_at", cell, "_sample", F.lit(None).cast(probes.schema).alias("_probe"))
    p = probes.select(*by, _micros(ts).alias("_at"), F.struct(*[F.col(c) for c in probes.columns]).alias("_probe"))
    p = p.select(*by, "_at", cell, F.lit(None).cast(s.schema["_sample"].dataType).alias("_sample"), "_probe")
    both = s.unionByName(p)
    # a probe at a sample's time sees it: samples come first, the largest value last of them
    inside = Window.partitionBy(*by, "_cell").orderBy("_at", F.col("_probe").isNotNull(), "_sample.value")
    seen = both.withColumn("_last", F.last("_sample", ignorenulls=True).over(inside)).filter("_probe is not null").select(*by, "_cell", "_probe", "_last")
    cells = both.groupBy(*by, "_cell").agg(F.max("_sample").alias("_left"))  # (time, value): the cell's last sample
    before = Window.partitionBy(*by).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    carried = cells.withColumn("_carried", F.last("_left", ignorenulls=True).over(before)).filter("_carried is not null").select(*by, "_cell", "_carried")
    joined = seen.join(carried, _same(seen, carried, [*by, "_cell"]), "left").withColumn("_found", F.coalesce("_last", "_carried"))
    age = _micros(F.col(f"_probe.{ts}")) - F.col("_found.at")
    fresh = F.col(f"_probe.{ts}").isNotNull() if max_age_seconds is None else age < int(max_age_seconds * 1_000_000)
    found = F.when(fresh, F.col("_found"))
    return joined.select(*[F.col(f"_probe.{c}").alias(c) for c in probes.columns],
                         F.timestamp_micros(found["at"]).cast("timestamp_ntz").alias("sample_ts"), found["value"].alias("value"))


def steps(samples: DataFrame, by: tuple[str, ...], start: str, end: str, step_seconds: int) -> DataFrame:
    """Every series at every step of [start, end]: what a dashboard's panel asks for."""
    moment = lambda t: F.lit(t).cast("timestamp_ntz")
    grid = F.sequence(moment(start), moment(end), F.expr(f"INTERVAL {int(step_seconds)} SECONDS"))
    return samples.select(*by).distinct().withColumn("ts", F.explode(grid))


def instant_values(samples: DataFrame, by: tuple[str, ...], start: str, end: str, step_seconds: int,
                   staleness_seconds: float = STALENESS_SECONDS) -> DataFrame:
    """(series, ts, sample_ts, value) at the steps that have a sample younger than the look-back; others show a gap."""
    found = asof_join(steps(samples, by, start, end, step_seconds), samples, by, max_age_seconds=staleness_seconds,
                      cell_seconds=max(CELL_SECONDS, int(staleness_seconds)))
    return found.filter("value is not null")


def increments(samples: DataFrame, by: tuple[str, ...], cell_seconds: int = CELL_SECONDS, once: bool = False) -> DataFrame:
    """(series, _at, _v, _inc) of counter samples: how much each grew on the one before it, in (time, value) order.

    A lower value is a restart, counting from zero; a series' first sample grew by nothing. ``once``: equal times count
    once, with the largest value. Samples without time or value are none.
    """
    s = samples.select(*by, _micros("ts").alias("_at"), F.col("value").cast("double").alias("_v")).filter("_at is not null and _v is not null")
    if once:
        s = s.groupBy(*by, "_at").agg(F.max("_v").alias("_v"))
    s = s.withColumn("_cell", F.floor(F.col("_at") / (int(cell_seconds) * 1_000_000)))
    # the value before each sample: inside its cell, or the last of the series' cells before
    near = s.withColumn("_prev", F.lag("_v").over(Window.partitionBy(*by, "_cell").orderBy("_at", "_v")))
    cells = s.groupBy(*by, "_cell").agg(F.max(F.struct("_at", "_v")).alias("_left"))
    carried = cells.withColumn("_carried", F.lag("_left").over(Window.partitionBy(*by).orderBy("_cell"))["_v"]).select(*by, "_cell", "_carried")
    rows = near.join(carried, _same(near, carried, [*by, "_cell"]), "left").select(
        *[near[c] for c in by], "_at", "_v", F.coalesce("_prev", "_carried").alias("_prev"))
    grew = F.when(F.col("_v") < F.col("_prev"), F.col("_v")).otherwise(F.col("_v") - F.col("_prev"))
    return rows.withColumn("_inc", F.coalesce(grew, F.lit(0.0))).drop("_prev")


def extrapolated_rate(samples: DataFrame, by: tuple[str, ...], start: str, end: str, step_seconds: int, range_seconds: int,
                      cell_seconds: int = CELL_SECONDS) -> DataFrame:
    """(series, ts, rate): the counter's per-second rate over (ts - range, ts] at each step that has two samples there.

    The increase between the range's first and last sample (a lower value is a restart, counting from zero) is extended towards
    the range's ends: up to an end that lies within 1.1 mean sample distances, else by half a distance, and never before
    the time at which the counter would have been zero. Equal times count once, with the largest value.
    """
    rows = increments(samples, by, cell_seconds, once=True)
    # the steps whose range holds the sample: start + k step with at <= step < at + range
    first, last = _micros(F.lit(start).cast("timestamp_ntz")), _micros(F.lit(end).cast("timestamp_ntz"))
    step, range_ = int(step_seconds) * 1_000_000, int(range_seconds) * 1_000_000
    low = F.greatest(F.lit(0).cast("long"), F.ceil((F.col("_at") - first) / step))
    high = F.least(F.floor((last - first) / step), F.ceil((F.col("_at") + range_ - first) / step) - 1)
    held = rows.withColumn("_low", low).withColumn("_high", high).filter("_low <= _high").withColumn(
        "_step", F.explode(F.sequence("_low", "_high")))
    per = held.groupBy(*by, "_step").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("_at", "_v", "_inc")).alias("a"), F.max("_at").alias("b"), F.sum("_inc").alias("inc")).filter("n > 1")
    at = first + F.col("_step") * step
    grown = F.col("inc") - F.col("a._inc")
    sampled = (F.col("b") - F.col("a._at")) / 1e6
    mean = sampled / (F.col("n") - 1)
    to_end, to_start = (at - F.col("b")) / 1e6, (F.col("a._at") - (at - range_)) / 1e6
    to_end = F.when(to_end >= mean * 1.1, mean / 2).otherwise(to_end)
    to_start = F.when(to_start >= mean * 1.1, mean / 2).otherwise(to_start)
    to_zero = F.when((grown > 0) & (F.col("a._v") >= 0), sampled * F.try_divide(F.col("a._v"), grown))
    to_start = F.least(to_start, to_zero)  # least skips nulls
    rate = grown * (sampled + to_start + to_end) / sampled / float(range_seconds)
    return per.select(*by, F.timestamp_micros(at).cast("timestamp_ntz").alias("ts"), F.round(rate, 6).alias("rate"))
