"""Row numbers, running sums and successors in a sort order without a single hot task.

A window partitioned by a key processes one key in one task; a global window
processes everything in one task. Here a few bounds, drawn from a sample of the
sort keys, cut any group -- or the whole table -- into contiguous chunks. The
bounds are literals in the plan, so a row's chunk is a plain expression of the
row: every reader agrees on it, also after an executor loss, and nothing has to
be written in between. Numbering and ``lead`` run inside each (chunk, group);
chunks are stitched with a window over one summary row per chunk and group.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Sampled rows per bound: chunk sizes then differ by a small factor only.
SAMPLES_PER_CHUNK = 20


def chunk_of(df: DataFrame, keys: list[str], chunks: int, group: int = 0) -> Column | None:
    """The number of the contiguous chunk (by ``keys``) that a row of ``df`` is in; none if nothing has to be cut.

    The only job this starts reads ``df`` once, every task forwarding ``SAMPLES_PER_CHUNK * chunks`` rows at random
    at most; so many keys are collected, whatever the size of ``df``. Results built on the chunks do not depend on where the
    bounds fall.

    The first ``group`` keys name a row's group. Of a group, all of whose rows fit into a chunk or two, nothing is cut: bounds count
    only where two of them or more fall into the same group, and only rows of such groups are compared with them.
    """
    if chunks <= 1:
        return None
    key = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)])
    name = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys[:group])]) if group else F.lit(0)
    drawn = df.select(key.alias("k"), name.alias("g"), F.rand(7).alias("r")).orderBy("r").limit(SAMPLES_PER_CHUNK * chunks)
    options = {"ignoreNullFields": "false"}
    as_text = [F.to_json("k", options).alias("j"), (F.to_json("g", options) if group else F.lit("")).alias("g")]
    sample = [(r.j, r.g) for r in drawn.select("k", "g").orderBy("k").select(*as_text).collect()]
    step = max(1, len(sample) // chunks)
    bounds = list(dict.fromkeys(sample[step::step]))
    if group:
        often = Counter(g for _, g in bounds)
        bounds = [(j, g) for j, g in bounds if often[g] > 1]
    if not bounds:
        return None
    kind = df.select(key.alias("k")).schema["k"].dataType.simpleString()
    table = F.from_json(F.lit("[" + ",".join(j for j, _ in bounds) + "]"), f"array<{kind}>")  # folded to one literal
    half = lambda s: F.floor((s["lo"] + s["hi"]) / 2).cast("int")
    search = F.aggregate(  # binary search: bounds up to the row's key
        F.sequence(F.lit(1), F.lit(len(bounds).bit_length())),
        F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi")),
        lambda s, _: F.when(s["lo"] >= s["hi"], s).when(
            F.get(table, half(s)) <= key, F.struct((half(s) + 1).alias("lo"), s["hi"].alias("hi"))).otherwise(
            F.struct(s["lo"].alias("lo"), half(s).alias("hi"))))
    if not group:
        return search["lo"]
    kind = df.select(name.alias("g")).schema["g"].dataType.simpleString()
    large = F.from_json(F.lit("[" + ",".join(dict.fromkeys(g for _, g in bounds)) + "]"), f"array<{kind}>")
    return F.when(F.array_contains(large, name), search["lo"]).otherwise(F.lit(0))


def ranked(df: DataFrame, order: list[str], group: list[str] | None = None, next_of: str | None = None,
           partitions: int | None = None, weight: str | None = None, bounds_from: DataFrame | None = None) -> DataFrame:
    """Add ``_rank`` (1-based position in ``order`` within ``group``) and, when
    ``next_of`` is given, ``_next`` = that column on the following row, wrapping
    to the group's first row. ``order`` must make rows unique within a group.
    With ``weight`` (a count column) a row takes that many places; ``_rank`` is its first.
    ``bounds_from``: a cheaper frame with the same sort columns to draw the bounds from.
    """
    group = list(group or [])
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    places = F.col(weight) if weight else F.lit(1)

    def numbered(window, rank: str, following: str, frame: DataFrame) -> DataFrame:
        upto = F.sum(places).over(window.rowsBetween(Window.unboundedPreceding, 0)) - places + 1 if weight else F.row_number().over(window)
        out = frame.withColumn(rank, upto)
        return out.withColumn(following, F.lead(next_of).over(window)) if next_of else out

    chunk = chunk_of(df if bounds_from is None else bounds_from, [*group, *order], n, len(group))
    if chunk is None and group:  # no group is larger than a task may hold
        whole = Window.partitionBy(*group)
        out = numbered(whole.orderBy(*order), "_rank", "_next", df).withColumn("_rank", F.col("_rank").cast("long"))
        if next_of:
            out = out.withColumn("_next", F.coalesce("_next", F.max(F.when(F.col("_rank") == 1, F.col(next_of))).over(whole)))
        return out
    cut = df.withColumn("_chunk", F.lit(0) if chunk is None else chunk)
    local = numbered(Window.partitionBy("_chunk", *group).orderBy(*order), "_rn", "_lnext", cut)
    # out of the numbered rows: the same partitioning, and the shuffle below them is made once for both
    summary_aggs = [(F.max(F.col("_rn") + places) - 1).alias("_n")]
    if next_of:
        summary_aggs.append(F.max(F.when(F.col("_rn") == 1, F.col(next_of))).alias("_head"))
    chunks = local.groupBy("_chunk", *group).agg(*summary_aggs)
    # chunks are numbered in sort order
    by_chunk = Window.partitionBy(*group).orderBy("_chunk")
    cols = [
        F.col("_chunk").alias("_c__chunk"),
        *[F.col(g).alias(f"_c_{g}") for g in group],
        F.coalesce(F.sum("_n").over(by_chunk.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
    ]
    if next_of:
        cols += [F.lead("_head").over(by_chunk).alias("_next_head"), F.first("_head").over(by_chunk).alias("_first_head")]
    c = chunks.select(*cols)
    # null-safe on the group columns: a NULL group is a group too; on the chunk, for no filter on one side to keep the shuffle from being made once
    cond = [F.col("_chunk").eqNullSafe(F.col("_c__chunk"))] + [F.col(g).eqNullSafe(F.col(f"_c_{g}")) for g in group]
    out = local.join(c, cond, "inner").drop(*[f"_c_{x}" for x in ["_chunk", *group]]).withColumn(
        "_rank", (F.col("_before") + F.col("_rn")).cast("long")
    )
    if next_of:
        out = out.withColumn("_next", F.coalesce(F.col("_lnext"), F.col("_next_head"), F.col("_first_head")))
        out = out.drop("_lnext", "_next_head", "_first_head")
    return out.drop("_chunk", "_rn", "_before")


def percentiles(df: DataFrame, value: str, ps: tuple[float, ...], group: list[str]) -> DataFrame:
    """Exact interpolated percentiles ``_p`` (an array) of ``value`` per group, nulls left out.

    Equal values are counted first; distinct ones take their places from ``ranked`` (so no group has to
    fit into one task), and the two neighbours of each rank are picked by a maximum that combines map-side.
    """
    values = df.filter(F.col(value).isNotNull()).select(*group, F.col(value).alias("_v"))
    counted = values.groupBy(*group, "_v").agg(F.count(F.lit(1)).alias("_w"))
    placed = ranked(counted, ["_v"], group, weight="_w", bounds_from=values)
    totals = counted.groupBy(*[F.col(g).alias(f"_t_{g}") for g in group]).agg(F.sum("_w").alias("_total"))
    cond = [F.col(g).eqNullSafe(F.col(f"_t_{g}")) for g in group]
    rows = placed.join(totals, cond)  # one row per group on the right
    first, last = F.col("_rank") - 1, F.col("_rank") - 1 + F.col("_w")
    picks = []
    for i, p in enumerate(ps):
        at = F.lit(float(p)) * (F.col("_total") - 1)
        for name, k in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            picks.append(F.max(F.when((first <= k) & (k < last), F.col("_v"))).alias(f"_{name}{i}"))
    got = rows.groupBy(*group).agg(F.max("_total").alias("_total"), *picks)

    def value_at(i: int, p: float) -> Column:
        at = F.lit(float(p)) * (F.col("_total") - 1)
        return F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * (at - F.floor(at))

    return got.select(*group, F.array(*[value_at(i, p) for i, p in enumerate(ps)]).alias("_p"))
