"""Mixing sources to target weights by pivotal dependent rounding.

``targets`` turns weights into words per source; a document's expected number of copies is its source's
target over the source's size. The whole part is certain, the fraction is a copy probability.
``mix`` rounds the fractions: documents of a source meet in pairs, mass moves from one to the other in
a random direction, in words, until one of the two is integral. Expectations stay as they are and the
words of a pair do not change, so a source's total stays on its target.

Sources are cut into buckets of about ``bucket_rows`` documents by a hash, each bucket is one group of
``applyInPandas`` and leaves at most one fractional document; these residuals meet in the next level of a
reduction tree (``FAN_IN`` buckets a group) until one is left a source. Every level is written to the
shared folder. A hash of seed, document and level orders a group; its draws come from a generator seeded by seed, level,
source and part, so they do not depend on that order. Reruns agree.

The root's residual is what no pair can settle. ``finish="trim"``: the mix takes that document's words
up to the target. ``finish="round"``: it is copied whole with its probability.

Defined results: null text has size 0; a null source is a source, the last; documents without words take
0 words and no part in the pairing; repeated rows are documents of their own; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from streamcharts.llm.common import WORD, text_of, written

FAN_IN = 256
_EPS = 1e-9
_STATE = "doc_id bigint, source string, size bigint, copies int, p double, part bigint, u bigint"


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"),
                       F.regexp_count(text_of(text_col), F.lit(WORD)).cast("long").alias("size"))


def targets(rows: DataFrame, share: float = 1.5, weights: tuple[float, ...] = (3, 1, 2), most: float = 2.0) -> DataFrame:
    """source, source_size, n_docs, target. Weights go round over the sources by code point, null last.

    Sharing the excess of full sources again and again ends at one water level: target = min(cap, level *
    weight). With sources in the order of cap / weight, the level is that of the first source which the
    level of the sources from it on does not fill. One row a source enters these windows.
    """
    per = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    per = per.withColumn("weight", w).withColumn("cap", most * F.col("source_size"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    all_rows = Window.partitionBy(F.lit(1))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    left = share * F.sum("source_size").over(all_rows) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    open_weight = F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    per = per.withColumn("_at", F.row_number().over(order)).withColumn("_level", left / open_weight)
    fits = F.when(F.col("_level") <= F.col("cap") / F.col("weight"), F.struct("_at", "_level"))
    level = F.min(fits).over(all_rows)["_level"]
    return per.withColumn("_to", level).select(
        "source", "source_size", "n_docs",
        F.when(F.col("_to").isNull(), F.col("cap")).otherwise(
            F.least(F.col("cap"), F.col("_to") * F.col("weight"))).alias("target"))


def _pivot(key: tuple, group: pd.DataFrame, seed: int, level: int) -> pd.DataFrame:
    """Pair the documents of a group one after the other; at most one stays fractional."""
    group = group.sort_values(["u", "doc_id", "size"], kind="stable").reset_index(drop=True)
    p, size, copies = group["p"].to_numpy().copy(), group["size"].to_numpy(), group["copies"].to_numpy().copy()
    source, part = key
    name = f"{seed}:{level}:{int(part)}:" + ("n" if source is None else f"s{source}")
    draw = np.random.Generator(np.random.PCG64(xxhash.xxh64_intdigest(name.encode("utf-8", "surrogatepass")))).random(len(p))
    i = -1  # the document that is fractional so far
    for j in range(len(p)):
        if p[j] == 0.0 or p[j] == 1.0 or i < 0:
            i = j if i < 0 and 0.0 < p[j] < 1.0 else i
            continue
        up = min((1 - p[i]) * size[i], p[j] * size[j])    # words that i can take from j
        down = min(p[i] * size[i], (1 - p[j]) * size[j])  # words that j can take from i
        move = up if draw[j] * (up + down) < down else -down
        p[i] += move / size[i]
        p[j] -= move / size[j]
        for k in (i, j):
            if p[k] < _EPS or p[k] > 1 - _EPS:
                p[k] = round(p[k])
        settled_i, settled_j = p[i] in (0.0, 1.0), p[j] in (0.0, 1.0)
        i = -1 if settled_i and settled_j else (j if settled_i else i)
    settled = (p == 0.0) | (p == 1.0)
    group["copies"] = (copies + np.where(settled, p, 0.0)).astype("int32")
    group["p"] = np.where(settled, 0.0, p)
    return group


def _pivots(seed: int, level: int):
    return lambda key, group: _pivot(key, group, seed, level)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", share: float = 1.5,
        weights: tuple[float, ...] = (3, 1, 2), most: float = 2.0, seed: int = 17, bucket_rows: int = 1024,
        finish: str = "trim") -> DataFrame:
    """doc_id, size, source_size, target, copies, taken of every document."""
    rows = sized(docs, id_col, text_col, source_col)
    goal = written(targets(rows, share, weights, most), "mix-targets")
    biggest = goal.agg(F.max("n_docs")).first()[0] or 0
    s, g = rows.alias("s"), goal.alias("g")
    f = F.coalesce(F.col("target") / F.nullif(F.col("source_size"), F.lit(0)), F.lit(0.0))
    state = s.join(g, F.col("s.source").eqNullSafe(F.col("g.source"))).select(
        "doc_id", "s.source", "size", F.floor(f).cast("int").alias("copies"),
        F.when(F.col("size") > 0, f - F.floor(f)).otherwise(0.0).alias("p"),
        F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.ceil(F.col("n_docs") / bucket_rows)).alias("part"),
        F.xxhash64(F.lit(seed + 1), "doc_id").alias("u"))
    state = state.withColumn("p", F.when(F.col("p") < _EPS, 0.0).otherwise(F.col("p")))
    done = []
    parts, level = max(1, math.ceil(biggest / bucket_rows)), 0
    while True:
        state = written(state.groupBy("source", "part").applyInPandas(_pivots(seed, level), _STATE), f"mix-level{level}")
        if parts <= 1:
            break
        done.append(state.filter("p = 0"))
        parts, level = math.ceil(parts / FAN_IN), level + 1
        state = state.filter("p > 0").withColumn("part", F.floor(F.col("part") / FAN_IN)).withColumn(
            "u", F.xxhash64(F.lit(seed + 1 + level), "doc_id"))
    for x in done:
        state = state.unionByName(x)
    chance = F.pmod(F.xxhash64(F.lit(seed + 99), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    rest = F.floor(F.col("p") * F.col("size") + chance) if finish == "trim" else F.lit(0)
    copies = F.col("copies") + (F.lit(0) if finish == "trim" else F.when(chance < F.col("p"), 1).otherwise(0))
    st = state.withColumn("_copies", copies.cast("int")).alias("s")
    return st.join(g, F.col("s.source").eqNullSafe(F.col("g.source"))).select(
        "doc_id", "size", "source_size", "target", F.col("_copies").alias("copies"),
        (F.col("_copies") * F.col("size") + rest).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", **settings) -> DataFrame:
    """The documents of the mix, each as often as it is copied, whole, with the columns of ``docs``."""
    plan = written(mix(docs, id_col, finish="round", **settings).groupBy(F.col("doc_id").alias("__mix_id")).agg(
        F.array_sort(F.collect_list("copies")).alias("__mix_copies")).filter("array_max(__mix_copies) > 0"), "mix-plan")
    left = docs.join(plan, docs[id_col].cast("long").eqNullSafe(plan["__mix_id"]))
    if plan.filter("size(__mix_copies) > 1").isEmpty():
        own = F.col("__mix_copies")[0]
    else:  # rows that share an identifier take its copies one after the other
        own = F.element_at("__mix_copies", F.row_number().over(Window.partitionBy("__mix_id").orderBy(*docs.columns)))
    return left.withColumn("__mix_n", own).filter("__mix_n > 0").withColumn(
        "__mix_copy", F.explode(F.sequence(F.lit(1), F.col("__mix_n")))).select(*[left[c] for c in docs.columns])
