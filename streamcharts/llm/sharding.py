"""Sharding by jump consistent hashing, in DataFrame functions only.

A row's shard follows from its key and the number of shards alone: a linear
congruential generator, seeded with the key, draws the shard counts at which the
key would jump to the newest shard; the last jump below the count is its shard.
Adding a shard moves rows only into the new one. There is no ring table.

64-bit products wrap around in the published algorithm; ANSI SQL raises an error
instead, so the generator's state is kept in three limbs of 22, 22 and 20 bits.

Defined results: a null key is a key of its own (0); null text has size 8 and
checksum 0; repeated rows each get a slot of their own; an empty table gives an
empty result; other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streamcharts.llm.common import text_of

MULTIPLIER = 2862933555777941757  # fixed value: the generator of the published algorithm
_M22, _M20 = (1 << 22) - 1, (1 << 20) - 1
_C = (MULTIPLIER & _M22, (MULTIPLIER >> 22) & _M22, MULTIPLIER >> 44)


def _next_key(s: Column) -> tuple[Column, Column, Column]:
    """key * MULTIPLIER + 1 modulo 2**64, limb by limb."""
    k0, k1, k2 = s["k0"], s["k1"], s["k2"]
    r0 = k0 * _C[0] + 1
    r1 = k0 * _C[1] + k1 * _C[0] + F.shiftright(r0, 22)
    r2 = k0 * _C[2] + k1 * _C[1] + k2 * _C[0] + F.shiftright(r1, 22)
    return r0.bitwiseAND(_M22), r1.bitwiseAND(_M22), r2.bitwiseAND(_M20)


def jump_shards(key: Column, counts: tuple[int, ...]) -> Column:
    """Struct with the shard of ``key`` for each number of shards in ``counts`` (fields s0, s1, ...).

    The generator runs once for all counts. The draws needed are about ln(count); the loop has room
    for many more, and a key that would still need another raises an error instead of a wrong shard.
    """
    most = max(counts)
    steps = min(most, int(6 * math.log(most)) + 30)
    key = F.coalesce(key.cast("long"), F.lit(0).cast("long"))

    def state(k0, k1, k2, shards, j):
        return F.struct(k0.alias("k0"), k1.alias("k1"), k2.alias("k2"), j.alias("j"),
                        *[s.alias(f"s{i}") for i, s in enumerate(shards)])

    def step(s: Column, _: Column) -> Column:
        k0, k1, k2 = _next_key(s)
        # (key >> 33) + 1 of the 64-bit key
        top = (F.shiftleft(k2, 11) + F.shiftright(k1, 11) + 1).cast("double")
        to = F.floor((s["j"] + 1).cast("double") * (F.lit(float(1 << 31)) / top)).cast("long")
        moved = state(k0, k1, k2, [F.when(s["j"] < n, s["j"]).otherwise(s[f"s{i}"]) for i, n in enumerate(counts)], to)
        return F.when(s["j"] < most, moved).otherwise(s)

    zero = F.lit(0).cast("long")
    start = state(key.bitwiseAND(_M22), F.shiftrightunsigned(key, 22).bitwiseAND(_M22),
                  F.shiftrightunsigned(key, 44), [zero] * len(counts), zero)
    end = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, step)
    return F.transform(F.array(end), lambda s: F.struct(*[
        F.when(s["j"] >= most, s[f"s{i}"]).otherwise(F.raise_error("jump hash: more draws needed"))
        .cast("int").alias(f"s{i}") for i in range(len(counts))]))[0]


def shard(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text",
          rows_per_chunk: int = 16_384) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row of ``docs``.

    Slots number the rows of a shard from 0 without gaps. A shard is numbered in chunks of about
    ``rows_per_chunk`` rows (by identifier and checksum, so that no shard is one task): a running count inside each
    chunk, plus the rows of the chunks before it. Equal rows are counted before the shuffle and
    spread out again at the end, so a row repeated any number of times is one row to the window.
    """
    text = text_of(text_col)
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text).cast("long") + 8).alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
    ).groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("n"))
    chunks = max(1, math.ceil(docs.count() / (rows_per_chunk * shards)))
    j = jump_shards(F.col("doc_id"), (shards, shards + 1))
    placed = rows.withColumn("_j", j).select(
        "doc_id", "size", "text_crc32", "n", F.col("_j.s0").alias("shard"), F.col("_j.s1").alias("grown_shard"),
        F.pmod(F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(chunks)) + F.col("text_crc32"), F.lit(chunks)).alias("chunk"),
    )
    before = placed.groupBy("shard", "chunk").agg(F.sum("n").alias("n")).select(
        "shard", "chunk",
        (F.sum("n").over(Window.partitionBy("shard").orderBy("chunk")) - F.col("n")).alias("before"),
    )
    here = Window.partitionBy("shard", "chunk").orderBy("doc_id", "text_crc32", "size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    numbered = placed.withColumn("upto", F.sum("n").over(here)).join(before, ["shard", "chunk"])
    last = F.col("before") + F.col("upto") - 1
    return numbered.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        F.explode(F.sequence(last - F.col("n") + 1, last)).alias("slot"), "grown_shard",
    )
