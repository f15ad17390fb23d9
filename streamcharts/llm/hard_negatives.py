"""Hard negatives by exact inner products, scored with precomputed subset sums (the method of the Four Russians).

Components become integers (floor(256 x)). Candidates are stored as bit planes: one byte holds one bit of eight
neighbouring dimensions. For each group of eight dimensions an anchor has a table of the sums of all 256 subsets of its
components; a plane's byte looks its sum up, and the planes are added with a shift between them, the sign plane negative.
The result is the whole inner product, exact at any size: sums that 62 bits cannot hold are worked out in whole numbers
of any length.

Blocks of anchors meet strips of chunks of candidates, every block every strip, each as one task's work that holds one chunk's
scores at a time and hands on the best of its strip only. The first round finds each anchor's positives; with them
the second has the window of scores that a negative must lie in, and scores again, which costs less than keeping scores.

Defined results: a row without identifier, label or vector, or with a null or non-finite component, takes no part; rows
equal in identifier, label and vector are one row; a row is no candidate for an anchor of its own identifier; vectors of
different lengths meet in the components that both have; ties go to the smaller identifier; an anchor without positives,
and a positive without negatives in its window, give no rows; scores beyond 64 bits are compared as the largest (or
smallest) number of 64 bits; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from streamcharts.llm.common import written

SCALE = 256
CHUNK, BLOCK = 4_096, 512        # candidates and anchors packed together, at most about so many
STRIPS, STRIP = 8, 64            # strips at least, chunks in one at most
AT_ONCE = 64                     # anchors whose tables are held at a time

_MOST = (1 << 63) - 1


def whole(x: np.ndarray) -> np.ndarray:
    """floor(SCALE x) as int64, or as Python's whole numbers where those of a row are too large."""
    scaled = np.floor(x * SCALE) if not x.size or np.abs(x).max() < 2.0**53 else None
    if scaled is not None:
        return scaled.astype(np.int64)
    numbers = [n * SCALE // d for n, d in (float(v).as_integer_ratio() for v in x.ravel())]  # floor of the exact product
    return np.array(numbers, object).reshape(x.shape)


def planes(v: np.ndarray) -> np.ndarray:
    """Bit planes [bits, groups, rows] of rows of integers, the lowest first, the last one the sign."""
    n, width = v.shape
    bits = max([int(abs(y)).bit_length() for y in (v.max(), v.min())], default=0) + 1 if v.size else 1
    groups = -(-max(width, 1) // 8)
    out = np.zeros((bits, groups, n), np.uint8)
    for p in range(bits):
        one = np.zeros((n, groups * 8), np.uint8)
        one[:, :width] = (v >> p) & 1
        out[p] = np.packbits(one, axis=1, bitorder="little").T
    return out


def tables(a: np.ndarray, groups: int, kind: type) -> np.ndarray:
    """Sums of all subsets of each group of eight components: [groups, 256, anchors]."""
    a = np.concatenate([a, np.zeros((len(a), max(0, groups * 8 - a.shape[1])), a.dtype)], 1).astype(kind)
    out = np.zeros((groups, 256, len(a)), kind)
    for g in range(groups):
        for i in range(8):
            out[g, 1 << i:2 << i] = out[g, :1 << i] + a[:, g * 8 + i]
    return out


def scores(a: np.ndarray, p: np.ndarray, largest: int) -> np.ndarray:
    """Inner products [candidates, anchors] of anchors with candidates given as planes; ``largest``: of the anchors' components.

    The kind of number is the smallest that holds every sum that may come up on the way.
    """
    bits, groups, n = p.shape
    bound = (largest * 8 * groups + 1) << bits
    kind = np.int32 if bound < 1 << 31 else np.int64 if bound < 1 << 62 else object
    t = tables(a, groups, kind)
    out, looked = np.zeros((n, len(a)), kind), np.empty((n, len(a)), kind)
    for k in range(bits - 1, -1, -1):
        out *= 2
        for g in range(groups):
            np.take(t[g], p[k, g], axis=0, out=looked, mode="clip")
            out += looked
        if k == bits - 1:
            out *= -1
    return out


def best(s: np.ndarray, at: np.ndarray, most: int) -> np.ndarray:
    """Of the places ``at``, the ``most`` of the highest scores, in order; ties in the order of places."""
    x = s[at]
    if len(at) > most:
        at = at[x >= np.partition(x, len(x) - most)[len(x) - most]]
        x = s[at]
    return at[np.argsort(-x, kind="stable")[:most]]


def _clamped(x) -> int:
    return max(-_MOST, min(_MOST, int(x)))


def sound_rows(vectors: DataFrame, label: Column, id_col: str, vector_col: str) -> DataFrame:
    """vec_id, label, x (array of double) of the rows that take part."""
    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    sound = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return vectors.filter(F.col(id_col).isNotNull() & label.isNotNull() & F.col(vector_col).isNotNull() & sound).select(
        F.col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"), x.alias("x")).dropDuplicates()


def _rows(t: pa.Table, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Identifiers, labels and vectors (filled up with zeros), in the order of the identifiers."""
    t = t.sort_by("vec_id")
    x = np.zeros((t.num_rows, width))
    for i, row in enumerate(t.column("x").to_pylist()):
        x[i, :len(row)] = row
    return np.asarray(t.column("vec_id")), np.asarray(t.column("label")), x


def mine(vectors: DataFrame, label: Column | str = "label", id_col: str = "vec_id", vector_col: str = "embedding", every: int = 100, n_positives: int = 5,
         n_negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors: rows whose identifier ``every`` divides. Positives: an anchor's best rows of its label. Negatives: for each
    positive, the best rows of other labels that score ``low`` to ``high`` per cent of the positive's score.
    """
    spark = vectors.sparkSession
    label = F.col(label) if isinstance(label, str) else label
    rows = written(sound_rows(vectors, label, id_col, vector_col), "negatives-rows")
    n, n_anchors, width = rows.agg(F.count(F.lit(1)), F.count_if(F.col("vec_id") % every == 0), F.max(F.size("x"))).first()
    width = max(1, width or 0)
    n_chunks, n_blocks = max(STRIPS, -(-n // CHUNK)), max(1, -(-n_anchors // BLOCK))
    n_strips = max(STRIPS, -(-n_chunks // STRIP))
    dealt = F.xxhash64("vec_id", "label", "x")

    def pack(t: pa.Table) -> pa.Table:
        ids, labels, x = _rows(t, width)
        p = planes(whole(x))
        return pa.table({"chunk": pa.array([t.column("chunk")[0].as_py()], pa.int64()), "ids": pa.array([ids.astype("<i8").tobytes()]),
                         "labels": pa.array([labels.astype("<i8").tobytes()]), "bits": pa.array([len(p)], pa.int32()), "planes": pa.array([p.tobytes()])})

    def pack_anchors(t: pa.Table) -> pa.Table:
        ids, labels, x = _rows(t, width)
        return pa.table({"block": pa.array([t.column("block")[0].as_py()], pa.int64()), "a_ids": pa.array([ids.astype("<i8").tobytes()]),
                         "a_labels": pa.array([labels.astype("<i8").tobytes()]), "a_x": pa.array([x.astype("<f8").tobytes()])})

    chunks = written(rows.withColumn("chunk", F.pmod(dealt, F.lit(n_chunks))).groupBy("chunk").applyInArrow(
        pack, "chunk bigint, ids binary, labels binary, bits int, planes binary"), "negatives-chunks")
    blocks = written(rows.filter(F.col("vec_id") % every == 0).withColumn("block", F.pmod(dealt, F.lit(n_blocks))).groupBy("block").applyInArrow(
        pack_anchors, "block bigint, a_ids binary, a_labels binary, a_x binary"), "negatives-anchors")
    strips = chunks.withColumn("c_strip", F.col("chunk") % n_strips).withColumn("c_block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)).cast("array<bigint>")))

    def met(blocks: DataFrame, choose: Callable, schema: str) -> DataFrame:
        """What ``choose`` finds for each anchor in each strip."""
        wide = blocks.withColumn("strip", F.explode(F.sequence(F.lit(0), F.lit(n_strips - 1)).cast("array<bigint>")))
        names = [c.split()[0] for c in schema.split(", ")]
        kinds = [pa.int32() if c.endswith(" int") else pa.int64() for c in schema.split(", ")]

        def search(b: pa.Table, c: pa.Table) -> pa.Table:
            found: list[tuple] = []
            if b.num_rows and c.num_rows:
                r = {k: b.column(k)[0].as_py() for k in b.column_names}
                ids, labels = np.frombuffer(r["a_ids"], "<i8"), np.frombuffer(r["a_labels"], "<i8")
                a = whole(np.frombuffer(r["a_x"], "<f8").reshape(-1, width))
                kept = choose(r, ids, labels, _chunks(c, width), a)
                found = [(r["block"], *x) for x in kept]
            return pa.table([pa.array([x[i] for x in found], k) for i, k in enumerate(kinds)], names)

        return wide.groupBy("block", "strip").cogroup(strips.groupBy("c_block", "c_strip")).applyInArrow(search, schema)

    def positives_of(r, ids, labels, parts, a):
        held: dict[int, list] = {}
        for c_ids, c_labels, first, s in _scored(parts, a):
            for k in range(s.shape[1]):
                i = first + k
                at = best(s[:, k], np.flatnonzero((c_labels == labels[i]) & (c_ids != ids[i])), n_positives)
                held[i] = sorted(held.get(i, []) + [(-x, y) for x, y in zip(s[at, k].tolist(), c_ids[at].tolist(), strict=True)])[:n_positives]
        return [(i, int(ids[i]), y, _clamped(-x)) for i, xs in held.items() for x, y in xs]

    found = met(blocks, positives_of, "block bigint, no int, anchor_id bigint, positive_id bigint, positive_score bigint")
    order = Window.partitionBy("block", "no").orderBy(F.desc("positive_score"), "positive_id")
    positives = written(found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= n_positives), "negatives-positives")
    windows = positives.groupBy("block").agg(F.collect_list(F.struct("no", "place", "positive_id", "positive_score")).alias("windows"))

    def negatives_of(r, ids, labels, parts, a):
        wanted: dict[int, list] = {}
        for w in r["windows"]:
            wanted.setdefault(w["no"], []).append((w["place"], w["positive_id"], w["positive_score"]))
        held: dict[tuple, list] = {}
        for c_ids, c_labels, first, s in _scored(parts, a):
            for k in range(s.shape[1]):
                i = first + k
                other = (c_labels != labels[i]) & (c_ids != ids[i])
                for w in wanted.get(i, ()):
                    least, most = -(-low * w[2] // 100), high * w[2] // 100
                    at = best(s[:, k], np.flatnonzero(other & (s[:, k] >= least) & (s[:, k] <= most)), n_negatives) if least <= most else ()
                    if len(at):
                        held[i, w] = sorted(held.get((i, w), []) + [(-x, y) for x, y in zip(s[at, k].tolist(), c_ids[at].tolist(), strict=True)])[:n_negatives]
        return [(i, w[0], int(ids[i]), w[1], y, w[2], _clamped(-x)) for (i, w), xs in held.items() for x, y in xs]

    found = met(blocks.join(windows, "block"), negatives_of, "block bigint, no int, place int, anchor_id bigint, positive_id bigint, negative_id bigint, "
                                                             "positive_score bigint, negative_score bigint")
    order = Window.partitionBy("block", "no", "place").orderBy(F.desc("negative_score"), "negative_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n_negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _chunks(t: pa.Table, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Identifiers, labels and planes of the chunks of a strip."""
    for i in range(t.num_rows):
        r = {k: t.column(k)[i].as_py() for k in ("ids", "labels", "bits", "planes")}
        ids = np.frombuffer(r["ids"], "<i8")
        yield ids, np.frombuffer(r["labels"], "<i8"), np.frombuffer(r["planes"], np.uint8).reshape(r["bits"], -(-width // 8), len(ids))


def _scored(parts: Iterator[tuple], a: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int, np.ndarray]]:
    """Each chunk's identifiers and labels with its scores against ``AT_ONCE`` anchors at a time, from the given one on."""
    largest = max(int(abs(a.max())), int(abs(a.min()))) if a.size else 0
    for ids, labels, p in parts:
        for first in range(0, len(a), AT_ONCE):
            yield ids, labels, first, scores(a[first:first + AT_ONCE], p, largest)
