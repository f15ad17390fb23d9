"""Exact top-k search by inner product with two cover trees.

Vectors become integers (floor(256 x)), so scores are exact. The first points of a farthest-point walk over a
bounded sample (``SAMPLE`` rows) are the upper level of the index: every vector goes to the cell of its nearest
pivot, cells of more than ``CHUNK`` rows are cut by a hash. Queries are laid into groups by the same walk, with
fewer pivots. A node stands for its rows by a centre and a covering radius; no query of a node q can score more
than  q.c + |q| r + |c| s + r s  with a row of a node c (r, s: radii of the rows' and the queries' node). A pair of
nodes below the worst k-th score of the query node is left out: first whole chunks against whole query groups, from
their summaries alone, then, where vectors meet, nodes of the two trees. First k-th scores come from the sample.

Queries meet the rows in blocks, chunk by group. Nothing is sampled away: the sample only places pivots and
gives first bounds.

Defined results: a vector that is null, or holds a null or a non-finite component, takes no part, nor does a row
without identifier; vectors of different lengths meet in the components that both have; rows equal in identifier and
vector are one row; a row is no candidate for a query of its own identifier; ties go to the smaller identifier;
components must stay within 2 ** 22 in size after scaling, else an error is raised rather than a sum overflowing;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from streamcharts.llm.common import smallest_hashes, written

SCALE, TOP, EVERY = 256, 5, 50   # fixed values: the contract's scaling, results and queries
SAMPLE, CHUNK, LEAF, FAN = 2_048, 1_024, 64, 16
PIVOTS = 512                     # cells at most; larger cells are cut
_LIMIT = 1 << 22

_RESULT = "query_id bigint, query_no bigint, vec_id bigint, score bigint"


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, v (array of bigint) of the rows that take part."""
    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    sound = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    small = F.forall(x, lambda c: F.abs(c) < _LIMIT / SCALE)
    v = F.when(small, F.transform(x, lambda c: F.floor(c * SCALE).cast("bigint"))).otherwise(
        F.raise_error(F.lit("a component is too large for exact sums")))
    return vectors.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & sound).select(
        F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).dropDuplicates(["vec_id", "v"])


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of integers as rows of ``width``, short ones filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.asarray(column.value_lengths()).astype(np.int64)
    out = np.zeros((len(column), width))
    at = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[np.repeat(np.arange(len(column)), lengths), at] = np.asarray(column.flatten())
    return out


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of x to one row y."""
    d = x - y
    return np.einsum("ij,ij->i", d, d)


def farthest_first(x: np.ndarray, most: int, radius: float = 0.0) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Points of a farthest-point walk until all lie within ``radius``; each row's nearest point and squared distance."""
    points, near, far = [0], np.zeros(len(x), np.int64), _distances(x, x[0])
    while len(points) < most and far.max() > radius * radius:
        i = int(far.argmax())
        d = _distances(x, x[i])
        closer = d < far
        near[closer], far[closer] = len(points), d[closer]
        points.append(i)
    return points, near, far


class Node:
    """A node of a cover tree: rows, centre, covering radius, children of at most half the radius where possible."""

    def __init__(self, x: np.ndarray, rows: np.ndarray):
        own = x[rows]
        centre = own[int(_distances(own, own.mean(0)).argmin())]
        self.rows, self.centre = rows, centre
        self.radius = math.sqrt(_distances(own, centre).max())
        self.size = math.sqrt(float(centre @ centre))
        self.children: list[Node] = []
        if len(rows) > LEAF and self.radius > 0:
            _, near, _ = farthest_first(own, FAN, self.radius / 2)
            self.children = [Node(x, rows[near == k]) for k in range(near.max() + 1)]


def _bound(q: Node, c: Node) -> float:
    b = float(q.centre @ c.centre) + q.size * c.radius + c.size * q.radius + q.radius * c.radius
    return b + 1e-9 * abs(b) + 1e-6


class Search:
    """The best rows of each query so far."""

    def __init__(self, queries: np.ndarray, query_ids: np.ndarray, x: np.ndarray, ids: np.ndarray, worst: np.ndarray, top: int):
        self.q, self.q_ids, self.x, self.ids = queries, query_ids, x, ids
        self.known = worst  # a k-th score that others have found
        self.score = np.full((len(queries), top), -np.inf)
        self.row = np.full((len(queries), top), np.iinfo(np.int64).max)
        self.pairs = 0  # scores worked out

    def worst(self, rows: np.ndarray) -> float:
        return float(np.maximum(self.known[rows], self.score[rows, -1]).min())

    def meet(self, q: Node, c: Node) -> None:
        self.pairs += len(q.rows) * len(c.rows)
        s = self.q[q.rows] @ self.x[c.rows].T  # whole numbers below 2 ** 53: exact
        ids = np.broadcast_to(self.ids[c.rows], s.shape)
        s = np.where(ids == self.q_ids[q.rows][:, None], -np.inf, s)
        s, ids = np.concatenate([self.score[q.rows], s], 1), np.concatenate([self.row[q.rows], ids], 1)
        order = np.lexsort((ids, -s), axis=1)[:, :self.score.shape[1]]
        self.score[q.rows] = np.take_along_axis(s, order, 1)
        self.row[q.rows] = np.take_along_axis(ids, order, 1)

    def run(self, q: Node, c: Node) -> None:
        if _bound(q, c) < self.worst(q.rows):
            return
        if not q.children and not c.children:
            self.meet(q, c)
        elif q.children and (not c.children or q.radius > c.radius):
            for k in q.children:
                self.run(k, c)
        else:
            for k in sorted(c.children, key=lambda k: -_bound(q, k)):
                self.run(q, k)


def top_k(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", top: int = TOP, every: int = EVERY) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose identifier ``every`` divides, its best rows."""
    spark = vectors.sparkSession
    rows = written(quantised(vectors, id_col, vector_col), "search-rows")
    n, width = rows.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    if not n:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    sample = smallest_hashes(rows, SAMPLE, "vec_id").toArrow()
    s_x, s_ids = _matrix(sample.column("v"), width), np.asarray(sample.column("vec_id"))
    walk, _, _ = farthest_first(s_x, min(PIVOTS, math.ceil(n / CHUNK)))
    pivots, coarse = s_x[walk], s_x[walk[:max(1, len(walk) // 16)]]

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column("v"), width)
            size = np.einsum("ij,ij->i", x, x)[:, None]
            near = [(size - 2 * x @ p.T + (p * p).sum(1)).argmin(1) if len(x) else np.zeros(0, np.int64) for p in (pivots, coarse)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *[pa.array(k.astype(np.int32)) for k in near]],
                                             ["vec_id", "v", "cell", "coarse"])

    placed = written(rows.mapInArrow(cells, "vec_id bigint, v array<bigint>, cell int, coarse int"), "search-cells")
    query = F.col("vec_id") % every == 0

    def gathered(df: DataFrame, cell: str, name: str) -> DataFrame:
        """One row a group of at most about CHUNK rows: its rows, centre, radius and the worst first k-th score."""
        sizes = df.groupBy(cell).count()  # at most PIVOTS rows
        cut = F.pmod(F.xxhash64("vec_id", "v"), F.ceil(F.col("count") / CHUNK))
        groups = df.join(F.broadcast(sizes), cell).withColumn("part", cut)

        def pack(t: pa.Table) -> pa.Table:
            x, ids = _matrix(t.column("v"), width), np.asarray(t.column("vec_id"))
            node = Node(x, np.arange(len(x)))
            worst = None
            if name == "group":
                s = x @ s_x.T
                s[ids[:, None] == s_ids[None, :]] = -np.inf
                worst = np.sort(s, 1)[:, -top] if s.shape[1] >= top else np.full(len(x), -np.inf)
            return pa.table({
                name: pa.array([int(t.column(cell)[0].as_py()) * (1 << 32) + t.column("part")[0].as_py()], pa.int64()),
                "ids": pa.array([ids.tolist()], pa.list_(pa.int64())), "x": pa.array([x.astype("<i4").tobytes()], pa.binary()),
                "centre": pa.array([node.centre.tolist()], pa.list_(pa.float64())), "radius": pa.array([node.radius]),
                "worst": pa.array([worst.tolist() if worst is not None else None], pa.list_(pa.float64()))})

        return written(groups.groupBy(cell, "part").applyInArrow(
            pack, f"{name} bigint, ids array<bigint>, x binary, centre array<double>, radius double, worst array<double>"), f"search-{name}")

    chunks, groups = gathered(placed, "cell", "chunk"), gathered(placed.filter(query), "coarse", "group")

    # summaries: chunks against batches of groups
    batch = F.pmod(F.xxhash64("group"), F.lit(max(1, groups.count() // 256)))
    low = F.array_min("worst")
    batches = groups.groupBy(batch.alias("batch")).agg(F.collect_list(
        F.struct("group", "centre", "radius", low.alias("low"))).alias("groups"))
    wide = chunks.select("chunk", "centre", "radius").withColumn(
        "batch", F.explode(F.sequence(F.lit(0), F.lit(max(1, groups.count() // 256) - 1))))

    def left(part: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in part:
            out = []
            for r in b.to_pylist():
                c, g = np.array(r["centre"]), r["groups"]
                q = np.array([x["centre"] for x in g]).reshape(len(g), width)
                rq = np.array([x["radius"] for x in g])
                bound = q @ c + np.sqrt((q * q).sum(1)) * r["radius"] + math.sqrt(c @ c) * rq + rq * r["radius"]
                keep = bound + 1e-9 * np.abs(bound) + 1e-6 >= np.array([x["low"] for x in g])
                out += [(r["chunk"], x["group"]) for x, k in zip(g, keep, strict=True) if k]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], ["chunk", "group"])

    pairs = wide.join(batches, "batch").mapInArrow(left, "chunk bigint, group bigint")
    met = pairs.join(chunks.select("chunk", "ids", "x"), "chunk").join(
        groups.select("group", F.col("ids").alias("q_ids"), F.col("x").alias("q_x"), "worst"), "group").sortWithinPartitions("chunk")

    def search(part: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree: tuple = (None, None, None, None)
        for b in part:
            for i in range(b.num_rows):
                r = {k: b.column(k)[i] for k in ("chunk", "group", "ids", "x", "q_ids", "q_x", "worst")}
                if tree[0] != r["chunk"].as_py():
                    x = np.frombuffer(r["x"].as_py(), "<i4").reshape(-1, width).astype(np.float64)
                    tree = (r["chunk"].as_py(), x, np.asarray(r["ids"].values), Node(x, np.arange(len(x))))
                q = np.frombuffer(r["q_x"].as_py(), "<i4").reshape(-1, width).astype(np.float64)
                q_ids = np.asarray(r["q_ids"].values)
                s = Search(q, q_ids, tree[1], tree[2], np.asarray(r["worst"].values), top)
                s.run(Node(q, np.arange(len(q))), tree[3])
                at, k = np.nonzero(np.isfinite(s.score))
                no = (r["group"].as_py() << 12) + at  # a query's place: rows of one identifier stay apart
                yield pa.RecordBatch.from_arrays([pa.array(y) for y in (
                    q_ids[at], no, s.row[at, k], s.score[at, k].astype(np.int64))], ["query_id", "query_no", "vec_id", "score"])

    found = met.mapInArrow(search, _RESULT)
    order = Window.partitionBy("query_id", "query_no").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).select(
        "query_id", "rank", "vec_id", "score")
