"""Near-duplicate documents by chosen paths.

A document's set holds the hashes of its five-word shingles. Documents with equal sets form a class that one
representative stands for. Representatives descend a forest: at each node, a few coordinates of the minwise
signature, picked by the node's key, send a document to one child each, so that two documents of similarity s
stay together with about s times the branches per level. Where a node is small, its documents are compared with
one another by signature; a larger one branches again. Independent trees repeat this up to the recall wanted.

A node that cannot be split, thousands of near copies, is not compared pair by pair. Its leader, the document
nearest to the node's commonest signature, is compared with the others (a join on the node, whose tasks Spark can
split); for these comparisons nodes with one leader, of whatever tree, are one cluster. What is then in one component
needs no further comparison. If most of a cluster resembles its leader, or few of it are outside its largest component,
those outside are compared with all of it, in blocks, on the full sets; otherwise each of its nodes branches again by its
own key, so that trees stay independent, up to ``DEPTH`` levels.

Every link is confirmed on the full sets: first one link a document and node, then those between components.
Signatures and full sets lie in buckets by identifier, so that levels and confirmations move rows to them instead.
Components come from chunks of links joined up in a task each, then alternating large-star and small-star steps. Pair work stays near-linear: only pairs
that the signatures hold similar reach the confirmation.

Defined results: null text, empty text and text without words have an empty set and link with nothing; fewer than
five words are one shingle; rows that share an identifier count as one document; rows without one go by a 64-bit hash
of their text, so those of equal texts are one document: they are compared and linked like others, but a component is
numbered by its identifiers only (null if it has none; then the smallest hash is kept); repeated rows and equal texts share a component; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from streamcharts.llm.common import bucketed, in_batches, written
from streamcharts.llm.words import pieces, words_of

WIDTH = 5                  # words of a shingle
SIMILAR = (75, 100)        # linked: 100 * intersection >= 75 * union
COORDINATES = 64           # of a signature
BRANCHES = 4 / 3           # coordinates chosen at a node, on average: pairs below the threshold die out
RECALL = 0.9999            # of a pair at the threshold, over all trees
SMALL = 64                 # documents of a node that is compared exhaustively, or outside its largest component
FEW, BLOCK = 512, 2048     # documents outside that are compared with so many of the cluster at a time
DEPTH = 24                 # levels before the last resort
LIKELY = 0.5               # signatures that agree so often make a candidate (4.6 deviations below the threshold)

CHUNK = 1 << 18            # links that a task joins up at once
PIECE = 2 << 20             # bytes of text worked on at a time

_U = np.uint64
_rng = np.random.default_rng(20_011)
_MULTIPLY = _rng.integers(1, 2**63, COORDINATES, dtype=np.uint64) * _U(2) + _U(1)
_ADD = _rng.integers(0, 2**63, COORDINATES, dtype=np.uint64)
_STEP = [_U(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def trees(recall: float = RECALL) -> int:
    """Trees that keep a pair at the threshold together for two levels with this probability."""
    s, more = SIMILAR[0] / SIMILAR[1], BRANCHES - 1
    met = 1.0
    for _ in range(2):
        met = 1 - (1 - s * met) * (1 - more * s * met)
    return math.ceil(math.log(1 - recall) / math.log(1 - met))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of the texts one after the other, and where each text begins (one more at the end)."""
    lists = words_of(texts)
    coded = lists.flatten().dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in coded.dictionary.to_pylist()], np.uint64)
    codes = np.asarray(coded.indices)
    real = (np.asarray(pc.binary_length(coded.dictionary)) > 0)[codes] if len(codes) else np.zeros(0, bool)
    ends = np.concatenate([[0], np.cumsum(real)])[np.asarray(lists.offsets) - lists.offsets[0].as_py()]
    return (hashes[codes[real]] if len(codes) else np.zeros(0, np.uint64)), ends


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words, at = word_hashes(texts)
    if len(words) >= WIDTH:
        runs = np.zeros(len(words) - WIDTH + 1, np.uint64)
        for k in range(WIDTH):
            runs += _mix(words[k:len(words) - WIDTH + 1 + k] + _STEP[k]) * _STEP[k]
        runs = _mix(runs)
    out = []
    for a, b in zip(at[:-1], at[1:], strict=True):
        if b - a >= WIDTH:
            out.append(np.unique(runs[a:b - WIDTH + 1]))
        elif b > a:
            out.append(np.array([xxhash.xxh64_intdigest(words[a:b].tobytes(), seed=int(b - a))], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _signatures(sets: list[np.ndarray]) -> list[bytes | None]:
    full = [i for i, s in enumerate(sets) if len(s)]
    out: list[bytes | None] = [None] * len(sets)
    if full:
        x = np.concatenate([sets[i] for i in full])
        at = np.concatenate([[0], np.cumsum([len(sets[i]) for i in full])[:-1]])
        sig = np.empty((len(full), COORDINATES), np.uint32)
        for k in range(COORDINATES):
            sig[:, k] = np.minimum.reduceat((x * _MULTIPLY[k] + _ADD[k]) >> _U(32), at)
        for i, row in zip(full, sig, strict=True):
            out[i] = row.tobytes()
    return out


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pa.default_memory_pool().release_unused()
        for b in pieces(batch, 1, PIECE):
            sets = shingle_sets(b.column(1))
            keys = [xxhash.xxh128_digest(s.tobytes()) if len(s) else None for s in sets]
            signed = _signatures(sets)  # low: the lowest byte of each coordinate, which is what small nodes compare
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()),
                 pa.array(signed, pa.binary()), pa.array([None if s is None else s[::4] for s in signed], pa.binary()), b.column(2)],
                ["doc_id", "n_shingles", "key", "sig", "low", "named"])


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pa.default_memory_pool().release_unused()
        for b in pieces(batch, 1, PIECE):
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([s.tobytes() for s in shingle_sets(b.column(1))], pa.binary())], ["id", "full"])


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, COORDINATES)


def _children(node: np.ndarray, sig: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and the keys of their children. A node picks one coordinate, or two, by its key."""
    pick, step = _mix(node + _STEP[0]) % _U(COORDINATES), _mix(node + _STEP[4]) % _U(COORDINATES - 1) + _U(1)
    both = np.flatnonzero(_mix(node ^ _STEP[3]) < _U(int((BRANCHES - 1) * 2**64)))
    rows = np.concatenate([np.arange(len(node)), both])
    pick = np.concatenate([pick, (pick + step)[both] % _U(COORDINATES)])
    value = sig[rows, pick.astype(np.int64)].astype(np.uint64)
    return rows, _mix(_mix(node[rows] ^ _STEP[1]) + value * _STEP[2] + pick * _STEP[3])


def _descend(node: np.ndarray, ids: pa.Array, sig: np.ndarray) -> pa.RecordBatch:
    rows, kids = _children(node, sig)
    return pa.RecordBatch.from_arrays([pa.array(kids.view(np.int64)), ids.take(pa.array(rows))], ["node", "id"])


def _roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sig = _matrix(b.column(1))
        for t in range(trees()):
            yield _descend(np.full(len(sig), _mix(np.array([t + 1], np.uint64))[0]), b.column(0), sig)


def _branch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield _descend(np.asarray(b.column(0)).view(np.uint64), b.column(1), _matrix(b.column(2)))


def _compare_small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Likely pairs of small nodes. ``first``: the likeliest partner of a document among those before it."""
    for batch in batches:
        a, b, first = [], [], []
        members = batch.column("members")
        at, flat = np.asarray(members.offsets), members.values
        ids = np.asarray(flat.field("id"))
        sig = np.frombuffer(b"".join(flat.field("low").to_pylist()), np.uint8).reshape(len(flat), COORDINATES)
        sizes = np.diff(at)
        two = at[:-1][sizes == 2]
        if len(two):
            two = two[(sig[two] == sig[two + 1]).mean(1) >= LIKELY]
            x, y = ids[two], ids[two + 1]
            a.append(np.minimum(x, y)), b.append(np.maximum(x, y)), first.append(np.ones(len(two), bool))
        for s, n in zip(at[:-1][sizes > 2], sizes[sizes > 2], strict=True):
            order = np.argsort(ids[s:s + n], kind="stable")
            own, m = ids[s:s + n][order], sig[s:s + n][order]
            near = (m[:, None, :] == m[None, :, :]).mean(-1)
            i, j = np.nonzero(np.triu(near >= LIKELY, 1))
            if len(i):
                best = np.where(np.tri(n, k=-1, dtype=bool), near, -1.0).argmax(1)
                a.append(own[i]), b.append(own[j]), first.append(best[j] == i)
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (a, b, first)], ["a", "b", "first"])


def _compare_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (node, a, b, sig_a, sig_b) whose signatures are likely."""
    for b in batches:
        if b.num_rows:
            near = (_matrix(b.column(3)) == _matrix(b.column(4))).mean(1) >= LIKELY
            yield b.filter(pa.array(near)).select([0, 1, 2])


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b, full_a, full_b) that the full sets link."""
    for batch in batches:
        hold = []
        for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            if min(len(p), len(q)) * SIMILAR[1] < SIMILAR[0] * max(len(p), len(q)):
                hold.append(False)
                continue
            both = np.concatenate([p, q])
            both.sort()
            common = int((both[1:] == both[:-1]).sum())
            hold.append(SIMILAR[1] * common >= SIMILAR[0] * (len(p) + len(q) - common))
        yield batch.filter(pa.array(hold, pa.bool_())).select([0, 1])


def _compare_full(table: pa.Table) -> pa.Table:
    """Links between the few (``left``) and the others of a node's chunk that are in another component."""
    left, ids, label = (np.asarray(table.column(k)) for k in ("left", "id", "label"))
    sets = [np.frombuffer(x, np.uint64) for x in table.column("full").to_pylist()]
    few, others = np.flatnonzero(left), np.flatnonzero(~left)
    a, b = [], []
    if len(few) and len(others):
        values, at = np.unique(np.concatenate([sets[i] for i in others]), return_inverse=True)
        sizes = np.array([len(sets[i]) for i in others])
        starts = np.cumsum(sizes) - sizes
        for i in few:
            mine = np.zeros(len(values) + 1, bool)
            place = np.searchsorted(values, sets[i])
            place = place[(place < len(values))]
            place = place[np.isin(values[place], sets[i])]
            mine[place] = True
            common = np.add.reduceat(mine[at].astype(np.int64), starts)
            hold = (SIMILAR[1] * common >= SIMILAR[0] * (sizes + len(sets[i]) - common)) & (label[others] != label[i])
            a += [ids[i]] * int(hold.sum())
            b += ids[others[hold]].tolist()
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


_PAIR, _LABEL = "a bigint, b bigint", "id bigint, label bigint"


def _forest(most: int):
    """Links (a, b) to labels: id, the smallest identifier that it reaches by the links of its chunk of at most about ``most``."""

    def labelled(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        a, b = (np.concatenate([np.asarray(x.column(k)) for x in held]) for k in (0, 1))
        ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        a, b, label = at[:len(a)], at[len(a):], np.arange(len(ids))
        while (label[a] != label[b]).any():
            x, y = label[a], label[b]
            np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
            while (label[label] != label).any():
                label = label[label]
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(ids[label])], ["id", "label"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= most:
                yield labelled(held)
                held, n = [], 0
        if n:
            yield labelled(held)

    return run


def components(links: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """id, label: the smallest id reachable, for every id in ``links`` (a, b).

    Links are joined up in chunks first, each in a task. More than one chunk: what these find goes through star steps.
    """
    links = links.filter("a <> b")
    n = links.count()
    labels = written(links.coalesce(max(1, math.ceil(n / chunk))).mapInArrow(_forest(chunk), _LABEL), "cc")
    if n < chunk:
        return labels
    edges = written(labels.filter("id <> label").select(F.col("id").alias("u"), F.col("label").alias("v")).distinct(), "cc")

    def star(e: DataFrame, both: bool) -> DataFrame:
        sym = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v"))) if both else e
        low = sym.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        met = sym.join(low, "u")
        out = met.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")) if both else met.select(
            F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        return out.filter("u <> v").distinct()

    def mark(e: DataFrame):
        return e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    before = mark(edges)
    while before[0]:
        edges = written(star(written(star(edges, True), "cc"), False), "cc")
        now = mark(edges)
        if now == before:
            break
        before = now
    # every edge now leads from a node to the smallest of its component
    return written(edges.select(F.col("u").alias("id"), F.col("v").alias("label")).unionByName(
        edges.select(F.col("v").alias("id"), F.col("v").alias("label")).distinct()), "cc")


class _Search:
    """The state of one search: representatives, their full sets and the components found so far."""

    def __init__(self, docs: DataFrame, signs: DataFrame):
        self.spark: SparkSession = docs.sparkSession
        self.docs = docs
        # by identifier: each level meets signatures and sets by it
        self.reps = bucketed(signs.filter("n_shingles > 0").groupBy("key").agg(
            F.min("doc_id").alias("id"), F.first("sig").alias("sig"), F.first("low").alias("low")).select("id", "sig", "low"), "near-reps", "id")
        self.labels = self.spark.createDataFrame([], _LABEL)
        self.sets: DataFrame | None = None

    def with_sets(self, ids: DataFrame) -> None:
        """Full sets of the representatives that may be compared, written once, by identifier."""
        ids = ids.select(F.col("id").alias("_near_id")).distinct()
        self.sets = bucketed(self.docs.join(ids, F.col("doc_id") == F.col("_near_id"), "left_semi").mapInArrow(
            _full_sets, "id bigint, full binary"), "near-sets", "id", distinct=True)

    def apart(self, pairs: DataFrame) -> DataFrame:
        """Pairs whose ends are not in one component yet."""
        la = self.labels.select(F.col("id").alias("a"), F.col("label").alias("_la"))
        lb = self.labels.select(F.col("id").alias("b"), F.col("label").alias("_lb"))
        return pairs.join(la, "a", "left").join(lb, "b", "left").filter(
            F.coalesce("_la", "a") != F.coalesce("_lb", "b")).select("a", "b")

    def confirm(self, pairs: DataFrame) -> None:
        """Add the pairs that the full sets link, and bring the components up to date.

        Sets of the ends a, which may be few and common, are dealt out again, so that Spark can split the join with them.
        """
        pairs = written(pairs.distinct(), "near-asked")
        fb = self.sets.select(F.col("id").alias("b"), F.col("full").alias("full_b"))
        ids = pairs.select(F.col("a").alias("id")).distinct()
        fa = self.sets.join(ids, "id", "left_semi").select(F.col("id").alias("a"), F.col("full").alias("full_a"))
        held = pairs.join(fb, "b").join(fa, "a").select("a", "b", "full_a", "full_b").mapInArrow(_confirm, _PAIR)
        self.add(held)

    def add(self, held: DataFrame) -> None:
        new = written(held.distinct(), "near-links")
        if not new.isEmpty():
            # what is known is a forest of labels: only these and the new links are joined up
            known = self.labels.filter("id <> label").select(F.col("id").alias("a"), F.col("label").alias("b"))
            self.labels = components(known.unionByName(new))


def _nodes(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (node, id, n) of small and of large nodes; nodes of one document are gone."""
    sizes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    live = written(rows.join(sizes, "node"), "near-nodes")
    return live.filter(F.col("n") <= SMALL), live.filter(F.col("n") > SMALL)


def _small_pairs(search: _Search, small: DataFrame) -> DataFrame:
    members = small.select("node", "id").join(search.reps.select("id", "low"), "id").groupBy("node").agg(
        F.collect_list(F.struct("id", "low")).alias("members"))
    return written(members.select("members").mapInArrow(_compare_small, f"{_PAIR}, first boolean").groupBy("a", "b").agg(
        F.max("first").alias("first")), "near-pairs")


def _nearest(table: pa.Table) -> pa.Table:
    """Of a node's chunk, the document that agrees most with the commonest value of each coordinate."""
    sig = _matrix(table.column("sig").combine_chunks())
    agree = np.zeros(len(sig), np.int64)
    for k in range(COORDINATES):
        values, at, n = np.unique(sig[:, k], return_inverse=True, return_counts=True)
        agree += at == n.argmax()
    ids = np.asarray(table.column("id"))
    best = np.lexsort((ids, -agree))[0]
    return pa.table({"node": table.column("node")[:1], "id": ids[best:best + 1], "agree": agree[best:best + 1]})


def _clusters(search: _Search, large: DataFrame, level: int) -> tuple[DataFrame, DataFrame]:
    """Rows (node, id, leader): nodes with the same leader as one. Rows (node, cluster): the cluster of each node."""
    chunk = F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / BLOCK))
    leaders = large.join(search.reps.select("id", "sig"), "id").withColumn("chunk", chunk).groupBy("node", "chunk").applyInArrow(
        _nearest, "node bigint, id bigint, agree bigint").groupBy("node").agg(
        F.max_by("id", F.struct("agree", -F.col("id"))).alias("leader"))
    leaders = written(leaders.withColumn("cluster", F.xxhash64("leader", F.lit(level))), "near-leaders")
    merged = large.join(leaders, "node").select(F.col("cluster").alias("node"), "id", "leader").distinct()
    return written(merged, "near-clusters"), leaders.select("node", "cluster")


def _star_pairs(search: _Search, clusters: DataFrame) -> DataFrame:
    """Every document of a cluster that resembles its leader: (node, a, b)."""
    heads = clusters.select("node", "leader").distinct().join(
        search.reps.select(F.col("id").alias("leader"), F.col("sig").alias("head")), "leader")
    met = clusters.filter("id <> leader").select("node", "id").join(search.reps.select("id", "sig"), "id").join(heads, "node")
    return written(met.select("node", F.col("leader").alias("a"), F.col("id").alias("b"), "head", "sig").mapInArrow(
        _compare_pairs, f"node bigint, {_PAIR}").distinct(), "near-stars")


def _mixed(search: _Search, clusters: DataFrame, stars: DataFrame) -> DataFrame:
    """Rows (node, id, label, n, few, top, done) of clusters that hold more than one component. few: rows outside
    the largest, top; done: whether these are to be compared with all now."""
    labelled = written(clusters.select("node", "id").join(search.labels, "id", "left").withColumn(
        "label", F.coalesce("label", "id")), "near-labelled")
    parts = labelled.groupBy("node", "label").agg(F.count(F.lit(1)).alias("m")).groupBy("node").agg(
        F.sum("m").alias("n"), F.max(F.struct("m", "label")).alias("most"))
    alike = stars.groupBy("node").agg(F.count(F.lit(1)).alias("alike"))
    nodes = parts.join(alike, "node", "left").select(
        "node", "n", (F.col("n") - F.col("most.m")).alias("few"), F.col("most.label").alias("top"),
        F.coalesce(F.col("alike") * 2 >= F.col("n"), F.lit(False)).alias("_close")).filter("few > 0")
    nodes = nodes.withColumn("done", F.col("_close") | (F.col("few") <= SMALL)).drop("_close")
    return written(labelled.join(nodes, "node"), "near-mixed")


def _few_against_all(search: _Search, mixed: DataFrame) -> DataFrame:
    """Links of the rows outside a cluster's largest component, in blocks: FEW of them against BLOCK rows of it."""
    blocks, chunks = F.ceil(F.col("few") / FEW), F.ceil(F.col("n") / BLOCK)
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    own = lambda n: F.pmod(F.xxhash64("id"), n)
    few = mixed.filter("label <> top").select(
        "node", "id", "label", F.lit(True).alias("left"), own(blocks).alias("block"), upto(chunks).alias("chunk"))
    others = mixed.select("node", "id", "label", F.lit(False).alias("left"), upto(blocks).alias("block"), own(chunks).alias("chunk"))
    return few.unionByName(others).join(search.sets, "id").groupBy("node", "block", "chunk").applyInArrow(_compare_full, _PAIR)


def _own(id_col: str, text_col: str) -> Column:
    """What a row goes by: its identifier, or else a hash of its text."""
    return F.coalesce(F.col(id_col).cast("long"), F.xxhash64(F.lit("no identifier"), F.col(text_col)))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row."""
    return _labelled(docs, id_col, text_col).select(
        F.when(F.col("named"), F.col("own")).alias("doc_id"), "n_shingles", "component_id", "kept")


def _labelled(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """own, named, n_shingles, component_id, kept of every row."""
    docs = docs.select(_own(id_col, text_col).alias("doc_id"), F.col(text_col).alias("text"),
                       F.col(id_col).cast("long").isNotNull().alias("named"))
    signs = written(in_batches(docs).mapInArrow(
        _sign, "doc_id bigint, n_shingles bigint, key binary, sig binary, low binary, named boolean"), "near-signs")
    search = _Search(docs, signs)
    rows = search.reps.select("id", "sig").mapInArrow(_roots, "node bigint, id bigint")
    pairs = None
    for level in range(1, DEPTH + 1):
        small, large = _nodes(rows)
        found = _small_pairs(search, small)
        pairs = found if pairs is None else pairs.unionByName(found)
        if level == 1:
            search.with_sets(found.select(F.col("a").alias("id")).unionByName(found.select(F.col("b").alias("id"))).unionByName(
                large.select("id")))
        if large.isEmpty():
            break
        clusters, cluster_of = _clusters(search, large, level)
        stars = _star_pairs(search, clusters)
        search.confirm(search.apart(stars.select("a", "b")))
        mixed = _mixed(search, clusters, stars)
        done = F.lit(level == DEPTH) | F.col("done")
        if not mixed.filter(done).isEmpty():
            search.add(_few_against_all(search, mixed.filter(done)))
        again = mixed.filter(~done).select(F.col("node").alias("cluster")).distinct()
        if again.isEmpty():
            break
        # the nodes themselves branch, not their clusters: a pair that one tree loses is left to the others
        live = large.join(cluster_of.join(again, "cluster", "left_semi"), "node").select("node", "id")
        rows = live.join(search.reps.select("id", "sig"), "id").select("node", "id", "sig").mapInArrow(_branch, "node bigint, id bigint")
    search.confirm(search.apart(pairs.filter("first").select("a", "b")))
    search.confirm(search.apart(pairs.select("a", "b")))

    classes = signs.filter("n_shingles > 0").groupBy("key").agg(F.min("doc_id").alias("id")).join(
        search.labels, "id", "left").select("key", F.coalesce("label", "id").alias("component"))
    out = signs.drop("sig", "low").join(classes, "key", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    out = out.select(F.col("doc_id").alias("own"), "named", "n_shingles", component.alias("component_id"))
    if signs.filter(~F.col("named")).isEmpty():
        return out.withColumn("kept", F.col("own") == F.col("component_id"))
    heads = out.groupBy("component_id").agg(F.min(F.when(F.col("named"), F.col("own"))).alias("_first"), F.min("own").alias("_any"))
    return out.join(heads, "component_id").select("own", "named", "n_shingles", F.col("_first").alias("component_id"),
                                                  (F.col("own") == F.coalesce("_first", "_any")).alias("kept"))


def kept_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, one of each component, with the columns of ``docs``."""
    stay = written(_labelled(docs, id_col, text_col).filter("kept").groupBy(F.col("own").alias("__near_id")).agg(
        F.count(F.lit(1)).alias("__near_n")), "near-kept")
    kept = docs.withColumn("__near_own", _own(id_col, text_col)).join(stay, F.col("__near_own") == F.col("__near_id"))
    if not stay.filter("__near_n > 1").isEmpty():  # rows that share an identifier: the first of them
        order = Window.partitionBy("__near_id").orderBy(*docs.columns)
        kept = kept.withColumn("__near_n", F.row_number().over(order)).filter("__near_n = 1")
    return kept.select(*docs.columns)
