"""SentencePiece encoding by Gumbel top-k sampling without replacement, and decoding.

A text's lattice holds every way to cut it into pieces of a vocabulary. ``encode`` emits distinct segmentations
drawn without replacement in proportion to their probability: each segmentation has a Gumbel-perturbed log
probability, and a best-first (A*) search over sets of segmentations finds the largest without listing the others.
A set's largest perturbed value is a Gumbel variable at the log of the set's mass, which the lattice gives exactly; the
segmentation that attains it is a sample of the set. A set popped from the queue is split at every unit of the text
into the segmentations that agree before the unit and differ there, whose values are Gumbel variables truncated
at the popped one. The value after the last sample is the threshold of the inclusion probabilities.

No piece crosses a unit (blanks and the word after them, or a character that stands in no longer piece), so a
lattice is a row of small ones, worked out once for each distinct unit of a run of texts, in numpy. Draws are hashes of
the row's key, the sample, the unit and the step: a row's result depends on its key and text alone.

The vocabulary comes from a public model file (``PIECES``, a parameter). Byte-pair models rank their pieces instead of
weighing them; their log probabilities follow Zipf's law, log(1 / (rank + 2)) over the vocabulary. Characters
without a piece become their bytes.

Defined results: null text is empty and has one segmentation, of no pieces; a text with fewer segmentations than asked
has so many rows; a null key is a key; repeated rows give equal results; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from streamcharts.llm.common import in_batches
from streamcharts.llm.words import pieces

PIECES = "/opt/tokenizers/piece_bpe_32k.model"
SAMPLES = 4
SEED = 4
BYTE_COST = 12.0   # natural log; a byte is so much less likely than the first piece
TEXT = 2 << 20    # bytes of text worked on at a time

_U = np.uint64


class Vocabulary:
    """Pieces with a blank for the mark of one, log probabilities, bytes. Small enough to send along with a task."""

    def __init__(self, path: str = PIECES):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.bytes: list[bytes] = [b""] * n
        self.byte_ids = [-1] * 256
        names, scores = {}, {}
        for i in range(n):
            if sp.is_byte(i):
                self.bytes[i] = bytes([int(sp.id_to_piece(i)[3:5], 16)])
                self.byte_ids[self.bytes[i][0]] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                names[i] = sp.id_to_piece(i).replace("▁", " ")
                self.bytes[i] = names[i].encode()
                scores[i] = sp.get_score(i)
        ranks = {i: r for r, (i, s) in enumerate(sorted(scores.items(), key=lambda x: -x[1]))}
        is_rank = all(abs(s - round(s)) < 1e-6 for s in scores.values())
        self.log = np.zeros(n)
        self.log[list(names)] = [-np.log(ranks[i] + 2) if is_rank else scores[i] for i in names]
        self.log[list(names)] -= np.log(np.exp(self.log[list(names)]).sum())
        self.names = names


class _Lattices:
    """What the search needs of a vocabulary: hashes of the pieces by length, the pattern of a unit."""

    def __init__(self, v: Vocabulary):
        self.v = v
        by: dict[int, list[tuple[int, int]]] = {}
        for i, name in v.names.items():
            codes = np.frombuffer(name.encode("utf-32-le"), np.uint32).astype(np.uint64)
            by.setdefault(len(name), []).append((int(list(self.hashes(codes, len(name)))[-1][1][0]), i))
        self.by_length = {n: tuple(np.array(x, t) for x, t in zip(zip(*sorted(p), strict=True), (np.uint64, np.int64), strict=True)) for n, p in by.items()}
        # first place to look for a hash: its piece, -1 for none, -2 for several
        self.slots = {}
        for n, (h, _) in self.by_length.items():
            slots, at = np.full(1 << 18, -1, np.int32), (h >> _U(46)).astype(np.int64)
            slots[at] = np.arange(len(h))
            several, number = np.unique(at, return_counts=True)
            slots[several[number > 1]] = -2
            self.slots[n] = slots
        inner = {c for p in v.names.values() if len(p) > 1 for c in p} - {" "}
        chars = "".join(map(re.escape, sorted(inner)))
        self.unit = re.compile(f" *[{chars}]+| +|[^ {chars}]" if chars else " +|[^ ]", re.DOTALL)
        self.kind = np.zeros(0x110000, np.uint8)  # of a character: 0 stands alone, 1 a blank, 2 inside longer pieces
        self.kind[[ord(c) for c in inner]] = 2
        self.kind[32] = 1
        self.floor = float(v.log[list(v.names)].max()) - BYTE_COST

    def cut(self, texts: list[str]) -> tuple[np.ndarray, pa.StringArray]:
        """Number of units of each text with a blank before it, and the units one after the other (``unit`` on every text)."""
        whole = "".join([f" {t}" for t in texts if t])
        codes = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        kind = self.kind[codes]
        begin = np.ones(len(codes), bool)  # a blank goes on with blanks, an inner character with either
        begin[1:] = ~(((kind[1:] == 1) & (kind[:-1] == 1)) | ((kind[1:] == 2) & (kind[:-1] > 0)))
        sizes = np.array([len(t) + 1 if t else 0 for t in texts], np.int64)
        ends = np.cumsum(sizes)
        begin[(ends - sizes)[sizes > 0]] = True
        at = np.flatnonzero(begin)
        width = 1 + (codes >= 0x80).astype(np.int8) + (codes >= 0x800) + (codes >= 0x10000)
        place = np.concatenate([[0], np.cumsum(width, dtype=np.int64)])[np.append(at, len(codes))].astype(np.int32)
        number = np.diff(np.searchsorted(at, np.concatenate([[0], ends])))
        return number, pa.StringArray.from_buffers(len(at), pa.py_buffer(place), pa.py_buffer(whole.encode()))

    def log(self, segmentation: tuple[int, ...]) -> float:
        return sum(float(self.v.log[p]) if p >= 0 else self.floor * len(chr(-p - 1).encode("utf-8", "surrogatepass")) for p in segmentation)

    @staticmethod
    def hashes(codes: np.ndarray, most: int, left: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each length up to ``most``: the beginnings of runs of codes and their hashes. ``left``: codes up to a run's end."""
        at, h = np.arange(len(codes)), np.zeros(len(codes), np.uint64)
        left = len(codes) - at if left is None else left
        for n in range(1, most + 1):
            go = left[at] >= n
            if not go.all():
                at, h = at[go], h[go]
            h = (h + codes[at + (n - 1)] + _U(1)) * _U(0x9E3779B97F4A7C15)
            yield at, (h ^ (h >> _U(29))) * _U(0xD6E8FEB86659FD93)


class Units:
    """The lattices of a list of distinct units: nodes in a row, edges by the node they lead to."""

    def __init__(self, lat: _Lattices, units: pa.StringArray):
        lengths = np.asarray(pc.utf8_length(units)).astype(np.int64)
        codes = np.frombuffer("".join(units.to_pylist()).encode("utf-32-le"), np.uint32).astype(np.uint64)
        begin = np.cumsum(lengths) - lengths
        self.first_node = begin + np.arange(len(units))       # node of nothing
        self.last_node = self.first_node + lengths
        unit = np.repeat(np.arange(len(units)), lengths)
        left = np.repeat(begin + lengths, lengths) - np.arange(len(codes))  # characters up to the unit's end
        start, end, piece = [], [], []
        for n, (at, h) in enumerate(lat.hashes(codes, max(lat.by_length), left), 1):
            if not len(at) or n not in lat.by_length:
                continue
            known, ids = lat.by_length[n]
            i = lat.slots[n][h >> _U(46)]
            hit = np.flatnonzero(i != -1)
            at, h, i = at[hit], h[hit], i[hit]
            several = np.flatnonzero(i == -2)
            i[several] = np.minimum(np.searchsorted(known, h[several]), len(known) - 1)
            hit = known[i] == h
            node = at[hit] + unit[at[hit]]
            start.append(node), end.append(node + n), piece.append(ids[i[hit]])
        single = np.zeros(len(codes) + len(units), bool)
        for s, e in zip(start, end, strict=True):
            single[s[e - s == 1]] = True
        bare = np.flatnonzero(~single[np.arange(len(codes)) + unit])
        node = bare + unit[bare]
        # a character without a piece: its code, negative
        start.append(node), end.append(node + 1), piece.append(-codes[bare].astype(np.int64) - 1)
        start, end, piece = (np.concatenate([y.astype(np.int32) for y in x]) for x in (start, end, piece))
        order = np.argsort(end, kind="stable").astype(np.int32)
        self.start, end, self.piece = start[order], end[order], piece[order]
        del start, piece, order
        self.log = lat.v.log[np.maximum(self.piece, 0)]
        bare = np.flatnonzero(self.piece < 0)
        code = -self.piece[bare] - 1
        self.log[bare] = lat.floor * (1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000))
        nodes = len(codes) + len(units)
        self.edge = np.searchsorted(end, np.arange(nodes + 1)).astype(np.int32)  # first edge of each node
        # masses, position by position
        total, paths = np.zeros(nodes), np.ones(nodes)
        depth = np.arange(nodes) - np.repeat(self.first_node, lengths + 1)
        by_depth = np.argsort(depth, kind="stable")
        cut = np.searchsorted(depth[by_depth], np.arange(int(depth.max(initial=0)) + 2))
        count = np.diff(self.edge)
        n = count[by_depth]
        begin = np.concatenate([[0], np.cumsum(n, dtype=np.int64)])  # of a node's edges, by depth
        e = np.repeat((self.edge[by_depth] - begin[:-1]).astype(np.int32), n) + np.arange(begin[-1], dtype=np.int32)
        start, log = self.start[e], self.log[e]
        for d in range(1, len(cut) - 1):
            at, k = by_depth[cut[d]:cut[d + 1]], n[cut[d]:cut[d + 1]]
            low, high = begin[cut[d]], begin[cut[d + 1]]
            via, seg = start[low:high], begin[cut[d]:cut[d + 1]] - low
            value = total[via] + log[low:high]
            top = np.maximum.reduceat(value, seg)
            total[at] = top + np.log(np.add.reduceat(np.exp(value - np.repeat(top, k)), seg))
            paths[at] = np.minimum(np.add.reduceat(paths[via], seg), 1e300 / (1 + len(lat.by_length)))
        del e, start, log, begin
        self.total, self.z = total, total[self.last_node]
        self.node_paths, self.paths = paths, paths[self.last_node]
        self.lat = lat
        self.cum = total[self.start]
        self.cum += self.log
        self.cum -= total[end]
        cum = np.cumsum(np.exp(self.cum, out=self.cum))
        np.subtract(cum, np.concatenate([[0.0], cum])[self.edge[end]], out=self.cum)
        self.cum[self.edge[1:][count > 0] - 1] = 2.0  # the last edge takes what rounding leaves

    def sample(self, units: np.ndarray, draw) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A segmentation of each unit: log probability, number of pieces, the pieces one after the other.

        ``draw(rows, step)`` gives numbers in (0, 1).
        """
        log, number = np.zeros(len(units)), np.zeros(len(units), np.int64)
        rows, steps = np.arange(len(units)), []
        node, first = self.last_node[units], self.first_node[units]  # of the rows that go on
        while len(rows):
            u = draw(rows, len(steps))
            e = self.edge[node]
            on = np.flatnonzero(self.cum[e] < u)
            while len(on):
                e[on] += 1
                on = on[self.cum[e[on]] < u[on]]
            steps.append((rows, self.piece[e]))
            log[rows] += self.log[e]
            number[rows] = len(steps)
            node = self.start[e]
            on = np.flatnonzero(node > first)
            rows, node, first = rows[on], node[on], first[on]
        out, last = np.empty(int(number.sum()), np.int32), np.cumsum(number) - 1
        for k, (r, p) in enumerate(steps):  # from the end of a unit to its beginning
            out[last[r] - k] = p
        return log, number, out

    def sample_without(self, unit: int, taken: list[tuple[int, ...]], draw) -> tuple[int, ...]:
        """A segmentation of one unit in proportion to its probability, none of ``taken``."""
        node, out, k = int(self.last_node[unit]), [], 0
        left = [t for t in taken]
        while node > self.first_node[unit]:
            first, last = int(self.edge[node]), int(self.edge[node + 1])
            here, edges, start = float(self.total[node]), range(first, last), self.start[first:last]
            weights = np.exp(self.total[start] + self.log[first:last] - here).tolist()
            paths, piece, sure = self.node_paths[start].tolist(), self.piece[first:last].tolist(), []
            for w, ways, p in zip(weights, paths, piece, strict=True):
                via = [t for t in left if t and t[-1] == p]
                if via:
                    w -= sum(float(np.exp(self.lat.log(t) - here)) for t in via)
                sure.append(max(w, 1e-300) if ways > len(via) else 0.0)
            weights = sure
            u = float(draw(k)) * sum(weights)
            for e, w in zip(edges, weights, strict=True):
                u -= w
                if w and u <= 0:
                    break
            else:
                e = max(zip(weights, edges, strict=True))[1]
            out.append(int(self.piece[e]))
            left = [t[:-1] for t in left if t and t[-1] == out[-1]]
            node, k = int(self.start[e]), k + 1
        return tuple(reversed(out))


def _named(*parts, x: np.ndarray | None = None) -> np.ndarray:
    """The parts of a draw's name, mixed; ``x``: parts before them."""
    x = np.array([0x243F6A8885A308D3], np.uint64) if x is None else x
    for p in parts:
        x = x ^ np.asarray(p).astype(np.uint64)
        x *= _U(0x9E3779B97F4A7C15)
        x ^= x >> _U(32)
        x *= _U(0xD6E8FEB86659FD93)
        x ^= x >> _U(29)
    return x


def _number(x: np.ndarray) -> np.ndarray:
    return ((x >> _U(11)).astype(np.float64) + 0.5) / float(1 << 53)


def _uniform(*parts) -> np.ndarray:
    """Numbers in (0, 1) from the parts of a draw's name."""
    return _number(_named(*parts))


def _one(*parts: int) -> float:
    """The same of a single draw."""
    x, m = 0x243F6A8885A308D3, (1 << 64) - 1
    for p in parts:
        x = (x ^ p) * 0x9E3779B97F4A7C15 & m
        x = (x ^ (x >> 32)) * 0xD6E8FEB86659FD93 & m
        x ^= x >> 29
    return ((x >> 11) + 0.5) / (1 << 53)


class _Sample:
    """One segmentation a text: for each unit its log probability, and where its pieces are in the store."""

    def __init__(self, log: np.ndarray, number: np.ndarray, place: np.ndarray):
        self.log, self.number, self.place = log, number, place


class TopK:
    """Gumbel top-k over the segmentations of a run of texts. Results: ``found``, ``threshold``, ``z``."""

    def __init__(self, lat: _Lattices, texts: list[str], keys: list, k: int, seed: int):
        number, units = lat.cut(texts)
        coded = units.dictionary_encode()
        self.t = np.asarray(coded.indices).astype(np.int64)
        self.units = Units(lat, coded.dictionary)
        self.at = np.concatenate([[0], np.cumsum(number)])
        self.doc = np.repeat(np.arange(len(texts)), number)
        self.i = np.arange(len(self.t)) - self.at[self.doc]
        self.seed = np.array([xxhash.xxh64_intdigest(f"{seed}:{x}") for x in keys], np.uint64)
        self.full = np.flatnonzero(number > 0)
        self.unit_z = self.units.z[self.t]
        self.z = self._per_doc(self.unit_z)
        self.after = self.z[self.doc] - self._before(self.unit_z) - self.unit_z  # mass of the units after each
        self.store: list[np.ndarray] = []
        self.stored = 0
        self._search(k)

    def _per_doc(self, x: np.ndarray, how=np.add, empty: float = 0.0) -> np.ndarray:
        out = np.full(len(self.at) - 1, empty, x.dtype)
        if len(self.full):
            out[self.full] = how.reduceat(x, self.at[self.full])
        return out

    def _before(self, x: np.ndarray) -> np.ndarray:
        """Sum over the units of a text before each."""
        c = np.concatenate([[0.0], np.cumsum(x)])
        return c[:-1] - c[self.at[self.doc]]

    def _keep(self, pieces: np.ndarray) -> int:
        place, self.stored = self.stored, self.stored + len(pieces)
        self.store.append(pieces)
        return place

    def _draw(self, rows: np.ndarray, sample: int):
        named = _named(self.seed[self.doc[rows]], self.i[rows], sample)
        return lambda r, step: _number(_named(step, x=named[r]))

    def _truncated(self, at: np.ndarray, phi: np.ndarray, bound: np.ndarray, stream: int) -> np.ndarray:
        """Gumbel variables at phi, below bound."""
        u = _uniform(self.seed[self.doc[at]], self.i[at], 1000 + stream)
        with np.errstate(divide="ignore", over="ignore"):
            g = phi - np.log(-np.log(u) + np.exp(phi - bound))
        return np.where(phi == -np.inf, -np.inf, np.minimum(g, bound))

    def _front(self, s: _Sample, after: np.ndarray, bound: np.ndarray, stream: int) -> np.ndarray:
        """Largest value of the segmentations that agree with ``s`` before a unit and differ there; units ``after`` a text's."""
        value = np.full(len(self.t), -np.inf)
        at = np.flatnonzero((self.i > after[self.doc]) & (self.units.paths[self.t] > 1) & np.isfinite(bound[self.doc]))
        rest = self.unit_z[at] + np.log(np.maximum(-np.expm1(s.log[at] - self.unit_z[at]), 1e-16))
        value[at] = self._truncated(at, self._before(s.log)[at] + rest + self.after[at], bound[self.doc[at]], stream)
        return value

    def _search(self, k: int) -> None:
        docs, everywhere = np.arange(len(self.at) - 1), np.arange(len(self.t))
        log, number, pieces = self.units.sample(self.t, self._draw(everywhere, 0))
        first = _Sample(log, number, self._keep(pieces) + np.cumsum(number) - number)
        best = self.z - np.log(-np.log(_uniform(self.seed, 2000)))
        self.found = [(docs, first, best)]
        fronts = [(first, self._front(first, np.full(len(docs), -1), best, 0))]
        taken: dict[tuple[int, int], list[tuple[int, ...]]] = {}
        for r in range(1, k + 1):
            tops = np.stack([self._per_doc(v, np.maximum, -np.inf) for _, v in fronts])
            which, best = tops.argmax(0), tops.max(0)
            if r == k:
                self.threshold = best
                return
            open_docs = np.flatnonzero(np.isfinite(best))
            j = np.full(len(docs), len(self.t))
            for f, (_, v) in enumerate(fronts):
                hit = np.flatnonzero((v == best[self.doc]) & (which[self.doc] == f) & np.isfinite(v))
                np.minimum.at(j, self.doc[hit], hit)
            # the same before the unit, another segmentation of it, anything after it
            log, number, place = (np.zeros(len(self.t)), np.zeros(len(self.t), np.int64), np.zeros(len(self.t), np.int64))
            here = j[self.doc]
            for f, (s, _) in enumerate(fronts):
                m = (which[self.doc] == f) & (everywhere < here)
                log[m], number[m], place[m] = s.log[m], s.number[m], s.place[m]
            rest = np.flatnonzero((everywhere > here) & np.isfinite(best)[self.doc])
            log[rest], number[rest], new = self.units.sample(self.t[rest], self._draw(rest, r))
            place[rest] = self._keep(new) + np.cumsum(number[rest]) - number[rest]
            store = self.pieces()
            phis = np.full(len(open_docs), -np.inf)
            for n, d in enumerate(open_docs.tolist()):
                f, u = int(which[d]), int(j[d])
                s, _ = fronts[f]
                got = taken.setdefault((f, u), [tuple(store[s.place[u]:s.place[u] + s.number[u]].tolist())])
                seg = self.units.sample_without(int(self.t[u]), got, lambda step, s=int(self.seed[d]), i=int(self.i[u]), r=r: _one(s, i, r, 5000 + step))
                got.append(seg)
                log[u], number[u], place[u] = self.units.lat.log(seg), len(seg), self._keep(np.array(seg, np.int32))
                # what is left of the popped set
                if self.units.paths[self.t[u]] > len(got):
                    z = self.unit_z[u]
                    left = 1 - sum(np.exp(self.units.lat.log(x) - z) for x in got)
                    phis[n] = s.log[self.at[d]:u].sum() + z + np.log(max(left, 1e-16)) + self.after[u]
            popped = j[open_docs]
            rest_of = self._truncated(popped, phis, best[open_docs], 10 * r + 7)
            for f, (_, values) in enumerate(fronts):
                own = which[open_docs] == f
                values[popped[own]] = rest_of[own]
            s = _Sample(log, number, place)
            self.found.append((open_docs, s, best))
            fronts.append((s, self._front(s, np.where(np.isfinite(best), j - self.at[:-1], 1 << 60), best, 10 * r)))

    def pieces(self) -> np.ndarray:
        self.store = [np.concatenate(self.store)] if self.store else [np.zeros(0, np.int32)]
        return self.store[0]


def _ids(lat: _Lattices, pieces: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Identifiers of pieces, characters without a piece as bytes; and how many each piece has become."""
    bare = np.flatnonzero(pieces < 0)
    size = np.ones(len(pieces), np.int64)
    spelled = [chr(-int(p) - 1).encode("utf-8", "surrogatepass") for p in pieces[bare]]
    size[bare] = [len(b) for b in spelled]
    out = np.repeat(pieces, size)
    if len(bare):
        out[out < 0] = np.array(lat.v.byte_ids)[np.frombuffer(b"".join(spelled), np.uint8)]
    return out, size


_ROWS = "doc_id bigint, sample int, n_ids int, log_prob double, perturbed double, inclusion double, ids binary"


_SPELLED = "text_sha256 string, text_length int"


def _spell(table: list[bytes], ids: bytes) -> str:
    """The text that 32-bit identifiers spell."""
    return b"".join([table[i] for i in np.frombuffer(ids, "<i4").tolist()]).decode("utf-8", "replace")[1:]


def _spelled(table: pa.Array, ids: np.ndarray, begin: np.ndarray, end: np.ndarray) -> Iterator[str]:
    """The texts that identifiers from ``begin`` to ``end`` spell. ``table``: bytes of all pieces."""
    spelled = table.take(pa.array(ids))
    at = np.asarray(pa.Array.from_buffers(pa.int32(), len(ids) + 1, [None, spelled.buffers()[1]]))
    data = memoryview(spelled.buffers()[2] or b"")
    for a, b in zip(at[begin].tolist(), at[end].tolist(), strict=True):
        yield str(data[a:b], "utf-8", "replace")[1:]


@lru_cache(2)
def _lattices(packed: bytes) -> _Lattices:
    import pickle

    return _Lattices(pickle.loads(packed))


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: int = SAMPLES, model: str = PIECES,
           seed: int = SEED, spelled: bool = False) -> DataFrame:
    """doc_id, sample (from 1, by falling perturbed value), n_ids, log_prob (of the segmentation, all summing to 1),
    perturbed (against the text's mass), inclusion (probability under the threshold), ids (32-bit, little-endian).
    ``spelled``: also text_sha256 and text_length (characters) of what the identifiers of each row decode to.
    """
    import pickle

    packed = docs.sparkSession.sparkContext.broadcast(pickle.dumps(Vocabulary(model)))  # a vocabulary, whatever the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lat = _lattices(packed.value)
        table = pa.array(lat.v.bytes, pa.binary())
        for batch in batches:
            for b in pieces(batch, 1, TEXT):
                pa.default_memory_pool().release_unused()
                keys, texts = b.column(0).to_pylist(), [t or "" for t in b.column(1).to_pylist()]
                top = TopK(lat, texts, keys, samples, seed)
                store = top.pieces()
                threshold = top.threshold - top.z
                for n, (open_docs, s, value) in enumerate(top.found, 1):
                    total = np.concatenate([[0], np.cumsum(s.number)])
                    flat = store[np.repeat(s.place - total[:-1], s.number) + np.arange(total[-1])]
                    ids, size = _ids(lat, flat)
                    ends = np.concatenate([[0], np.cumsum(size)])[total][top.at]  # per text
                    ids = ids.astype("<i4")
                    log = np.minimum(top._per_doc(s.log) - top.z, 0.0)[open_docs]
                    inclusion = -np.expm1(-np.exp(np.minimum(log - threshold[open_docs], 700.0)))
                    packed_ids = [ids[ends[d]:ends[d + 1]].tobytes() for d in open_docs.tolist()]
                    columns = [
                        pa.array([keys[d] for d in open_docs.tolist()], pa.int64()), pa.array(np.full(len(open_docs), n, np.int32)),
                        pa.array(np.diff(ends)[open_docs].astype(np.int32)), pa.array(log), pa.array((value - top.z)[open_docs]),
                        pa.array(inclusion), pa.array(packed_ids, pa.binary())]
                    names = ["doc_id", "sample", "n_ids", "log_prob", "perturbed", "inclusion", "ids"]
                    if spelled:
                        digests, lengths = [], []
                        for text in _spelled(table, ids, ends[open_docs], ends[open_docs + 1]):
                            digests.append(hashlib.sha256(text.encode()).hexdigest()), lengths.append(len(text))
                        columns += [pa.array(digests, pa.string()), pa.array(lengths, pa.int32())]
                        names += ["text_sha256", "text_length"]
                    yield pa.RecordBatch.from_arrays(columns, names)

    return in_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))).mapInArrow(
        run, f"{_ROWS}, {_SPELLED}" if spelled else _ROWS)


def decode(encoded: DataFrame, model: str = PIECES, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with ``text``: the text that the identifiers spell."""
    shared = encoded.sparkSession.sparkContext.broadcast(Vocabulary(model).bytes)
    at, names = encoded.columns.index(ids_col), [*encoded.columns, "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for b in batches:
            texts = [None if x is None else _spell(table, x) for x in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], names)

    return in_batches(encoded).mapInArrow(run, StructType([*encoded.schema.fields, StructField("text", StringType())]))
