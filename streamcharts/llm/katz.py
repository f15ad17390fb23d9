"""Katz backoff language model: trained on part of the documents, scores all of them.

A text is its words, lower-cased A-Z, and one end. The model is a bigram model (a third order would shuffle
nearly every token once more; see README). Counts up to ``K`` are discounted by Good and Turing's rule,

    P(w | v) = d(c(v, w)) c(v, w) / c(v)      where training has v w
             = alpha(v) P(w)                   where it has v, but not v w
             = P(w)                            where it does not have v as a context
    P(w)     = d(c(w)) c(w) / N, and the mass left for all unknown words together,

with alpha(v) such that P(. | v) sums to one exactly. Where nothing is left for unseen words (every follower of v
occurs more than K times) the denominator is c(v) + 1; where the counts of counts give valid discounts only up to
a smaller count, or none at all, the rest are d(r) = r / (r + 1).

How it runs. Documents are read once, in chunks of about ``CHUNK`` bytes; a chunk keeps its distinct words and
its texts as numbers into them. Words are dealt to buckets by hash; a bucket adds up its words' counts over all
chunks and tells every chunk the numbers and counts of its own words. Chunks then add up their pairs of words and
deal each distinct one to a bucket by the first word; pairs of a word so frequent that it would fill a bucket are
dealt by the second word, too. A bucket adds up its pairs, stores them (the n-gram table, one row of packed columns a
bucket) and answers each chunk with the counts of the chunk's pairs, in the order in which these came. What depends on
the discounts, known only when all buckets are counted, is kept symbolic: contexts that the chunk has unseen pairs of
come with their statistics. The last step brings a chunk's texts and answers together. No step holds more than a
chunk or a bucket, and no count is cut off. A chunk and a bucket exchange one row each way, whatever they share; work
in a bucket is one sort of what it gets.

Packed columns: 64-bit integers as byte planes under zstd, so that small numbers take little room.

Defined results: null text is empty and has one token, the end; a null identifier trains; repeated rows count and
score each for itself; an empty table gives an empty result; without training rows every token is unknown and P is
one (log 0); other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamcharts.llm.common import in_batches, written
from streamcharts.llm.near_dedup import _mix
from streamcharts.llm.words import pieces, words_of

K = 5                    # counts up to this are discounted
CHUNK = 12 << 20         # bytes of text in a chunk, but for a longer text
ROWS = 100_000           # texts in a chunk at most
BUCKET = 2_000_000       # tokens that a bucket gets on average, and words of chunks that a bucket of words gets
FOLDS, FOLD = 7, 2       # held out: crc32 of the identifier modulo FOLDS is FOLD

_U = np.uint64
END = _U(zlib.crc32(b"end of text"))  # no word's hash but by the chance that any two words have
START = -1


def pack(a: np.ndarray) -> bytes:
    planes = np.ascontiguousarray(np.ascontiguousarray(a).astype("<i8", copy=False).view(np.uint8).reshape(-1, 8).T)
    return len(a).to_bytes(8, "little") + pa.Codec("zstd").compress(planes, asbytes=True)


def unpack(b: bytes) -> np.ndarray:
    n = int.from_bytes(b[:8], "little")
    raw = pa.Codec("zstd").decompress(b[8:], 8 * n, asbytes=True) if n else b""
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, n).T).view("<i8").reshape(n)


def _steps(sorted_values: np.ndarray) -> bytes:
    """Sorted integers as their differences."""
    return pack(np.diff(sorted_values, prepend=sorted_values.dtype.type(0)).view(np.int64))


def _sums(b: bytes) -> np.ndarray:
    return np.cumsum(unpack(b))


def _floats(a: np.ndarray) -> bytes:
    return pack(np.ascontiguousarray(a, np.float64).view(np.int64))


def _as_floats(b: bytes) -> np.ndarray:
    return unpack(b).view(np.float64)


def _in_runs(values: np.ndarray, runs: np.ndarray) -> bytes:
    """Values that ascend within runs, as differences there."""
    step = np.diff(values, prepend=0)
    start = np.cumsum(runs) - runs
    step[start] = values[start]
    return pack(step)


def _from_runs(b: bytes, runs: np.ndarray) -> np.ndarray:
    step = unpack(b)
    total, start = np.cumsum(step), np.cumsum(runs) - runs
    return total - np.repeat(total[start] - step[start], runs)


def trains(doc_id) -> bool:
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % FOLDS != FOLD


def _training(ids: list) -> np.ndarray:
    return np.array([trains(i) for i in ids], bool)


def _batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


# ------------------------------------------------------------------ chunks
_CHUNK = ("chunk bigint, ids array<bigint>, lengths binary, tokens binary, words binary, seen binary, n bigint, n_words bigint, "
          "n_train bigint, d_train bigint")
_CHUNK_T = pa.schema([("chunk", pa.int64()), ("ids", pa.list_(pa.int64())), ("lengths", pa.binary()), ("tokens", pa.binary()),
                      ("words", pa.binary()), ("seen", pa.binary()), ("n", pa.int64()), ("n_words", pa.int64()), ("n_train", pa.int64()),
                      ("d_train", pa.int64())])


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a task in runs of about ``CHUNK`` bytes of text, however the batches end."""
    held, size, rows = [], 0, 0

    def gathered() -> pa.RecordBatch:
        whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        held.clear()
        return whole

    for batch in batches:
        for b in pieces(batch, 1, CHUNK // 8):
            n = pc.sum(pc.binary_length(b.column(1))).as_py() or 0
            if held and (size + n > CHUNK or rows + b.num_rows > ROWS):
                yield gathered()
                size = rows = 0
            held.append(b)
            size, rows = size + n, rows + b.num_rows
    if rows:
        yield gathered()


def _numbered(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct words and of the end, sorted; all texts' words and ends as numbers into them; tokens of each text."""
    lists = words_of(texts)
    coded, ends = lists.flatten().dictionary_encode(), np.asarray(lists.offsets) - lists.offsets[0].as_py()
    del lists
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    dictionary, codes = coded.dictionary, np.asarray(coded.indices)
    hashes = np.empty(len(dictionary) + 1, np.uint64)
    hashes[0] = END
    hashes[1:] = np.fromiter(map(xxhash.xxh64_intdigest, dictionary.to_pylist()), np.uint64, len(dictionary))
    real = np.asarray(pc.binary_length(dictionary)) > 0
    kept = real[codes] if len(codes) else np.zeros(0, bool)
    at = ends - np.searchsorted(np.flatnonzero(~kept), ends)
    words, number = np.unique(hashes[np.concatenate([[True], real])], return_inverse=True)
    of_code = np.zeros(len(real), np.int32)
    of_code[real] = number[1:]
    lengths = np.diff(at) + 1
    tokens = np.full(int(lengths.sum()), number[0], np.int32)
    inner = np.ones(len(tokens), bool)
    inner[np.cumsum(lengths) - 1] = False
    tokens[inner] = of_code[codes[kept]] if len(codes) else 0
    return words, tokens, lengths


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    for b in _gathered(batches):
        words, tokens, lengths = _numbered(b.column(1))
        ids = b.column(0).to_pylist()
        train = _training(ids)
        seen = np.bincount(tokens[np.repeat(train, lengths)], minlength=len(words))
        yield _batch(_CHUNK_T, [(number, ids, pack(lengths), pack(tokens), _steps(words), pack(seen), len(tokens), len(words),
                                 int(lengths[train].sum()), int(train.sum()))])
        del words, tokens, lengths, seen
        pa.default_memory_pool().release_unused()
        number += 1


# ------------------------------------------------------------------- words
_WORDS = "bucket int, chunk bigint, words binary, seen binary"
_WORDS_T = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("words", pa.binary()), ("seen", pa.binary())])
_COUNTED = "bucket int, chunk bigint, at binary, count binary, stats array<bigint>"
_COUNTED_T = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("at", pa.binary()), ("count", pa.binary()),
                        ("stats", pa.list_(pa.int64()))])


def _bucket_edges(buckets: int) -> np.ndarray:
    """First hash of each bucket but the first."""
    return np.array([(i << 64) // buckets for i in range(1, buckets)], np.uint64)


def _deal_words(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for chunk, words, seen in zip(*[b.column(k).to_pylist() for k in ("chunk", "words", "seen")], strict=True):
                w, s = _sums(words).view(np.uint64), unpack(seen)
                cut = [0, *np.searchsorted(w, _bucket_edges(buckets)).tolist(), len(w)]
                yield _batch(_WORDS_T, [(i, chunk, _steps(w[x:y]), pack(s[x:y])) for i, (x, y) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if y > x])
    return run


def _stats(counts: np.ndarray, first: list[int]) -> list[int]:
    """What the discounts need: ``first``, then how many have count 1 .. K + 1."""
    return [*first, *[int((counts == r).sum()) for r in range(1, K + 2)]]


def _count_words(table: pa.Table) -> pa.Table:
    bucket = table.column("bucket")[0].as_py()
    parts = [(c, _sums(w).view(np.uint64), unpack(s)) for c, w, s in zip(*[table.column(k).to_pylist() for k in ("chunk", "words", "seen")], strict=True)]
    words, at = np.unique(np.concatenate([w for _, w, _ in parts]), return_inverse=True)
    counts = np.bincount(at, np.concatenate([s for _, _, s in parts]), len(words)).astype(np.int64)
    known = counts[counts > 0]
    # the bucket's own row is its part of the unigram table
    rows = [(bucket, None, _steps(words), pack(counts), _stats(known, [len(words), int(known.sum()), len(known)]))]
    start = 0
    for chunk, w, _ in parts:
        own = at[start:start + len(w)]
        rows.append((bucket, chunk, _steps(own), pack(counts[own]), None))
        start += len(w)
    return pa.Table.from_batches([_batch(_COUNTED_T, rows)])


# --------------------------------------------------------------- discounts
def discounts(counts_of_counts: list[int]) -> np.ndarray:
    """d(0) .. d(K): Katz's discounts for the largest number of counts that gives valid ones; d(0) is not used."""
    n = [0, *counts_of_counts]
    for k in range(K, 0, -1):
        if all(n[r] > 0 for r in range(1, k + 1)):
            over = (k + 1) * n[k + 1] / n[1]
            if over < 1:
                d = [((r + 1) * n[r + 1] / (r * n[r]) - over) / (1 - over) for r in range(1, k + 1)]
                if all(0 < x < 1 for x in d):
                    return np.array([1.0, *d, *[r / (r + 1) for r in range(k + 1, K + 1)]])
    return np.array([1.0, *[r / (r + 1) for r in range(1, K + 1)]])


class Unigrams:
    """P(w) by training count; count 0 is all unknown words together."""

    def __init__(self, total: int, types: int, counts_of_counts: list[int]):
        self.total, self.types = total, types
        d = discounts(counts_of_counts)
        left = sum((1 - d[r]) * r * n for r, n in enumerate(counts_of_counts[:K], 1))
        if left <= 0:  # every word occurs more than K times: one more count for the unknown words
            d, left, size = np.ones(K + 1), 1.0, total + 1
        else:
            size = total
        self.d, self.size, self.unknown = d, size, left / size

    def p(self, counts: np.ndarray) -> np.ndarray:
        c = counts.astype(np.float64)
        return np.where(counts > 0, self.d[np.where(counts <= K, counts, 0)] * c / self.size, self.unknown)


# ------------------------------------------------------------------- pairs
_PAIRS = "bucket int, chunk bigint, kind string, parts array<binary>, ids array<bigint>"
_PAIRS_T = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("kind", pa.string()), ("parts", pa.list_(pa.binary())),
                      ("ids", pa.list_(pa.int64()))])


class Chunk:
    """A chunk's texts, its words' numbers and counts, and how its distinct pairs are dealt. From its rows of kinds text and words."""

    def __init__(self, rows: list[dict], offsets: np.ndarray, d_train: int):
        """offsets: the number of the first word of each bucket of words."""
        text = next(r for r in rows if r["kind"] == "text")
        answers = sorted((r for r in rows if r["kind"] == "words"), key=lambda r: r["bucket"])
        self.ids, self.lengths, self.w = text["ids"], unpack(text["parts"][0]), unpack(text["parts"][1])
        self.number = np.concatenate([_sums(r["parts"][0]) + offsets[r["bucket"]] for r in answers])
        self.count = np.concatenate([unpack(r["parts"][1]) for r in answers])
        # contexts: 0 is the start of a text
        self.v_number, self.v_count = np.concatenate([[START], self.number]), np.concatenate([[d_train], self.count])
        v = np.concatenate([[0], self.w[:-1] + 1])
        v[np.cumsum(self.lengths)[:-1]] = 0
        self.key = v * len(self.number) + self.w  # of each token's pair

    def deal(self, pairs: np.ndarray, buckets: int, full: int) -> None:
        """pairs: the distinct keys, sorted. Sets their order by bucket, where each bucket ends and the contexts' runs in that order."""
        v, w = np.divmod(pairs, len(self.number))
        share = np.maximum(1, -(-self.v_count // full)).astype(np.uint64)  # buckets that a context takes
        to = _mix(_mix(self.v_number.astype(np.uint64))[v] + _mix(self.number.astype(np.uint64))[w] % share[v]) % _U(buckets)
        ordered = np.sort((to << _U(40)) | np.arange(len(pairs), dtype=np.uint64))
        self.order = (ordered & _U((1 << 40) - 1)).astype(np.int64)
        self.v, self.w_of = v[self.order].astype(np.int32), w[self.order].astype(np.int32)
        to = (ordered >> _U(40)).astype(np.int64)
        self.ends = np.searchsorted(to, np.arange(buckets + 1))
        self.runs = np.flatnonzero(np.concatenate([[True], (self.v[1:] != self.v[:-1]) | (to[1:] != to[:-1])]))
        self.run_ends = np.searchsorted(self.runs, self.ends)

    def shares(self) -> Iterator[tuple[int, slice, slice]]:
        """Of each bucket that gets something: its number, its pairs and its runs."""
        for i in np.flatnonzero(np.diff(self.ends)).tolist():
            yield i, slice(self.ends[i], self.ends[i + 1]), slice(self.run_ends[i], self.run_ends[i + 1])


def _deal_pairs(buckets: int, full: int, offsets: np.ndarray, d_train: int):
    """full: contexts above this are dealt by the second word, too."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        c = Chunk(rows, offsets, d_train)
        chunk = rows[0]["chunk"]
        del rows
        # each token's pair, and whether it trains
        tokens = np.sort(c.key * 2 + np.repeat(_training(c.ids), c.lengths))
        c.key = c.w = None
        new = np.flatnonzero(np.concatenate([[True], tokens[1:] >> 1 != tokens[:-1] >> 1]))
        trained = np.add.reduceat(tokens & 1, new)
        pairs = tokens[new] >> 1
        del tokens, new
        c.deal(pairs, buckets, full)
        v, trained = c.v[c.runs], trained[c.order]
        w, w_count = c.number[c.w_of], c.count[c.w_of]
        lengths = np.diff(c.runs, append=len(pairs))
        out = []
        for i, x, r in c.shares():
            out.append((i, chunk, "pairs", [pack(np.diff(c.v_number[v[r]], prepend=0)), pack(c.v_count[v[r]]), pack(lengths[r]),
                                            _in_runs(w[x], lengths[r]), pack(w_count[x]), pack(trained[x])], None))
        pa.default_memory_pool().release_unused()
        return pa.Table.from_batches([_batch(_PAIRS_T, out)])
    return run


def _by_pair(v: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The order by v, then w; where a pair is new in it; the distinct pairs. Overwrites v."""
    low, size = int(v.min()), int(w.max()) + 1
    if (int(v.max()) - low + 1) * size < 1 << 63:
        v -= low
        v *= size
        v += w
        order = np.argsort(v, kind="stable").astype(np.int32)  # chunks come sorted, which this makes use of
        v = v[order]
        new = np.concatenate([[True], v[1:] != v[:-1]])
        gv, gw = np.divmod(v[new], size)
        return order, new, gv + low, gw
    order = np.lexsort((w, v)).astype(np.int32)
    v, w = v[order], w[order]
    new = np.concatenate([[True], (v[1:] != v[:-1]) | (w[1:] != w[:-1])])
    return order, new, v[new], w[new]


def _count_pairs(uni: Unigrams, full: int):
    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        chunks, columns = [], [[] for _ in range(6)]
        for chunk, parts in zip(table.column("chunk").to_pylist(), table.column("parts"), strict=True):
            p = parts.as_py()
            runs = unpack(p[2])
            chunks.append(chunk)
            for held, x in zip(columns, (np.cumsum(unpack(p[0])), unpack(p[1]), runs, _from_runs(p[3], runs), unpack(p[4]),
                                         unpack(p[5]).astype(np.int32)), strict=True):
                held.append(x)
        run_ends, ends = (np.cumsum([0, *map(len, columns[k])]) for k in (0, 3))  # of chunks
        run_v, run_count, runs, w, w_count, trained = (np.concatenate(columns.pop(0)) for _ in range(6))
        order, new, gv, gw = _by_pair(np.repeat(run_v, runs), w)
        del w
        own = np.empty(len(order), np.int32)  # of each pair of a chunk
        own[order] = np.cumsum(new) - 1
        w_count = w_count[order[new]]
        del order, new
        c = np.bincount(own, trained, len(gv)).astype(np.int64)
        del trained
        # contexts, their followers seen in training by count, and the P that these have without a context
        first = np.concatenate([[True], gv[1:] != gv[:-1]])
        ctx = (np.cumsum(first) - 1).astype(np.int32)
        n_ctx = int(ctx[-1]) + 1
        starts = np.cumsum(runs) - runs
        run_ctx = ctx[own[starts]]
        cv = np.empty(n_ctx, np.int64)
        cv[run_ctx] = run_count
        few = np.stack([np.bincount(ctx[c == r], minlength=n_ctx) for r in range(1, K + 1)])
        lower = np.bincount(ctx, np.where(c > 0, uni.p(w_count), 0.0), n_ctx)
        hot = cv > full
        stored = c > 0
        followers = np.bincount(ctx[stored], minlength=n_ctx)
        rows = [(bucket, None, "table", [
            pack(np.diff(gv[first], prepend=0)), pack(followers), _in_runs(gw[stored], followers[followers > 0]), pack(c[stored]), pack(cv),
            *[pack(x) for x in few], _floats(lower)], _stats(c[stored], []))]
        for i in np.flatnonzero(hot):
            rows.append((bucket, None, "hot", None, [int(gv[first][i]), *few[:, i].tolist(), int(lower[i:i + 1].view(np.int64)[0])]))
        # the chunks' answers
        seen = c[own]
        bare = ((few.sum(0) == 0) & ~hot)[run_ctx]  # nothing is left for unseen followers; of hot contexts other buckets know more
        open_ = _open(seen, starts, run_count, full)
        for k, chunk in enumerate(chunks):
            r = slice(run_ends[k], run_ends[k + 1])
            at = run_ctx[r][open_[r]]
            rows.append((bucket, chunk, "pairs", [
                pack(seen[ends[k]:ends[k + 1]]), np.packbits(bare[r]).tobytes() if bare[r].any() else b"", pack(few[:, at].ravel()),
                _floats(lower[at])], None))
        pa.default_memory_pool().release_unused()
        return pa.Table.from_batches([_batch(_PAIRS_T, rows)])
    return run


def _open(seen: np.ndarray, starts: np.ndarray, run_count: np.ndarray, full: int) -> np.ndarray:
    """Runs that come with their context's statistics: it is known and not hot, and some pair is not seen in training."""
    return (np.minimum.reduceat(seen, starts) == 0) & (run_count > 0) & (run_count <= full)


# ----------------------------------------------------------------- scores
_SCORES = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
_SCORES_T = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                       ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])


def log_backoff(d: np.ndarray, cv: np.ndarray, few: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """log10 alpha of contexts. few: followers with count 1 .. K, a row each; lower: the followers' P without a context."""
    left = ((1 - d[1:, None]) * np.arange(1, K + 1)[:, None] * few).sum(0) / cv
    left = np.where(few.sum(0) == 0, 1 / (cv + 1), left)
    return np.log10(left) - np.log10(1 - lower)


def _finish(d: np.ndarray, hot: list[list[int]], buckets: int, full: int, offsets: np.ndarray, uni: Unigrams, d_train: int):
    """hot: number, followers with count 1 .. K and the bits of the followers' P; a row for each bucket that has the context."""
    got = np.array(hot, np.int64).reshape(-1, K + 2)
    hot_number, at = np.unique(got[:, 0], return_inverse=True)
    hot_few = np.stack([np.bincount(at, x, len(hot_number)).astype(np.int64) for x in got[:, 1:K + 1].T])
    hot_lower = np.bincount(at, np.ascontiguousarray(got[:, K + 1]).view(np.float64), len(hot_number))
    log_d = np.log10(np.append(d, 1.0))

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        c = Chunk(rows, offsets, d_train)
        answers = [r["parts"] for r in sorted((r for r in rows if r["kind"] == "pairs"), key=lambda r: r["bucket"])]
        del rows
        by_key = np.argsort(c.key)
        key = c.key[by_key]
        new = np.concatenate([[True], key[1:] != key[:-1]])
        c.deal(key[new], buckets, full)
        pair = np.empty(len(key), np.int32)  # of each token
        pair[by_key] = np.cumsum(new) - 1
        del by_key, key, new
        c.key = None
        seen = np.concatenate([unpack(p[0]) for p in answers])
        v = c.v[c.runs]
        cv, lengths = c.v_count[v], np.diff(c.runs, append=len(seen))
        bare, few, lower = np.zeros(len(v), bool), np.zeros((K, len(v)), np.int64), np.zeros(len(v))
        open_ = _open(seen, c.runs, cv, full)
        for (_, _, r), p in zip(c.shares(), answers, strict=True):
            if p[1]:
                bare[r] = np.unpackbits(np.frombuffer(p[1], np.uint8), count=r.stop - r.start)
            some = np.flatnonzero(open_[r]) + r.start
            few[:, some], lower[some] = unpack(p[2]).reshape(K, -1), _as_floats(p[3])
        is_hot = np.flatnonzero(cv > full)
        if len(is_hot):
            which = np.searchsorted(hot_number, c.v_number[v[is_hot]])
            few[:, is_hot], lower[is_hot] = hot_few[:, which], hot_lower[which]
            bare[is_hot] = few[:, is_hot].sum(0) == 0
            open_[is_hot] = True
        alpha = np.zeros(len(v))  # of unknown contexts nothing is taken
        alpha[open_] = log_backoff(d, cv[open_], few[:, open_], lower[open_])
        size = np.log10(np.maximum(cv + bare, 1))
        value = np.empty(len(seen))
        value[c.order] = np.where(seen > 0, np.log10(np.maximum(seen, 1)) + log_d[np.minimum(seen, K + 1)] - np.repeat(size, lengths),
                                  np.log10(uni.p(c.count))[c.w_of] + np.repeat(alpha, lengths))
        pa.default_memory_pool().release_unused()
        starts = np.cumsum(c.lengths) - c.lengths
        score = np.add.reduceat(value[pair], starts)
        known = np.add.reduceat((c.count > 0).astype(np.int64)[c.w], starts)
        base = np.add.reduceat(np.log10((c.count + 1) / (uni.total + (uni.types + 1)))[c.w], starts)
        return pa.Table.from_arrays([pa.array(x, f.type) for x, f in zip((
            c.ids, ~_training(c.ids), c.lengths, known, np.full(len(c.ids), uni.total), base, score), _SCORES_T, strict=True)], schema=_SCORES_T)
    return run


def _kept(df: DataFrame, name: str) -> DataFrame:
    """``written``; its shuffles' files go when it is written, not when the driver happens to collect garbage."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, "false")
    conf.set(key, "true")
    try:
        return written(df.select("*"), name)
    finally:
        conf.set(key, before)


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_tokens: int = BUCKET) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document."""
    spark = docs.sparkSession
    chunks = written(in_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))).mapInArrow(
        _chunks, _CHUNK), "lm-chunks")
    tokens, entries, d_train = chunks.agg(*[F.coalesce(F.sum(k), F.lit(0)) for k in ("n", "n_words", "d_train")]).first()
    if not tokens:
        return spark.createDataFrame([], _SCORES)

    counted = _kept(chunks.select("chunk", "words", "seen").mapInArrow(_deal_words(max(16, -(-entries // bucket_tokens))), _WORDS).groupBy(
        "bucket").applyInArrow(_count_words, _COUNTED), "lm-unigrams")
    per_bucket = counted.filter("chunk is null").select("bucket", "stats").collect()  # K + 4 numbers a bucket
    total = [sum(x) for x in zip(*[r.stats for r in per_bucket], strict=True)]
    uni = Unigrams(total[1], total[2], total[3:])
    sizes = np.zeros(max(r.bucket for r in per_bucket) + 2, np.int64)
    for r in per_bucket:
        sizes[r.bucket + 1] = r.stats[0]
    offsets = np.cumsum(sizes)[:-1]

    buckets = max(16, -(-tokens // bucket_tokens))
    full = max(1, (uni.total + buckets - 1) // buckets // 4)
    texts = chunks.select(F.lit(0).alias("bucket"), "chunk", F.lit("text").alias("kind"), F.array("lengths", "tokens").alias("parts"), "ids").union(
        counted.filter("chunk is not null").select("bucket", "chunk", F.lit("words"), F.array("at", "count"), F.lit(None).cast("array<bigint>")))
    tables = _kept(texts.groupBy("chunk").applyInArrow(_deal_pairs(buckets, full, offsets, d_train), _PAIRS).groupBy("bucket").applyInArrow(
        _count_pairs(uni, full), _PAIRS), "lm-bigrams")

    seen = tables.filter("kind = 'table'").select("ids").collect()
    d = discounts([sum(x) for x in zip(*[r.ids for r in seen], strict=True)])
    hot = [r.ids for r in tables.filter("kind = 'hot'").select("ids").collect()]  # at most 4 contexts a bucket, in 8 rows
    return texts.union(tables.filter("chunk is not null")).groupBy("chunk").applyInArrow(
        _finish(d, hot, buckets, full, offsets, uni, d_train), _SCORES)
