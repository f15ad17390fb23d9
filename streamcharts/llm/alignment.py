"""Alignment of two tokenizers over the same texts, by divide and conquer at shared cuts.

Each text is encoded twice (A: byte-level pairs with a blank put before the text; B: SentencePiece pieces, which
put that blank themselves). Byte offsets at which a token of A and one of B both end are shared cuts. An interval
of tokens is cut at the shared end nearest to its middle, which bisection in the other tokenizer's ends finds, and both
halves are taken up in turn; an interval without a shared end inside is a group. All intervals of a run of texts go a level
at a time in numpy, so a level costs a few array operations, whatever the number of texts.

Every occurrence of a token of A is linked with every occurrence of a token of B in its group. How many documents
hold a pair of identifiers linked is counted over the whole corpus: a task packs documents into chunks of about
``CHUNK`` bytes and writes a chunk's distinct pairs once, with their documents counted, and each document's links as
places in that list. Pairs are summed by pair, so a frequent pair costs one row a chunk; the highest count of
each identifier of A (no more rows than the vocabulary, hence broadcast) is joined to them, and the counts go back
to the chunks, where the documents' links are looked up in arrays.

Defined results: null and empty texts have no tokens, nor have texts whose tokens of A or B do not spell a blank and the
text (a text holding the mark of blanks itself, for one): zeros and an empty ``groups``; strings of special tokens
are plain text; repeated rows count as documents each and give equal rows; a null identifier is kept; ties in the highest
count all count as best; a very long text is a chunk of its own; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamcharts.llm.common import in_batches, written
from streamcharts.llm.words import pieces

BYTE_PAIRS = "/opt/tokenizers/byte_bpe_50k.json"
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
RUN = 2 << 20      # bytes of text aligned at a time
CHUNK = 8 << 20    # bytes of text whose pairs are listed once
WIDE = 4_096       # links from which a group's identifiers are counted before they are paired

# Fixed value: how byte-level pairs split a text before merging.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_of_char() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones themselves, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokenizers:
    """Both tokenizers, the bytes of their tokens, and identifiers as text."""

    def __init__(self, a_model: bytes, b_model: bytes):
        import sentencepiece

        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        n = self.pieces.get_piece_size()
        self.b = [bytes([int(self.pieces.id_to_piece(i)[3:5], 16)]) if self.pieces.is_byte(i)
                  else self.pieces.id_to_piece(i).replace("▁", " ").encode() for i in range(n)]
        self.encode_a, self.a, self.lossless = self._byte_level(a_model)
        self.a_size = np.array([len(x) for x in self.a], np.int64)
        self.b_size = np.array([len(x) for x in self.b], np.int64)
        # identifiers followed by what may stand after them, for groups as text: , | for A and , ; for B
        self.words = [f"{i}{c}" for c in ",|" for i in range(len(self.a))] + [f"{i}{c}" for c in ",;" for i in range(n)]

    @staticmethod
    def _byte_level(model: bytes):
        """The encoder of A. Merges listed in the order of their identifiers are ranks, which a faster library takes;
        it gives the same tokens (tested), every byte among them. Other files go to their own library."""
        spec = json.loads(model)
        back, vocab = _byte_of_char(), spec["model"]["vocab"]
        table = [b""] * (max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1)
        for t in spec["added_tokens"]:
            table[t["id"]] = t["content"].encode()
        for t, i in vocab.items():
            if all(c in back for c in t):
                table[i] = bytes(back[c] for c in t)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        made = [vocab.get(x + y, -1) for x, y in pairs]
        split = spec.get("pre_tokenizer") or {}
        ranked = (sorted(vocab.values()) == list(range(len(vocab))) and made == list(range(256, len(vocab))) and spec["normalizer"] is None
                  and split == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True})
        if ranked:
            import tiktoken

            return tiktoken.Encoding("a", pat_str=SPLIT, mergeable_ranks={table[i]: i for i in vocab.values()}, special_tokens={}).encode_ordinary, table, True
        from tokenizers import Tokenizer

        own = Tokenizer.from_str(model.decode())
        own.encode_special_tokens = True
        return lambda text: own.encode(text, add_special_tokens=False).ids, table, False


@lru_cache(maxsize=2)
def _tokenizers(a_model: bytes, b_model: bytes) -> Tokenizers:
    return Tokenizers(a_model, b_model)


def _ranges(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The whole numbers of each [start, stop), and the range that each is of."""
    n = np.maximum(stop - start, 0)
    owner = np.repeat(np.arange(len(n)), n)
    return np.arange(n.sum()) + np.repeat(start - (np.cumsum(n) - n), n), owner


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Places in ``ends_a`` of the ends that ``ends_b`` shares, inside the intervals [lo, hi) of places.

    Both lists rise. Each interval looks for the shared end nearest to its middle in widening steps, by bisection in
    ``ends_b``; what was looked up once is remembered. Found: both sides are intervals of the next level. None: a leaf.
    """
    state = np.zeros(len(ends_a), np.int8)  # 0: not looked up, 1: not shared, 2: shared
    cuts = []
    lo, hi = lo[lo < hi], hi[lo < hi]
    while len(lo):
        mid = (lo + hi) >> 1
        cut = np.full(len(lo), -1)
        left, right, reach, open_ = mid.copy(), mid.copy(), 1, np.arange(len(lo))
        while len(open_):
            new_left, new_right = np.maximum(lo[open_], left[open_] - reach), np.minimum(hi[open_], right[open_] + reach)
            (x, ox), (y, oy) = _ranges(new_left, left[open_]), _ranges(right[open_], new_right)
            at, owner = np.concatenate([x, y]), open_[np.concatenate([ox, oy])]
            ask = at[state[at] == 0]
            place = np.minimum(np.searchsorted(ends_b, ends_a[ask]), len(ends_b) - 1)
            state[ask] = 1 + (ends_b[place] == ends_a[ask])
            hit = state[at] == 2
            far = np.full(len(lo), np.iinfo(np.int64).max)
            np.minimum.at(far, owner[hit], 2 * np.abs(at[hit] - mid[owner[hit]]) + (at[hit] < mid[owner[hit]]))
            found = open_[far[open_] < np.iinfo(np.int64).max]
            cut[found] = mid[found] + np.where(far[found] & 1, -1, 1) * (far[found] >> 1)
            left[open_], right[open_] = new_left, new_right
            open_ = open_[(cut[open_] < 0) & ((left[open_] > lo[open_]) | (right[open_] < hi[open_]))]
            reach *= 2
        ok = cut >= 0
        cut, lo, hi = cut[ok], lo[ok], hi[ok]
        cuts.append(cut)
        lo, hi = np.stack([lo, cut + 1], 1).ravel(), np.stack([cut, hi], 1).ravel()
        lo, hi = lo[lo < hi], hi[lo < hi]
    return np.sort(np.concatenate(cuts)) if cuts else np.zeros(0, np.int64)


def _linked(ids_a: np.ndarray, ids_b: np.ndarray, a0: np.ndarray, a1: np.ndarray, b0: np.ndarray, b1: np.ndarray, group_doc: np.ndarray,
            n_pairs: int, n_b: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct linked pairs of each document, as document * n_pairs + a * n_b + b in order, and how often each is linked."""
    size = (a1 - a0) * (b1 - b0)
    small = np.flatnonzero(size <= WIDE)
    k, g = _ranges(np.zeros(len(small), np.int64), size[small])
    width = (b1 - b0)[small][g]
    key = np.sort(group_doc[small][g] * n_pairs + ids_a[a0[small][g] + k // width] * n_b + ids_b[b0[small][g] + k % width])
    first = np.flatnonzero(np.diff(key, prepend=-1))
    key, times = key[first], np.diff(first, append=len(key))
    wide = []
    for g in np.flatnonzero(size > WIDE):
        (a, m), (b, n) = (np.unique(ids[x:y], return_counts=True) for ids, x, y in ((ids_a, a0[g], a1[g]), (ids_b, b0[g], b1[g])))
        wide.append((group_doc[g] * n_pairs + (a[:, None] * n_b + b[None, :]).ravel(), (m[:, None] * n[None, :]).ravel()))
    if wide:
        key, times = (np.concatenate([x, *y]) for x, y in zip((key, times), zip(*wide, strict=True), strict=True))
        order = np.argsort(key)
        key = key[order]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        key, times = key[first], np.add.reduceat(times[order], first)
    return key, times


class Run:
    """The alignment of some texts."""

    def __init__(self, t: Tokenizers, texts: list[str | None], digest: bool):
        n, n_b = len(texts), len(t.b)
        a, b = [], []
        for text, ids in zip(texts, t.pieces.encode([x or "" for x in texts], num_threads=1), strict=True):
            spelt = f" {text}".encode() if text else b""
            own = t.encode_a(f" {text}") if text else []
            same = (t.lossless or b"".join(map(t.a.__getitem__, own)) == spelt) and b"".join(map(t.b.__getitem__, ids)) == spelt
            a.append(own if same else []), b.append(ids if same else [])
        self.n_a, self.n_b = (np.array([len(x) for x in y], np.int64) for y in (a, b))
        ids_a, ids_b = (np.fromiter(chain.from_iterable(x), np.int64, k.sum()) for x, k in ((a, self.n_a), (b, self.n_b)))
        ends_a, ends_b = np.cumsum(t.a_size[ids_a]), np.cumsum(t.b_size[ids_b])
        last = np.cumsum(self.n_a)
        held = self.n_a > 0
        inner = shared_cuts(ends_a, ends_b, (last - self.n_a)[held], last[held] - 1)
        cut = np.sort(np.concatenate([inner, last[held] - 1]))   # last token of A of each group
        a1, b1 = cut + 1, np.searchsorted(ends_b, ends_a[cut]) + 1
        a0, b0 = np.append(0, a1)[:-1], np.append(0, b1)[:-1]
        doc = np.searchsorted(last, cut, side="right")
        self.n_groups = np.bincount(doc, minlength=n)
        key, self.times = _linked(ids_a, ids_b, a0, a1, b0, b1, doc, len(t.a) * n_b, n_b)
        doc, pair = np.divmod(key, len(t.a) * n_b)
        self.n_links = np.bincount(doc, self.times, n).astype(np.int64)
        # a document's distinct pairs, as places in the order of the run's list
        self.pairs, self.place = np.unique(pair, return_inverse=True)
        self.bounds = np.searchsorted(doc, np.arange(n + 1))
        self.groups = self._spelt(t, ids_a, ids_b, a1, b1, b0, digest)

    def _spelt(self, t: Tokenizers, ids_a, ids_b, a1, b1, b0, digest) -> list[str]:
        """Each document's groups as text, or the digest of that."""
        word = np.zeros(len(ids_a) + len(ids_b), np.int64)
        n_a, n_b = len(t.a), len(t.b)
        before = np.repeat(b0, np.diff(a1, prepend=0))            # tokens of B ahead of each token of A
        after = np.repeat(a1, np.diff(b1, prepend=0))             # tokens of A ahead of each token of B
        end_a, end_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
        end_a[a1 - 1], end_b[b1 - 1] = n_a, n_b
        word[np.arange(len(ids_a)) + before] = ids_a + end_a
        word[np.arange(len(ids_b)) + after] = ids_b + end_b + 2 * n_a
        out, at, word = [], 0, word.tolist()
        for n in (self.n_a + self.n_b).tolist():
            text = "".join(map(t.words.__getitem__, word[at:at + n]))[:-1]
            out.append(hashlib.sha256(text.encode()).hexdigest() if digest and n else text)
            at += n
        return out


def _packed(x: np.ndarray) -> bytes:
    """Whole numbers below 2 ** 32 as planes of bytes, so that the high ones compress away."""
    return x.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpacked(x: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(x, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


_DOCUMENT = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string"
_ALIGNED = f"chunk bigint, {_DOCUMENT}, links binary, pair bigint, place int, docs bigint"


def _chunk(number: int, ids: list[pa.Array], runs: list[Run]) -> Iterator[pa.RecordBatch]:
    """The rows of a chunk: its documents, then its distinct pairs with their documents counted."""
    pairs, back = np.unique(np.concatenate([r.pairs for r in runs]), return_inverse=True)
    docs, at = np.zeros(len(pairs), np.int64), 0
    for doc_ids, r in zip(ids, runs, strict=True):
        place = back[at:at + len(r.pairs)][r.place]
        at += len(r.pairs)
        docs += np.bincount(place, minlength=len(pairs))
        links = []
        for x, y in zip(r.bounds[:-1].tolist(), r.bounds[1:].tolist(), strict=True):
            links.append(_packed(np.concatenate([np.diff(place[x:y], prepend=0), r.times[x:y]])))
        n = len(links)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, number)), doc_ids, *[pa.array(x) for x in (r.n_a, r.n_b, r.n_groups.astype(np.int64), r.n_links)],
             pa.array(r.groups, pa.string()), pa.array(links, pa.binary()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64())],
            ["chunk", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "links", "pair", "place", "docs"])
    n = len(pairs)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, number)), *[pa.nulls(n, pa.int64())] * 5, pa.nulls(n, pa.string()), pa.nulls(n, pa.binary()), pa.array(pairs),
         pa.array(np.arange(n, dtype=np.int32)), pa.array(docs)],
        ["chunk", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "links", "pair", "place", "docs"])


def _counted(docs: pa.Table, pairs: pa.Table) -> pa.Table:
    """A chunk's documents with the corpus-wide counts of their links."""
    count, best = np.zeros(pairs.num_rows, np.int64), np.zeros(pairs.num_rows, bool)
    place = np.asarray(pairs.column("place"))
    count[place], best[place] = np.asarray(pairs.column("n")), np.asarray(pairs.column("best"))
    n_best, total = [], []
    for links in docs.column("links").to_pylist():
        at, times = np.split(_unpacked(links), 2)
        at = np.cumsum(at)
        n_best.append(int(times[best[at]].sum())), total.append(int((times * count[at]).sum()))
    kept = [c.split()[0] for c in _DOCUMENT.split(", ")]
    return pa.table([docs.column(c) for c in kept] + [pa.array(n_best, pa.int64()), pa.array(total, pa.int64())], [*kept, "n_best", "count_sum"])


def align(docs: DataFrame, a_path: str = BYTE_PAIRS, b_path: str = PIECES, digest: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups, n_best, count_sum of each document.

    ``groups``: identifiers as ``a1,a2|b1;a3|b2,b3``; with ``digest`` the lowercase SHA-256 of that, worked out where the
    text is, as the text itself is several times the document.
    """
    with open(a_path, "rb") as f, open(b_path, "rb") as g:  # read on the driver; both are a few MB
        a_model, b_model = f.read(), g.read()
    models = docs.sparkSession.sparkContext.broadcast((a_model, b_model))
    n_b = len(Tokenizers(a_model, b_model).b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, task = _tokenizers(*models.value), TaskContext.get().partitionId() << 32
        ids, runs, held, seen = [], [], 0, 0
        for batch in batches:
            for part in pieces(batch, 1, RUN):
                ids.append(part.column(0)), runs.append(Run(t, part.column(1).to_pylist(), digest))
                held += part.column(1).nbytes
                if held >= CHUNK:
                    yield from _chunk(task + seen, ids, runs)
                    ids, runs, held, seen = [], [], 0, seen + 1
                    pa.default_memory_pool().release_unused()
        if runs:
            yield from _chunk(task + seen, ids, runs)

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = written(in_batches(texts).mapInArrow(run, _ALIGNED), "aligned")
    pairs = rows.filter(F.col("pair").isNotNull()).select("chunk", "pair", "place", "docs")
    counts = pairs.groupBy("pair").agg(F.sum("docs").alias("n"))
    highest = counts.groupBy(F.floor(F.col("pair") / n_b).alias("a")).agg(F.max("n").alias("most"))  # rows: identifiers of A
    known = pairs.join(counts, "pair").withColumn("a", F.floor(F.col("pair") / n_b)).join(F.broadcast(highest), "a").select(
        "chunk", "place", "n", (F.col("n") == F.col("most")).alias("best"))
    documents = rows.filter(F.col("pair").isNull()).select(
        F.col("chunk").alias("of_chunk"), *[c.split()[0] for c in _DOCUMENT.split(", ")], "links")
    return documents.groupBy("of_chunk").cogroup(known.groupBy("chunk")).applyInArrow(_counted, f"{_DOCUMENT}, n_best bigint, count_sum bigint")
