"""Toxicity through a noisy channel.

A writer hides a word by other characters (1d10t), by stretching it (looooser) or by taking it apart
(s c u m). Each suspicious token becomes a lattice of what its characters may stand for; Viterbi decoding
under a character language model of order four finds the likeliest word. Plain words are their own
decoding. The classifier sees the restored words of a text and nothing else.

The character model counts over all documents (a table of 28 ** 4 cells, whatever the size of the corpus).
The classifier is logistic regression over at most ``TERMS`` words, chosen by the likelihood ratio, fitted on
at most ``SAMPLE`` labelled training documents; these two bounds are its parameters.

Defined results: null and empty texts score as a text without any known word; a document without an identifier is
not held out and trains nothing; labels of unknown documents or without a value are left out, of several labels
of a document the largest holds; without training rows of both classes the score is the share of toxic ones (0 if
none); repeated rows score alike; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamcharts.llm.common import in_batches, smallest_hashes, written
from streamcharts.llm.words import word_counts

SAMPLE, TERMS, FOLDS = 20_000, 2_000, 5
LETTERS = 28  # edge of a word, a-z, any other letter
_OTHER = 27

# What a character may stand for besides itself.
STANDS_FOR = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i",
}
_SIGNS = re.escape("".join(STANDS_FOR))
_HIDDEN = re.compile(rf"(?<![^\W\d_]|[{_SIGNS}])[^\W_{_SIGNS}]*[{_SIGNS}][^\W_]*(?:[{_SIGNS}]+[^\W_]*)*")
_STRETCHED = re.compile(r"[^\W\d_]*([^\W\d_])\1\1[^\W\d_]*")
_APART = re.compile(r"(?<![^\W_])[^\W_](?:[ .\-_*][^\W_](?![^\W_])){2,}")
_WORD = re.compile(r"[^\W\d_]+")
_SWAP, _STRETCH, _UNDOUBLE, _JOIN = -0.7, -0.3, -2.0, -0.2  # log probabilities of the channel's steps
_BEAM, _CLOSE = 3, 4.0  # paths of a token that count: so many, within so much of the likeliest


def _code(c: str) -> int:
    return ord(c) - 96 if "a" <= c <= "z" else _OTHER


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of four characters in a row over words with their counts."""
    total = np.zeros(LETTERS**4)
    table = np.full(0x110000, _OTHER, np.int64)
    table[97:123] = np.arange(1, 27)
    table[32] = 0
    for batch in batches:
        rows = [(w, n) for w, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) if w.isalpha()]
        if not rows:
            continue
        text = "   " + "".join(w + "   " for w, _ in rows)
        codes = table[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
        weight = np.repeat([n for _, n in rows], [len(w) + 3 for w, _ in rows])
        gram = ((codes[:-3] * LETTERS + codes[1:-2]) * LETTERS + codes[2:-1]) * LETTERS + codes[3:]
        ends = (codes[3:] != 0) | (codes[2:-1] != 0)  # a letter, or the first edge after one
        total += np.bincount(gram[ends], weight[: len(gram)][ends], LETTERS**4)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at].astype(np.int64))], ["gram", "n"])


def character_model(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """log P(character | three before it), interpolated down to single characters; at most 28 ** 4 rows reach the driver."""
    rows = word_counts(docs, text_col).mapInArrow(_gram_counts, "gram bigint, n bigint").groupBy("gram").agg(
        F.sum("n").alias("n")).toPandas()
    counts = np.zeros(LETTERS**4)
    counts[rows["gram"].to_numpy(dtype=np.int64)] = rows["n"].to_numpy(dtype=np.float64)
    counts = counts.reshape((LETTERS,) * 4)
    p = np.full(LETTERS, 1 / LETTERS)
    for lower in (counts.sum((0, 1, 2)), counts.sum((0, 1)), counts.sum(0), counts):
        p = (lower + 5 * p) / (lower.sum(-1, keepdims=True) + 5)
    return np.log(p).astype(np.float32)


class Restorer:
    """Decodes suspicious tokens under a character model."""

    def __init__(self, model: np.ndarray):
        self.model = model
        self.decode = lru_cache(1 << 16)(self._decode)

    def _decode(self, token: str) -> tuple[str, ...]:
        """The words of the likeliest paths through the token's lattice that end differently."""
        apart = len(token) > 2 and not token[1].isalnum() and token[1] not in STANDS_FOR
        chars = token[::2] if apart else token
        # positions: (letter, length of the run of equal characters)
        runs: list[list] = []
        for c in chars:
            if runs and runs[-1][0] == c and not apart:
                runs[-1][1] += 1
            else:
                runs.append([c, 1])
        states: dict[tuple, tuple[float, str]] = {(0, 0, 0): (0.0, "")}
        for c, n in runs:
            options: list[tuple[str, float]] = []
            for letter, cost in [(c, 0.0)] if c.isalpha() else [(x, _SWAP) for x in STANDS_FOR.get(c, "")]:
                options.append((letter, cost + (0.0 if n == 1 else _UNDOUBLE if n == 2 else 2 * _STRETCH)))
                if n > 1:
                    options.append((letter * 2, cost + (_STRETCH if n > 2 else 0.0)))
            if not c.isalpha():  # a sign may also just stand there
                options.append(("", (8 if c.isdigit() else 2) * _SWAP * n))
            new: dict[tuple, tuple[float, str]] = {}
            for ctx, (score, out) in states.items():
                for add, cost in options:
                    ways = [(ctx, score + cost, out)]
                    if apart and out and ctx[2]:  # a word may end between two characters that stand apart
                        ways.append(((0, 0, 0), score + cost + _JOIN + float(self.model[(*ctx, 0)]), out + " "))
                    for at, s, o in ways:
                        for ch in add:
                            s += float(self.model[(*at, _code(ch))])
                            at = (at[1], at[2], _code(ch))
                        if at not in new or new[at][0] < s:
                            new[at] = (s, o + add)
            states = new
        ends = sorted(((score + float(self.model[(*ctx, 0)]), out) for ctx, (score, out) in states.items()), reverse=True)
        return tuple(w for score, out in ends[:_BEAM] if score > ends[0][0] - _CLOSE for w in out.split())

    def words(self, text: str) -> set[str]:
        """The words of a text and the decodings of its suspicious tokens."""
        text = text.lower()
        found = set(_WORD.findall(text))
        hidden = {m[0].rstrip("!") for m in _HIDDEN.finditer(text)} if not text.isalpha() else set()
        hidden |= {w for w in found if _STRETCHED.fullmatch(w)}
        hidden |= {m[0] for m in _APART.finditer(text)}
        for token in hidden:
            if any(c.isalpha() for c in token):
                found.update(self.decode(token))
        return found


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "toxic") -> DataFrame:
    """text, toxic of the sample: the labelled training documents with the smallest hashes."""
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col))).groupBy(
        F.col(id_col).alias("_label_id")).agg(F.max(label_col).cast("int").alias("toxic"))
    sample = F.broadcast(smallest_hashes(known, SAMPLE, "_label_id"))  # SAMPLE rows at most
    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).join(
        sample, F.col("_id") == F.col("_label_id")).select("_id", "text", "toxic")


def fit(rows: pd.DataFrame, terms: list[str]) -> tuple[float, np.ndarray]:
    """Bias and weights of a logistic regression. ``rows``: toxic, terms (indices of the words present)."""
    y = rows["toxic"].to_numpy(dtype=np.float64)
    rate = (y.sum() + 0.0) / max(1, len(y))
    if not terms or rate in (0.0, 1.0):
        return (math.log(rate / (1 - rate)) if 0 < rate < 1 else (-50.0 if rate == 0 else 50.0)), np.zeros(len(terms))
    at = np.concatenate([np.asarray(t, np.int64) for t in rows["terms"]]) if len(rows) else np.zeros(0, np.int64)
    doc = np.repeat(np.arange(len(rows)), [len(t) for t in rows["terms"]])
    bias, w = math.log(rate / (1 - rate)), np.zeros(len(terms))
    seen = np.bincount(at, minlength=len(terms)) + 1.0
    for _ in range(300):
        z = bias + np.bincount(doc, w[at], len(rows))
        err = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        bias -= 4 * err.mean()
        w -= (np.bincount(at, err[doc], len(terms)) + 0.05 * w) * 2 / seen
        w = np.clip(w, 0, 12)  # the terms were chosen because they speak for the label
    return float(bias), w


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"):
    """The model: characters, words, weights, bias."""
    spark = docs.sparkSession
    chars = character_model(docs, text_col)
    shared = spark.sparkContext.broadcast(chars)  # 28 ** 4 cells of four bytes
    sample = training_rows(docs, labels, id_col, text_col, label_col)

    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        restorer = Restorer(shared.value)
        for b in batches:
            for i, t, y in zip(b["_id"], b["text"], b["toxic"], strict=True):
                found = sorted(restorer.words(t or ""))
                yield pd.DataFrame({"_id": i, "word": [None, *found], "toxic": y})

    seen = written(sample.mapInPandas(words, "_id bigint, word string, toxic int"), "toxic-words")
    n = {r.toxic: r["count"] for r in seen.filter("word is null").groupBy("toxic").count().collect()}
    n1, n0 = sum(v for k, v in n.items() if k), n.get(0, 0)
    if not n1 or not n0:
        return shared, [], np.zeros(0), (-50.0 if not n1 else 50.0)
    c = seen.filter("word is not null").groupBy("word").agg(
        F.sum(F.when(F.col("toxic") != 0, 1).otherwise(0)).alias("a"), F.sum(F.when(F.col("toxic") == 0, 1).otherwise(0)).alias("b"))
    rate = (F.col("a") + F.col("b")) / float(n1 + n0)
    part = lambda k, m: F.when(k > 0, k * F.log(k / (m * rate))).otherwise(0.0)
    rest = lambda k, m: F.when(k < m, (m - k) * F.log((m - k) / (m * (1 - rate)))).otherwise(0.0)
    a, b = F.col("a"), F.col("b")
    ratio = 2 * (part(a, float(n1)) + part(b, float(n0)) + F.when(rate < 1, rest(a, float(n1)) + rest(b, float(n0))).otherwise(0.0))
    terms = sorted(r.word for r in c.filter(a / float(n1) > 3 * b / float(n0)).withColumn("g", ratio).filter("g > 40").orderBy(
        F.desc("g"), "word").limit(TERMS).collect())
    index = spark.createDataFrame([(w, i) for i, w in enumerate(terms)], "word string, at int")
    rows = seen.join(F.broadcast(index), "word", "left").groupBy("_id", "toxic").agg(  # TERMS rows at most
        F.collect_list("at").alias("terms")).select("toxic", "terms").toPandas()  # SAMPLE rows at most
    bias, w = fit(rows, terms)
    return shared, terms, w, bias


def _scorer(model):
    """Texts to log odds."""
    shared, terms, weights, bias = model
    weight = dict(zip(terms, weights.tolist(), strict=True))

    def start():
        restorer, known = Restorer(shared.value), weight.keys()
        return lambda texts: np.array(
            [bias + sum(weight[w] for w in sorted(known & restorer.words(t or ""))) for t in texts.to_pylist()], np.float64)

    return start


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    start = _scorer(learn(docs, labels, id_col, text_col, label_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        odds = start()
        for b in batches:
            s = 1 / (1 + np.exp(-np.clip(odds(b.column(1)), -50, 50)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s)], ["doc_id", "score"])

    scored = in_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))).mapInArrow(
        run, "doc_id bigint, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def clean_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "toxic") -> DataFrame:
    """The documents scored below one half, with the columns of ``docs``."""
    start = _scorer(learn(docs, labels, id_col, text_col, label_col))
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        odds = start()
        for b in batches:
            yield b.filter(pa.array(odds(b.column(at)) < 0))

    return in_batches(docs).mapInArrow(run, docs.schema)
