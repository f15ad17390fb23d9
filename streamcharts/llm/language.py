"""Language identification by a convolutional network over bytes.

A text is lower-cased and cut into windows of ``LENGTH`` bytes, which overlap by a filter's width less one byte, so that no
run of bytes is lost. In a window, bytes become vectors, filters of several widths run over them, each filter's largest
value is kept, and a linear layer with softmax gives probabilities of languages. A text's probabilities are
the windows' log probabilities averaged by their bytes of letters. Every window of every text counts.

Training is in numpy on the driver: snippets of labelled texts, at places that a hash picks, ``SNIPPETS`` in all shared
evenly by the languages (``LEAST`` each at least; the ``LANGUAGES`` most frequent values of the column are learned), cut to
random lengths and a part of them mixed with other bytes, so that short and dirty texts are met too; Adam on the cross entropy. The
bounds are parameters; the network does not depend on the size of the corpus.

Filters are applied without multiplying: a filter's answer to two neighbouring bytes is one row of a table of 65,536, so a
filter of width four is two lookups and a sum.

Defined results: null texts and texts without a letter are ``und`` with score 0; documents without identifier take part in
training and are not held out; without labelled texts all are ``und``; repeated rows give equal results; ties go
to the language that sorts first; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from streamcharts.llm.common import in_batches
from streamcharts.llm.words import pieces

FOLDS, FOLD = 4, 2                      # fixed values: held out where crc32 of the identifier modulo FOLDS is FOLD
UNKNOWN = "und"
LENGTH, WIDTHS, FILTERS, VECTOR = 128, (2, 3, 4), 32, 8
LANGUAGES, SNIPPETS, LEAST, PLACES = 256, 8_192, 64, 4
ROUNDS, BATCH, RATE, SEED = 10, 64, 4e-3, 11
AT_ONCE, HELD = 64, 4_096               # windows whose filter answers are held at a time, and whose bytes are
RUN = 1 << 20                           # bytes of text worked on at a time

LETTER = r"\p{L}"
_ORDERS = 1 << 40


class Network:
    """Byte vectors, filters and the linear layer; ``names``: the languages."""

    def __init__(self, names: list[str], rng: np.random.Generator):
        self.names = names
        n = len(WIDTHS) * FILTERS
        self.p = {"vector": rng.normal(0, 0.5, (256, VECTOR)), "out": rng.normal(0, 0.1, (n, len(names))), "bias": np.zeros(len(names))}
        for w in WIDTHS:
            self.p[f"f{w}"] = rng.normal(0, 1 / np.sqrt(w * VECTOR), (w * VECTOR, FILTERS))
            self.p[f"b{w}"] = np.zeros(FILTERS)
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def forward(self, x: np.ndarray) -> tuple[np.ndarray, list, np.ndarray]:
        """Log probabilities of windows [n, LENGTH] of bytes, where each filter was largest, and its answers there."""
        v, seen, largest = self.p["vector"][x], [], []
        for w in WIDTHS:
            spans = np.lib.stride_tricks.sliding_window_view(v.reshape(len(x), -1), w * VECTOR, axis=1)[:, ::VECTOR]
            answers = spans @ self.p[f"f{w}"]
            at = answers.argmax(1)
            seen.append((at, spans[np.arange(len(x))[:, None], at]))
            largest.append(np.take_along_axis(answers, at[:, None, :], 1)[:, 0] + self.p[f"b{w}"])
        pooled = np.concatenate(largest, 1)
        return self.log_odds(pooled), seen, pooled

    def log_odds(self, pooled: np.ndarray) -> np.ndarray:
        z = np.maximum(pooled, 0) @ self.p["out"] + self.p["bias"]
        z -= z.max(1, keepdims=True)
        return z - np.log(np.exp(z).sum(1, keepdims=True))

    def gradient(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross entropy. A filter learns from the one place of each window where it was largest."""
        logs, seen, pooled = self.forward(x)
        d = np.exp(logs)
        d[np.arange(len(y)), y] -= 1
        d /= len(y)
        out = {"out": np.maximum(pooled, 0).T @ d, "bias": d.sum(0), "vector": np.zeros_like(self.p["vector"])}
        back = (d @ self.p["out"].T) * (pooled > 0)
        for i, w in enumerate(WIDTHS):
            g, (at, spans) = back[:, i * FILTERS:(i + 1) * FILTERS], seen[i]
            out[f"f{w}"] = np.einsum("nf,nfk->kf", g, spans)
            out[f"b{w}"] = g.sum(0)
            to = (g[:, :, None] * self.p[f"f{w}"].T[None]).reshape(-1, w, VECTOR)
            rows = x[np.arange(len(x))[:, None, None], at[:, :, None] + np.arange(w)].reshape(-1, w)
            np.add.at(out["vector"], rows.ravel(), to.reshape(-1, VECTOR))
        return out

    def fit(self, x: np.ndarray, y: np.ndarray, rng: np.random.Generator) -> None:
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        steps, total = 0, ROUNDS * -(-len(x) // BATCH)
        for _ in range(ROUNDS):
            order = rng.permutation(len(x))
            for at in range(0, len(x), BATCH):
                rows = order[at:at + BATCH]
                grads = self.gradient(dirtied(x[rows], rng), y[rows])
                steps += 1
                rate = RATE * (1 - (steps - 1) / total)
                for k, g in grads.items():
                    m[k] += 0.1 * (g - m[k])
                    s[k] += 0.001 * (g * g - s[k])
                    self.p[k] -= (rate * (m[k] / (1 - 0.9**steps)) / (np.sqrt(s[k] / (1 - 0.999**steps)) + 1e-8)).astype(np.float32)

    def looked_up(self) -> "Lookups":
        return Lookups(self)


def dirtied(x: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """The windows as shorter texts (half of them) and with some bytes replaced (a quarter of them)."""
    x = x.copy()
    ends = np.where(rng.random(len(x)) < 0.5, rng.integers(8, LENGTH + 1, len(x)), LENGTH)
    x[np.arange(LENGTH)[None, :] >= ends[:, None]] = 0
    hit = (rng.random(x.shape) < 0.15) & (rng.random(len(x)) < 0.25)[:, None] & (x > 0)
    x[hit] = rng.integers(33, 127, hit.sum())
    return x


class Lookups:
    """The filters as tables: for each width its answers to pairs of bytes, and to a last single byte where the width is odd."""

    def __init__(self, net: Network):
        self.net, self.tables = net, {}
        for w in WIDTHS:
            f = net.p[f"f{w}"].reshape(w, VECTOR, FILTERS)
            one = [net.p["vector"] @ f[j] for j in range(w)]
            pairs = [(one[j][:, None, :] + one[j + 1][None, :, :]).reshape(-1, FILTERS) for j in range(0, w - 1, 2)]
            self.tables[w] = (pairs, one[-1] if w % 2 else None)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        """As ``Network.forward``, of any number of windows."""
        out = np.empty((len(x), len(self.net.names)), np.float32)
        for at in range(0, len(x), AT_ONCE):
            part = x[at:at + AT_ONCE]
            two = part[:, :-1].astype(np.intp) * 256 + part[:, 1:]
            largest = []
            for w in WIDTHS:
                pairs, last = self.tables[w]
                n = LENGTH - w + 1
                answers = pairs[0].take(two[:, :n], axis=0)
                for j, t in enumerate(pairs[1:], 1):
                    answers += t.take(two[:, 2 * j:2 * j + n], axis=0)
                if last is not None:
                    answers += last.take(part[:, w - 1:], axis=0)
                largest.append(answers.max(1) + self.net.p[f"b{w}"])
            out[at:at + AT_ONCE] = self.net.log_odds(np.concatenate(largest, 1))
        return out


def windows(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the windows over texts data[offsets[i]:offsets[i + 1]]: the text, the first byte, the bytes up to the text's end."""
    step = LENGTH - max(WIDTHS) + 1
    sizes = np.diff(offsets)
    number = np.maximum(1, -(-(sizes - (LENGTH - step)) // step)) * (sizes > 0)
    text = np.repeat(np.arange(len(sizes)), number)
    start = (np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)) * step
    return text, offsets[:-1][text] + start, sizes[text] - start


def cut(data: np.ndarray, start: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The bytes of windows [n, LENGTH], zeros behind the texts' ends."""
    x = np.take(data, start[:, None] + np.arange(LENGTH)[None, :], mode="clip")
    short = np.flatnonzero(left < LENGTH)
    x[short] *= np.arange(LENGTH)[None, :] < left[short][:, None]
    return x


def letters(x: np.ndarray) -> np.ndarray:
    """Bytes of letters in each window: a to z and all that are not ASCII."""
    return ((x >= 128) | ((x >= 97) & (x <= 122))).sum(1)


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % FOLDS == FOLD, F.lit(False))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Network | None:
    """The network, from labelled documents that are not held out; None without any."""
    known = docs.select(F.col(id_col).alias("doc_id"), F.lower(F.col(text_col)).alias("text"), F.col(lang_col).cast("string").alias("lang")).filter(
        F.col("lang").isNotNull() & ~held_out(F.col("doc_id")) & F.col("text").rlike(LETTER))
    counts = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()
    if not counts:
        return None
    names = sorted(r.lang for r in counts)
    each = max(LEAST, SNIPPETS // len(names))
    # characters are at most four bytes; places are spread over the text by the hash
    place = F.explode(F.sequence(F.lit(1), F.lit(PLACES)))
    snippets = known.filter(F.col("lang").isin(names)).withColumn("place", place).withColumn(
        "order", F.xxhash64("doc_id", "text", "place")).withColumn(
        "from", F.pmod(F.xxhash64("order"), F.greatest(F.lit(1), F.char_length("text") - LENGTH + 1)).cast("int") + 1).select(
        "lang", "order", F.expr(f"substring(text, from, {LENGTH})").alias("snippet"))
    # of a frequent language only orders far below the bound that so many snippets have are dealt out at all
    bound = {r.lang: int(min(1.0, (2 * each + 1000) / (r["count"] * PLACES)) * _ORDERS) for r in counts}
    near = F.create_map(*[F.lit(x) for pair in bound.items() for x in pair])[F.col("lang")]
    first = Window.partitionBy("lang").orderBy("order", "snippet")
    sample = snippets.withColumn("order", F.pmod("order", F.lit(_ORDERS))).filter(F.col("order") < near).withColumn(
        "_rn", F.row_number().over(first)).filter(F.col("_rn") <= each).select("lang", "order", "snippet").toArrow().sort_by(
        [("lang", "ascending"), ("order", "ascending"), ("snippet", "ascending")])
    cut = [s.encode()[:LENGTH] for s in sample.column("snippet").to_pylist()]
    x = np.zeros((len(cut), LENGTH), np.uint8)
    for i, s in enumerate(cut):
        x[i, :len(s)] = np.frombuffer(s, np.uint8)
    y = np.array([names.index(v) for v in sample.column("lang").to_pylist()])
    rng = np.random.default_rng(SEED)
    net = Network(names, rng)
    net.fit(x, y, rng)
    return net


def identify(docs: DataFrame, net: Network | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document; ``net``: trained on ``docs`` where none is given."""
    net = net or train(docs, id_col, text_col, lang_col)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(F.col(id_col)).alias("held_out"),
                        F.lower(F.col(text_col)).alias("text"), F.coalesce(F.col(text_col).rlike(LETTER), F.lit(False)).alias("sound"))
    if net is None:
        return texts.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    names = np.array(net.names, object)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = net.looked_up()
        for batch in batches:
            for part in pieces(batch, 2, RUN):
                text = part.column(2).fill_null("")
                n = len(text)
                offsets = np.frombuffer(text.buffers()[1], np.int32, n + 1, 4 * text.offset).astype(np.int64) if n else np.zeros(1, np.int64)
                data = np.frombuffer(text.buffers()[2], np.uint8) if text.buffers()[2] is not None else np.zeros(0, np.uint8)
                total, weight = np.zeros((n, len(names))), np.zeros(n)
                doc, start, left = windows(offsets)
                for at in range(0, len(doc), HELD):
                    some = slice(at, at + HELD)
                    x = cut(data, start[some], left[some])
                    w = letters(x) + 1e-3
                    np.add.at(total, doc[some], tables.log_odds(x) * w[:, None])
                    np.add.at(weight, doc[some], w)
                mean = total / np.maximum(weight, 1e-9)[:, None]
                p = np.exp(mean - mean.max(1, keepdims=True))
                p /= p.sum(1, keepdims=True)
                sound = np.asarray(part.column(3).fill_null(False).to_numpy(zero_copy_only=False), bool)
                best = p.argmax(1)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(np.where(sound, names[best], UNKNOWN), pa.string()),
                     pa.array(np.where(sound, np.minimum(p[np.arange(n), best], 1.0), 0.0))], ["doc_id", "held_out", "lang_pred", "score"])

    return in_batches(texts).mapInArrow(predict, "doc_id bigint, held_out boolean, lang_pred string, score double")
