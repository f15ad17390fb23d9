"""Secret scan with guess costs.

The contract's patterns (assignments, access keys, hex runs) give the base spans. Values that stand behind a
credential word, in more spellings than the assignment pattern knows and from ``MIN_VALUE`` characters on, are
measured by how many guesses an attacker needs: dynamic programming finds the cheapest segmentation of the
value into dictionary words (by rank), dates, repeats, keyboard walks, ascending runs and brute force. A value
of at least 10 ** ``MIN_GUESSES`` guesses is a secret of kind ``guess``; cheap ones (placeholders, words) are not.

The cost is the minimum over all segmentations, and the time about n log n in a value's length. Words are found by one automaton.
Walks and runs, and repeats with a unit of any size, may begin and end anywhere inside their longest extent; their cost is
concave in their length, so of two places where such a part may begin the later one is dropped once the earlier one is
cheaper. Repeats come from the maximal repetitions of the value (``repetitions``).

The dictionary holds every word that makes up at least ``SHARE`` of the corpus's words, counted over all documents, punctuation at
its edges left off. That is no more than 1 / ``SHARE`` words, whatever the corpus, which bounds what reaches the driver.

Defined results: null text is empty; repeated rows give repeated results; of equal counts the word first in code
point order ranks first; an empty table gives an empty result; a null identifier stays null; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamcharts.llm.common import in_batches, written
from streamcharts.llm.words import word_counts

SHARE, MIN_VALUE, MIN_GUESSES = 1e-5, 6, 8.0
KINDS = ("assign", "access", "hex", "guess")

# The contract's patterns.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")

_CREDENTIAL = re.compile(
    r"""(?:password|passwd|passphrase|passcode|pwd|pass|secret|token|api[_ -]?key|access[_ -]?key|private[_ -]?key|auth|"""
    r"""bearer|credentials?|login|pin)["']?[\x20\t]*(?:=>|[:=]|\x20is\x20)[\x20\t]*["']?([^\s"',;]+)""", re.IGNORECASE | re.ASCII)

# The rows of a keyboard.
KEYBOARD = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
_DATES = (r"(?:19|20)\d\d[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:0[1-9]|[12]\d|3[01])",
          r"(?:0[1-9]|[12]\d|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:19|20)\d\d", r"(?:19|20)\d\d")
_DATES_ANYWHERE = [re.compile(f"(?=({d}))", re.ASCII) for d in _DATES]
_DATE_COST = {True: math.log10(365 * 100), False: 2.0}  # a day of a century, a year of one
_BRUTE = 1.0     # log10 of guesses a character tried blindly
_PART = 0.3      # log10 of guesses for where a part ends


def _neighbours() -> dict[str, set[str]]:
    near: dict[str, set[str]] = {}
    for y, row in enumerate(KEYBOARD):
        for x, c in enumerate(row):
            near[c] = {KEYBOARD[v][u] for v in (y - 1, y, y + 1) for u in (x - 1, x, x + 1)
                       if 0 <= v < len(KEYBOARD) and 0 <= u < len(KEYBOARD[v]) and KEYBOARD[v][u] != c}
    return near


_NEAR = _neighbours()


#: Kinds of runs: whether a character goes on from the one before it, fixed cost, cost a character.
_RUNS = (
    (lambda a, b: a == b, 1.5, 0.0),                                  # aaaa
    (lambda a, b: b in _NEAR.get(a, ()), 2.0, 0.15),                  # qwerty, zaq1
    (lambda a, b: ord(b) - ord(a) == 1 and b.isalnum(), 1.5, 0.0),    # abcd, 1234
    (lambda a, b: ord(a) - ord(b) == 1 and b.isalnum(), 1.5, 0.0))    # dcba
_LEAST_RUN = 3
_SHORT = 1_024  # characters up to which all periods are tried


def repetitions(text: str) -> list[tuple[int, int, int]]:
    """(begin, end, period) of the maximal stretches of at least two periods, for every period from 2 on that is not itself made of
    repeats (stretches of others may be among them)."""
    if len(text) < 4:
        return []
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    return _repetitions_short(codes) if len(codes) <= _SHORT else _repetitions_long(codes)


def _repetitions_short(codes: np.ndarray) -> list[tuple[int, int, int]]:
    """Every period: where the text equals itself so many characters on."""
    out = []
    for p in range(2, len(codes) // 2 + 1):
        breaks = np.flatnonzero(codes[p:] != codes[:-p])
        begin, end = np.append(-1, breaks) + 1, np.append(breaks, len(codes) - p)
        for i in np.flatnonzero(end - begin >= p).tolist():
            out.append((int(begin[i]), int(end[i]) + p, p))
    return out


def _repetitions_long(codes: np.ndarray) -> list[tuple[int, int, int]]:
    """Periods from 2 q to below 4 q by the runs of q characters at every q-th place, for q = 1, 2, 4, ...

    Such a stretch holds one of these runs in its first period, and the same run a period on. Equal runs have equal numbers
    (doubled from scale to scale). Where a run overlaps its next occurrence by half or more, the text repeats with a
    shorter period there; inside that chain of occurrences there is nothing new, and a later chain
    can only lie one period on by its beginning or by its end.
    """
    n = len(codes)
    scales = [np.unique(codes, return_inverse=True)[1].astype(np.int64)]
    found = []
    q = 1
    while 4 * q <= n:
        ids = scales[-1]
        order = np.argsort(ids, kind="stable")
        same = ids[order[1:]] == ids[order[:-1]]
        if not same.any():
            break
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        first = np.flatnonzero(np.append(True, ~(same & (np.diff(order) <= q // 2))))   # of each chain, in sorted order
        last = np.append(first[1:], len(order)) - 1
        chain = np.searchsorted(first, np.arange(len(order)), side="right") - 1
        x = np.arange(0, len(ids), q)
        own = chain[place[x]]
        step = 1
        while len(x):
            c = own + step
            ok = c < len(first)
            ok[ok] &= (ids[order[first[c[ok]]]] == ids[x[ok]]) & (order[first[c[ok]]] < x[ok] + 4 * q)
            x, own, c = x[ok], own[ok], c[ok]
            for p in (order[first[c]] - order[first[own]], order[last[c]] - order[last[own]]):
                fit = (p >= 2 * q) & (p < 4 * q) & (x + p < n)
                found.append(x[fit] * n + p[fit])
            step += 1
        pair = ids[:-q] * (int(ids.max()) + 1) + ids[q:]
        scales.append(np.unique(pair, return_inverse=True)[1].astype(np.int64))
        q *= 2
    if not found:
        return []
    x, p = np.divmod(np.unique(np.concatenate(found)), n)
    on, back = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
    for k in reversed(range(len(scales))):
        ids, q = scales[k], 1 << k
        for _ in range(2 if k == len(scales) - 1 else 1):  # of the largest scale several fit
            while True:
                a = x + on
                fit = np.flatnonzero(a + p < len(ids))
                fit = fit[ids[a[fit]] == ids[a[fit] + p[fit]]]
                on[fit] += q
                if k < len(scales) - 1 or not len(fit):
                    break
            while True:
                a = x - back - q
                fit = np.flatnonzero((a >= 0) & (a + p < len(ids)))
                fit = fit[ids[a[fit]] == ids[a[fit] + p[fit]]]
                back[fit] += q
                if k < len(scales) - 1 or not len(fit):
                    break
    whole = on + back >= p
    rows = np.unique(np.stack([(x - back)[whole], (x + on + p)[whole], p[whole]], 1), axis=0)
    return [tuple(r) for r in rows.tolist()]


class Guesser:
    """Guess costs under a dictionary of ranked words."""

    def __init__(self, ranks: dict[str, int]):
        import ahocorasick

        self.words = ahocorasick.Automaton()
        for w, rank in ranks.items():
            if len(w) >= 3:
                self.words.add_word(w, (len(w), math.log10(rank + 1) + _PART))
        if len(self.words):
            self.words.make_automaton()

    def cost(self, value: str) -> float:
        """log10 of the guesses for ``value``: the cheapest way to cut it into parts that are guessed one by one."""
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in value)
        n = len(low)
        upper = [0]
        for c in value:
            upper.append(upper[-1] + c.isupper())
        ends: dict[int, list[tuple[int, float]]] = {}   # fixed parts: (begin, cost) by their end
        for at, (m, cost) in self.words.iter(low) if len(self.words) else ():
            up = upper[at + 1] - upper[at + 1 - m]
            spelled = 0.0 if not up else math.log10(2) if up in (1, m) else _log10_comb(m, up)
            ends.setdefault(at + 1, []).append((at + 1 - m, cost + spelled))
        for pattern in _DATES_ANYWHERE:
            for d in pattern.finditer(low):
                ends.setdefault(d.end(1), []).append((d.start(), _DATE_COST[len(d[1]) > 4] + _PART))
        stretches: dict[int, list[tuple[int, int, int]]] = {}   # repetitions by the end of their second period
        for begin, end, p in repetitions(low):
            stretches.setdefault(begin + 2 * p, []).append((begin, end, p))
        best = [0.0] * (n + 1)
        runs: list[list[int]] = [[] for _ in _RUNS]    # where a run may begin that goes on to here
        begun = [0] * len(_RUNS)
        live: list[tuple[int, int, int, dict[int, list[int]]]] = []
        log10 = math.log10
        for j in range(1, n + 1):
            b = best[j - 1] + _BRUTE
            for i, cost in ends.get(j, ()):
                b = min(b, best[i] + cost)
            if j > 1:
                x, y = low[j - 2], low[j - 1]
                for k, (goes_on, fixed, each) in enumerate(_RUNS):
                    if not goes_on(x, y):
                        begun[k] = j - 1
                        if runs[k]:
                            runs[k] = []
                        continue
                    if j - _LEAST_RUN < begun[k]:
                        continue
                    runs[k].append(j - _LEAST_RUN)
                    kept, least = [], math.inf
                    for i in runs[k]:
                        c = best[i] + log10(j - i) + each * (j - i)
                        if c < least:
                            least = c
                            kept.append(i)
                    runs[k] = kept
                    b = min(b, least + fixed + _PART)
            for begin, end, p in stretches.get(j, ()):
                live.append((begin, end, p, {}))
            if live:
                live = [x for x in live if x[1] >= j]
                for begin, _, p, classes in live:
                    starts = classes.setdefault((j - begin) % p, [])
                    starts.append(j - 2 * p)
                    kept, least = [], math.inf
                    for i in starts:
                        c = best[i] + log10((j - i) // p)
                        if c < least:
                            least = c
                            kept.append(i)
                    classes[(j - begin) % p] = kept
                    b = min(b, least + p * _BRUTE + _PART)
            best[j] = b
        return best[n]


def _log10_comb(n: int, k: int) -> float:
    """log10 of n over k, also where that is no float."""
    return (math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)) / math.log(10) if n > 500 else math.log10(math.comb(n, k))


def guess_cost(value: str, ranks: dict[str, int], longest: int = 0) -> float:
    """``Guesser.cost`` of one value."""
    return Guesser(ranks).cost(value)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the contract's spans, sorted."""
    spans = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    spans += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    spans += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(spans)


def guess_spans(text: str, ranks: "dict[str, int] | Guesser", longest: int = 0) -> list[tuple[int, int, int, float]]:
    """(start, kind, end, cost) of credential values that are hard to guess."""
    guesser = ranks if isinstance(ranks, Guesser) else None
    found = []
    for m in _CREDENTIAL.finditer(text):
        if len(m[1]) >= MIN_VALUE:
            guesser = guesser or Guesser(ranks)
            cost = guesser.cost(m[1])
            if cost >= MIN_GUESSES:
                found.append((m.start(1), 3, m.end(1), cost))
    return found


def dictionary(docs: DataFrame, text_col: str = "text") -> dict[str, int]:
    """Rank of each frequent word, from 1: by falling count, ties in code point order."""
    bare = F.regexp_replace("word", r"^\P{L}+|\P{L}+$", "")
    words = written(word_counts(docs, text_col).groupBy(bare.alias("word")).agg(F.sum("n").alias("n")), "words")
    total = words.agg(F.sum("n")).first()[0] or 0
    frequent = words.filter((F.col("n") >= SHARE * total) & F.col("word").rlike(r"^\p{L}{3,}$"))
    return {r.word: k for k, r in enumerate(frequent.orderBy(F.desc("n"), "word").collect(), 1)}  # 1 / SHARE rows at most


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_guess, guess_log10 (largest) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(dictionary(docs, text_col))  # 1 / SHARE entries at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Guesser(shared.value)
        for b in batches:
            out: list[list] = [[] for _ in range(7)]
            for t in b.column(1).to_pylist():
                base = base_spans(t or "")
                more = guess_spans(t or "", known)
                row = [sum(k == x for _, k, _ in base) for x in range(3)]
                row += [hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(sorted(base + [s[:3] for s in more])),
                        len(more), max((s[3] for s in more), default=None)]
                for column, x in zip(out, row, strict=True):
                    column.append(x)
            kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64(), pa.float64()]
            names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_guess", "guess_log10"]
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(x, k) for x, k in zip(out, kinds, strict=True)]], names)

    schema = "n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_guess bigint, guess_log10 double"
    return in_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))).mapInArrow(
        run, f"doc_id bigint, {schema}")
