import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from streamcharts.llm import secrets, toxicity
from streamcharts.llm.queries import QUERIES
from tests.llm.conftest import ROWS

SF = "/root/testdata/sf0.001"
ASSIGN = re.compile("(" + "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in
                                   ("password", "passwd", "secret", "token", "api_?key"))
                    + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base(t):
    s = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(t) if len(m[2]) >= 12]
    s += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
    s += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]
    return [f"{k}:{a}:{b}" for a, _, b, k in sorted(s)]


def check(rows, docs):
    want = sorted((str(i), hashlib.sha256(",".join(base(t or "")).encode()).hexdigest(),
                   *[sum(x.startswith(k) for x in base(t or "")) for k in ("assign", "access", "hex")]) for i, t in docs)
    assert want == sorted((str(r.doc_id), r.base_sha256, r.n_assign, r.n_access, r.n_hex) for r in rows)
    texts = dict(docs)
    for r in rows:
        assert not r.spans or set(base(texts[r.doc_id] or "")) <= set(r.spans.split(","))


def test_base_spans(spark, odd, none):
    rnd = random.Random(2)
    parts = ["password", "PassWd", "ſecret", "toKen", "API_KEY", "apikey", "=", " : ", '"', "'", "AKIA", "AKIAAKIA", "0" * 16, "ab12cd34", "Z9", " ",
             "é", "abcdef0123456789", "Q" * 14, "-_./+=", "token=abc token=abcdefghijklmnop"]
    docs = [(i, "".join(rnd.choices(parts, k=rnd.randrange(14)))) for i in range(1500)] + [(9999, None)]
    check(secrets.scan(spark.createDataFrame(docs, "doc_id bigint, text string")).collect(), docs)
    check(secrets.scan(odd).collect(), [(r[0], r[1]) for r in ROWS])
    assert secrets.scan(none).count() == 0


def test_query(spark):
    docs = [tuple(d) for d in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    check(QUERIES["op5_guess_cost_secrets"](spark, SF).collect(), docs)


def brute(value, ranks):
    """The cheapest segmentation by trying all cuts and, for every part, all kinds; nothing is left out."""
    from math import comb

    low, n = "".join(c.lower() if len(c.lower()) == 1 else c for c in value), len(value)
    dates = [re.compile(d) for d in secrets._DATES]

    def part(i, j):
        s, m = low[i:j], j - i
        costs = [secrets._BRUTE] if m == 1 else []
        if m >= 3 and s in ranks:
            up = sum(c.isupper() for c in value[i:j])
            costs.append(np.log10(ranks[s] + 1) + (0 if not up else np.log10(2) if up in (1, m) else np.log10(comb(m, up))) + secrets._PART)
        if any(d.fullmatch(s) for d in dates):
            costs.append(secrets._DATE_COST[m > 4] + secrets._PART)
        pairs = list(zip(s, s[1:]))
        for holds, start, turn in ((lambda a, b: a == b, 1.5, 0), (lambda a, b: b in secrets._NEAR.get(a, ()), 2.0, .15),
                                   (lambda a, b: ord(b) - ord(a) == 1 and b.isalnum(), 1.5, 0), (lambda a, b: ord(a) - ord(b) == 1 and b.isalnum(), 1.5, 0)):
            if m >= 3 and all(holds(a, b) for a, b in pairs):
                costs.append(start + np.log10(m) + turn * m + secrets._PART)
        for size in range(2, m // 2 + 1):
            if m % size == 0 and s == s[:size] * (m // size):
                costs.append(size * secrets._BRUTE + np.log10(m // size) + secrets._PART)
        return min(costs, default=np.inf)

    best = [0.0]
    for j in range(1, n + 1):
        best.append(min(best[i] + part(i, j) for i in range(j)))
    return best[-1]


def test_guess_costs_are_the_cheapest_segmentation():
    ranks = {"pass": 3, "word": 9, "password": 2, "summer": 40, "dragon": 200}
    rnd = random.Random(4)
    parts = ["pass", "Word", "PASSWORD", "sumMer", "dragon", "1987", "2001-04-17", "20010417", "aaaa", "qwer", "zaq1", "abcd", "4321", "xyxyxy", "k", "7", "!", "a" * 15,
             "qwertyuiop[]", "0123456789", "aabaab", "x7K" * 3, "İ"]
    for _ in range(400):
        v = "".join(rnd.choices(parts, k=rnd.randrange(1, 5)))
        assert secrets.guess_cost(v, ranks, 8) == pytest.approx(brute(v, ranks)), v
    for _ in range(200):
        v = "".join(rnd.choices("aab1", k=rnd.randrange(1, 30)))
        assert secrets.guess_cost(v, ranks) == pytest.approx(brute(v, ranks)), v
    unit = "".join(rnd.choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJ0123456789", k=17))
    assert secrets.guess_cost(unit * 3, ranks) == pytest.approx(brute(unit * 3, ranks)) and secrets.guess_cost(unit * 3, ranks) < 18
    assert secrets.guess_cost("password1987", ranks, 8) < 4 < 15 < secrets.guess_cost("x9Tq0vLm2Rw8zKp4", ranks, 8)


def test_repetitions_by_scales_are_those_of_all_periods():
    rnd = random.Random(5)
    primitive = lambda u: (u + u).find(u, 1) == len(u)
    for _ in range(1500):
        few = "abcd"[:rnd.choice([1, 2, 2, 3, 4])]
        t = "".join(rnd.choices(few, k=rnd.randrange(4, 50)))
        if rnd.random() < 0.5:
            unit = "".join(rnd.choices(few, k=rnd.randrange(1, 20)))
            t = unit * rnd.randrange(1, 5) + t + unit * 3
        codes = np.frombuffer(t.encode("utf-32-le"), np.uint32).astype(np.int64)
        every, found = set(secrets._repetitions_short(codes)), set(secrets._repetitions_long(codes))
        assert {x for x in every if primitive(t[x[0]:x[0] + x[2]])} <= found <= every, t


def test_long_values_take_no_square_of_their_length():
    import time

    rnd = random.Random(6)
    start = time.process_time()
    for v in ("a" * 100_000, "x9Kq" * 25_000, "".join(rnd.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=100_000))):
        secrets.guess_cost(v, {"password": 1})
    assert time.process_time() - start < 60


def test_weak_values_are_no_guess_spans():
    ranks = {"password": 1, "changeme": 5}
    spans = secrets.guess_spans("pwd: changeme pass = password1 login => kX93vq-1Zt0 bearer: x", ranks, 8)
    assert [(a, b) for a, _, b, _ in spans] == [(40, 51)]


@pytest.fixture(scope="module")
def chars(spark):
    return toxicity.character_model(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_channel_restores_hidden_words(chars):
    r = toxicity.Restorer(chars)
    for text, word in [("you 1d10t!", "idiot"), ("a l0ser", "loser"), ("$tup1d", "stupid"), ("m o r o n", "moron"), ("looooser", "loser"),
                       ("p@th3tic", "pathetic"), ("s.c.u.m", "scum"), ("tr4sh!!!", "trash"), ("cl0wn", "clown"), ("w0rthle55", "worthless")]:
        assert word in r.words(text), (text, r.words(text))
    assert r.words("") == set() and r.words("Plain words") == {"plain", "words"}
    assert r.words("0" * 50 + " @@@ 4162304444530366") == set()
    assert len(r.words("a " * 5000 + "x1" * 3000)) > 0


def test_character_model_is_a_distribution(chars):
    assert np.allclose(np.exp(chars).sum(-1), 1, atol=1e-4)


def test_toxicity_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = QUERIES["op9_noisy_channel_toxicity"](spark, sf).collect()
    label = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(rows) == 1000
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= .5) and 0 <= r.score <= 1
    seen = [r for r in rows if r.held_out and r.doc_id in label]
    assert sum(r.predicted == label[r.doc_id] for r in seen) >= .9 * len(seen)


def test_toxicity_edges(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, None), (None, 1), (77, 1)], "doc_id bigint, toxic int")
    got = toxicity.score(odd, labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"] and got.count() == len(ROWS)
    assert toxicity.score(none, labels).count() == 0
    assert toxicity.score(odd, labels.limit(0)).filter("predicted = 0").count() == len(ROWS)
    clean = toxicity.clean_documents(odd, labels.limit(0))
    assert clean.schema == odd.schema and clean.count() == len(ROWS)


def test_labels_of_held_out_rows_do_not_matter(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "toxic")
    from pyspark.sql import functions as F
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (sorted(map(tuple, toxicity.score(docs, x).collect())) for x in (labels, turned))
    assert a == b


def test_most_frequent_words(spark):
    from collections import Counter

    from streamcharts.llm.words import most_frequent, word_counts
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = Counter(w.decode() for r in docs.collect() for w in (r.text or "").encode().lower().split())
    assert {r.word: r.n for r in word_counts(docs).collect()} == want
    for k in (1, 50, 10**6):
        assert most_frequent(word_counts(docs), k) == [w for w, _ in sorted(want.items(), key=lambda x: (-x[1], x[0].encode()))[:k]]
