import math
import random
import zlib
from collections import Counter, defaultdict

import pytest

from streamcharts.llm import katz
from streamcharts.llm.queries import QUERIES
from tests.llm.conftest import ROWS

SF = "/root/testdata/sf0.001"


def words(t):
    return (t or "").encode().lower().split()  # bytes: A-Z only, ASCII white space only


class Brute:
    """The model as its docstring says, from dictionaries."""

    def __init__(self, docs):
        self.uni, self.bi, self.next = Counter(), Counter(), defaultdict(set)
        self.ctx = Counter()
        for i, t in docs:
            if i is None or zlib.crc32(str(i).encode()) % 7 != 2:
                w = [*words(t), "END"]
                self.uni.update(w)
                for v, x in zip(["START", *w[:-1]], w, strict=True):
                    self.bi[v, x] += 1
                    self.ctx[v] += 1
                    self.next[v].add(x)
        self.n, self.v = sum(self.uni.values()), len(self.uni)
        self.du, self.db = self.discounts(self.uni), self.discounts(self.bi)
        left = sum((1 - self.du(c)) * c for c in self.uni.values())
        self.size, self.unknown = (self.n, left / self.n) if left > 0 else (self.n + 1, 1 / (self.n + 1))
        if left <= 0:
            self.du = lambda c: 1.0

    @staticmethod
    def discounts(counts):
        n = Counter(counts.values())
        for k in range(5, 0, -1):
            if all(n[r] for r in range(1, k + 1)) and (k + 1) * n[k + 1] / n[1] < 1:
                over = (k + 1) * n[k + 1] / n[1]
                d = {r: ((r + 1) * n[r + 1] / (r * n[r]) - over) / (1 - over) for r in range(1, k + 1)}
                if all(0 < x < 1 for x in d.values()):
                    return lambda c: d.get(c, c / (c + 1) if c <= 5 else 1.0)
        return lambda c: c / (c + 1) if c <= 5 else 1.0

    def p1(self, w):
        return self.du(self.uni[w]) * self.uni[w] / self.size if self.uni[w] else self.unknown

    def p(self, v, w):
        if not self.ctx[v]:
            return self.p1(w)
        bare = all(self.bi[v, x] > 5 for x in self.next[v])
        size = self.ctx[v] + bare
        if self.bi[v, w]:
            return self.db(self.bi[v, w]) * self.bi[v, w] / size
        left = 1 - sum(self.db(self.bi[v, x]) * self.bi[v, x] / size for x in self.next[v])
        return left / (1 - sum(self.p1(x) for x in self.next[v])) * self.p1(w)


def check(rows, docs):
    m = Brute(docs)
    log = lambda p: math.log10(p) if p > 0 else -math.inf
    want = []
    for i, t in docs:
        w = [*words(t), "END"]
        want.append((str(i), i is not None and zlib.crc32(str(i).encode()) % 7 == 2, len(w), sum(m.uni[x] > 0 for x in w), m.n,
                     sum(math.log10((m.uni[x] + 1) / (m.n + m.v + 1)) for x in w),
                     sum(log(m.p(v, x)) for v, x in zip(["START", *w[:-1]], w, strict=True))))
    got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in rows)
    for g, w in zip(got, sorted(want), strict=True):
        assert g[:5] == w[:5] and g[5:] == (pytest.approx(w[5], rel=1e-9), pytest.approx(w[6], rel=1e-9)), (g, w)
    return m


def test_scores_follow_the_definition(spark, odd, none):
    check(katz.score(odd).collect(), [(r[0], r[1]) for r in ROWS])
    assert katz.score(none).count() == 0
    rnd = random.Random(6)
    vocabulary = [f"w{int(rnd.paretovariate(.7))}" for _ in range(4000)]
    docs = [(i, " ".join(rnd.choices(vocabulary, k=rnd.randrange(40)))) for i in range(400)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    m = check(katz.score(df).collect(), docs)
    assert m.db(1) < .5
    check(katz.score(df.repartition(5), bucket_tokens=50).collect(), docs)  # many buckets, most contexts split


def test_split_contexts_with_nothing_left(spark):
    """A frequent context whose followers all occur more than K times, and unseen followers of it."""
    docs = [(i, "the cat the dog the end" if i % 2 else "the cat sat one two") for i in range(60)]
    docs += [(1000 + i, f"the new{i} the cat the") for i in range(40)]
    docs = [(i, t) for i, t in docs if i < 1000 or zlib.crc32(str(i).encode()) % 7 == 2]
    check(katz.score(spark.createDataFrame(docs, "doc_id bigint, text string"), bucket_tokens=10).collect(), docs)


def test_probabilities_sum_to_one(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(60).collect()]
    m = Brute(docs)
    for v in ["START", *list(m.ctx)[:25]]:
        assert sum(m.p(v, w) for w in m.uni) + m.p(v, "no such word") == pytest.approx(1)


def test_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    check(QUERIES["op1_katz_scoring"](spark, SF).collect(), docs)


def test_no_training_rows(spark):
    held = [i for i in range(50) if not katz.trains(i)][:3]
    rows = katz.score(spark.createDataFrame([(i, "a b") for i in held], "doc_id bigint, text string")).collect()
    assert {(r.n_tokens, r.n_known, r.train_tokens, r.score) for r in rows} == {(3, 0, 0, 0.0)}


def test_chunks_go_by_bytes_and_share_one_row_with_a_bucket(spark, monkeypatch):
    """Short Arrow batches do not make more chunks; a chunk and a bucket exchange one row each way, so that rows do not
    grow with a chunk's contexts."""
    kept = {}
    monkeypatch.setattr(katz, "written", lambda df, name, write=katz.written: kept.setdefault(name, write(df, name)))
    rnd = random.Random(9)
    vocabulary = [f"w{int(rnd.paretovariate(.8))}" for _ in range(3000)]
    docs = [(i, " ".join(rnd.choices(vocabulary, k=rnd.randrange(60)))) for i in range(600)]
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        check(katz.score(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3), bucket_tokens=400).collect(), docs)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    assert kept["lm-chunks"].count() == 3
    answers = kept["lm-bigrams"].filter("chunk is not null")
    assert answers.groupBy("chunk", "bucket").count().agg({"count": "max"}).first()[0] == 1
    assert answers.count() <= 3 * kept["lm-bigrams"].filter("kind = 'table'").count()
