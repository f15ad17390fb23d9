import math
import random

import numpy as np

from streamcharts.llm import cover_tree
from streamcharts.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def brute(rows, top=5, every=50):
    whole = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            whole[i, tuple(math.floor(256 * x) for x in v)] = 1
    out = []
    for (q, a) in whole:
        if q % every == 0:
            s = sorted((-sum(x * y for x, y in zip(a, b)), i) for (i, b) in whole if i != q)[:top]
            out += [(q, k + 1, i, -x) for k, (x, i) in enumerate(s)]
    return sorted(out)


def got(df):
    assert df.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(map(tuple, df.collect()))


def test_against_brute_force(spark):
    rnd = random.Random(8)
    centres = [[rnd.gauss(0, 3) for _ in range(6)] for _ in range(9)]
    rows = [(i, [c + rnd.gauss(0, .2) for c in rnd.choice(centres)]) for i in range(-300, 2600)]
    rows += [(5000 + i, centres[0]) for i in range(1500)]  # one vector many times
    rows += [(9000, None), (9050, [1.0, None]), (9100, [float("nan")]), (9150, [float("inf")] * 6), (None, [1.0]), (9200, []), (9250, [2.0, 1.0]),
             (0, rows[300][1]), (0, [9.0] * 6)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    as_float = [(i, v if v is None else [x if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert got(cover_tree.top_k(df)) == brute(as_float)


def test_few_rows(spark):
    schema = "vec_id bigint, embedding array<double>, cell int, count int"
    rows = [(0, [1.0], 1, 1), (50, [-1.0], 2, 2), (7, [3.0], 3, 3)]
    assert got(cover_tree.top_k(spark.createDataFrame(rows, schema))) == brute([r[:2] for r in rows])
    assert got(cover_tree.top_k(spark.createDataFrame(rows[:1], schema))) == []
    assert got(cover_tree.top_k(spark.createDataFrame([], schema))) == []


def test_pruning_leaves_out_pairs():
    rnd = np.random.default_rng(1)
    x = np.floor(np.concatenate([rnd.normal(c, 1, (500, 3)) for c in (0, 400, -400)]) * 10)
    s = cover_tree.Search(x[500:520], np.arange(500, 520), x, np.arange(1500), np.full(20, -np.inf), 5)
    s.run(cover_tree.Node(x[500:520], np.arange(20)), cover_tree.Node(x, np.arange(1500)))
    assert s.pairs < 20 * 1000
    full = x[500:520] @ x.T
    full[np.arange(20), np.arange(500, 520)] = -np.inf
    assert (np.sort(full, 1)[:, ::-1][:, :5] == s.score).all()


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert got(QUERIES["op3_cover_tree_search"](spark, SF)) == brute(rows)
