import numpy as np

from streamcharts.llm import near_dedup as nd
from tests.llm.test_pipeline import near_copies


def test_signatures_and_sets_are_not_shuffled_again(spark, monkeypatch):
    """A join of identifiers with them moves the identifiers only."""
    seen = []

    class Kept(nd._Search):
        def __init__(self, *args):
            super().__init__(*args)
            seen.append(self)

    monkeypatch.setattr(nd, "_Search", Kept)
    docs = near_copies(40, 60, 2, 0, np.random.default_rng(1))
    nd.near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for held in (seen[0].reps, seen[0].sets):
            met = spark.range(50).join(held, "id")
            plan = met._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange hashpartitioning") == 1 and met.count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_components_by_chunks(spark, monkeypatch):
    """One chunk is joined up at once; many chunks meet in star steps with the same result."""
    rnd = np.random.default_rng(2)
    pairs = [(i, i + 1) for i in range(300)] + [(int(a) + 1000, int(b) + 1000) for a, b in rnd.integers(0, 400, (350, 2))]
    links = spark.createDataFrame(pairs, "a bigint, b bigint")
    parent = {i: i for p in pairs for i in p}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in pairs:
        x, y = sorted((top(a), top(b)))
        parent[y] = x
    linked = {i for a, b in pairs if a != b for i in (a, b)}
    tables, write = [], nd.written
    monkeypatch.setattr(nd, "written", lambda df, name: tables.append(name) or write(df, name))
    for chunk in (1 << 18, 64):
        rows = nd.components(links, chunk).collect()
        assert {r.id: r.label for r in rows} == {i: top(i) for i in linked} and len(rows) == len(linked)
        assert chunk == 64 or len(tables) == 1
