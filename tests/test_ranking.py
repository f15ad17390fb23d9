import random

from streamcharts.operators.ranking import ranked


def test_global_ranking_across_many_partitions(spark):
    rnd = random.Random(3)
    keys = rnd.sample(range(1_000_000), 4000)
    df = spark.createDataFrame([(k, f"v{k}") for k in keys], "k bigint, v string").repartition(7)
    got = {r.k: (r._rank, r._next) for r in ranked(df, ["k"], next_of="k", partitions=16).collect()}
    order = sorted(keys)
    assert {k: got[k][0] for k in keys} == {k: i + 1 for i, k in enumerate(order)}
    assert got[order[-1]][1] == order[0] and got[order[0]][1] == order[1]


def test_grouped_ranking_with_one_hot_group(spark):
    rows = [("hot", i) for i in range(3000)] + [(f"g{j}", i) for j in range(40) for i in range(3)]
    df = spark.createDataFrame(rows, "g string, i int")
    out = ranked(df, ["i"], ["g"], partitions=12)
    bad = out.filter("_rank != i + 1").count()
    assert bad == 0 and out.count() == len(rows)


def test_null_group_is_ranked_too(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), ("a", 5)], "g string, i int")
    got = {(r.g, r.i, r._rank) for r in ranked(df, ["i"], ["g"], partitions=4).collect()}
    assert got == {(None, 1, 1), (None, 2, 2), ("a", 5, 1)}
