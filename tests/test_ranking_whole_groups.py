"""Groups that fit into a task are numbered whole: no bounds to compare each row with, and one shuffle."""

from streamcharts.operators.ranking import ranked
from streamcharts.plans import registry as R
from conftest import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def check(df, sizes, **kw):
    got = {(r.g, r.i): (r._rank, r._next) for r in ranked(df, ["i"], ["g"], next_of="i", **kw).collect()}
    assert got == {(g, i): (i + 1, (i + 1) % n) for g, n in sizes.items() for i in range(n)}


def test_small_groups_are_not_cut(spark):
    sizes = {f"g{k}": 1 + k % 5 for k in range(400)} | {None: 3}
    df = spark.createDataFrame([(g, i) for g, n in sizes.items() for i in range(n)], "g string, i int").repartition(5)
    check(df, sizes, partitions=8)
    assert "_chunk" not in plan(ranked(df, ["i"], ["g"], next_of="i", partitions=8))


def test_a_large_group_is_cut_and_the_others_are_not(spark):
    sizes = {f"g{k}": 1 + k % 5 for k in range(200)} | {None: 2000}
    df = spark.createDataFrame([(g, i) for g, n in sizes.items() for i in range(n)], "g string, i int").repartition(5)
    check(df, sizes, partitions=16)
    check(df, sizes, partitions=16, bounds_from=df.filter("i % 3 = 0"))
    out = ranked(df, ["i"], ["g"], next_of="i", partitions=16)
    assert "_chunk" in plan(out)


def test_export_and_next_track_compare_no_row_with_bounds(spark):
    assert "_chunk" not in plan(R.next_track(spark, SF_SMALL)) and "_chunk" not in plan(R.export_user(spark, SF_SMALL))
