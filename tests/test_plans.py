"""Plan-shape guards for the scale properties the README claims."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL

BATCH = sorted(n for n in entry.queries() if not n.startswith("stream_"))


def _plan(spark, name):
    df = entry.queries()[name](spark, SF_SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_or_python(spark, name):
    plan = _plan(spark, name)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "PythonUDF"):
        assert bad not in plan, (name, bad)


def _formatted(spark, name):
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        entry.queries()[name](spark, SF_SMALL).explain("formatted")
    return buf.getvalue()


def test_trending_pushes_type_and_time_into_the_scan(spark):
    text = _formatted(spark, "trending_global")
    pushed = next(line for line in text.splitlines() if line.startswith("PushedFilters") and "event_type" in line)
    assert "EqualTo(event_type,view)" in pushed
    assert "GreaterThanOrEqual(ts," in pushed and "LessThan(ts," in pushed


def test_trending_aggregates_before_catalog_join(spark):
    plan = _plan(spark, "trending_global")
    # the partial aggregate over events sits below the first join with the catalog
    first_join = plan.index("BroadcastHashJoin")
    assert plan.rfind("HashAggregate") > first_join


def test_catalog_page_is_cut_before_the_artist_join(spark):
    plan = _plan(spark, "list_songs")
    assert "TakeOrderedAndProject" in plan
    assert plan.index("BroadcastHashJoin") < plan.index("TakeOrderedAndProject")


def test_for_you_joins_users_by_broadcast_when_the_lists_are_small(spark):
    from conftest import SF_SMALL
    from streamcharts.plans.registry import QUERIES

    df = QUERIES["for_you_all"](spark, SF_SMALL)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "isFinalPlan=true" in final and "BroadcastHashJoin [based_on" in final


def test_numbering_needs_no_checkpoint_and_one_full_shuffle(spark):
    plan = _plan(spark, "next_track")
    assert "RDDScan" not in plan and "rangepartitioning" not in plan


def test_scans_prune_columns(spark):
    plan = _plan(spark, "genre_counts")
    scan = next(line for line in plan.splitlines() if "part.parquet" in line)
    assert "p_type" in scan and "p_name" not in scan


def test_stored_trending_read_prunes_day_partitions(spark):
    import contextlib
    import io

    from streamcharts.operators import trending as tr
    from streamcharts.plans import registry as R
    from streamcharts.streaming import views as V

    root = R._run_stream(spark, SF_SMALL)
    df = tr.trending(V.buckets(spark, root), R.tb.songs(spark, SF_SMALL), R.tb.artists(spark, SF_SMALL),
                     asof="2024-01-30 23:59:00", window_minutes=1440)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    assert any(line.startswith("PartitionFilters") and "day" in line for line in text.splitlines())
    assert "GreaterThanOrEqual(window_start," in text
