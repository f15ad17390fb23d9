"""Approximate distincts within tolerance of exact; no raw user id in any written table."""

import glob

from pyspark.sql import functions as F

from streamcharts.plans import registry as R
from conftest import decode_messages
from streamcharts.streaming.processor import RollupSink

from conftest import SF_ORACLE, SF_SMALL


def test_approx_and_sketch_within_tolerance(spark):
    keys = R.QUERIES["minute_unique_exact"](spark, SF_ORACLE).count()
    for name in ("minute_unique_approx", "unique_union_sketch"):
        got = R.QUERIES[name](spark, SF_ORACLE)
        assert got.count() == got.filter("within_error").count() == keys


def test_within_error_sees_a_wrong_estimate(spark):
    estimate = R.ru.unique_listeners(R._epoch_deltas(spark, SF_ORACLE), mode="union")
    wrong = R._within_error(spark, SF_ORACLE, estimate.withColumn("unique_listeners", F.col("unique_listeners") + 2))
    assert wrong.filter("within_error").count() == 0


def test_no_raw_user_id_in_outputs(spark, scratch):
    msgs = R._messages(spark, SF_SMALL)
    RollupSink(f"{scratch}/out", "r")(decode_messages(msgs), 0)
    raw_ids = {str(r.user_id) for r in R.tb.events(spark, SF_SMALL).select("user_id").distinct().collect()}
    for table in ("song_minute", "user_genre", "batches"):
        df = spark.read.parquet(f"{scratch}/out/{table}")
        for c, t in df.dtypes:
            if t == "string":
                vals = {r[0] for r in df.select(c).distinct().collect()}
                assert not (vals & raw_ids) or c == "run", (table, c)
    assert "userId" not in " ".join(open(p).read() for p in glob.glob(f"{scratch}/out/**/*.json", recursive=True))
