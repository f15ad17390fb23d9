"""What may grow with the log or the catalog is not decoded again, not broadcast, and not spread out as (pattern, row) pairs."""

import datetime as dt
import re

from conftest import SF_SMALL
from pyspark.sql import functions as F

from streamcharts.operators import search as sx
from streamcharts.plans import registry as R
from streamcharts.streaming import listeners as ls


def test_lists_of_ids_meet_before_they_become_rows(spark, scratch):
    cards = spark.range(400).select("id", F.concat(F.lit("common "), F.when(F.col("id") % 100 == 0, "abcd").otherwise("wxyz")).alias("title"), F.lit("x").alias("artist"))
    sx.build_index(cards, f"{scratch}/ix")
    wanted = spark.createDataFrame([("mon abcd",), ("common",), ("wxyz",), ("nothing",)], "pattern string").withColumn("grams", sx.pattern_trigrams(F.col("pattern")))
    got = sx._candidates(spark, f"{scratch}/ix", wanted)
    assert {(r.pattern, r.n) for r in got.groupBy("pattern").agg(F.count_distinct("id").alias("n")).collect()} == {("mon abcd", 4), ("common", 400), ("wxyz", 396)}
    assert got.count() == 800
    assert not re.search(r"Aggregate \[pattern#\d+, id#", got._jdf.queryExecution().optimizedPlan().toString())


def test_the_dictionary_of_listeners_is_not_broadcast(spark, scratch, monkeypatch):
    rows = [(s, dt.datetime(2024, 1, 1, 0, m), f"u{u}") for s in (1, 2) for m in range(3) for u in range(50)]
    plays, seen, write = spark.createDataFrame(rows, "song_id bigint, window_start timestamp, user_hash string"), [], type(spark.range(1).write).parquet
    monkeypatch.setattr(type(spark.range(1).write), "parquet", lambda self, *a, **k: (seen.append(self._df._jdf.queryExecution().executedPlan().toString()), write(self, *a, **k))[1])
    sink = ls.ListenerSink(f"{scratch}/l", "r1")
    for epoch in (0, 1):
        sink(plays, epoch)
    assert len(seen) == 4 and not any(re.search(r"BroadcastHashJoin \[user_hash", p) for p in seen)
    assert {r.unique_listeners for r in ls.unique_listeners(spark, f"{scratch}/l").collect()} == {50}


def test_epochs_read_what_was_decoded_once(spark):
    weeks = R._weekly_epochs(spark, SF_SMALL)
    plans = [w._jdf.queryExecution().optimizedPlan().toString() for w in weeks]
    assert len(weeks) == 4 and all("sha2" not in p and "from_json" not in p for p in plans)
    assert sum(w.count() for w in weeks) == R._messages(spark, SF_SMALL).count()
