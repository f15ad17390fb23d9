"""Leaderboard buckets that expire and free their storage.

A key, a minute's board of a genre or of all, lives until ``ttl`` after its last write; each write renews it. A write after
that finds no key and begins a new one, so what counts is a key's last *session* of writes, those less than the TTL
apart, if it has not ended. Deltas are written per micro-batch under ``slot=/run=/epoch=`` (a slot is a few minutes); ``live`` sums the
last sessions, and ``expire`` removes an epoch's folder of a slot when all of its sessions have ended. It only removes what no read at
that time or later sees, so it can run at any time and break off anywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streamcharts.constants import TREND_TTL_SECONDS
from streamcharts.functions.timefns import epoch_minute


SLOT_MINUTES = 10  # minutes to a folder: what is alive spans a few


class LeaderboardSink:
    """``foreachBatch`` callback on plays ``(song_id, genre, window_start)``; ``clock``: when it writes (default: now)."""

    def __init__(self, root: str, run_id: str, slot_minutes: int = SLOT_MINUTES):
        self.root, self.run_id, self.slot = root.rstrip("/"), run_id, slot_minutes

    def __call__(self, plays: DataFrame, epoch_id: int, clock: Column | None = None) -> None:
        now = (clock if clock is not None else F.current_timestamp()).cast("timestamp")
        plays.groupBy(epoch_minute(F.col("window_start")).alias("minute"), "genre", "song_id").agg(F.count(F.lit(1)).alias("plays")).withColumn(
            "written_at", now).withColumn("slot", F.floor(F.col("minute") / self.slot)).withColumn("run", F.lit(self.run_id)).withColumn("epoch", F.lit(int(epoch_id)).cast("long")).write.mode(
            "overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("slot", "run", "epoch").parquet(f"{self.root}/leaderboard")


def _sessions(rows: DataFrame, keys: list[str], ttl_seconds: int) -> DataFrame:
    """(*keys, began, ends) of every session of writes; a key has few writes, one an epoch that touched it."""
    ttl = f"{int(ttl_seconds)} seconds"
    writes = rows.select(*keys, "written_at").distinct()
    # bounds as aggregates: a condition on the window's own bounds would be applied before sessions are merged
    return writes.groupBy(*keys, F.session_window("written_at", ttl)).agg(
        F.min("written_at").alias("began"), (F.max("written_at") + F.expr(f"INTERVAL {ttl}")).alias("ends")).drop("session_window")


def live(spark: SparkSession, root: str, asof: Column, ttl_seconds: int = TREND_TTL_SECONDS) -> DataFrame:
    """(scope, minute, genre, song_id, plays, expires_at) of the boards alive at ``asof``; writes after it are not seen."""
    asof = asof.cast("timestamp")
    rows = spark.read.parquet(f"{root.rstrip('/')}/leaderboard").filter(F.col("written_at") <= asof).drop("slot", "run", "epoch")
    out = None
    for scope, keys in (("genre", ["minute", "genre"]), ("global", ["minute"])):
        alive = _sessions(rows, keys, ttl_seconds).filter(F.col("ends") > asof)
        # keys are few next to their songs; an ended session's rows are older than the live one's beginning
        board = rows.join(alive, keys).filter(F.col("written_at") >= F.col("began")).groupBy(*keys, "song_id").agg(
            F.sum("plays").alias("plays"), F.max("ends").alias("expires_at"))
        board = board.select(F.lit(scope).alias("scope"), "minute", F.col("genre") if "genre" in keys else F.lit(None).cast("string").alias("genre"),
                             "song_id", "plays", "expires_at")
        out = board if out is None else out.unionByName(board)
    return out


def expire(spark: SparkSession, root: str, asof: Column, ttl_seconds: int = TREND_TTL_SECONDS) -> int:
    """Remove each epoch's folder of a slot in which every minute's session of writes, over all genres, has ended by ``asof``;
    returns how many. The board of all genres is the last of a minute's keys to die.
    """
    root = root.rstrip("/")
    rows = spark.read.parquet(f"{root}/leaderboard")
    asof = asof.cast("timestamp")
    written = rows.groupBy("slot", "run", "epoch", "minute", "written_at").agg(F.count(F.lit(1)).alias("songs"))
    sessions = _sessions(rows, ["minute"], ttl_seconds)
    ended = written.join(sessions, "minute").filter((F.col("written_at") >= F.col("began")) & (F.col("written_at") < F.col("ends")))
    dead = ended.groupBy("slot", "run", "epoch").agg(F.max("ends").alias("ends")).filter(F.col("ends") <= asof)
    jvm, conf, gone = spark._jvm, spark._jsc.hadoopConfiguration(), 0
    for r in dead.toLocalIterator():  # names of folders
        path = jvm.org.apache.hadoop.fs.Path(f"{root}/leaderboard/slot={r.slot}/run={r.run}/epoch={r.epoch}")
        fs = path.getFileSystem(conf)
        gone += bool(fs.delete(path, True))
        for parent in (path.getParent(), path.getParent().getParent()):  # empty ones go too
            if fs.exists(parent) and not fs.listStatus(parent):
                fs.delete(parent, False)
    return gone
