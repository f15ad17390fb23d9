"""Exact distinct listeners that merge over epochs.

Users get dense numbers from a dictionary that grows with the log; a minute's listeners are bitmaps over them, 32,768 users to
a piece. Epochs write their own bitmaps and ``bitmap_or_agg`` unites them, so a listener heard in several batches, or
in several minutes of a day, counts once; a replay rewrites its epoch's bitmaps and finds its users' numbers again. The dictionary is append-only
and one job writes it: an append is committed whole, so a batch that breaks off has given out its numbers or none.

Numbers are dealt in ``LANES``: a user's hash names a lane, a lane numbers its new users in the order of their hashes after
those it has, and lanes interleave. So no window runs over all users, and numbers stay dense as lanes are filled evenly.
The dictionary grows with the log: it is joined by merging, never broadcast, so it does not pass the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from streamcharts.streaming.compaction import read_if_there

LANES = 256


class ListenerSink:
    """``foreachBatch`` callback on decoded plays ``(song_id, window_start, user_hash)``: dictionary first, then bitmaps."""

    def __init__(self, root: str, run_id: str, lanes: int = LANES):
        self.root, self.run_id, self.lanes = root.rstrip("/"), run_id, lanes

    def __call__(self, plays: DataFrame, epoch_id: int) -> None:
        self._number(plays)
        users = plays.sparkSession.read.parquet(f"{self.root}/users").select("user_hash", "user_no")
        # one row a listener and minute before the dictionary is met
        heard = plays.select("song_id", "window_start", "user_hash").distinct().join(users.hint("merge"), "user_hash")
        bitmaps = heard.groupBy("song_id", "window_start", F.bitmap_bucket_number("user_no").alias("piece")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("user_no")).alias("listeners"))
        bitmaps.withColumn("day", F.to_date("window_start")).withColumn("run", F.lit(self.run_id)).withColumn(
            "epoch", F.lit(int(epoch_id)).cast("long")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "day", "run", "epoch").parquet(f"{self.root}/listeners")

    def _number(self, plays: DataFrame) -> None:
        """Numbers for the users that have none. Each call adds files of its own, so what an epoch gave out before stays."""
        spark = plays.sparkSession
        users = plays.select("user_hash").distinct().withColumn("lane", F.pmod(F.xxhash64("user_hash"), F.lit(self.lanes)))
        known = read_if_there(spark, f"{self.root}/users")
        if known is None:
            users = users.withColumn("used", F.lit(0))
        else:
            used = known.groupBy(F.pmod(F.xxhash64("user_hash"), F.lit(self.lanes)).alias("lane")).agg(F.count(F.lit(1)).alias("used"))  # a row a lane
            users = users.join(known.select("user_hash").hint("merge"), "user_hash", "left_anti").join(used, "lane", "left")
        place = F.row_number().over(Window.partitionBy("lane").orderBy("user_hash")) - 1 + F.coalesce("used", F.lit(0))
        new = users.select("user_hash", (place * self.lanes + F.col("lane") + 1).cast("long").alias("user_no"))
        new.write.mode("append").parquet(f"{self.root}/users")


def unique_listeners(spark: SparkSession, root: str, grain: str = "minute") -> DataFrame:
    """(song_id, window_start, unique_listeners) per minute, or per ``hour`` or ``day``: exact over all epochs."""
    rows = spark.read.parquet(f"{root.rstrip('/')}/listeners")
    if grain != "minute":
        rows = rows.withColumn("window_start", F.date_trunc(grain, "window_start").cast(rows.schema["window_start"].dataType))
    return rows.groupBy("song_id", "window_start", "piece").agg(F.bitmap_count(F.bitmap_or_agg("listeners")).alias("n")).groupBy(
        "song_id", "window_start").agg(F.sum("n").alias("unique_listeners"))
