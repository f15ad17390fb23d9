"""Streaming intake (Q10 as a stream: P13, P14, P19, J4, K12, A10, A11).

Play/skip/like requests arrive as a stream; each micro-batch reads the song and
account tables anew and joins the requests to them -- inside ``foreachBatch``, where
adaptive execution applies -- publishes the accepted events as keyed records and writes
the refused ones, counted by reason and type. File output goes under
``run=<id>/epoch=<batch>`` (dynamic overwrite: a replayed batch rewrites its
own files); a Kafka sink is at-least-once, as the reference's producer was.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from streamcharts.operators.events import accept_events, to_messages
from streamcharts.session import ensure_conf, scratch_path
from streamcharts.streaming.processor import run_id_for


# Reads a lookup table as it is now. A frame made before the stream starts lists its files once, and
# songs added later would be refused as unknown.
Loader = Callable[[SparkSession], DataFrame]


class IntakeSink:
    """``foreachBatch`` callback: look requests up, publish the accepted, count the refused."""

    def __init__(self, root: str, run_id: str, songs: Loader, users: Loader, fmt: str = "json",
                 topic: str | None = None, bootstrap_servers: str | None = None):
        self.songs = songs
        self.users = users
        self.root = root.rstrip("/")
        self.run_id = run_id
        self.fmt = fmt
        self.topic = topic
        self.bootstrap_servers = bootstrap_servers

    def _write(self, df: DataFrame, table: str, epoch_id: int, fmt: str) -> None:
        (
            df.withColumn("run", F.lit(self.run_id))
            .withColumn("epoch", F.lit(int(epoch_id)).cast("long"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("run", "epoch")
            .format(fmt)
            .save(f"{self.root}/{table}")
        )

    def __call__(self, requests: DataFrame, epoch_id: int) -> None:
        # The lookups run here, per micro-batch, rather than in the streaming plan: inside
        # foreachBatch AQE is active, so a small lookup side is broadcast at run time and a
        # song holding most of a batch is split by skew-join handling.
        spark = requests.sparkSession
        checked = accept_events(requests, self.songs(spark), self.users(spark)).persist()
        try:
            if checked.isEmpty():
                return
            accepted = checked.filter(F.col("reject_reason").isNull())
            ts = F.col("ts") if "ts" in checked.columns else F.current_timestamp()
            messages = to_messages(accepted, ts)
            if self.fmt == "kafka":
                (
                    messages.write.format("kafka")
                    .option("kafka.bootstrap.servers", self.bootstrap_servers)
                    .option("topic", self.topic)
                    .save()
                )
            else:
                self._write(messages, "messages", epoch_id, self.fmt)
            refused = checked.filter(F.col("reject_reason").isNotNull()).groupBy("reject_reason", "type").agg(
                F.count(F.lit(1)).alias("requests")
            )
            self._write(refused, "refused", epoch_id, "parquet")
        finally:
            checked.unpersist()


def start_intake(requests: DataFrame, songs: Loader, users: Loader, output_root: str,
                 checkpoint: str | None = None, trigger: dict | None = None, fmt: str = "json",
                 topic: str | None = None, bootstrap_servers: str | None = None) -> StreamingQuery:
    """Validate a request stream ``(type, user_id, song_id[, ts, ...])`` and publish accepted events.

    ``songs`` and ``users`` are called for every micro-batch and return the tables as they are then.
    """
    spark = requests.sparkSession
    ensure_conf(spark)
    checkpoint = checkpoint or scratch_path(spark, "intake-checkpoint")
    run_id = run_id_for(spark, checkpoint, output_root)
    sink = IntakeSink(output_root, run_id, songs, users, fmt, topic, bootstrap_servers)
    return (
        requests.writeStream.foreachBatch(sink)  # lookups (J4), per micro-batch
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .start()
    )


def refused_counts(spark, root: str) -> DataFrame:
    """Refused requests by reason over all batches."""
    return spark.read.parquet(f"{root.rstrip('/')}/refused").groupBy("reject_reason").agg(
        F.sum("requests").alias("rejected")
    )


def published_messages_path(root: str) -> str:
    return f"{root.rstrip('/')}/messages"
