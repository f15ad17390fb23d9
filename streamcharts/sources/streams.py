"""Event-log stream sources.

``kafka`` needs the Kafka connector on the classpath; it is not bundled here
and is untested in this repository. ``json``/``parquet`` read a directory of
record files with the same ``key``/``value`` columns, which is how tests and
offline replays drive the identical downstream plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamcharts.sources.schemas import MESSAGE_SCHEMA


def message_stream(
    spark: SparkSession,
    fmt: str = "json",
    path: str | None = None,
    topic: str | None = None,
    bootstrap_servers: str | None = None,
    starting_offsets: str = "latest",
    max_per_trigger: int | None = None,
) -> DataFrame:
    """A streaming frame of ``key, value`` strings.

    The offset position is read from the checkpoint after the first run;
    ``starting_offsets`` only applies to a fresh checkpoint. ``max_per_trigger``
    bounds each micro-batch (offsets for Kafka, files otherwise).
    """
    if fmt == "kafka":
        reader = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap_servers)
            .option("subscribe", topic)
            .option("startingOffsets", starting_offsets)
        )
        if max_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", int(max_per_trigger))
        raw = reader.load()
        return raw.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))
    if path is None:
        raise ValueError("a path is required for file streams")
    reader = spark.readStream.schema(MESSAGE_SCHEMA)
    if max_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_per_trigger))
    return reader.format(fmt).load(path)


def write_messages(messages: DataFrame, fmt: str = "json", path: str | None = None, topic: str | None = None,
                   bootstrap_servers: str | None = None, mode: str = "append") -> None:
    """Publish keyed records in one batch write (Kafka or files)."""
    if fmt == "kafka":
        (
            messages.write.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap_servers)
            .option("topic", topic)
            .save()
        )
        return
    messages.write.mode(mode).format(fmt).save(path)
