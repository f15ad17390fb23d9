"""Command-line launcher for the rollup job (Q11's entry point).

    spark-submit streamcharts/streaming/run.py --format kafka --topic play-events \
        --bootstrap-servers broker:9092 --output s3://bucket/rollups

The checkpoint defaults to a folder under ``spark.checkpoint.dir``; the HMAC
key is read from a file, which must be given, so it never appears in process listings.
"""

from __future__ import annotations

import argparse
import os
import sys

if __package__ in (None, ""):  # run as a file by spark-submit
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark.sql import SparkSession  # noqa: E402

from streamcharts.session import ensure_conf  # noqa: E402
from streamcharts.sources.streams import message_stream  # noqa: E402
from streamcharts.streaming.processor import start_rollups  # noqa: E402


def parse_args(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description="Decode, pseudonymize and roll up play events.")
    p.add_argument("--format", default="kafka", choices=["kafka", "json", "parquet"])
    p.add_argument("--path", help="input folder for json/parquet record files")
    p.add_argument("--topic", default="play-events")
    p.add_argument("--bootstrap-servers")
    p.add_argument("--starting-offsets", default="latest")
    p.add_argument("--max-per-trigger", type=int, help="offsets (kafka) or files per micro-batch")
    p.add_argument("--output", required=True, help="root folder of the delta tables")
    p.add_argument("--checkpoint", help="default: under spark.checkpoint.dir")
    p.add_argument("--trigger-seconds", type=int, default=5)
    p.add_argument("--once", action="store_true", help="process what is available, then stop")
    p.add_argument("--salt-file", required=True, help="file holding the pseudonym key")
    p.add_argument("--event-types", default="play", help="comma-separated types to roll up")
    return p.parse_args(argv)


def main(argv=None, spark: SparkSession | None = None):
    args = parse_args(argv)
    spark = spark or SparkSession.builder.appName("streamcharts-rollups").getOrCreate()
    ensure_conf(spark)
    with open(args.salt_file, "rb") as f:
        salt = f.read().strip()
    if not salt:
        raise SystemExit("the key file is empty")
    stream = message_stream(spark, args.format, path=args.path, topic=args.topic,
                            bootstrap_servers=args.bootstrap_servers, starting_offsets=args.starting_offsets,
                            max_per_trigger=args.max_per_trigger)
    trigger = {"availableNow": True} if args.once else {"processingTime": f"{args.trigger_seconds} seconds"}
    query = start_rollups(stream, args.output, args.checkpoint, trigger=trigger, salt=salt,
                          event_types=tuple(t for t in args.event_types.split(",") if t))
    query.awaitTermination()
    return query


if __name__ == "__main__":
    main()
