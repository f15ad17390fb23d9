"""Gateway access-log lines (S10) and metric samples.

Line format: ``addr "METHOD path PROTO" status <seconds>s -> upstream``, where a request
that the gateway tried again names every upstream, with commas between; the last one answered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streamcharts.sources.schemas import REQUEST_LOG

ACCESS_LINE = r'^(\S+) "(\S+) (\S+)[^"]*" (\d{3}) ([0-9.]+)s -> (\S+(?:\s*,\s*\S+)*)$'


def format_access_line(addr: Column, method: Column, path: Column, status: Column, seconds: Column,
                       upstream: Column) -> Column:
    return F.format_string('%s "%s %s HTTP/1.1" %d %.3fs -> %s', addr, method, path, status, seconds, upstream)


def parse_access_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """Split access-log text into typed columns; lines that do not match get ``parsed = false``."""
    v = F.col(col)

    def grp(i):
        return F.regexp_extract(v, ACCESS_LINE, i)

    return lines.select(
        grp(1).alias("addr"),
        grp(2).alias("method"),
        grp(3).alias("path"),
        grp(4).try_cast("int").alias("status"),
        grp(5).try_cast("double").alias("request_seconds"),
        F.nullif(F.regexp_extract(grp(6), r"([^\s,]+)$", 1), F.lit("")).alias("upstream"),
        F.when(v.rlike(ACCESS_LINE), F.size(F.split(grp(6), ","))).alias("tries"),
        v.rlike(ACCESS_LINE).alias("parsed"),
    )


def read_access_log(spark: SparkSession, path: str) -> DataFrame:
    """Text files, one line per request, split into columns."""
    return parse_access_lines(spark.read.text(path))


def read_request_log(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A stored request log with the fixed schema (no inference)."""
    return spark.read.format(fmt).schema(REQUEST_LOG).load(path)
