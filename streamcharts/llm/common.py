"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streamcharts.session import scratch_path

#: Fixed value: what separates words in every contract of this subpackage.
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(col: Column | str) -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only. Texts of one byte a character take the faster built-in."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


#: Bytes of an Arrow batch that a Python worker holds at a time. Texts are long, so rows are the wrong measure.
ARROW_BYTES = "4m"


def in_batches(df: DataFrame, size: str = ARROW_BYTES) -> DataFrame:
    """``df`` for a Python stage: batches end at ``size``, whatever the texts' lengths. A setting of the session."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)
    return df


def smallest_hashes(df: DataFrame, most: int, *keys: str) -> DataFrame:
    """The ``most`` rows with the smallest hashes of ``keys``: a sample that reruns agree on.

    Rows far above the bound that so many rows would have are left out first, so that the tasks together
    forward little more than what stays.
    """
    total, size = df.count(), 1 << 30
    place = F.pmod(F.xxhash64(*keys), F.lit(size))
    if total > 4 * most:
        df = df.filter(place < int(size * (2 * most + 1000) / total))
    return df.orderBy(place, *keys).limit(most)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared scratch folder, read back: cuts the lineage, outlives executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, key: str, distinct: bool = False) -> DataFrame:
    """``written``, dealt by ``key`` into as many buckets as shuffles have partitions: joins on ``key`` move only the other side.
    ``distinct``: repeated rows once."""
    spark = df.sparkSession
    path, n = scratch_path(spark, name), int(spark.conf.get("spark.sql.shuffle.partitions"))
    known_as = os.path.basename(path).replace("-", "_")
    df = df.repartition(n, key)
    (df.dropDuplicates() if distinct else df).write.format("parquet").bucketBy(n, key).option("path", path).saveAsTable(known_as)
    table = spark.table(known_as)
    spark.sql(f"DROP TABLE {known_as}")  # its files stay: only the catalogue forgets the name
    return table
