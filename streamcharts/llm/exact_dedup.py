"""Exact deduplication as a stateful stream, in DataFrame functions only.

``dedup_state`` is the streaming job: keyed state on disk (RocksDB, checkpointed in the shared
folder), without a watermark and so without expiry. Per digest it retains the largest identifier,
the locator of that row and the number of rows. A stream that goes on later takes the same
checkpoint and output folders again; a replayed micro-batch rewrites its own epoch folder.

``dedup`` runs that job over the fingerprints of a whole table and then compares full bytes on hits:
the texts of all documents that share a digest are grouped by digest and text, with partial
aggregation before the shuffle, so a group of any number of copies moves one text per task. Digests
that hold two different texts (none in practice) are grouped anew by their text.

Defined results: null text equals empty text; a null identifier sorts below every other; of rows with
the same text and the same largest identifier, the one with the largest locator stays; repeated rows
all count; an empty table gives an empty result; columns besides identifier and text are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streamcharts.llm.common import lower_ascii, text_of, written
from streamcharts.session import scratch_path

_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # else every state partition reserves a write-ahead log of full size on disk, whatever it holds
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    # a state partition holds little at a time; stores stay open on an executor for a while after a stream ends
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "4",
    "spark.sql.streaming.stateStore.rocksdb.blockCacheSizeMB": "2",
}


def sha256(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def dedup_state(fingerprints: DataFrame, output: str, checkpoint: str, trigger: dict | None = None):
    """Start the stream. ``fingerprints``: a streaming frame of digest, doc_id, locator.

    Each micro-batch writes the digests it touched (digest, keep, group_size) to ``output/epoch=N``.
    Identifiers and counts only grow, so the largest of them over all epochs is the state.
    """
    spark = fingerprints.sparkSession
    state = fingerprints.groupBy("digest").agg(
        F.max(F.struct("doc_id", "locator")).alias("keep"), F.count(F.lit(1)).alias("group_size"))

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{output}/epoch={epoch}")

    before = {k: spark.conf.get(k, None) for k in _STORE}
    for k, v in _STORE.items():
        spark.conf.set(k, v)
    try:
        return state.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(
            write).trigger(**(trigger or {"availableNow": True})).start()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v else spark.conf.unset(k)


def read_state(spark, output: str) -> DataFrame:
    """digest, keep (doc_id, locator), group_size after all epochs so far."""
    return spark.read.parquet(output).groupBy("digest").agg(
        F.max("keep").alias("keep"), F.max("group_size").alias("group_size"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          digest: Callable[[Column], Column] = sha256, files_per_trigger: int = 100_000) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row, dropped ones too."""
    spark = docs.sparkSession
    norm = lower_ascii(text_of(text_col))
    base = docs.select(F.col(id_col).alias("doc_id"), norm.alias("norm"))
    prints = written(base.select(
        "doc_id", F.monotonically_increasing_id().alias("locator"), digest(F.col("norm")).alias("digest"),
        sha256(F.col("norm")).alias("text_sha256")), "dedup-prints")
    if prints.isEmpty():  # nothing for a stream to read
        return prints.select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(0).cast("long").alias("group_size"),
                             F.lit(True).alias("kept"), "text_sha256")
    out = scratch_path(spark, "dedup-state")
    stream = spark.readStream.schema(prints.schema).option("maxFilesPerTrigger", files_per_trigger).parquet(
        prints.inputFiles()[0].rsplit("/", 1)[0])
    dedup_state(stream, out, scratch_path(spark, "dedup-checkpoint")).awaitTermination()
    state = read_state(spark, out)
    rows = prints.join(state, "digest")

    # full bytes on hits
    hits = rows.filter("group_size > 1").select(F.col("doc_id").alias("_id")).distinct()
    texts = base.join(hits, base.doc_id.eqNullSafe(hits["_id"]), "left_semi").withColumn(
        "digest", digest(F.col("norm"))).groupBy("digest", "norm").agg(F.count(F.lit(1)).alias("n"))
    two = written(texts.groupBy("digest").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1"), "dedup-clash")
    out_cols = ["doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size",
                (F.col("locator") == F.col("keep.locator")).alias("kept"), "text_sha256"]
    if two.isEmpty():
        return rows.select(*out_cols)
    # the digest did not tell these texts apart: group them by their bytes
    apart = written(base.select("doc_id", "norm", F.monotonically_increasing_id().alias("locator"),
                                digest(F.col("norm")).alias("digest")).join(two, "digest", "left_semi"), "dedup-apart")
    classes = apart.groupBy("norm").agg(
        F.max(F.struct("doc_id", "locator")).alias("keep"), F.count(F.lit(1)).alias("group_size"))
    again = apart.join(classes, "norm").withColumn("text_sha256", sha256(F.col("norm")))
    return rows.join(two, "digest", "left_anti").select(*out_cols).unionByName(again.select(*out_cols))


def kept_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with the columns of ``docs``; of rows equal in identifier and text, one."""
    stay = dedup(docs, id_col, text_col).filter("kept").select(
        F.col("doc_id").alias("__dup_id"), F.col("text_sha256").alias("__dup_sha"))
    mark = docs.withColumn("__dup_own", sha256(lower_ascii(text_of(text_col))))

    def meet(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        return left.join(right, left[id_col].eqNullSafe(right["__dup_id"]) & (left["__dup_own"] == right["__dup_sha"]), how)

    kept = meet(mark, stay, "left_semi")
    repeats = written(mark.groupBy(F.col(id_col).alias("__dup_id"), F.col("__dup_own").alias("__dup_sha")).agg(
        F.count(F.lit(1)).alias("__dup_n")).filter("__dup_n > 1").drop("__dup_n"), "dedup-repeats")
    if not repeats.isEmpty():
        first = Window.partitionBy(id_col, "__dup_own").orderBy(*[c for c in docs.columns if c not in (id_col, text_col)] or [id_col])
        one = meet(kept, repeats, "left_semi").withColumn("__dup_rn", F.row_number().over(first)).filter("__dup_rn = 1")
        kept = meet(kept, repeats, "left_anti").unionByName(one.drop("__dup_rn"))
    return kept.drop("__dup_own")
