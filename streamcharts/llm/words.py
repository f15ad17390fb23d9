"""Word counts of whole texts, for the operators that learn from the corpus."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamcharts.llm.common import in_batches, written

#: Bytes of text that are split into words at a time.
PIECE = 4 << 20
#: Distinct words that a task counts before it hands them on.
HELD = 200_000


def pieces(batch: pa.RecordBatch, column: int, size: int = PIECE) -> Iterator[pa.RecordBatch]:
    """The rows of ``batch`` in runs of about ``size`` bytes of text, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = held = 0
    for i, n in enumerate(sizes):
        if held and held + n > size:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if len(sizes) > start:
        yield batch.slice(start)


def words_of(texts: pa.Array) -> pa.ListArray:
    """Lists of words: A-Z lower-cased, split at \\x20 and \\x09-\\x0D; empty strings may stand at the ends."""
    return pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, int] = {}

    def counted() -> pa.RecordBatch:
        held.pop("", None)
        out = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])
        held.clear()
        return out

    for batch in batches:
        for part in pieces(batch, 0):
            got = pc.value_counts(words_of(part.column(0)).flatten())
            for w, n in zip(got.field("values").to_pylist(), got.field("counts").to_pylist(), strict=True):
                held[w] = held.get(w, 0) + n
        if len(held) > HELD:
            yield counted()
            pa.default_memory_pool().release_unused()
    yield counted()


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """word, n over all documents; counted in each task before the shuffle."""
    return in_batches(docs.select(F.col(text_col).alias("text"))).mapInArrow(_count, "word string, n bigint").groupBy(
        "word").agg(F.sum("n").alias("n"))


def most_frequent(words: DataFrame, most: int) -> list[str]:
    """The ``most`` words of the largest counts, ties in code point order.

    A histogram over the counts' magnitudes (at most 64 * 16 rows) tells from which magnitude on to look, so that
    tasks send the driver little more than what it keeps.
    """
    words = written(words.select("word", "n", F.floor(F.log2(F.col("n").cast("double")) * 16).alias("size")), "word-counts")
    low, seen = 0, 0
    for r in sorted(words.groupBy("size").count().collect(), reverse=True):
        low, seen = r["size"], seen + r["count"]
        if seen >= most:
            break
    return [r.word for r in words.filter(F.col("size") >= low).orderBy(F.desc("n"), "word").limit(most).collect()]
