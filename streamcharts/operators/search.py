"""Substring search by a trigram index (P10, Q3).

``build_index`` writes, for each run of three characters of the lower-cased texts, the ids of the rows that hold it:
posting lists in pieces of ``PIECE`` consecutive ids, so that a frequent trigram is many rows and no array grows with the
catalog, in ``BUCKETS`` folders by the trigram's hash; beside it how many rows hold each trigram.

A pattern's literal runs name trigrams that every match must hold. The ``RAREST`` of them are looked up, the ids that all of
them list are candidates (the lists meet piece by piece, before they become rows), and ``ilike`` on the candidates' rows decides, with ``%`` and ``_`` as wildcards. So results equal
the scan's. A pattern without a literal run of three characters, or with a backslash, names no trigram: it is answered by the
scan itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from streamcharts.constants import CATALOG_DEFAULT_LIMIT, CATALOG_MAX_LIMIT
from streamcharts.functions.scalars import clamp_limit

BUCKETS = 64
PIECE = 1 << 16   # ids to a posting row
RAREST = 3        # trigrams of a pattern that are looked up
LONGER = 4        # but none that so many times more rows hold than the rarest: its list costs more than it excludes


def trigrams(text: Column) -> Column:
    """The distinct runs of three characters of an already lower-cased text."""
    n = F.char_length(text)
    return F.when(n >= 3, F.array_distinct(F.transform(F.sequence(F.lit(1), n - 2), lambda i: F.substring(text, i, F.lit(3))))).otherwise(
        F.array().cast("array<string>"))


def like_pattern(q: Column) -> Column:
    return F.concat(F.lit("%"), q, F.lit("%"))


def pattern_trigrams(q: Column) -> Column:
    """Trigrams that every match of the pattern holds; empty where the scan has to answer."""
    literal = F.split(F.lower(like_pattern(q)), "[%_]")
    grams = F.array_distinct(F.flatten(F.transform(literal, trigrams)))
    return F.when(F.contains(q, F.lit("\\")), F.array().cast("array<string>")).otherwise(grams)


def _bucket(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(BUCKETS)).cast("int")


def build_index(cards: DataFrame, path: str, columns: tuple[str, ...] = ("title", "artist"), id_col: str = "id") -> None:
    """Write the index of ``cards`` to ``path``. A null text holds nothing."""
    spark, path = cards.sparkSession, path.rstrip("/")
    texts = [F.coalesce(trigrams(F.lower(F.col(c))), F.array().cast("array<string>")) for c in columns]
    held = cards.select(F.col(id_col).cast("long").alias("id"), F.explode(F.array_distinct(F.flatten(F.array(*texts)))).alias("gram"))
    lists = held.groupBy("gram", F.floor(F.col("id") / PIECE).alias("piece")).agg(F.sort_array(F.collect_set("id")).alias("ids"))
    lists.withColumn("bucket", _bucket(F.col("gram"))).hint("rebalance", "bucket").sortWithinPartitions("bucket", "gram", "piece").write.mode(
        "overwrite").partitionBy("bucket").parquet(f"{path}/postings")
    postings = spark.read.parquet(f"{path}/postings")
    postings.groupBy("gram").agg(F.sum(F.size("ids")).alias("n")).sort("gram").write.mode("overwrite").parquet(f"{path}/grams")


def matches(columns: tuple[str, ...], pattern: Column) -> Column:
    found = F.lit(False)
    for c in columns:
        found = found | F.coalesce(F.ilike(F.col(c), pattern), F.lit(False))
    return found


def _candidates(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """(pattern, id) of the rows that hold the rarest trigrams of each pattern of ``wanted(pattern, grams)``.

    A pattern with a trigram that nothing holds has none.
    """
    counts = spark.read.parquet(f"{path}/grams")
    each = wanted.select("pattern", F.explode("grams").alias("gram")).join(counts, "gram", "left")
    order = Window.partitionBy("pattern").orderBy(F.col("n").asc_nulls_first(), "gram")  # a row a trigram of the pattern
    rare = each.withColumn("_rn", F.row_number().over(order)).withColumn(
        "_least", F.min(F.coalesce("n", F.lit(0))).over(Window.partitionBy("pattern"))).filter(
        (F.col("_rn") <= RAREST) & (F.col("n") <= LONGER * F.col("_least")))
    rare = rare.withColumn("_k", F.count(F.lit(1)).over(Window.partitionBy("pattern"))).withColumn("bucket", _bucket(F.col("gram")))
    lists = rare.join(spark.read.parquet(f"{path}/postings"), ["bucket", "gram"]).groupBy("pattern", "piece").agg(
        F.collect_list("ids").alias("_lists"), F.first("_k").alias("_k")).filter(F.size("_lists") == F.col("_k"))
    common = F.aggregate(F.slice("_lists", 2, RAREST), F.col("_lists")[0], F.array_intersect)  # at most RAREST lists of PIECE ids
    return lists.select("pattern", F.explode(common).alias("id"))


def search_all(cards: DataFrame, path: str, patterns: DataFrame, columns: tuple[str, ...] = ("title", "artist")) -> DataFrame:
    """(pattern, and the card) of every match of every pattern of ``patterns(pattern)``.

    Patterns that name no trigram are told by name to one scan of the cards for all of them.
    """
    spark = cards.sparkSession
    wanted = patterns.select("pattern").filter("pattern is not null").distinct().withColumn("grams", pattern_trigrams(F.col("pattern")))
    found = cards.join(_candidates(spark, path.rstrip("/"), wanted.filter(F.size("grams") > 0)), "id")
    found = found.filter(matches(columns, like_pattern(F.col("pattern"))))
    short = [r.pattern for r in wanted.filter(F.size("grams") == 0).collect()]  # the caller's own short patterns
    if short:
        scanned = cards.withColumn("pattern", F.explode(F.array(*[F.lit(p) for p in short])))
        found = found.unionByName(scanned.filter(matches(columns, like_pattern(F.col("pattern")))))
    return found


def search(cards: DataFrame, path: str, q: str, genre: str | None = None, limit=None, columns: tuple[str, ...] = ("title", "artist")) -> DataFrame:
    """Q3 by the index: cards whose title or artist holds ``q``, of one genre if given, by id, top n."""
    n = clamp_limit(limit, CATALOG_DEFAULT_LIMIT, CATALOG_MAX_LIMIT)
    spark = cards.sparkSession
    rows = cards.filter(F.col("genre") == genre) if genre else cards
    grams = spark.range(1).select(pattern_trigrams(F.lit(q)).alias("g")).first().g
    if grams:
        counts = spark.read.parquet(f"{path.rstrip('/')}/grams").filter(F.col("gram").isin(grams)).orderBy("n", "gram").collect()  # a row a trigram of q
        if len(counts) < len(grams):
            return rows.limit(0)
        rare = [r.gram for r in counts[:RAREST]]
        buckets = [r.b for r in spark.createDataFrame([(g,) for g in rare], "gram string").select(_bucket(F.col("gram")).alias("b")).collect()]
        lists = spark.read.parquet(f"{path.rstrip('/')}/postings").filter(F.col("bucket").isin(buckets) & F.col("gram").isin(rare))
        ids = lists.select(F.explode("ids").alias("id")).groupBy("id").count().filter(F.col("count") == len(rare)).select("id")
        rows = rows.join(ids, "id", "left_semi")
    return rows.filter(matches(columns, like_pattern(F.lit(q)))).orderBy("id").limit(n)
