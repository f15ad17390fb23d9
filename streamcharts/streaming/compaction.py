"""Levelled compaction, erasure and retention of the delta log.

The rollup job adds an epoch folder per micro-batch and never rewrites one but its own. ``compact`` folds the epochs that
came since the last time, all but each run's newest (it may still be replayed), into *segments*, one row per key:

* ``base/<table>/segment=<version>-<n>/<part>=...``: parts are days (``song_minute``, ``song_span``) or buckets of users'
  hashes (``user_genre``)
* ``base/manifest/version=N``: which parts of which segments hold, their levels, and the last folded epoch of each
  run; written last, by one committed write

A part with ``FAN`` segments of a level has them merged into one of the next. So a compaction writes what is new and, now and
then, parts that were touched often; a day without late events is never written again. ``song_span`` holds the same
plays summed over hours and days, for windows that read few rows (``views.window_plays``).

``erase`` records users' hashes as tombstones. Reads hide their rows at once; the next compaction rewrites the parts that
hold them, and only those: a hash names its bucket, and of that bucket's segments those are written again in which
it is found. Epochs up to the erasure stay hidden if they are delivered again; what a user does later counts.
Play counts hold no user and stay. The listeners' sketches hold hashes of hashes, from which no user's can be taken out
without the events: they stay until their minutes are rolled up anew.

Readers (``views``) take the newest manifest, the segments it names and the epochs above its pointer, so a compaction
that breaks off changes nothing, and a folded epoch that is delivered again is not read a second time. ``vacuum`` removes folders
that no reader of the newest versions needs.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = {"song_minute": ["day", "song_id", "genre", "window_start"], "song_span": ["day", "span", "song_id", "genre", "window_start"],
        "user_genre": ["bucket", "user_hash", "genre"]}
PART = {"song_minute": "day", "song_span": "day", "user_genre": "bucket"}
SOURCE = {"song_minute": "song_minute", "song_span": "song_minute", "user_genre": "user_genre"}  # table of epochs that each is folded from
SPANS = (60, 1440)  # minutes of the coarser sums, each a multiple of the one before
FAN = 4             # segments of a level that a part may have
BUCKETS = 16        # of users' hashes; a root keeps those it began with, so give a large one more

_MANIFEST = "kind string, table string, part string, segment string, level int, rows bigint, name string, number bigint"


@dataclass(frozen=True)
class Piece:
    """A part of a segment, and the rows it holds."""

    table: str
    part: str
    segment: str
    level: int
    rows: int

    @property
    def since(self) -> int:
        return int(self.segment.split("-")[0])


@dataclass
class Manifest:
    version: int = 0
    folded: dict[str, int] = field(default_factory=dict)   # last folded epoch of each run
    pieces: list[Piece] = field(default_factory=list)
    cleaned: set[str] = field(default_factory=set)         # erasures that no piece is left of
    buckets: int = BUCKETS

    def of(self, table: str) -> list[Piece]:
        return [p for p in self.pieces if p.table == table]


def read_if_there(spark: SparkSession, path: str) -> DataFrame | None:
    """The parquet table at ``path``; None if there is none. Other errors are raised."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def manifest(spark: SparkSession, root: str, version: int | None = None) -> Manifest:
    """The newest manifest, or that of ``version``: a row a run, an erasure and a piece (days or buckets times a few levels)."""
    found = read_if_there(spark, f"{root.rstrip('/')}/base/manifest")
    if found is None:
        return Manifest()
    version = version if version is not None else found.agg(F.max("version")).first()[0]
    m = Manifest(version)
    for r in found.filter(F.col("version") == version).collect():
        if r.kind == "piece":
            m.pieces.append(Piece(r["table"], r.part, r.segment, r.level, r.rows))
        elif r.kind == "folded":
            m.folded[r.name] = r.number
        elif r.kind == "cleaned":
            m.cleaned.add(r.name)
        else:
            m.buckets = r.number
    return m


def _commit(spark: SparkSession, root: str, m: Manifest) -> None:
    rows = [("piece", p.table, p.part, p.segment, p.level, p.rows, None, None) for p in m.pieces]
    rows += [("folded", None, None, None, None, None, k, v) for k, v in sorted(m.folded.items())]
    rows += [("cleaned", None, None, None, None, None, k, None) for k in sorted(m.cleaned)]
    rows += [("buckets", None, None, None, None, None, None, m.buckets)]
    spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.parquet(f"{root}/base/manifest/version={m.version}")


def pointer(spark: SparkSession, root: str) -> tuple[int, dict[str, int]]:
    """The newest version (0: none yet) and each folded run's last folded epoch."""
    m = manifest(spark, root)
    return m.version, m.folded


def open_epochs(frame: DataFrame, folded: dict[str, int]) -> DataFrame:
    """The epochs above the pointer. Only partition columns are named, so folded folders are not listed for reading."""
    for run, upto in folded.items():
        frame = frame.filter(~((F.col("run") == run) & (F.col("epoch") <= upto)))
    return frame


# ------------------------------------------------------------------ tombstones
def erase(spark: SparkSession, root: str, hashes: DataFrame) -> str:
    """Record the users of ``hashes(user_hash)`` as erased up to now; returns the erasure's name."""
    root, name = root.rstrip("/"), "e" + uuid.uuid4().hex[:15]
    newest = _newest_epochs(spark, root)
    hashes.select("user_hash").filter("user_hash is not null").distinct().write.parquet(f"{root}/tombstones/users/erasure={name}")
    at = [(run, epoch, manifest(spark, root).version) for run, epoch in newest.items()] or [("", -1, manifest(spark, root).version)]
    spark.createDataFrame(at, "run string, upto bigint, version bigint").coalesce(1).write.parquet(
        f"{root}/tombstones/since/erasure={name}")  # an erasure without this is not there
    return name


def _newest_epochs(spark: SparkSession, root: str) -> dict[str, int]:
    log = read_if_there(spark, f"{root}/batches")
    return {} if log is None else {r.run: r.epoch for r in log.groupBy("run").agg(F.max("epoch").alias("epoch")).collect()}


def _erasures(spark: SparkSession, root: str, m: Manifest) -> tuple[DataFrame | None, set[str]]:
    """Tombstones that may still hide something, ``(user_hash, run, upto, version, erasure)``, and those with pieces to clean."""
    since = read_if_there(spark, f"{root}/tombstones/since")
    if since is None:
        return None, set()
    rows = since.collect()  # a row a run and erasure
    unclean = {r.erasure for r in rows} - m.cleaned
    needed = unclean | {r.erasure for r in rows if r.upto > m.folded.get(r.run, -1)}
    if not needed:
        return None, set()
    users = spark.read.parquet(f"{root}/tombstones/users").filter(F.col("erasure").isin(sorted(needed)))
    return users.join(since.filter(F.col("erasure").isin(sorted(needed))), "erasure"), unclean


def _without(rows: DataFrame, erased: DataFrame | None, condition: str) -> DataFrame:
    """Rows that no tombstone hides."""
    if erased is None:
        return rows
    t = erased.select(F.col("user_hash").alias("_hash"), F.col("run").alias("_run"), F.col("upto").alias("_upto"), F.col("version").alias("_version"))
    return rows.join(t, F.expr(f"user_hash = _hash AND {condition}"), "left_anti")


_IN_EPOCHS = "run = _run AND epoch <= _upto"
_IN_PIECES = "_since <= _version"


# --------------------------------------------------------------------- reading
def _pieces(spark: SparkSession, root: str, pieces: list[Piece]) -> DataFrame:
    """The rows of some pieces of one table, with ``_since``: the version that wrote them."""
    table = pieces[0].table
    frame = spark.read.option("basePath", f"{root}/base/{table}").parquet(
        *[f"{root}/base/{table}/segment={p.segment}/{PART[table]}={p.part}" for p in pieces])
    return frame.withColumn("_since", F.substring_index("segment", "-", 1).cast("long")).drop("segment")


def base_rows(spark: SparkSession, root: str, table: str, m: Manifest | None = None, parts: tuple[str, str] | None = None) -> DataFrame | None:
    """What is folded of ``table``, without erased users; None where nothing is. ``parts``: only those of the
    range (days as ISO text), so that the others' folders are not even listed."""
    root = root.rstrip("/")
    m = m or manifest(spark, root)
    pieces = [p for p in m.of(table) if parts is None or parts[0] <= p.part <= parts[1]]
    if not pieces:
        return None
    rows = _pieces(spark, root, pieces)
    if table == "user_genre":
        erased, unclean = _erasures(spark, root, m)
        if unclean:
            rows = _without(rows, erased.filter(F.col("erasure").isin(sorted(unclean))), _IN_PIECES)
    return rows.drop("_since")


def epoch_rows(spark: SparkSession, root: str, table: str, m: Manifest | None = None) -> DataFrame:
    """What is not folded yet of ``table``, without erased users, with ``first_written``."""
    root = root.rstrip("/")
    m = m or manifest(spark, root)
    rows = open_epochs(spark.read.parquet(f"{root}/{table}"), m.folded)
    if table == "user_genre":
        rows = _without(rows, _erasures(spark, root, m)[0], _IN_EPOCHS)
    return rows.drop("run", "epoch").withColumn("first_written", F.col("written_at"))


def log_rows(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Base rows and open epochs of ``table``, with ``first_written`` and ``written_at`` of each row."""
    m = manifest(spark, root)
    rows, base = epoch_rows(spark, root, table, m), base_rows(spark, root, table, m)
    return rows if base is None else rows.unionByName(base.drop("bucket"))


# ------------------------------------------------------------------ compaction
def _fold(rows: DataFrame, table: str) -> DataFrame:
    aggs = [F.sum("plays").cast("long").alias("plays"), F.max("written_at").alias("written_at"),
            F.min("first_written").alias("first_written")]
    if table == "song_minute":
        aggs += [F.max("uniq_approx").alias("uniq_approx"), F.hll_union_agg("uniq_sketch", True).alias("uniq_sketch")]
    return rows.groupBy(*KEYS[table]).agg(*aggs)


def span_start(at: Column, span: Column | int) -> Column:
    """The beginning of the span of so many minutes that holds ``at``."""
    length = (span if isinstance(span, Column) else F.lit(span)) * 60
    seconds = F.unix_seconds(at.cast("timestamp"))
    return F.timestamp_seconds(seconds - F.pmod(seconds, length))


def _spans(rows: DataFrame) -> DataFrame:
    """Minutes as members of their hours and days."""
    rows = rows.withColumn("span", F.explode(F.array(*[F.lit(s) for s in SPANS])))
    return rows.withColumn("window_start", span_start(F.col("window_start"), F.col("span")).cast(rows.schema["window_start"].dataType))


class _Compaction:
    """One compaction under way: writes segments of the next version, keeps the manifest to be."""

    def __init__(self, spark: SparkSession, root: str, m: Manifest):
        self.spark, self.root, self.m, self.n = spark, root, replace(m, version=m.version + 1, pieces=list(m.pieces), cleaned=set(m.cleaned)), 0

    def write(self, rows: DataFrame, table: str, level: int) -> None:
        """``rows`` folded as a new segment."""
        name = f"{self.m.version:08d}-{self.n}"
        self.n += 1
        path = f"{self.root}/base/{table}/segment={name}"
        part = PART[table]
        # parts lie together, a large one in several files; the fold's own shuffle is by all keys
        _fold(rows, table).hint("rebalance", part).write.mode("overwrite").partitionBy(part).parquet(path)
        written = read_if_there(self.spark, path)
        if written is None:
            return  # nothing but erased rows
        for r in written.groupBy(F.col(part).cast("string").alias("part")).count().collect():
            self.m.pieces.append(Piece(table, r.part, name, level, r["count"]))

    def replace(self, old: list[Piece], rows: DataFrame, level: int) -> None:
        gone = set(old)
        self.m.pieces = [p for p in self.m.pieces if p not in gone]
        self.write(rows, old[0].table, level)

    def fold_epochs(self, upto: dict[str, int]) -> None:
        new = " OR ".join(f"(run = '{run}' AND epoch <= {e})" for run, e in sorted(upto.items()))
        erased, _ = _erasures(self.spark, self.root, self.m)
        for table, source in SOURCE.items():
            rows = open_epochs(self.spark.read.parquet(f"{self.root}/{source}"), self.m.folded).filter(new)
            if table == "user_genre":
                rows = _without(rows, erased, _IN_EPOCHS).withColumn("bucket", bucket(self.m.buckets))
            rows = rows.drop("run", "epoch").withColumn("first_written", F.col("written_at"))
            self.write(_spans(rows) if table == "song_span" else rows, table, 1)
        self.m.folded = self.m.folded | upto

    def clean(self) -> None:
        """Rewrite the pieces that hold erased users."""
        erased, unclean = _erasures(self.spark, self.root, self.m)
        if not unclean:
            return
        erased = erased.filter(F.col("erasure").isin(sorted(unclean))).withColumn("bucket", bucket(self.m.buckets))
        touched = {str(r.bucket) for r in erased.select("bucket").distinct().collect()}  # at most the number of buckets
        pieces = [p for p in self.m.of("user_genre") if p.part in touched]
        if pieces:
            rows = _pieces(self.spark, self.root, pieces)
            held = rows.join(erased.select(F.col("user_hash").alias("_hash"), F.col("version").alias("_version")),
                             F.expr(f"user_hash = _hash AND {_IN_PIECES}"), "left_semi")
            found = {(str(r.bucket), r["_since"]) for r in held.select("bucket", "_since").distinct().collect()}
            hold = [p for p in pieces if (p.part, p.since) in found]
            for level in sorted({p.level for p in hold}):
                some = [p for p in hold if p.level == level]
                self.replace(some, _without(_pieces(self.spark, self.root, some), erased, _IN_PIECES).drop("_since"), level)
        self.m.cleaned |= unclean

    def merge(self, fan: int) -> None:
        """Parts with ``fan`` segments of a level get one of the next instead."""
        for table in KEYS:
            level = 1
            while level <= max((p.level for p in self.m.of(table)), default=0):
                by_part: dict[str, list[Piece]] = {}
                for p in self.m.of(table):
                    if p.level == level:
                        by_part.setdefault(p.part, []).append(p)
                full = [p for ps in by_part.values() if len(ps) >= fan for p in ps]
                if full:
                    self.replace(full, _pieces(self.spark, self.root, full).drop("_since"), level + 1)
                level += 1


def bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("user_hash"), F.lit(buckets)).cast("int")


def compact(spark: SparkSession, root: str, fan: int = FAN, buckets: int = BUCKETS) -> int:
    """Fold every run's epochs but its newest, apply erasures, merge full levels; returns the version readers now see.

    ``buckets`` counts on the first compaction of a root only.
    """
    root = root.rstrip("/")
    m = manifest(spark, root)
    m.buckets = m.buckets if m.version else buckets
    upto = m.folded | {run: e - 1 for run, e in _newest_epochs(spark, root).items() if e - 1 > m.folded.get(run, -1)}
    if upto == m.folded and not _erasures(spark, root, m)[1]:
        return m.version
    c = _Compaction(spark, root, m)
    c.clean()  # of what was there; new segments hold no erased row
    if upto != m.folded:
        c.fold_epochs(upto)
    c.merge(fan)
    _commit(spark, root, c.m)
    return c.m.version


def vacuum(spark: SparkSession, root: str, keep: int = 1) -> list[str]:
    """Remove folded epoch folders and pieces that the newest ``keep`` versions do not name; returns the paths removed.

    Run it when no reader of an older version is left.
    """
    root = root.rstrip("/")
    newest = manifest(spark, root)
    if not newest.version:
        return []
    kept = [manifest(spark, root, v) for v in range(max(1, newest.version - keep + 1), newest.version)] + [newest]
    live = {(p.table, p.segment, p.part) for m in kept for p in m.pieces}
    folded = {run: min(m.folded.get(run, -1) for m in kept) for run in newest.folded}
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    patterns = [*(f"{root}/{t}/{days}run=*/epoch=*" for t in set(SOURCE.values()) for days in ("", "day=*/")),
                *(f"{root}/base/{t}/segment=*/{p}=*" for t, p in PART.items()), f"{root}/base/manifest/version=*"]
    gone = []
    for pattern in patterns:
        path = jvm.org.apache.hadoop.fs.Path(pattern)
        for status in path.getFileSystem(conf).globStatus(path) or []:
            where = status.getPath().toString()
            parts = dict(x.split("=", 1) for x in where.split("/") if "=" in x)
            if "version" in parts:
                old = int(parts["version"]) < kept[0].version
            elif "segment" in parts:
                table = where.split("/base/")[1].split("/")[0]
                old = int(parts["segment"].split("-")[0]) <= newest.version and (table, parts["segment"], parts[PART[table]]) not in live
            else:
                old = int(parts["epoch"]) <= folded.get(parts["run"], -1)
            if old and path.getFileSystem(conf).delete(status.getPath(), True):
                gone.append(where)
    return gone
