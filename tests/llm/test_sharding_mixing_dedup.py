import hashlib
import re
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from streamcharts.llm import exact_dedup, mixing, sharding
from streamcharts.llm.queries import QUERIES
from tests.llm.conftest import ROWS

SF = "/root/testdata/sf0.001"


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def jump(key, n):
    b, j, key = -1, 0, key % 2**64
    while j < n:
        b, key = j, (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def check_shards(rows, docs, n):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(
        (i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in docs)
    slots = defaultdict(list)
    for r in rows:
        assert (r.law, r.shard, r.grown_shard) == ("key", jump(r.doc_id or 0, n), jump(r.doc_id or 0, n + 1))
        assert r.grown_shard in (r.shard, n)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_follow_the_published_algorithm(spark, odd, none):
    docs = [(r[0], r[1]) for r in ROWS]
    check_shards(sharding.shard(odd, 24).collect(), docs, 24)
    check_shards(sharding.shard(odd, 3, rows_per_chunk=1).collect(), docs, 3)
    assert sharding.shard(none, 24).count() == 0
    many = [-1, -2**63, 2**63 - 1, *range(0, 40000, 97)]
    got = spark.createDataFrame([(k,) for k in many], "k bigint").withColumn(
        "s", sharding.jump_shards(F.col("k"), (1, 24, 1000))).collect()
    assert all([*r.s] == [jump(r.k, 1), jump(r.k, 24), jump(r.k, 1000)] for r in got)


def test_shard_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    check_shards(QUERIES["op8_jump_sharding"](spark, SF).collect(), [tuple(d) for d in docs], 24)


def check_dedup(rows, docs):
    groups = defaultdict(list)
    for i, t in docs:
        groups[lower(t)].append(i)
    sha = {hashlib.sha256(t.encode()).hexdigest(): t for t in groups}
    assert Counter((r.doc_id, sha[r.text_sha256]) for r in rows) == Counter((i, lower(t)) for i, t in docs)
    kept = Counter()
    for r in rows:
        ids = groups[sha[r.text_sha256]]
        top = max((i for i in ids if i is not None), default=None)
        assert r.group_size == len(ids) and r.keep_id == top and (not r.kept or r.doc_id == top)
        kept[r.text_sha256] += r.kept
    assert set(kept.values()) <= {1}


def test_dedup(spark, odd, none):
    docs = [(r[0], r[1]) for r in ROWS]
    check_dedup(exact_dedup.dedup(odd).collect(), docs)
    assert exact_dedup.dedup(none).count() == 0
    # a digest of a few bits: unequal texts meet, the byte comparison keeps them apart
    check_dedup(exact_dedup.dedup(odd, digest=lambda t: (F.crc32(F.encode(t, "UTF-8")) % 3).cast("string")).collect(), docs)


def test_dedup_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    check_dedup(QUERIES["op10_stateful_dedup"](spark, SF).collect(), [tuple(d) for d in docs])


def test_kept_documents(spark, odd):
    got = exact_dedup.kept_documents(odd)
    assert got.columns == odd.columns
    assert Counter((r.doc_id, lower(r.text)) for r in got.collect()) == Counter(
        [(2, "alpha beta  gamma"), (4, ""), (5, "Éa É"), (6, "éa É"), (None, "no id"), (7, "word " * 3000), (8, " \t\n"), (9, "x" * 60000)])


def test_state_goes_on_and_replays(spark, scratch):
    """Two runs over a growing folder equal one; state never expires."""
    rows = [("a", 1, 10), ("b", 2, 20), ("a", 5, 50), ("c", 3, 30), ("a", 4, 40)]
    for k, part in enumerate((rows[:2], rows[2:])):
        spark.createDataFrame(part, "digest string, doc_id bigint, locator bigint").write.mode("append").parquet(f"{scratch}/in")
        s = spark.readStream.schema("digest string, doc_id bigint, locator bigint").parquet(f"{scratch}/in")
        exact_dedup.dedup_state(s, f"{scratch}/out", f"{scratch}/ck").awaitTermination()
    got = {r.digest: (r.keep.doc_id, r.keep.locator, r.group_size) for r in exact_dedup.read_state(spark, f"{scratch}/out").collect()}
    assert got == {"a": (5, 50, 3), "b": (2, 20, 1), "c": (3, 30, 1)}


def shares(sizes, share=1.5, weights=(3, 1, 2), most=2.0):
    """Reshare the excess round by round."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    left, goal, free = share * sum(sizes.values()), dict.fromkeys(names, 0.0), set(names)
    while left > 1e-9 and free:
        total, extra = sum(w[s] for s in free), 0.0
        for s in sorted(free, key=str):
            goal[s] += left * w[s] / total
        for s in [*free]:
            if goal[s] >= most * sizes[s]:
                extra += goal[s] - most * sizes[s]
                goal[s] = most * sizes[s]
                free.discard(s)
        left = extra
    return goal


def check_mix(rows, docs):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert Counter((r.doc_id, r.size) for r in rows) == Counter((i, size(t)) for i, t, _ in docs)
    sizes, taken, source = defaultdict(int), defaultdict(int), defaultdict(set)
    for _, t, s in docs:
        sizes[s] += size(t)
    goal = shares(sizes)
    by_id = {i: s for i, t, s in docs}
    for r in rows:
        s = by_id[r.doc_id]
        assert r.source_size == sizes[s] and abs(r.target - goal[s]) < 1e-6 * max(1, goal[s]) and 0 <= r.taken <= 2 * r.size
        taken[s] += r.taken
    assert all(abs(taken[s] - goal[s]) <= 2 for s in goal)


def test_mix(spark, odd, none):
    docs = [(r[0], r[1], r[3]) for r in ROWS]
    got = mixing.mix(odd)
    check_mix(got.collect(), docs)
    assert sorted(map(str, got.collect())) == sorted(map(str, mixing.mix(odd).collect()))
    assert mixing.mix(none).count() == 0


def test_mix_tree(spark):
    """Many levels of the tree, heavy sources: totals on target, expectations kept over seeds."""
    docs = [(i, "w " * (1 + i * 7919 % 50), "hot" if i % 3 else f"s{i % 5}") for i in range(3000)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, source string")
    check_mix(mixing.mix(df, bucket_rows=4).collect(), docs)


def test_mix_keeps_the_expectation_of_every_length(spark):
    """Long and short documents are copied alike: mean copies over many sources and seeds, and in levels of the tree."""
    docs = spark.range(40 * 1024).selectExpr("id AS doc_id", "concat('s', id % 40) AS source",
                                             "repeat('w ', if(id DIV 40 % 20 = 0, 40, 2)) AS text").cache()
    for share, bucket_rows in ((0.2, 2048), (0.8, 2048), (0.8, 16)):
        for seed in (17, 1017):
            got = mixing.mix(docs, share=share, weights=(1,), seed=seed, bucket_rows=bucket_rows, finish="round").groupBy(
                "size").agg(F.avg("copies").alias("mean"), F.count(F.lit(1)).alias("n")).collect()
            assert len(got) == 2
            for r in got:
                assert abs(r["mean"] - share) < 5 * (share * (1 - share) / r.n) ** 0.5, (share, bucket_rows, seed, r)


def test_mixed_documents(spark, odd):
    got, plan = mixing.mixed_documents(odd), mixing.mix(odd, finish="round").collect()
    assert got.columns == odd.columns
    want = Counter()
    for r in plan:
        want[r.doc_id] += r.copies
    assert Counter(r.doc_id for r in got.collect()) == +want
