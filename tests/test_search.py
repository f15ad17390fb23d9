"""The trigram index answers as the scan does."""

import itertools

import pytest
from pyspark.sql import functions as F

from streamcharts.operators import catalog as cat
from streamcharts.operators import search as sx
from streamcharts.operators import trending as tr
from streamcharts.sources import tables as tb
from tests.conftest import SF_SMALL

CARDS = "id bigint, title string, artist string, genre string"
ROWS = [(1, "Red Velvet", "Ann", "pop"), (2, "red", "Bo_b", "pop"), (3, "InfraRED light", None, "rock"), (4, None, "Fred 100%", "rock"), (5, "", "", "pop"),
        (6, "ÉCLAIR été", "ΟΔΟΣ", "pop"), (7, "a\\b c", "x", "rock"), (8, "aaaaaa", "ab", "pop"), (9, "日本語の歌", "歌手", "pop"), (70_000, "red tail", "Zed", "pop"),
        (-3, "minus red", "neg", "rock"), (140_000, "İstanbul", "ﬁn", "pop")]
PATTERNS = ["red", "RED", "re", "e", "", "%", "_", "r_d", "re%vet", "red%", "a\\\\b", "aaa", "aaaaaaa", "100%", "é", "été", "ÉTÉ", "日本語", "本", "οδος", "ΟΔΟΣ", "zzz", "redzzz",
            "d v", "fra_ed", "İst", "ist", "___", "ﬁn", " "]


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    cards, path = spark.createDataFrame(ROWS, CARDS), str(tmp_path_factory.mktemp("index"))
    sx.build_index(cards, path)
    return cards, path


def scanned(cards, q):
    return sorted(r.id for r in cards.filter(F.col("title").ilike(f"%{q}%") | F.col("artist").ilike(f"%{q}%")).collect())


def test_every_pattern_equals_the_scan(spark, index):
    cards, path = index
    got = {}
    for r in sx.search_all(cards, path, spark.createDataFrame([(p,) for p in [*PATTERNS, None, "red"]], "pattern string")).collect():
        got.setdefault(r.pattern, []).append(r.id)
    for q in PATTERNS:
        assert sorted(got.get(q, [])) == scanned(cards, q), q


@pytest.mark.parametrize("q", ["red", "RED", "r_d", "e", "%", "zzz", "redzzz", "été", "re%vet", "a\\\\b"])
def test_one_search_equals_the_scan(index, q):
    cards, path = index
    assert [r.id for r in sx.search(cards, path, q, limit=200).collect()] == scanned(cards, q)
    assert [r.id for r in sx.search(cards, path, q, genre="pop", limit=2).collect()] == scanned(cards.filter("genre = 'pop'"), q)[:2]


def test_posting_lists_are_cut_into_pieces(spark, index):
    rows = spark.read.parquet(f"{index[1]}/postings").filter("gram = 'red'").collect()
    assert sorted(sorted(r.ids) for r in rows) == [[-3], [1, 2, 3, 4], [70_000]]
    assert spark.read.parquet(f"{index[1]}/grams").filter("gram = 'red'").first().n == 6


def test_a_search_reads_the_buckets_of_its_trigrams_only(index):
    cards, path = index
    text = sx.search(cards, path, "velvet")._jdf.queryExecution().toString()
    assert "bucket#" in text.split("PartitionFilters: [")[1].split("]")[0]


def test_catalog_search_equals_the_listing(spark, scratch):
    songs, artists = tb.songs(spark, SF_SMALL), tb.artists(spark, SF_SMALL)
    cards = tr.song_cards(songs, artists)
    sx.build_index(cards, scratch)
    for q, genre in itertools.product(("ed", "red", "supplier#", "o_c"), (None, "SMALL")):
        assert sx.search(cards, scratch, q, genre, 50).collect() == cat.list_songs(songs, artists, genre, q, 50).collect()


def test_an_empty_catalog(spark, scratch):
    cards = spark.createDataFrame([], CARDS)
    sx.build_index(spark.createDataFrame(ROWS[:1], CARDS).unionByName(cards), scratch)
    assert sx.search(cards, scratch, "velvet").collect() == []
