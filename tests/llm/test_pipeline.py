import importlib
import re
import sys
from collections import Counter

import numpy as np

import corpus_pipeline as cp
from streamcharts.llm import near_dedup as nd
from streamcharts.llm import segmentation as sg
from streamcharts.llm.queries import ORACLE, QUERIES
from tests.llm.conftest import ROWS

SF = "/root/testdata/sf0.001"


def sets(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def classes(docs):
    """component_id of each identifier, by comparing all pairs."""
    whole = [(i, sets(t)) for i, t in docs]
    parent = {i: i for i, _ in whole}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, (i, s) in enumerate(whole):
        for j, t in whole[:a]:
            if s and t and 4 * min(len(s), len(t)) >= 3 * max(len(s), len(t)) and 100 * len(s & t) >= 75 * len(s | t):
                x, y = sorted((top(i), top(j)))
                parent[y] = x
    return {i: top(i) for i, _ in whole}, {i: len(s) for i, s in whole}


def check_near(rows, docs):
    label, size = classes(docs)
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in docs)
    for r in rows:
        assert (r.n_shingles, r.component_id, r.kept) == (size[r.doc_id], label[r.doc_id], r.doc_id == label[r.doc_id]), r


def near_copies(n, words, edits, start, rnd):
    base = [f"{start}w{rnd.integers(0, 10**6)}" for _ in range(words)]
    out = []
    for i in range(n):
        w = list(base)
        for k in rnd.integers(0, words, rnd.integers(0, edits + 1)):
            w[k] = f"edit{i}"
        out.append((start + i, " ".join(w)))
    return out


def test_near_duplicates_against_all_pairs(spark, none):
    rnd = np.random.default_rng(3)
    docs = [x for g in range(30) for x in near_copies(6, 60, 3, 1000 * (g + 1), rnd)]  # around the threshold
    docs += near_copies(150, 120, 4, 100_000, rnd)   # a node that cannot be split
    passage = " ".join(f"common{i}" for i in range(60))
    docs += [(200_000 + i, " ".join([passage, *[f"own{i}x{k}" for k in range(70)]])) for i in range(150)]  # a common passage
    docs += [(300_000, "a b c"), (300_001, "A B  C"), (300_002, "a b"), (300_003, ""), (300_004, None), (300_005, "\t"), (300_006, "one")]
    docs += [(i + 400_000, t) for i, t in docs[:40]]
    check_near(nd.near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string")).collect(), docs)
    assert nd.near_duplicates(none).count() == 0


def test_pairs_that_share_mostly_a_common_passage(spark):
    """Planted pairs of 0.76 to 0.79, most of it a passage that thousands of other, longer documents hold as well."""
    passage, pairs = [f"common{i}" for i in range(200)], 500
    docs = [(2 * i + j, " ".join([*passage, *[f"both{i}x{k}" for k in range(45)], *[f"own{i}x{j}x{k}" for k in range(32 + i % 6)]]))
            for i in range(pairs) for j in (0, 1)]
    docs += [(10**6 + i, " ".join([*passage, *[f"long{i}x{k}" for k in range(250 + i * 37 % 500)]])) for i in range(3000)]
    got = {r.doc_id: r.component_id for r in nd.near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    assert sum(got[2 * i] == got[2 * i + 1] == 2 * i for i in range(pairs)) == pairs
    assert all(got[i] == i for i in got if i >= 10**6)


def test_last_resort_and_levels(spark, monkeypatch):
    """Hardly any levels and small nodes: the rest is compared across components."""
    rnd = np.random.default_rng(5)
    docs = near_copies(60, 80, 12, 0, rnd)
    monkeypatch.setattr(nd, "SMALL", 4)
    for depth in (1, 2):
        monkeypatch.setattr(nd, "DEPTH", depth)
        check_near(nd.near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string")).collect(), docs)


def test_near_duplicates_odd_rows(spark, odd):
    rows = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in nd.near_duplicates(odd).collect()}
    assert {(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True), (4, 0, 4, True), (8, 0, 8, True), (7, 1, 7, True)} <= rows
    kept = nd.kept_documents(odd)
    assert kept.schema == odd.schema and Counter(r.doc_id for r in kept.collect())[4] == 1


def test_documents_without_an_identifier(spark):
    """Different texts all stay; near copies leave one, that with an identifier if there is one."""
    words = lambda g, edit="": " ".join([*[f"g{g}w{k}" for k in range(60)], f"end{g}{edit}"])
    rows = [(None, words(g)) for g in range(6)] + [(None, words(2, e)) for e in "ab"] + [(None, words(3))]
    rows += [(7, words(4, "x")), (8, words(9)), (None, ""), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = nd.near_duplicates(docs).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
    assert Counter(r.component_id for r in got) == {None: 10, 7: 2, 8: 1}
    kept = nd.kept_documents(docs)
    assert kept.schema == docs.schema
    kept = [tuple(r) for r in kept.collect()]
    twos = {t for _, t in rows if t and t.startswith("g2w")}
    assert len([t for _, t in kept if t in twos]) == 1
    assert Counter(r for r in kept if r[1] not in twos) == Counter(
        [*[(None, words(g)) for g in (0, 1, 3, 5)], (7, words(4, "x")), (8, words(9)), (None, ""), (None, None)])


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 400), (400, 500), (7, 7)], "a bigint, b bigint")
    got = {r.id: r.label for r in nd.components(links).collect()}
    assert got == {**{i: 0 for i in range(201)}, 400: 400, 500: 400}


def test_near_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    check_near(QUERIES["op7_chosen_path_near_dedup"](spark, SF).collect(), docs)


def test_stages_on_odd_tables(spark, odd, none):
    for docs in (odd, none):
        for name, stage in cp.STAGES:
            out = stage(spark, docs, SF)
            if name != "SentencePiece":
                assert out.schema.names == docs.schema.names, name
            assert (out.count() > 0) == (docs is odd), name


def test_pipeline(spark):
    """Each stage against its own input by brute force."""
    from streamcharts.llm.common import written

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in cp.STAGES:
        out = written(stage(spark, docs, SF), "test")
        before, after = docs.collect(), out.collect()
        text = {r.doc_id: r.text or "" for r in before}
        ids = Counter(r.doc_id for r in after)
        assert set(ids) <= set(text)
        if name != "SentencePiece":
            assert out.columns == docs.columns and all(text[r.doc_id] == (r.text or "") for r in after)
        if name == "toxicity":
            insults = re.compile(r"\b(?:idiot|moron|stupid|scum|trash|loser|pathetic|worthless|clown|disgusting)\b", re.I)
            gone = set(text) - set(ids)  # from so few labels the classifier learns some of the words only
            assert all(insults.search(text[i]) for i in gone)
        elif name == "exact dedup":
            low = {i: re.sub("[A-Z]", lambda m: m[0].lower(), t) for i, t in text.items()}
            assert set(ids) == set({t: i for i, t in sorted(low.items())}.values())
        elif name == "MinHash near-dedup":
            label, _ = classes(text.items())
            assert set(ids) == set(label.values())
        elif name == "mixing":
            assert max(ids.values()) <= 2
        else:
            assert set(ids) == set(text)
            spelled = sg.Vocabulary().bytes
            for r in after:
                head = b"".join(spelled[i] for i in np.frombuffer(r.ids, "<i4")[:20].tolist()).decode("utf-8", "ignore")
                assert head[1:8] == text[r.doc_id][:7]
        docs = out
    assert sorted(map(str, cp.run(spark, SF).collect())) == sorted(map(str, after))


def test_registered_and_guarded(monkeypatch):
    import __spark_entry__ as entry

    names = [n for n in entry.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11)) and "pipeline" in entry.queries()
    assert set(ORACLE) <= set(entry.oracle_sql())
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    importlib.invalidate_caches()
    assert not [n for n in entry.queries() if n.startswith("op") or n == "pipeline"]
