import hashlib
import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from streamcharts.llm import segmentation as sg
from streamcharts.llm.queries import QUERIES
from tests.llm.conftest import ROWS

SF = "/root/testdata/sf0.001"
TEXTS = ["Hello world", "  two  spaces ", "a\nb\tc", "x▁y", "", " ", "日本 é ß 😀  ", "1234 ů²", "\x00\x01", "aaaaaaaaaaaaaaaaaaaaaaaa"]


@pytest.fixture(scope="module")
def lat():
    return sg._Lattices(sg.Vocabulary())


def every(lat, text):
    """All segmentations of the text with their log probabilities, by trying every cut."""
    names = {n: i for i, n in lat.v.names.items()}
    s = " " + text

    def cut(i):
        if i == len(s):
            return [()]
        out = []
        for j in range(i + 1, len(s) + 1):
            if s[i:j] in names:
                out += [(names[s[i:j]], *r) for r in cut(j)]
        if s[i] not in names:
            out += [(-ord(s[i]) - 1, *r) for r in cut(i + 1)]
        return out

    found = {c: lat.log(c) for c in (cut(0) if text else [()])}
    z = math.log(sum(map(math.exp, found.values())))
    return {c: p - z for c, p in found.items()}


def flat(lat, seg):
    return sg._ids(lat, np.array(seg, np.int64))[0].tolist()


def run(lat, texts, keys, k, seed=4):
    top = sg.TopK(lat, texts, keys, k, seed)
    store, out = top.pieces(), defaultdict(list)
    for docs, s, value in top.found:
        for d in docs.tolist():
            seg = [int(x) for u in range(top.at[d], top.at[d + 1]) for x in store[s.place[u]:s.place[u] + s.number[u]]]
            out[d].append((tuple(seg), s.log[top.at[d]:top.at[d + 1]].sum() - top.z[d], value[d] - top.z[d]))
    return out, top.threshold - top.z


def test_all_segmentations_once(lat):
    """Asked for more than there are, the search emits each exactly once, by falling value, probabilities summing to one."""
    for text in ["the", "then", "a b", "tt\nq", "éx", "", "in  on"]:
        want = every(lat, text)
        got, threshold = run(lat, [text], [3], len(want) + 3)
        assert {s: pytest.approx(p) for s, p, _ in got[0]} == want and len(got[0]) == len(want)
        values = [v for _, _, v in got[0]]
        assert values == sorted(values, reverse=True) and threshold[0] == -np.inf


def test_samples_follow_the_probabilities(lat):
    """First samples have the segmentations' probabilities; pairs those of drawing without replacement."""
    text, n = "then it", 30_000
    want = every(lat, text)
    got, threshold = run(lat, [text] * n, list(range(n)), 2)
    first, second = Counter(g[0][0] for g in got.values()), Counter((g[0][0], g[1][0]) for g in got.values())
    for s, p in want.items():
        p = math.exp(p)
        assert abs(first[s] - n * p) < 5 * math.sqrt(n * p * (1 - p)) + 3
    for (a, b), c in second.items():
        p = math.exp(want[a]) * math.exp(want[b]) / (1 - math.exp(want[a]))
        assert a != b and abs(c - n * p) < 5 * math.sqrt(n * p) + 3
    # weighed by the inclusion probability, the samples estimate the whole mass without bias
    total = [sum(math.exp(p) / -math.expm1(-math.exp(p - t)) for _, p, _ in got[d]) for d, t in enumerate(threshold)]
    assert abs(np.mean(total) - 1) < 5 * np.std(total) / math.sqrt(n)


def test_a_row_depends_on_its_key_and_text_alone(lat):
    alone, _ = run(lat, ["some longer text here"], [42], 3)
    among, _ = run(lat, ["other", "some longer text here", ""], [1, 42, 7], 3)
    other, _ = run(lat, ["some longer text here"], [43], 3)
    assert [s for s, _, _ in alone[0]] == [s for s, _, _ in among[1]] != [s for s, _, _ in other[0]]


def test_round_trip(spark, odd, none):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=sg.PIECES)
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(r[0] or 0, r[1]) for r in ROWS]
    docs = spark.createDataFrame([(100 * i + j, t) for j, (i, t) in enumerate(rows)], "doc_id bigint, text string")
    got = sg.decode(sg.encode(docs, samples=3)).collect()
    text = {r.doc_id: r.text or "" for r in docs.collect()}
    seen = defaultdict(list)
    for r in got:
        ids = np.frombuffer(r.ids, "<i4").tolist()
        assert r.text == text[r.doc_id] and r.n_ids == len(ids)
        if "▁" not in r.text:
            assert sp.decode(ids) == r.text
        seen[r.doc_id].append(r)
    assert set(seen) == set(text)
    for rs in seen.values():
        assert len({r.ids for r in rs}) == len(rs) == len({r.sample for r in rs}) and all(0 <= r.inclusion <= 1 and r.log_prob <= 0 for r in rs)
    assert sg.encode(none).count() == 0
    assert sg.encode(odd).filter("sample = 1").count() == len(ROWS)


def test_query(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op4_gumbel_segmentation"](spark, SF).collect()
    per = Counter(r.doc_id for r in rows)
    assert set(per) == set(docs) and max(per.values()) == sg.SAMPLES
    back = sg.decode(sg.encode(spark.read.parquet(f"{SF}/documents.parquet"))).collect()
    assert len(back) == len(rows) and all(r.text == docs[r.doc_id] for r in back)


def test_query_decodes_every_sample(spark):
    """More than two samples a text, all of which spell it."""
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op4_gumbel_segmentation"](spark, SF).collect()
    assert max(r.sample for r in rows) > 2
    assert all((r.text_sha256, r.text_length) == (hashlib.sha256(docs[r.doc_id].encode()).hexdigest(), len(docs[r.doc_id])) for r in rows)


def test_units_are_those_of_the_pattern(lat):
    """Cut by classes of characters, the units of every text are what the pattern finds in it."""
    rnd = np.random.default_rng(9)
    alphabet = list(" \n\tabétheing.,!?&#12▁日本語😀\x00̀ßů²") + ["  ", " the", "ing "]
    texts = TEXTS + ["".join(rnd.choice(alphabet, n)) for n in rnd.integers(0, 60, 400)] + ["", " ", "\U0010ffff a"]
    number, units = lat.cut(texts)
    want = [lat.unit.findall(" " + t) if t else [] for t in texts]
    assert number.tolist() == [len(x) for x in want] and units.to_pylist() == [u for x in want for u in x]
    assert lat.cut([])[1].to_pylist() == lat.cut([""])[1].to_pylist() == []


def test_spelled_texts_as_one_by_one(lat):
    """Texts from one gather are those of each row's identifiers, broken bytes too."""
    import pyarrow as pa

    rnd = np.random.default_rng(10)
    sizes = rnd.integers(0, 40, 200)
    ends = np.cumsum(sizes)
    ids = rnd.integers(0, len(lat.v.bytes), int(ends[-1])).astype("<i4")
    got = list(sg._spelled(pa.array(lat.v.bytes, pa.binary()), ids, ends - sizes, ends))
    assert got == [sg._spell(lat.v.bytes, ids[e - n:e].tobytes()) for e, n in zip(ends, sizes, strict=True)]
