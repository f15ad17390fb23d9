"""The language network, exact hard negatives and the alignment of tokenizers, against plain versions and on held-out rows."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from streamcharts.llm import alignment, hard_negatives, language
from streamcharts.llm.queries import op11_byte_cnn_language, op13_shared_cut_alignment
from tests.conftest import SF_ORACLE, SF_SMALL

# -- language ---------------------------------------------------------------------------------------------------------


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    got = op11_byte_cnn_language(spark, SF_ORACLE).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == docs.count()
    held = [r for r in got if r.held_out]
    assert 0.2 < len(held) / len(got) < 0.3
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


@pytest.fixture(scope="module")
def net():
    return language.Network(["a", "b", "c"], np.random.default_rng(1))


def test_tables_answer_as_the_filters_do(net):
    x = np.random.default_rng(2).integers(0, 256, (150, language.LENGTH)).astype(np.uint8)
    assert np.allclose(net.looked_up().log_odds(x), net.forward(x)[0], atol=1e-4)


def test_gradient_is_the_slope_of_the_loss(net):
    rng = np.random.default_rng(3)
    x, y = rng.integers(0, 256, (6, language.LENGTH)).astype(np.uint8), rng.integers(0, 3, 6)
    net64 = language.Network(["a", "b", "c"], np.random.default_rng(1))
    net64.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    grads = net64.gradient(x, y)
    for k, g in grads.items():
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        losses = []
        for d in (1e-6, -2e-6):
            net64.p[k][at] += d
            losses.append(-net64.forward(x)[0][np.arange(6), y].mean())
        net64.p[k][at] += 1e-6
        assert (losses[0] - losses[1]) / 2e-6 == pytest.approx(g[at], rel=1e-3), k


def test_windows_hold_every_run_of_bytes():
    rng = random.Random(4)
    texts = [bytes(rng.randrange(1, 256) for _ in range(n)) for n in (0, 1, 3, 127, 128, 129, 253, 254, 1000, 0)]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    text, start, left = language.windows(offsets)
    x = language.cut(data, start, left)
    for i, t in enumerate(texts):
        seen = {bytes(w[j:j + 4]) for w in x[text == i] for j in range(language.LENGTH - 3)}
        assert {t[j:j + 4] for j in range(len(t) - 3)} <= seen
        assert (text == i).any() == bool(t)
        assert all(bytes(w).rstrip(b"\0") in t for w in x[text == i])


def test_language_of_odd_rows(spark, odd, none):
    got = {(r.doc_id, r.lang_pred): r.score for r in language.identify(odd).collect()}
    assert len(language.identify(odd).collect()) == odd.count()
    assert got[3, "und"] == 0 and got[4, "und"] == 0 and got[8, "und"] == 0
    assert all(p in ("en", "fr", "und") for _, p in got)
    assert language.identify(none).collect() == []
    unlabelled = language.identify(odd.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in unlabelled} == {"und"}


def test_language_is_learned_without_held_out_labels(spark):
    """Labels of held-out rows may be anything without changing a prediction."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    wrong = docs.withColumn("lang", F.when(language.held_out(F.col("doc_id")), F.lit("xx")).otherwise(F.col("lang")))
    a, b = (sorted(language.identify(d).select("doc_id", "lang_pred", "score").collect()) for d in (docs, wrong))
    assert a == b


# -- hard negatives ---------------------------------------------------------------------------------------------------

VECTORS = "vec_id bigint, embedding array<double>, label int, score int, block string, x int"


def plain_negatives(rows, every=100, n_pos=5, n_neg=10):
    sound = {(i, l, tuple(v)) for i, v, l, *_ in rows if i is not None and l is not None and v is not None
             and all(x is not None and np.isfinite(x) for x in v)}
    whole = [(i, l, [n * 256 // d for n, d in (x.as_integer_ratio() for x in v)]) for i, l, v in sound]
    out = []
    for i, l, v in whole:
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, m) for j, m, w in whole if j != i)
        for s, j, _ in [x for x in scored if x[2] == l][:n_pos]:
            fit = [(-t, k) for t, k, m in scored if m != l and 30 * -s <= 100 * -t <= 90 * -s][:n_neg]
            out += [(i, j, r, k, -s, t) for r, (t, k) in enumerate(fit, 1)]
    return sorted(out)


def mined(spark, rows, **kw):
    return sorted(map(tuple, hard_negatives.mine(spark.createDataFrame(rows, VECTORS), **kw).collect()))


def test_negatives_against_all_pairs(spark, monkeypatch):
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 0.3, (4, 13))
    rows = [(i, (centres[i % 4] + rng.normal(0, 0.2, 13)).tolist(), int(rng.integers(0, 3)), 1, "b", 2) for i in range(400)]
    rows += [(100, rows[3][1], 1, 1, "b", 2), rows[7], rows[7]]                       # a second row of an anchor's identifier, copies
    rows += [(1000 + i, rows[8][1], i % 3, 1, "b", 2) for i in range(30)]             # ties
    rows += [(2000, rows[5][1][:9], 1, 1, "b", 2), (2001, [], 0, 1, "b", 2)]          # shorter vectors
    rows += [(3000, None, 1, 1, "b", 2), (None, rows[9][1], 1, 1, "b", 2), (3100, rows[9][1], None, 1, "b", 2),
             (3200, [None, *rows[9][1][1:]], 1, 1, "b", 2), (3300, [float("nan")] * 13, 1, 1, "b", 2), (3400, [float("inf")] * 13, 1, 1, "b", 2)]
    want = plain_negatives(rows, 20)
    assert len(want) > 300
    assert mined(spark, rows, every=20) == want
    monkeypatch.setattr(hard_negatives, "CHUNK", 16)   # many chunks, several to a strip
    monkeypatch.setattr(hard_negatives, "BLOCK", 4)
    assert mined(spark, rows, every=20) == want


def test_negatives_of_an_empty_table(spark):
    assert mined(spark, []) == []


def test_inner_products_of_any_size():
    rng = random.Random(6)
    for size in (1.0, 1e5, 1e9, 1e30):
        a, c = (np.array([[rng.uniform(-size, size) for _ in range(11)] for _ in range(n)]) for n in (3, 9))
        a, c = hard_negatives.whole(a), hard_negatives.whole(c)
        got = hard_negatives.scores(a, hard_negatives.planes(c), max(abs(int(a.min())), abs(int(a.max()))))
        want = [[sum(int(x) * int(y) for x, y in zip(u, w)) for u in a.tolist()] for w in c.tolist()]
        assert [[int(x) for x in r] for r in got.tolist()] == want


def test_negatives_with_huge_components(spark):
    rng = random.Random(7)
    rows = [(i, [rng.uniform(-1, 2) * 2e6 for _ in range(3)], i % 2, 1, "b", 2) for i in range(60)]
    assert mined(spark, rows, every=10) == plain_negatives(rows, 10)


# -- alignment --------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizers():
    with open(alignment.BYTE_PAIRS, "rb") as f, open(alignment.PIECES, "rb") as g:
        return alignment.Tokenizers(f.read(), g.read())


def own_library(texts):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(alignment.BYTE_PAIRS)
    own.encode_special_tokens = True
    return [own.encode(f" {x}", add_special_tokens=False).ids for x in texts]


def plain_alignment(t, rows):
    """Groups by walking both lists of ends; links one by one; counts in a dictionary."""
    out, links, total = {}, {}, Counter()
    for key, text in rows:
        a, b = (own_library([text])[0], t.pieces.encode(text)) if text else ([], [])
        spelt = f" {text}".encode() if text else b""
        if b"".join(t.a[i] for i in a) != spelt or b"".join(t.b[i] for i in b) != spelt:
            a = b = []
        ends = [list(np.cumsum([len(table[i]) for i in ids])) for table, ids in ((t.a, a), (t.b, b))]
        groups, i, j = [], 0, 0
        for e in sorted(set(ends[0]) & set(ends[1])):
            x, y = ends[0].index(e) + 1, ends[1].index(e) + 1
            groups.append((a[i:x], b[j:y]))
            i, j = x, y
        links[key] = Counter((p, q) for g in groups for p in g[0] for q in g[1])
        total.update(links[key].keys())
        out[key] = (len(a), len(b), len(groups), sum(links[key].values()),
                    ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in groups))
    most = {}
    for (p, _), n in total.items():
        most[p] = max(most.get(p, 0), n)
    return {k: (*v, sum(n for p, n in links[k].items() if total[p] == most[p[0]]), sum(n * total[p] for p, n in links[k].items()))
            for k, v in out.items()}


ODD_TEXTS = [None, "", " ", "a", "▁", "a▁b", "<s> </s> <unk> <|endoftext|>", "<0x41>", "\0\0", "  two  blanks ", "\t\n\r\n", "aaaa" * 500, "日本語のテキスト", "👩‍👩‍👧‍👦 é é ﬁ Ⅷ",
             "x" * 3000, "ab " * 900, "0123456789" * 50, "ÀÉÎ", "don't we'll I'M", "end  ", "the same", "the same", "café" * 40, "​﻿", "٣٤ ⁴"]


def test_alignment_against_plain_walk(spark, tokenizers):
    rows = list(enumerate(ODD_TEXTS))
    df = spark.createDataFrame([(i, x, 1, 2, "g") for i, x in rows], "doc_id bigint, text string, chunk int, pair int, groups string")
    got = {r[0]: tuple(r[1:]) for r in alignment.align(df).collect()}
    assert got == plain_alignment(tokenizers, rows)
    assert got[0] == got[1] == got[5] == (0, 0, 0, 0, "", 0, 0) and got[2][0] > 0


def test_alignment_over_chunks_and_whole_table(spark, tokenizers, monkeypatch):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    want = plain_alignment(tokenizers, [tuple(r) for r in docs.select("doc_id", "text").collect()])
    monkeypatch.setattr(alignment, "RUN", 1 << 14)
    monkeypatch.setattr(alignment, "CHUNK", 1 << 16)
    got = {r[0]: tuple(r[1:]) for r in alignment.align(docs.repartition(3)).collect()}
    assert got == want
    query = {r.doc_id: r.groups_sha256 for r in op13_shared_cut_alignment(spark, SF_SMALL).collect()}
    assert query == {k: hashlib.sha256(v[4].encode()).hexdigest() if v[0] else "" for k, v in want.items()}


def test_ranks_give_the_tokens_of_the_models_own_library(tokenizers):
    rng = random.Random(8)
    letters = [chr(c) for c in (*range(32, 127), 9, 10, 13, 0, 0xA0, 0xE9, 0x301, 0x3042, 0x1F600, 0x660, 0x2028, 0x7FF, 0xFF)]
    texts = ["".join(rng.choices(letters, k=rng.randrange(1, 200))) for _ in range(300)]
    texts += ["".join(rng.choices(["the", "in", "er", " ", "th", "a", "'s", "1", "  "], k=80)) for _ in range(300)]
    assert tokenizers.lossless
    assert [tokenizers.encode_a(f" {x}") for x in texts] == own_library(texts)


def test_shared_cuts_are_all_shared_ends():
    rng = random.Random(9)
    for _ in range(200):
        n = rng.choice([1, 2, 10, 300])
        a, b = (np.array(sorted({n, *(rng.randrange(1, n + 1) for _ in range(rng.randrange(0, n + 1)))})) for _ in range(2))
        got = alignment.shared_cuts(a, b, np.array([0]), np.array([len(a) - 1]))
        assert a[got].tolist() == sorted(set(a.tolist()) & set(b.tolist()) - {n})


def test_wide_groups_are_counted_before_they_are_paired(tokenizers, monkeypatch):
    texts = [x for x in ODD_TEXTS if x]
    want = alignment.Run(tokenizers, texts, False)
    monkeypatch.setattr(alignment, "WIDE", 0)
    got = alignment.Run(tokenizers, texts, False)
    for k in ("pairs", "place", "times", "bounds", "n_links"):
        assert np.array_equal(getattr(got, k), getattr(want, k))


def test_alignment_of_odd_rows(spark, odd, none):
    got = alignment.align(odd).collect()
    assert len(got) == odd.count() and {r.n_a for r in got if r.doc_id in (3, 4)} == {0}
    assert alignment.align(none).collect() == []
