import hashlib
import random
import re

from streamcharts.llm import pii
from streamcharts.llm.queries import QUERIES
from tests.llm.conftest import ROWS

SF = "/root/testdata/sf0.001"
KINDS = {  # the contract's patterns as they stand
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def base(text):
    spans = []
    for rank, (kind, rx) in enumerate(KINDS.items()):
        for m in re.finditer(rx, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if (kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m[0].split("."))
                    or kind == "card" and 14 <= len(d) <= 19 and luhn(d) or kind == "phone" and 10 <= len(d) <= 15):
                spans.append((m.start(), rank, m.end(), kind))
    return [f"{k}:{a}:{b}" for a, _, b, k in sorted(spans)]


def check(rows, docs):
    want = {}
    for i, t in docs:
        want.setdefault(i, []).append(base(t))
    got = {}
    for r in rows:
        got.setdefault(r.doc_id, []).append(r)
    assert {i: len(x) for i, x in want.items()} == {i: len(x) for i, x in got.items()}
    for i, lists in want.items():
        sha = sorted(hashlib.sha256(",".join(x).encode()).hexdigest() for x in lists)
        assert sha == sorted(r.base_sha256 for r in got[i]), (i, lists, [r.spans for r in got[i]])
        for r, x in zip(got[i], lists, strict=True) if len(lists) == 1 else []:
            assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(k) for s in x) for k in KINDS]
            assert set(x) <= set(r.spans.split(",")) or not x


TRICKY = [
    "a@b.c_d@e.f x..y@h-.i..j@k.l @m.n o@p q@r. s@t.u.", "a.b@c.d@e.f.g", "é x@y.zz 😀 me@é.com you@x.é",
    "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.255 1.2.3 9.9.9.9.9", "4111 1111 1111 1111 4111-1111-1111-1111 4111  1111 1111 1111",
    "4111111111111111 0 4111111111111112 5500-0000 0000-0004--4 12", "+1 (650) 555-1234 +49 30 1234567890123 +1 2 +12.34.56.78.90 ++1 650 555 1234)",
    "a\x01b@c.de\x02 1.2.3.4", "1 " * 4000, "9" * 5000, "a@" + "b." * 4000 + "c", "a." * 4000 + "@b.c", ". " * 500 + "@", "+" * 3000,
    "- " * 2000 + "4111111111111111", "ssn 123-45-6789, call (650) 555-1234 or jo (at) mail (dot) com", "",
]


def test_base_spans(spark, odd, none):
    rnd = random.Random(5)
    noise = ["".join(rnd.choice("a1.@-+ 4%_é(") for _ in range(rnd.randrange(60))) for _ in range(600)]
    docs = list(enumerate([*TRICKY, *noise, None]))
    got = pii.find(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    check(got, docs)
    check(pii.find(odd).collect(), [(r[0], r[1]) for r in ROWS])
    assert pii.find(none).count() == 0


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    check(QUERIES["op6_weak_supervision_pii"](spark, SF).collect(), [tuple(d) for d in docs])


def test_reliabilities_recover_a_known_model():
    rnd, counts = random.Random(3), {}
    yes, no = [.95, .9, .85, .8, .9], [.1, .2, .1, .3, .2]
    for _ in range(20000):
        true = rnd.random() < .6
        v = tuple(-1 if rnd.random() < .2 else int(rnd.random() < (yes if true else no)[i]) for i in range(5))
        counts[v] = counts.get(v, 0) + 1
    share, y, n = pii.reliabilities(sorted(counts.items()))
    assert abs(share - .6) < .03 and all(abs(a - b) < .04 for a, b in zip(y + n, yes + no, strict=True))


def test_the_classifier_adds_loose_spans(spark):
    """Trained without labels on ordinary text; what every labeler doubts stays out."""
    docs = [(i, f"write to jo{i}@mail.com, call +1 (650) 555-{1000 + i} or pay with card 4111 1111 1111 1111 today") for i in range(60)]
    docs += [(100 + i, f"ssn 123-45-{6700 + i}, call (650) 555-{1200 + i} or mail jo (at) mail (dot) com now") for i in range(30)]
    docs += [(200 + i, f"part no x000-00-0000y and 111-111-1111z or see at home dot matrix{i}") for i in range(30)]
    got = {r.doc_id: r.spans for r in pii.find(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    assert got[100] == "ssn:4:15,phone_local:22:36,email_at:45:67"
    assert got[1].startswith("email:9:21") and "ssn" not in got[200]
