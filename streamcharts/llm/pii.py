"""Personal data by weak supervision, in DataFrame functions only.

One pass finds the spans of the contract's four kinds and looser candidates (numbers and addresses that
those patterns miss). Labelers vote on every candidate: yes, no or nothing. Expectation-maximisation
estimates how often each labeler says yes on true and on false spans, and the share of true ones, from the
counts of vote patterns alone (at most 3 ** labelers times kinds rows, whatever the size of the corpus). Its
posteriors are the soft labels of the final span classifier, naive Bayes over the span's shape, its
surroundings and its votes. Candidates it finds likelier true than not become spans; the contract's spans stay.

Offsets come from marking matches with a control character and adding up the lengths of the pieces, so
they count code points. Patterns hold no repeated groups (Java matches those by recursion, which a long
enough text overflows): a dot between two parts of a host name is first turned into a mark of its own.

Defined results: null text is empty; texts with the two control characters used as marks keep their
offsets; repeated rows give repeated results; an empty table gives an empty result; a null identifier stays
null; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamcharts.llm.common import text_of, written

CUT, DOT = "\x01", "\x02"
BASE = ("email", "ip", "card", "phone")
EXTRA = ("email_at", "phone_local", "ssn", "iban")
LABELERS = ("pattern", "gazetteer", "context", "edges", "variety")

# The contract's patterns, written so that Java matches them without recursion.
_LOCAL = rf"A-Za-z0-9._%+{DOT}-"
_EMAIL = (rf"((?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++{DOT}[A-Za-z0-9{DOT}-]*+)")
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_IP = r"((?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++)"
_CARD_EDGE = r"(?<![0-9])(?<![0-9][\x20-])(?=[0-9])|(?<=[0-9])(?![0-9])(?![\x20-][0-9])"
_PHONE = r"(\+[0-9][\x20().0-9-]+[0-9])"

# Looser candidates.
_LOOSE = {
    "email_at": r"(?i)((?<![a-z0-9._%+-])[a-z0-9._%+-]++(?: ?\(at\) ?| ?\[at\] ?| at )[a-z0-9-]++"
                r"(?: ?\(dot\) ?| ?\[dot\] ?| dot )[a-z]++)",
    "phone_local": r"((?<![0-9+.()-])(?<![+(][0-9] )\(?[0-9]{3}\)?[ .-]{1,2}[0-9]{3}[ .-][0-9]{4}(?![0-9]))",
    "ssn": r"((?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-]))",
    "iban": r"((?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9]))",
}

# What the labelers look for.
_DOMAINS = r"(?i)(?:\.| dot |\) ?)(?:com|org|net|edu|gov|info|io|de|fr|es|uk|eu)$"
_ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65)"
_COUNTRIES = r"^(?:\+(?:1|7|20|2[1-9]|3[0-9]|4[0-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]))"
_IBANS = r"^(?:AT|BE|CH|CZ|DE|DK|ES|FI|FR|GB|IE|IT|LU|NL|NO|PL|PT|SE)"
_CONTEXT = (r"(?i)(?:e-?mail|mail|contact|reach|write|phone|tel|call|fax|mobile|cell|card|visa|credit|"
            r"ip|host|server|address|ssn|social security|iban|account)\W{0,3}(?:\w+\W{0,2})?$")


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once, also where ``use`` needs it inside a lambda."""
    return F.transform(F.array(value), use)[0]


def _pieces(marked: Column, kind: str, rank: int, context: int = 40) -> Column:
    """Array of spans (start, rank, end, kind, value, left, right) from text with marks around the matches."""
    def starts(parts: Column) -> Column:
        return F.aggregate(
            parts, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("all")),
            lambda s, x: F.struct((s["at"] + F.char_length(x)).alias("at"),
                                  F.concat(s["all"], F.array(s["at"])).alias("all")))["all"]

    def spans(w: Column) -> Column:
        parts, at = w["parts"], w["at"]
        odd = F.filter(F.sequence(F.lit(0), F.size(parts) - 1), lambda i: i % 2 == 1)
        return F.transform(odd, lambda i: F.struct(
            F.get(at, i).alias("start"), F.lit(rank).alias("rank"),
            (F.get(at, i) + F.char_length(F.get(parts, i))).alias("end"), F.lit(kind).alias("kind"),
            F.replace(F.get(parts, i), F.lit(DOT), F.lit(".")).alias("value"),
            F.replace(F.right(F.get(parts, i - 1), F.lit(context)), F.lit(DOT), F.lit(".")).alias("left"),
            F.substring(F.get(parts, i + 1), 1, 1).alias("right")))

    return _let(F.split(marked, CUT, -1),
                lambda parts: _let(F.struct(parts.alias("parts"), starts(parts).alias("at")), spans))


def _such(spans: Column, holds) -> Column:
    return F.filter(spans, lambda s: holds(s["value"]))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    doubled = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 1, d.cast("int") * 2).otherwise(
        d.cast("int")))
    total = F.aggregate(doubled, F.lit(0), lambda s, d: s + F.when(d > 9, d - 9).otherwise(d))
    return total % 10 == 0


def _found(text: Column) -> dict[str, Column]:
    """The spans of every kind; kinds whose texts lack a needed character are not searched."""
    none = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string,value:string,left:string,right:string>>")
    digits, at = text.rlike("[0-9]"), F.contains(text, F.lit("@"))
    marked = {
        "email": (at, F.regexp_replace(F.regexp_replace(text, r"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])", DOT),
                                       _EMAIL, f"{CUT}$1{CUT}")),
        "ip": (digits, F.regexp_replace(text, _IP, f"{CUT}$1{CUT}")),
        "card": (digits, F.regexp_replace(text, _CARD_EDGE, CUT)),
        "phone": (digits & F.contains(text, F.lit("+")), F.regexp_replace(text, _PHONE, f"{CUT}$1{CUT}")),
        "email_at": (text.rlike(r"(?i)\bat\b"), F.regexp_replace(text, _LOOSE["email_at"], f"{CUT}$1{CUT}")),
    } | {k: (digits, F.regexp_replace(text, _LOOSE[k], f"{CUT}$1{CUT}")) for k in EXTRA if k != "email_at"}
    right = {
        "ip": lambda v: v.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"),
        "card": lambda v: F.char_length(_digits(v)).between(14, 19) & _luhn(_digits(v)),
        "phone": lambda v: F.char_length(_digits(v)).between(10, 15),
    }
    out = {}
    for rank, kind in enumerate(BASE + EXTRA):
        needed, m = marked[kind]
        spans = _pieces(m, kind, rank)
        if kind in right:
            spans = _such(spans, right[kind])
        out[kind] = F.when(needed, spans).otherwise(none)
    return out


def _votes(s: Column) -> Column:
    """One vote a labeler: 1 yes, 0 no, -1 none."""
    v, kind, digits = s["value"], s["kind"], _digits(s["value"])
    base = kind.isin(*BASE)
    strict = (F.when(base, 1)
              .when(kind == "ssn", F.when(v.rlike("^(?:000|666|9)|-00-|-0000$"), 0).otherwise(1))
              .when(kind == "phone_local", F.when(v.rlike(r"^\(?[2-9][0-9]{2}\)?[ .-]{1,2}[2-9]"), 1).otherwise(0))
              .when(kind == "iban", F.when(F.char_length(F.replace(v, F.lit(" "), F.lit(""))).between(15, 34), 1).otherwise(0))
              .otherwise(-1))
    known = (F.when(kind.isin("email", "email_at"), F.when(v.rlike(_DOMAINS), 1).otherwise(0))
             .when(kind == "card", F.when(v.rlike(_ISSUERS), 1).otherwise(0))
             .when(kind == "phone", F.when(v.rlike(_COUNTRIES), 1).otherwise(0))
             .when(kind == "iban", F.when(v.rlike(_IBANS), 1).otherwise(0))
             .when(kind == "ip", F.when(v.rlike(r"^(?:0|127|255)\."), 0).otherwise(-1)).otherwise(-1))
    context = F.when(s["left"].rlike(_CONTEXT), 1).otherwise(-1)
    edges = F.when(s["left"].rlike(r"[A-Za-z0-9]$") | s["right"].rlike("^[A-Za-z0-9]"), 0).otherwise(1)
    variety = F.when(F.char_length(digits) < 7, -1).when(F.size(F.array_distinct(F.split(digits, ""))) <= 2, 0).otherwise(1)
    return F.array(strict, known, context, edges, variety).cast("array<int>")


def _features(s: Column) -> Column:
    """What the classifier sees, as short strings: kind, votes, length, character before and after."""
    n = F.char_length(s["value"])
    shape = F.when(n < 10, "s").when(n < 14, "m").when(n < 20, "l").otherwise("x")
    side = lambda c: F.when(c == "", "e").when(c.rlike(r"\s"), "w").when(c.rlike("[A-Za-z0-9]"), "a").otherwise("p")
    votes = F.transform(s["votes"], lambda v, i: F.concat(F.lit("v"), i.cast("string"), F.lit("="), v.cast("string")))
    return F.concat(F.array(F.concat(F.lit("kind="), s["kind"]), F.concat(F.lit("shape="), shape),
                            F.concat(F.lit("left="), side(F.right(s["left"], F.lit(1)))),
                            F.concat(F.lit("right="), side(s["right"]))), votes)


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, base: the contract's spans; loose: other candidates. Both with votes."""
    text = F.replace(F.replace(text_of(text_col), F.lit(CUT), F.lit("|")), F.lit(DOT), F.lit("|"))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    rows = rows.select("doc_id", *[c.alias(k) for k, c in _found(F.col("text")).items()])

    def voted(kinds):
        return F.transform(F.array_sort(F.concat(*[F.col(k) for k in kinds])), lambda s: F.struct(
            s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"),
            _votes(s).alias("votes"), _features(s.withField("votes", _votes(s))).alias("features")))

    return rows.select("doc_id", voted(BASE).alias("base"), voted(EXTRA).alias("loose"))


def reliabilities(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 50) -> tuple[float, list, list]:
    """EM over counts of vote patterns: share of true spans, each labeler's chance of yes on true and on false ones."""
    n = len(LABELERS)
    share, yes, no = 0.7, [0.8] * n, [0.3] * n
    total = sum(c for _, c in patterns)
    for _ in range(rounds if total else 0):
        t, f = [[1.0, 1.0] for _ in range(n)], [[1.0, 1.0] for _ in range(n)]
        mass = 1.0
        for votes, count in patterns:
            p = posterior(votes, share, yes, no)
            mass += p * count
            for i, v in enumerate(votes):
                if v >= 0:
                    t[i][v] += p * count
                    f[i][v] += (1 - p) * count
        share = min(0.99, max(0.01, mass / (total + 2)))
        yes, no = [x[1] / sum(x) for x in t], [x[1] / sum(x) for x in f]
    return share, yes, no


def posterior(votes, share, yes, no) -> float:
    a, b = math.log(share), math.log(1 - share)
    for i, v in enumerate(votes):
        if v >= 0:
            a += math.log(yes[i] if v else 1 - yes[i])
            b += math.log(no[i] if v else 1 - no[i])
    return 1 / (1 + math.exp(min(50.0, max(-50.0, b - a))))


def span_classifier(found: DataFrame) -> tuple[float, dict[str, float]]:
    """Bias and weight of each feature value: naive Bayes on EM's posteriors.

    What is collected is bounded: a row for each combination of feature values that occurs (at most 8 kinds, 3 ** 5
    votes, 4 shapes, 4 x 4 neighbours).
    """
    spans = found.select(F.explode(F.concat("base", "loose")).alias("s"))
    rows = spans.groupBy(F.col("s.votes").alias("votes"), F.col("s.features").alias("features")).agg(
        F.count(F.lit(1)).alias("n")).collect()
    by_votes: dict[tuple, int] = {}
    for r in rows:
        by_votes[tuple(r.votes)] = by_votes.get(tuple(r.votes), 0) + r.n
    model = reliabilities(sorted(by_votes.items()))
    mass = {True: 1.0, False: 1.0}
    per: dict[str, list[float]] = {}
    for r in rows:
        p = posterior(tuple(r.votes), *model)
        mass[True] += p * r.n
        mass[False] += (1 - p) * r.n
        for x in r.features:
            cell = per.setdefault(x, [0.5, 0.5])
            cell[0] += p * r.n
            cell[1] += (1 - p) * r.n
    bias = math.log(mass[True] / mass[False])
    return bias, {x: math.log(a / mass[True]) - math.log(b / mass[False]) for x, (a, b) in sorted(per.items())}


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of every document."""
    found = written(candidates(docs, id_col, text_col), "pii-candidates")
    bias, weights = span_classifier(found)
    if weights:
        table = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv])
        score = lambda s: F.aggregate(s["features"], F.lit(bias), lambda a, x: a + F.coalesce(table[x], F.lit(0.0)))
        added = F.filter("loose", lambda s: score(s) >= 0)
    else:
        added = F.col("loose")

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                     s["end"].cast("string"))), ",")

    def number(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    key = lambda spans: F.transform(spans, lambda s: F.struct(s["start"], s["rank"], s["end"], s["kind"]))
    merged = F.array_sort(F.concat(key("base"), key(added)))
    return found.select("doc_id", *map(number, BASE), F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        joined(merged).alias("spans"))
