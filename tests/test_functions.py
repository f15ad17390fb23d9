import hashlib
import hmac

import pytest
from pyspark.sql import functions as F

from streamcharts.functions.privacy import hmac_sha256_hex
from conftest import pseudonym
from streamcharts.functions.scalars import clamp_limit, duration_text, premium_allowed, role_at_least


def _py_hmac(salt: bytes, value: str) -> str:
    return hmac.new(salt, value.encode(), hashlib.sha256).hexdigest()


@pytest.mark.parametrize("salt", [b"k", b"streamcharts-salt", b"x" * 64, b"long-salt-" * 10])
def test_hmac_matches_python(spark, salt):
    values = ["42", "user@example.com", "héllo wörld", "", "日本語"]
    df = spark.createDataFrame([(v,) for v in values], "u string")
    got = [r[0] for r in df.select(hmac_sha256_hex(F.col("u"), salt)).collect()]
    assert got == [_py_hmac(salt, v) for v in values]


def test_pseudonym_null_is_anon_and_bigint_is_stringified(spark):
    df = spark.createDataFrame([(None,), (7,)], "u bigint")
    got = [r[0] for r in df.select(pseudonym(F.col("u"), "s")).collect()]
    assert got == ["anon", _py_hmac(b"s", "7")]


def test_pseudonym_stays_in_codegen(spark):
    df = spark.range(3).select(pseudonym(F.col("id")).alias("h"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "*(" in plan and "PythonUDF" not in plan and "BatchEvalPython" not in plan


@pytest.mark.parametrize(
    "limit,default,maximum,expected",
    [(None, 10, 50, 10), (0, 10, 50, 10), ("abc", 10, 50, 10), (float("nan"), 10, 50, 10),
     (5, 10, 50, 5), (500, 10, 50, 50), ("7", 100, 200, 7), (3.9, 10, 50, 3), ("Infinity", 10, 50, 50),
     (0.5, 10, 50, 1)],
)
def test_clamp_limit(limit, default, maximum, expected):
    assert clamp_limit(limit, default, maximum) == expected


def test_clamp_limit_rejects_negative():
    with pytest.raises(ValueError):
        clamp_limit(-1, 10, 50)


def test_duration_text(spark):
    df = spark.createDataFrame([(0,), (59,), (60,), (185,), (3600,)], "s int")
    assert [r[0] for r in df.select(duration_text(F.col("s"))).collect()] == ["0:00", "0:59", "1:00", "3:05", "60:00"]


def test_premium_gate_each_role(spark):
    rows = [(p, r) for p in (True, False) for r in ("free", "premium", "admin", None)]
    df = spark.createDataFrame(rows, "p boolean, r string")
    got = {(p, r): a for p, r, a in df.select("p", "r", premium_allowed(F.col("p"), F.col("r"))).collect()}
    assert got[(True, "free")] is False
    assert all(v for k, v in got.items() if k != (True, "free"))


def test_role_hierarchy(spark):
    df = spark.createDataFrame([("free",), ("premium",), ("admin",), ("root",)], "r string")
    got = [tuple(x) for x in df.select(role_at_least(F.col("r"), "premium"), role_at_least(F.col("r"), "admin")).collect()]
    assert got == [(False, False), (True, False), (True, True), (False, False)]


def test_key_pads_are_redacted_in_plan_text(spark):
    import contextlib
    import io
    import re

    df = spark.range(2).select(pseudonym(F.col("id")).alias("h"))
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    assert "sha2" in text and "redacted" in text
    assert not re.search(r"0x[0-9A-Fa-f]{64,}", text)


def test_numbered_pads_and_never_cuts(spark):
    from streamcharts.functions.scalars import numbered

    got = [r[0] for r in spark.createDataFrame([(1,), (9,), (10,), (99,), (100,), (1000,), (None,)], "n int").select(numbered(F.col("n"))).collect()]
    assert got == ["01", "09", "10", "99", "100", "1000", None]
