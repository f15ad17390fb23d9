"""Property tests: each hypothesis example set is evaluated in one Spark job."""

import datetime as dt
import hashlib
import hmac

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from streamcharts.constants import LATENCY_BUCKETS_SECONDS
from streamcharts.functions.privacy import hmac_sha256_hex
from streamcharts.functions.scalars import clamp_limit
from streamcharts.operators import observability as ob

SETTINGS = settings(max_examples=15, deadline=None)


@SETTINGS
@given(st.lists(st.text(max_size=40), min_size=1, max_size=30), st.binary(min_size=1, max_size=100))
def test_hmac_equals_python_for_any_text(spark, values, salt):
    df = spark.createDataFrame([(v,) for v in values], "u string")
    got = [r[0] for r in df.select(hmac_sha256_hex(F.col("u"), salt)).collect()]
    assert got == [hmac.new(salt, v.encode(), hashlib.sha256).hexdigest() for v in values]


@given(st.one_of(st.none(), st.integers(min_value=0, max_value=10_000), st.text(max_size=5)))
def test_clamp_limit_in_range(limit):
    assert 1 <= clamp_limit(limit, 10, 50) <= 50


@SETTINGS
@given(st.lists(st.floats(min_value=0.0, max_value=8.0, allow_nan=False), min_size=1, max_size=60))
def test_histogram_quantile_is_bounded_and_monotone(spark, durations):
    t0 = dt.datetime(2024, 1, 1)
    log = spark.createDataFrame([(t0, "s", 200, d) for d in durations],
                                "ts timestamp_ntz, service string, status int, duration_seconds double")
    wide = ob._bucket_counts(log, ["service"])
    qs = [0.1, 0.5, 0.9, 0.95, 0.99]
    row = wide.select(*[ob.quantile_from_buckets(q).alias(f"q{i}") for i, q in enumerate(qs)]).first()
    values = [row[f"q{i}"] for i in range(len(qs))]
    assert all(0.0 <= v <= LATENCY_BUCKETS_SECONDS[-1] for v in values)
    assert values == sorted(values)
