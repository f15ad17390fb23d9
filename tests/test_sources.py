from pyspark.sql import functions as F

from conftest import SF_SMALL
from conftest import decode_messages
from streamcharts.plans import registry as R
from streamcharts.operators import observability as ob
from streamcharts.sources import logs as lg
from streamcharts.sources.streams import message_stream, write_messages


def test_access_log_files_round_trip(spark, scratch):
    lines = R._access_lines(spark, SF_SMALL)
    lines.write.text(f"{scratch}/logs")
    parsed = lg.read_access_log(spark, f"{scratch}/logs")
    cut = parsed.filter(~F.col("parsed")).count()
    assert 0 < cut == parsed.filter("upstream is null").count() and parsed.count() == lines.count()
    assert parsed.filter("tries = 2").count() > 0
    assert parsed.filter("parsed").groupBy("upstream").count().count() == 15  # 5 services x 3 replicas


def test_access_line_with_several_upstreams(spark):
    lines = spark.createDataFrame([
        ('1.2.3.4 "GET /a HTTP/1.1" 200 0.010s -> a:4001, b:4002',), ('1.2.3.4 "GET /a HTTP/1.1" 502 0.010s -> a:4001,b:4002 , c:4003',),
        ('1.2.3.4 "GET /a HTTP/1.1" 200 0.010s -> a:4001',), ("garbage",), (None,)], "value string")
    got = [(r.upstream, r.tries, r.parsed) for r in lg.parse_access_lines(lines).collect()]
    assert got[:4] == [("b:4002", 2, True), ("c:4003", 3, True), ("a:4001", 1, True), (None, None, False)]
    share = {r.upstream: (r.requests, r.share) for r in ob.upstream_share(lg.parse_access_lines(lines)).collect()}
    assert share[None] == (2, None) and share["b:4002"] == (1, round(1 / 3, 6))


def test_batch_publish_then_stream_decode(spark, scratch):
    msgs = R._messages(spark, SF_SMALL)
    write_messages(msgs, "json", f"{scratch}/log")
    q = (decode_messages(message_stream(spark, "json", f"{scratch}/log")).writeStream.format("noop")
         .option("checkpointLocation", f"{scratch}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    assert sum(p["numInputRows"] for p in q.recentProgress) == msgs.count()
    decoded = decode_messages(spark.read.json(f"{scratch}/log"))
    assert decoded.filter(F.col("decode_error") == "malformed_json").count() == 0
