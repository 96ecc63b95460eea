"""Serialising, routing, retention, replay, counters."""

import json
import random

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from millrace import PipelineSpec, metrics, run
from millrace.plans.spec import Threshold
from millrace.sinks.log import captured_by, keep_newest, keep_young, replay, routed
from millrace.sinks.publish import (
    append,
    append_all,
    publishable,
    published,
    quarantined,
    serialised,
    start_append_all,
    valid_topic,
)


def test_envelope_text(events):
    payloads = ['{"price":"42000.50","b":1.0}', "null", None, " [1, 2]", '"x"', "1e400", "oops", "", '{"a":1} x']
    good, bad = publishable(events([(1700000000000 + i, p) for i, p in enumerate(payloads)]))
    texts = {r.seq: r.message for r in good.collect()}
    assert texts[0] == (
        '{"source":"s","type":"e","timestamp":1700000000000,"payload":{"price":"42000.50","b":1.0}}'
    )
    assert [json.loads(texts[i])["payload"] for i in range(1, 5)] == [None, None, [1, 2], "x"]
    assert texts[5].endswith('"payload":1e400}')
    assert sorted(r.seq for r in bad.collect()) == [6, 7, 8]


def test_topics(spark):
    names = {
        "my.topic": True, "a": True, "A-b_c.1": True, "has spaces!": False, "events.>": False, "a.*": False,
        "": False, "a\n": False, "é": False,
    }
    df = spark.createDataFrame([(name,) for name in names], "topic string")
    assert {r.topic: r.ok for r in df.select("topic", valid_topic().alias("ok")).collect()} == names


def test_routing_and_replay(events):
    topics = ["rt.test", "rt", "rt.a.b", "other.x", "rtx.a", "other"]
    df = events([{"topic": topic, "timestamp": 100 - i} for i, topic in enumerate(topics)])
    logs = {"main": ["rt.>"], "rest": ["other.*", "rt.test"]}
    found = {r.topic: r.log for r in routed(df, logs).collect()}
    assert found == {
        "rt.test": "main", "rt": None, "rt.a.b": "main", "other.x": "rest", "rtx.a": None, "other": None,
    }
    assert [r.topic for r in replay(df, "rt.>").collect()] == ["rt.a.b", "rt.test"]
    assert df.filter(captured_by([])).count() == 0


def test_age_limit(events):
    df = events([(t, "1") for t in (0, 99, 100, 200)])
    assert [r.seq for r in keep_young(df, 200, 100).orderBy("seq").collect()] == [2, 3]
    assert keep_young(df, 10**15, 0).count() == 4


@pytest.mark.parametrize("limit", [0, 1, 700, 2500, 3000, 10**9])
def test_size_limit(events, limit):
    rng = random.Random(limit)
    rows = []
    for i in range(200):
        time = rng.choice([rng.randrange(20_000_000), 7_000_000, 7_000_001])
        rows.append({"timestamp": time, "payload": "x" * rng.randrange(1, 40), "topic": rng.choice("aab")})
    df = events(rows).withColumn("log", F.col("topic"))
    want = []
    for log in "ab":
        own = [(r["timestamp"], i, len(r["payload"])) for i, r in enumerate(rows) if r["topic"] == log]
        left = limit
        for _, i, size in sorted(own, reverse=True):
            left -= size
            if limit and left < 0:
                break
            want.append(i)
    kept = keep_newest(df, limit, F.octet_length("payload"))
    assert sorted(r.seq for r in kept.collect()) == sorted(want)


def test_append_and_read_back(events, spark, tmp_path):
    good, _ = publishable(events([{"topic": "rt.test", "payload": '{"key":"value"}', "timestamp": 86_400_000}]))
    path = str(tmp_path / "log")
    append(good, path)
    append(good, path)
    stored = spark.read.parquet(path)
    assert stored.count() == 2
    row = stored.filter("day = date'1970-01-02' and topic_root = 'rt'").first()
    assert json.loads(row.message) == {
        "source": "s", "type": "e", "timestamp": 86_400_000, "payload": {"key": "value"},
    }


def test_one_pass_for_log_and_quarantine(events, spark, tmp_path):
    rows = [{"topic": "rt.a", "payload": p, "timestamp": 86_400_000 + i} for i, p in enumerate(["1", "oops", None, "{}"])]
    append_all(events(rows), f"{tmp_path}/log")
    events(rows).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(events(rows).schema).parquet(f"{tmp_path}/in")
    start_append_all(stream, f"{tmp_path}/live", f"{tmp_path}/checkpoint", availableNow=True).awaitTermination()
    for path in (f"{tmp_path}/log", f"{tmp_path}/live"):
        assert sorted(r.seq for r in published(spark, path).collect()) == [0, 2, 3]
        assert [(r.seq, r.payload, r.message) for r in quarantined(spark, path).collect()] == [(1, "oops", None)]


def test_counters(events):
    rows = [{"type": t, "payload": json.dumps({"v": v})} for t, v in zip("aabaaa", [1, 1, 9, 5, 5.1, 7])]
    rows.append({"type": "a", "payload": "é"})
    df = events(rows)
    spec = PipelineSpec(match_types=("a",), ttl_ms=60_000, threshold=Threshold("v", 1.0))
    fate = run(df, spec, keep_dropped=True)
    assert tuple(metrics.ingested(df).first()) == ("s", 7, 8 * 5 + 10 + 2)
    dropped = {(r.stage, r.events_dropped) for r in metrics.dropped(fate).collect()}
    assert dropped == {("filter", 1), ("dedup", 1), ("threshold", 1)}
    assert tuple(metrics.published(run(df, spec)).first()) == ("s", 4, 3 * 8 + 2)
    report = metrics.reduction(fate).first()
    assert report.events_ingested == (
        report.dropped_filter + report.dropped_dedup + report.dropped_threshold + report.events_published
    )
    assert (report.bytes_ingested, report.bytes_published) == (52, 26)


def test_observed_counts(events):
    seen = Observation()
    metrics.observed(events([(0, "abc"), (1, None)]), seen).count()
    assert seen.get == {"events": 2, "bytes": 3}
