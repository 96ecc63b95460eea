"""Routing by a table of patterns, logs with a manifest, and payloads as they are spelt in stored lines."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from millrace.sinks.log import keep_newest, routed, subject_regex
from millrace.sinks.manifest import append_measured, manifest, newest_of
from millrace.sinks.publish import serialised
from millrace.sinks.subjects import captures, routed_by_table
from millrace.sources.stored import from_json_lines

PATTERNS = "log string, rank int, pattern string"


def drawn(rng, tokens, longest):
    return ".".join(rng.choice(tokens) for _ in range(rng.randint(1, longest)))


def test_captures_are_those_of_the_regular_expressions(spark):
    rng = random.Random(2)
    topics = sorted({drawn(rng, ["a", "b", "c", "", "a+"], 5) for _ in range(400)} | {""})
    patterns = sorted({drawn(rng, ["a", "b", "*", ">", "", "a+"], 4) for _ in range(300)} | {">", "*", "a.>"})
    table = spark.createDataFrame([(f"l{i % 7}", i % 11, p) for i, p in enumerate(patterns)], PATTERNS)
    got = captures(spark.createDataFrame([(t,) for t in topics], "topic string"), table).collect()
    want = [(t, f"l{i % 7}", i % 11) for i, p in enumerate(patterns) for t in topics if re.search(subject_regex(p).replace(r"\z", r"\Z"), t)]
    assert sorted(tuple(r) for r in got) == sorted((t, log, rank) for t, log, rank in want)
    assert len(want) > 500


def test_messages_come_out_once_with_the_first_log(spark):
    logs = {"x": ["a.*", "b.>"], "y": ["*.b"], "z": [">"]}
    table = [(log, rank, p) for rank, (log, own) in enumerate(logs.items()) for p in own]
    rows = [("a.b", 1), ("a.b", 1), ("c.b", 2), ("b", 3), ("b.c.d", 4), (None, 5), ("a..b", 6)]
    messages = spark.createDataFrame(rows, "topic string, seq int")
    got = routed_by_table(messages, spark.createDataFrame(table, PATTERNS))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, routed(messages, logs).collect()), key=repr)
    none = routed_by_table(messages, spark.createDataFrame([], PATTERNS))
    assert none.count() == len(rows) and none.filter("log is not null").count() == 0


@pytest.mark.parametrize("limit", [0, 1, 400, 3000, 10**9])
def test_a_manifest_keeps_what_a_full_scan_keeps(events, spark, tmp_path, limit):
    rng = random.Random(limit)
    rows = [
        {"timestamp": rng.choice([5, 7, 3_600_000, 3_600_000, 9_000_000, 90_000_000]) + rng.choice([0, 0, 1]), "payload": json.dumps("x" * rng.randrange(40)), "type": rng.choice("ab")}
        for _ in range(120)
    ]
    messages = serialised(events(rows)).withColumn("log", F.col("type")).drop("refused")
    for part in range(3):
        append_measured(messages.filter(F.col("seq") % 3 == part), str(tmp_path))
    names = ["log", "seq", "timestamp", "message"]
    got = newest_of(spark, str(tmp_path), limit)
    assert sorted(map(tuple, got.select(names).collect())) == sorted(map(tuple, keep_newest(messages, limit).select(names).collect()))
    assert set(got.columns) == set(messages.columns)
    assert manifest(spark, str(tmp_path)).agg(F.sum("events")).first()[0] == 120


def test_an_append_that_failed_is_not_read(events, spark, tmp_path):
    messages = serialised(events([(5, "1"), (6, "2")])).withColumn("log", F.lit("l")).drop("refused")
    append_measured(messages, str(tmp_path))
    append_measured(messages, str(tmp_path))
    lines = spark.read.parquet(f"{tmp_path}/manifest").collect()
    spark.createDataFrame([r for r in lines if r["append"] == lines[0]["append"]]).write.parquet(f"{tmp_path}/fewer")
    folder = tmp_path / "manifest"
    for name in folder.iterdir():
        name.unlink()
    spark.read.parquet(f"{tmp_path}/fewer").write.mode("append").parquet(str(folder))
    assert newest_of(spark, str(tmp_path), 10**6).count() == 2


def test_payloads_keep_their_spelling(spark):
    payloads = [
        '{"b":1.0,"a": 1e2}', "[1.50,  2]", "1e2", "-0.10", r'"a\néb"', "null", "true", "{ }", '{"x":{"type":"t"}}',
        '{"type":"a","payload":2}', '"},"', '"a,\\"type\\":\\"b\\"}"',
    ]
    shapes = [
        '{{"source":"s","type":"t","timestamp":5,"payload":{}}}',
        ' {{ "payload" : {} , "source":"s","type" : "t","timestamp":5 }} ',
        '{{"type":"t","payload":{},"timestamp":5,"source":"s"}}',
    ]
    lines = [(shape.format(p), p) for shape in shapes for p in payloads]
    got = from_json_lines(spark.createDataFrame(lines, "value string, want string")).collect()
    assert all(tuple(r)[1:4] == ("s", "t", 5) for r in got)
    assert [r.payload for r in got] == [r.want for r in got]


def test_payloads_beside_other_things_are_the_same_json(spark):
    lines = [
        ('{"payload":{"b":1,"a":2},"more":{"x":[1]}}', {"a": 2, "b": 1}),
        ('{"payload":1,"payload":{"a":[2]}}', {"a": [2]}),
        (r'{"source":"q\"","payload":{"a": 1}}', {"a": 1}),
        ('{"type":"t"}', None),
        ("junk", None),
        (None, None),
    ]
    got = from_json_lines(spark.createDataFrame([(line,) for line, _ in lines], "value string")).collect()
    assert [r.payload and json.loads(r.payload) for r in got] == [want for _, want in lines]


def test_levels_near_the_root_are_joined_by_their_own_size(spark, monkeypatch):
    """All topics pass the root: what meets them there is counted by level, not over all patterns."""
    from millrace.sinks import subjects

    counted = []
    join = subjects.bounded_join
    monkeypatch.setattr(subjects, "bounded_join", lambda df, small, on, rows, how="left": counted.append((on, rows)) or join(df, small, on, rows, how))
    patterns = spark.createDataFrame([("l", i, f"a.b.u{i}") for i in range(50)], "log string, rank int, pattern string")
    topics = spark.createDataFrame([("a.b.u7",), ("a.b.x",)], "topic string")
    assert [(r.topic, r["rank"]) for r in subjects.captures(topics, patterns).collect()] == [("a.b.u7", 7)]
    ends, steps = ([rows for on, rows in counted if len(on) == n] for n in (1, 2))
    assert ends == [0, 0, 0, 50] and steps == [1, 1, 50]
